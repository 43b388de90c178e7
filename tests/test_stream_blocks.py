"""Rows travel to the state function and back in blocks, and a small bucket has few pages."""

import pickle

import pyarrow as pa
import pytest

from martlake.catalog import retail
from martlake.sources.replay import TimeOrdered
from martlake.streaming import jobs as S
from martlake.streaming import ordered as O
from tests.test_stream_state import Store


def test_blocks_hold_every_row_once():
    rows = [(k % 5, None if k % 11 == 0 else 1000 - k, None if k % 13 == 0 else k, k + 2**60, None if k % 3 else "c") for k in range(3000)]
    t = pa.table(list(map(list, zip(*rows))), schema=pa.schema([("bucket", pa.int32()), *[(n, pa.int64()) for n in ("at", "id", "x")], ("s", pa.string())]))
    got, n = [], 0
    for b in O._pack(iter(t.to_batches(max_chunksize=700))):
        for bucket, low, packed in zip(*[c.to_pylist() for c in b.columns]):
            block, n = pickle.loads(packed), n + 1
            got += [(bucket, *r) for r in block]
            timed = [r[0] for r in block if r[0] is not None and r[1] is not None]
            assert low == (min(timed) if timed else None) and len(timed) in (0, len(block))
    assert sorted(got, key=str) == sorted(rows, key=str) and n == 10
    schema = t.schema.remove(0)
    back = [r for b in O._unpack(schema)([pa.RecordBatch.from_arrays([pa.array([pickle.dumps([r[1:] for r in rows])])], names=["rows"])])
            for r in zip(*[c.to_pylist() for c in b.columns])]
    assert back == [r[1:] for r in rows]


def test_a_small_bucket_takes_few_messages_and_a_large_one_is_cut():
    store = Store()
    for _ in range(3):
        held = O.Pages(store)
        for k in range(2000):
            held.put((k, 1), ((held.get((k, 1)) or (0,))[0] + 1,))
        held.write()
    assert store.messages <= 3 * 3
    held = O.Pages(store)
    for k in range(30_000):
        held.put((k, 2), (k,))
    held.write()
    held = O.Pages(store)
    assert 8 <= held.size <= O.PAGES and all(held.get((k, 2)) == (k,) for k in range(30_000)) and all(held.get((k, 1)) == (3,) for k in range(2000))
    assert max(map(len, held.pages.values())) <= O.MOST
    before = store.messages
    one = O.Pages(store)
    one.get((7, 2))
    assert store.messages == before + 2  # the number of pages, and one of them


@pytest.mark.parametrize("most", [3])
def test_pages_are_cut_while_a_stream_runs(spark, small_dir, monkeypatch, most):
    t = retail(spark, small_dir)
    out = []
    for limit in (O.MOST, most):
        monkeypatch.setattr(O, "MOST", limit)
        src = TimeOrdered(spark, S.with_order(t, t["order_item"]), "order_date", 900, 2)
        out.append(sorted(map(str, S.run(S.low_stock_stream(t, src.rows, delay=src.delay), "cut", src).collect())))
    assert out[0] == out[1] and len(out[0]) > 5000
