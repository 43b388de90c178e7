"""A stateful processor that applies rows in event-time order behind the watermark.

Keys of a table (members, stock pairs, orders) are dealt to ``BUCKETS`` virtual buckets by hash, a
fixed number, and those of a bucket to pages, whose number the bucket's state holds: a query may be
stopped, its tables may grow, and it goes on from its checkpoint. Python is entered once for each
bucket and micro-batch. A page is one state entry, the keys and values of its part of the bucket; a
micro-batch reads and writes the pages of the rows it applies, each once. A message to the state
store takes as long as some hundred entries, so pages are few as long as a bucket is small. (With
256 pages from the start, messages took nine tenths of the time of a micro-batch; with an entry for
every key each row went to the state store three or four times.)

Rows reach the state function in blocks: what a task has for a bucket is packed as one value before
it is dealt out, and results leave in blocks too and are unpacked behind it. (Row by row, Spark's
own way into Python and out takes several times as long as applying a row.) A block waits in its
bucket's list until the watermark has passed its earliest row; it isn't opened before. A row that
the watermark has passed before it arrives is returned at once with code LATE and changes nothing.
Rows without an event time can't be ordered: they are returned with their own code, or NO_TIME.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Callable
from dataclasses import dataclass
from operator import itemgetter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming.stateful_processor import StatefulProcessor
from pyspark.sql.types import Row, StructType

#: for the life of a checkpoint: buckets, and pages of a bucket at most
BUCKETS, PAGES = 256, 256
#: entries of a page, unless a bucket has all its pages; the place of a bucket's number of pages
MOST, _SIZE = 4096, -1
#: rows that a task packs at once, and results in a block
_PACK, _BLOCK = 64_000, 8_000
LATE, NO_TIME = "LATE", "NO_TIME"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def micros(time: Column | str) -> Column:
    """Microseconds since 1970 of a TIMESTAMP_NTZ, in no time zone."""
    c = F.col(time) if isinstance(time, str) else time
    return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH), c.cast("timestamp_ntz"))


def from_micros(column: str) -> Column:
    return F.timestamp_add("MICROSECOND", F.col(column), F.expr(_EPOCH))


def bucket(*columns: str) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(BUCKETS)).cast("int").alias("bucket")


@dataclass
class Rules:
    """What a stream does with its rows; every function gets plain tuples.

    Rows are ``row`` (DDL of "at long, id long, ..."; a row without an id is a closing row),
    state entries ``key`` -> ``value``, results ``out``; waiting rows and entries are stored packed.
    """
    row: str
    key: str
    value: str
    out: str
    #: (get, put, row) -> output rows; get(key) gives an entry or None, put(key, value) sets it
    apply: Callable
    #: (row, code) -> output rows of a row that isn't applied
    refuse: Callable
    #: row -> (key, value) where the row opens an entry, else None
    opens: Callable = lambda row: None
    #: (get, put, key, at) -> output rows when a wake-up time that apply asked for has passed
    wake: Callable | None = None


class Pages:
    """The state entries of a bucket that one call touches: their pages, each read and written once.

    A bucket begins with one page; when one has more than ``MOST`` entries, there are twice as many.
    How many there are is an entry of the state too."""

    def __init__(self, held):
        self.held, self.pages, self.changed = held, {}, set()
        stored = held.getValue((_SIZE,))
        self.size = 1 if stored is None else pickle.loads(bytes(stored[0]))

    def _load(self, n: int) -> dict:
        if n not in self.pages:
            stored = self.held.getValue((n,))
            self.pages[n] = {} if stored is None else pickle.loads(bytes(stored[0]))
        return self.pages[n]

    def _place(self, key: tuple) -> int:
        return zlib.crc32(repr(key).encode()) % self.size

    def get(self, key: tuple) -> tuple | None:
        return self._load(self._place(key)).get(key)

    def put(self, key: tuple, value: tuple) -> None:
        n = self._place(key)
        self._load(n)[key] = value
        self.changed.add(n)

    def _grow(self) -> None:
        entries = [self._load(n) for n in range(self.size)]
        while self.size < PAGES and max(map(len, entries)) > MOST:
            # what was on page n goes to n and n + size
            self.size *= 2
            entries += [{} for _ in entries]
            for page in entries[:self.size // 2]:
                for key in [k for k in page if self._place(k) >= self.size // 2]:
                    entries[self._place(key)][key] = page.pop(key)
        self.pages = dict(enumerate(entries))
        self.changed = set(self.pages)
        self.held.updateValue((_SIZE,), (pickle.dumps(self.size),))

    def write(self) -> None:
        if self.size < PAGES and any(len(self.pages[n]) > MOST for n in self.changed):
            self._grow()
        for n in self.changed:
            self.held.updateValue((n,), (pickle.dumps(self.pages[n]),))


def _values(column) -> list:
    """The Python values of an Arrow column; numbers by way of numpy, which is many times faster."""
    import pyarrow.types as pt
    if column.null_count == len(column):
        return [None] * len(column)
    if not pt.is_integer(column.type):
        return column.to_pylist()
    if not column.null_count:
        return column.to_numpy().tolist()
    out = column.fill_null(0).to_numpy().tolist()
    for i in column.is_null().to_numpy(zero_copy_only=False).nonzero()[0].tolist():
        out[i] = None
    return out


def _pack(batches):
    """Rows (bucket, at, id, ...) -> (bucket, low, rows): the rows of a bucket packed, with their
    earliest time. Rows without a time or an id have blocks of their own, without one."""
    import numpy as np
    import pyarrow as pa

    def blocks(held):
        t = pa.Table.from_batches(held).combine_chunks()
        plain = t.column(1).is_null().to_numpy() | t.column(2).is_null().to_numpy()
        at = t.column(1).fill_null(0).to_numpy()
        group = t.column(0).to_numpy().astype(np.int64) * 2 + plain
        order = np.argsort(group, kind="stable")
        rows = list(zip(*[_values(c.combine_chunks()) for c in t.columns[1:]]))
        starts = np.flatnonzero(np.diff(group[order], prepend=-1))
        low = np.minimum.reduceat(at[order], starts).tolist()
        ends = [*starts[1:].tolist(), len(order)]
        places = order.tolist()
        packed = [pickle.dumps([rows[k] for k in places[i:j]]) for i, j in zip(starts.tolist(), ends)]
        first = group[order][starts]
        return pa.RecordBatch.from_arrays(
            [pa.array(first // 2, pa.int32()), pa.array([None if g & 1 else x for g, x in zip(first.tolist(), low)], pa.int64()), pa.array(packed, pa.binary())],
            names=["bucket", "low", "rows"])

    held, n = [], 0
    for b in batches:
        if b.num_rows:
            held.append(b)
            n += b.num_rows
        if n >= _PACK:
            yield blocks(held)
            held, n = [], 0
    if held:
        yield blocks(held)


def _unpack(schema):
    """Blocks of results -> their rows."""
    def run(batches):
        import pyarrow as pa
        for b in batches:
            for block in b.column(0):
                columns = zip(*pickle.loads(block.as_py()))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
    return run


class Ordered(StatefulProcessor):
    def __init__(self, rules: Rules):
        self.rules = rules
        self.block = Row("rows")

    def init(self, handle):
        r = self.rules
        self.handle = handle
        self.waiting = handle.getListState("waiting", "low long, rows binary")
        self.held = handle.getMapState("held", "page int", "entries binary")
        self.next = handle.getValueState("next", "at long")
        self.due = handle.getListState("due", f"at long, {r.key}") if r.wake else None

    def handleInputRows(self, key, rows, timerValues):
        mark = self._mark(timerValues)
        out, fresh, opened = [], [], {}
        for _, low, packed in rows:
            if low is not None and low >= mark:
                fresh.append((low, bytes(packed)))
                continue
            kept = []
            for row in pickle.loads(bytes(packed)):
                entry = self.rules.opens(row)
                if entry is not None:
                    opened.setdefault(*entry)
                elif row[1] is None:
                    pass  # a closing row
                elif row[0] is None:
                    out += self.rules.refuse(row, NO_TIME)
                elif row[0] < mark:
                    out += self.rules.refuse(row, LATE)
                else:
                    kept.append(row)
            if kept:
                fresh.append(_block(kept))
        held = Pages(self.held)
        for k, value in opened.items():
            if held.get(k) is None:
                held.put(k, value)
        out += self._pass(mark, fresh, held)
        held.write()
        yield from self._blocks(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        held = Pages(self.held)
        out = self._pass(self._mark(timerValues), [], held)
        held.write()
        yield from self._blocks(out)

    def _blocks(self, out):
        for i in range(0, len(out), _BLOCK):
            yield self.block(pickle.dumps(out[i:i + _BLOCK]))

    @staticmethod
    def _mark(timer_values) -> float:
        """The watermark in microseconds; a query that hasn't one yet is behind every event."""
        ms = timer_values.getCurrentWatermarkInMs()
        return ms * 1000 if ms > 0 else float("-inf")

    def _pass(self, mark, fresh, held: Pages) -> list[tuple]:
        """Applies what the watermark has passed and stores what hasn't; ``fresh`` are blocks."""
        next_ = self.next.get() if self.next.exists() else None
        next_ = None if next_ is None else next_[0]
        wake = min([low for low, _ in fresh], default=None)
        out = []
        if next_ is not None and next_ < mark:
            get, put, apply = held.get, held.put, self.rules.apply
            waiting = [(low, bytes(packed)) for low, packed in self.waiting.get()] if self.waiting.exists() else []
            ready, kept, due = [], [], []
            for low, packed in waiting:
                if low >= mark:
                    kept.append((low, packed))
                    continue
                rows = pickle.loads(packed)
                late = [r for r in rows if r[0] >= mark]
                ready += [r for r in rows if r[0] < mark] if late else rows
                if late:
                    kept.append(_block(late))
            ready.sort(key=itemgetter(0, 1))
            for row in ready:
                out += apply(get, put, row, due)
            kept += fresh
            if kept:
                self.waiting.put(kept)
            elif waiting:
                self.waiting.clear()
            times = [low for low, _ in kept]
            if self.due is not None:
                due += [tuple(r) for r in self.due.get()] if self.due.exists() else []
                for at, *k in sorted(d for d in due if d[0] < mark):
                    out += self.rules.wake(get, put, tuple(k), at)
                due = [d for d in due if d[0] >= mark]
                if due:
                    self.due.put(due)
                elif self.due.exists():
                    self.due.clear()
                times += [d[0] for d in due]
            wake = next_ = min(times, default=None)
        else:
            if fresh:
                self.waiting.appendList(fresh)
            next_ = wake if next_ is None else min(next_, wake) if wake is not None else next_
            wake = next_ if wake is not None else None
        if next_ is None:
            self.next.clear()
        elif wake is not None:
            self.next.update((next_,))
            self.handle.registerTimer(next_ // 1000 + 1)
        return out


def _block(rows: list[tuple]) -> tuple[int, bytes]:
    return min(r[0] for r in rows), pickle.dumps(rows)


def ordered(rows: DataFrame, openings: DataFrame | None, rules: Rules, delay: str) -> DataFrame:
    """The stream of results of ``rows`` (bucket, at, id, ...) under ``rules``; ``openings``, a
    stream with the same columns, opens state entries."""
    # the only state store that transformWithState runs on
    rows.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKSDB)
    marked = rows.withColumn("_event_time", F.timestamp_micros("at")).withWatermark("_event_time", delay)
    # the operator doesn't see the event-time column, so Spark hands it late rows as well
    both = marked.drop("_event_time")
    if openings is not None:
        both = both.unionByName(openings)
    blocks = both.mapInArrow(_pack, "bucket int, low long, rows binary")
    results = blocks.groupBy("bucket").transformWithState(Ordered(rules), "rows binary", "append", "eventTime")
    return results.mapInArrow(_unpack(to_arrow_schema(StructType.fromDDL(rules.out))), rules.out)
