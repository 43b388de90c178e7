"""Removal of repeated byte strings by merged Burrows-Wheeler transforms.

A byte goes when a ``WINDOW``-byte string covers it that also starts earlier in the corpus
(smaller doc_id, or same document and earlier start); strings are judged on the input.

Suffixes of a whole corpus can't be interleaved in one place, so they are first cut into
independent buckets. A window's anchor is its ``GRAM``-byte string of least hash (leftmost);
equal windows have equal anchors, and consecutive windows of one anchor form a stretch of
at most WINDOW - GRAM + 1 windows. A first scan finds the strings that would anchor more than
``CROWD`` differing stretches (a line shorter than a window that many documents hold in
different surroundings) and the others such stretches have in common: a window takes one of
these only if it has no other, so its anchor lies in the surroundings. Stretches are grouped by
anchor:

* of stretches with the same bytes the earliest stays to be judged, the others are repeats;
  a scanning task settles the copies among its own documents and deals them by document, so a
  passage that every document holds costs its anchor's bucket one entry for each batch;
* earliest stretches whose anchor no other stretch has are unique;
* the rest, groups in which stretches differ, are read; those with a window hash in common
  are put in suffix order to find the repeated windows: they form shards, each shard's
  Burrows-Wheeler transform is built alone, and the shards' interleave is refined two symbols
  a step (a stable partition by the merged transform), with the boundaries of equal prefixes
  carried along. When the prefixes are WINDOW long, every interval of suffixes is one
  repeated string.

Texts are UTF-8 bytes, null and empty ones hold none. Rows that share a doc_id stand at the
same place: neither is earlier than the other. Null doc_ids come after all others. Very long
texts are rows like any other. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlake.llm import textkit as tk

WINDOW = 100
GRAM = 40
SHARDS = 4
_PART_TEXT = 16 << 20
_SEGMENT = 8 << 20
#: text whose stretches a scanning task holds at once
_BATCH_TEXT = 8 << 20
#: differing stretches beyond which a string is no anchor, and how many a batch must have to report it
CROWD, _REPORT = 4096, 4
_PLACE = np.uint64((1 << 24) - 1)
_CROWDED = np.uint64(1 << 63)
_LAST = np.iinfo(np.int64).max


def _gram_hashes(part: np.ndarray):
    """(sums, hashes): prefix sums of the weighted bytes, and the hash of the gram at each place."""
    n = len(part)
    up, down = tk._powers(n)
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    b = part.astype(np.uint64)
    b += np.uint64(1)
    b *= up[:n]
    np.cumsum(b, out=sums[1:])
    h = sums[GRAM:] - sums[:n + 1 - GRAM]
    h *= down[:n + 1 - GRAM]
    return sums, tk.mix(h)


def _places_of(h: np.ndarray, among: np.ndarray) -> np.ndarray:
    """The places of ``h`` whose value is in ``among`` (sorted, not empty)."""
    low = np.uint64((1 << 22) - 1)
    table = np.zeros(1 << 22, bool)
    table[among & low] = True
    at = np.flatnonzero(table[h & low])
    return at[among[np.minimum(np.searchsorted(among, h[at]), len(among) - 1)] == h[at]]


def _stretches(buf: np.ndarray, off: np.ndarray, crowded: np.ndarray):
    """(anchor hash, hash of the bytes, document, start, windows - 1) of all stretches."""
    out = [[np.zeros(0, t)] for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64)]

    def add(part, edges, first_doc, shift):
        n = len(part)
        if n < WINDOW:
            return
        sums, h = _gram_hashes(part)
        _, down = tk._powers(n)
        # the low bits give way to the place, which makes the leftmost of equal grams least
        key = ((h >> np.uint64(1)) & ~_PLACE) | np.arange(len(h), dtype=np.uint64)
        if len(crowded):
            key[_places_of(h, crowded)] |= _CROWDED
        reach, width = WINDOW - GRAM + 1, 1
        while width * 2 <= reach:
            key = np.minimum(key[:-width], key[width:])
            width *= 2
        if reach > width:
            key = np.minimum(key[:width - reach], key[reach - width:])
        at = (key & _PLACE).astype(np.int64)
        inside = np.zeros(len(at), bool)
        size = np.diff(edges)
        inside[tk.ragged(edges[:-1], np.maximum(size - WINDOW + 1, 0))] = True
        new = inside.copy()
        new[1:] &= ~inside[:-1] | (at[1:] != at[:-1])
        lo = np.flatnonzero(new)
        end = inside.copy()
        end[:-1] &= ~inside[1:] | (at[1:] != at[:-1])
        hi = np.flatnonzero(end)
        text = (sums[hi + WINDOW] - sums[lo]) * down[lo] + (hi - lo).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        doc = np.searchsorted(edges, lo, "right") - 1
        start = lo - edges[doc]
        for o, x in zip(out, (h[at[lo]], tk.mix(text), doc + first_doc, start + shift, hi - lo)):
            o.append(x)

    for i, j in tk.doc_groups(off, min(tk.CHUNK, _SEGMENT)):
        if off[j] - off[i] <= _SEGMENT:
            add(buf[off[i]:off[j]], off[i:j + 1] - off[i], i, 0)
        else:  # one very long document, in segments that share WINDOW - 1 bytes
            for a in range(off[i], off[j], _SEGMENT):
                z = min(a + _SEGMENT + WINDOW - 1, off[j])
                add(buf[a:z], np.array([0, z - a]), i, a - off[i])
    return [np.concatenate(o) for o in out]


def _copies(keys: list[np.ndarray], doc: np.ndarray, start: np.ndarray):
    """(order, first): rows sorted by keys, then place; first marks each key's earliest row.
    Rows at the same place as the earliest are marked too."""
    order = np.lexsort((start, doc, *reversed(keys)))
    same = np.ones(max(len(order) - 1, 0), bool)
    for k in keys:
        same &= k[order][1:] == k[order][:-1]
    head = np.concatenate([[True], ~same]) if len(order) else np.zeros(0, bool)
    lead = np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))
    first = (doc[order] == doc[order][lead]) & (start[order] == start[order][lead])
    return order, head, first


_RUNS = "bucket int, ids binary, rows binary, anchor binary, text binary, doc binary, start binary, more binary, gone int"


def _few(batches):
    for b in batches:
        size = tk.flat_text(b.column("text"))[1]
        for i, j in tk.doc_groups(size, _BATCH_TEXT):
            yield b.slice(i, j - i)


def _common(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(gram hash, occurrences) of the grams that stretches with different bytes and one anchor
    have in common, of a few documents."""
    anchor, text, doc, start, more = _stretches(buf, off, np.zeros(0, np.uint64))

    def often(values):
        _, of, c = np.unique(values, return_inverse=True, return_counts=True)
        return c[of] >= _REPORT

    rows = np.flatnonzero(often(anchor))
    rows = rows[np.unique(text[rows], return_index=True)[1]]
    rows = rows[often(anchor[rows])]
    size = more[rows] + WINDOW
    ends = np.concatenate([[0], np.cumsum(size)])
    hashes = [np.zeros(0, np.uint64)]
    for i, j in tk.doc_groups(ends):
        data = buf[tk.ragged((off[doc] + start)[rows[i:j]], size[i:j])]
        hashes.append(_gram_hashes(data)[1][tk.ragged(ends[i:j] - ends[i], size[i:j] - GRAM + 1)])
    gram, c = np.unique(np.concatenate(hashes), return_counts=True)
    return gram[c >= _REPORT], c[c >= _REPORT]


def _reports(batches):
    for b in _few(batches):
        gram, c = _common(*tk.flat_text(b.column("text")))
        yield pa.RecordBatch.from_arrays([pa.array(gram.view(np.int64)), pa.array(c.astype(np.int64))], names=["gram", "c"])


def crowded_grams(docs: DataFrame) -> np.ndarray:
    """Hashes, sorted, of the grams that more than ``CROWD`` differing stretches have in common.
    They decide how stretches are dealt, not which windows are repeats."""
    total = docs.select("text").mapInArrow(_reports, "gram long, c long").groupBy("gram").agg(F.sum("c").alias("c"))
    found = total.filter(F.col("c") > CROWD).select("gram").toArrow().column("gram").to_numpy()
    return np.sort(found.astype(np.int64).view(np.uint64))


def _scan(n_buckets, crowded):
    def run(batches):
        for b in _few(batches):
            yield _runs(b, n_buckets, crowded)
    return run


def _runs(b, n_buckets: int, crowded: np.ndarray):
    """The stretches of a few documents by bucket, first those to be matched (gone 0, by anchor),
    then those that stand earlier among these documents already (gone 1, by document)."""
    buf, off = tk.flat_text(b.column("text"))
    ids = b.column("doc_id").fill_null(_LAST).to_numpy()
    row = b.column("row").to_numpy()
    anchor, text, doc, start, more = _stretches(buf, off, crowded)
    order, _, first = _copies([text], ids[doc], start)
    gone = np.concatenate([np.zeros(int(first.sum()), np.int64), np.ones(int((~first).sum()), np.int64)])
    rows = np.concatenate([order[first], order[~first]])
    deal = np.where(gone > 0, row.view(np.uint64)[doc[rows]], anchor[rows]) % np.uint64(n_buckets)
    part = gone * n_buckets + deal.astype(np.int64)
    by = np.argsort(part, kind="stable")
    rows, cut = rows[by], np.searchsorted(part[by], np.arange(2 * n_buckets + 1))
    used = np.flatnonzero(np.diff(cut))
    ends = np.append(cut[used], len(rows))
    docs = [np.unique(doc[rows[a:z]], return_inverse=True) for a, z in zip(ends, ends[1:])]
    return pa.RecordBatch.from_arrays(
        [pa.array((used % n_buckets).astype(np.int32)), pa.array([ids[d].tobytes() for d, _ in docs], pa.binary()),
         pa.array([row[d].tobytes() for d, _ in docs], pa.binary()),
         tk.blobs((anchor[rows] // np.uint64(n_buckets)).astype(np.uint32), ends), tk.blobs(text[rows], ends),
         pa.array([i.astype(np.uint32).tobytes() for _, i in docs], pa.binary()), tk.blobs(start[rows].astype(np.uint32), ends),
         tk.blobs(more[rows].astype(np.uint8), ends), pa.array((used // n_buckets).astype(np.int32))],
        names=["bucket", "ids", "rows", "anchor", "text", "doc", "start", "more", "gone"])


_SPANS = "bucket int, doc_id long, row long, start long, stop long, judge boolean"


def _span_table(bucket, doc_id, row, start, stop, judge):
    return pa.table({"bucket": np.full(len(row), bucket, np.int32), "doc_id": pa.array(doc_id, mask=doc_id == _LAST), "row": row,
                     "start": start.astype(np.int64), "stop": stop.astype(np.int64), "judge": judge})


def _match(rows):
    """Of one bucket: byte ranges that are repeats, and stretches to be judged (judge)."""
    def column(name, kind):
        return [np.frombuffer(x.as_buffer(), kind) for x in rows.column(name)]

    ids = column("ids", np.int64)
    base = np.concatenate([[0], np.cumsum([len(x) for x in ids])])
    ids, row = np.concatenate(ids), np.concatenate(column("rows", np.int64))
    anchor, text = np.concatenate(column("anchor", np.uint32)), np.concatenate(column("text", np.uint64))
    docs = column("doc", np.uint32)
    gone = np.repeat(rows.column("gone").to_numpy().astype(bool), [len(d) for d in docs])
    doc = np.concatenate([d.astype(np.int64) + b for d, b in zip(docs, base)])
    start, more = np.concatenate(column("start", np.uint32)).astype(np.int64), np.concatenate(column("more", np.uint8)).astype(np.int64)
    live = np.flatnonzero(~gone)
    order, head, first = _copies([anchor[live], text[live]], ids[doc[live]], start[live])
    order = live[order]
    repeat = np.concatenate([np.flatnonzero(gone), order[~first]])
    heads = order[head]
    a = anchor[heads]  # sorted
    n = np.diff(np.append(np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]])), len(a))) if len(a) else np.zeros(0, int)
    mixed = np.repeat(n > 1, n)
    # rows at one place with one text are judged each
    group = np.cumsum(head) - 1
    judged = order[first & mixed[group]] if len(a) else heads
    at = np.concatenate([repeat, judged])
    return _span_table(rows.column("bucket")[0].as_py(), ids[doc[at]], row[doc[at]], start[at], start[at] + more[at] + WINDOW,
                       np.arange(len(at)) >= len(repeat))


_READ = "bucket int, doc_id long, row long, start long, bytes binary"


def _read(docs, asked):
    """The bytes of the stretches to be judged, from the documents of one part."""
    buf, off = tk.flat_text(docs.column("text"))
    row = docs.column("row").to_numpy()
    order = np.argsort(row, kind="stable")
    want = asked.column("row").to_numpy()
    at = np.minimum(np.searchsorted(row[order], want), max(len(row) - 1, 0))
    found = np.flatnonzero(row[order][at] == want) if len(row) else np.zeros(0, int)
    doc = order[at[found]] if len(row) else found
    asked = asked.take(pa.array(found))
    start, stop = asked.column("start").to_numpy(), asked.column("stop").to_numpy()
    n = stop - start
    data = buf[tk.ragged(off[doc] + start, n)]
    return pa.table({**{c: asked.column(c) for c in ("bucket", "doc_id", "row", "start")},
                     "bytes": tk.blobs(data, np.concatenate([[0], np.cumsum(n)]))})


def shard_transform(symbols: np.ndarray, off: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes, before): the rotations of the strings symbols[off[i]:off[i+1]] in the order
    of their first ``depth`` symbols, and for each the place two symbols before it."""
    n = np.diff(off)
    string = np.repeat(np.arange(len(n)), n)
    begin, size = off[string], n[string]
    place = np.arange(len(symbols)) - begin
    rank, done = symbols.astype(np.int64), 1
    if int(symbols.max()) < 1 << 7:  # eight symbols at once, in one number
        for k in range(1, 8):
            rank = (rank << 7) | symbols[begin + (place + k) % size]
        _, rank = np.unique(rank, return_inverse=True)
        done = 8
    while done < depth:
        key = rank * (int(rank.max()) + 1) + rank[begin + (place + done) % size]
        _, rank = np.unique(key, return_inverse=True)
        done *= 2
        if int(rank.max()) + 1 == len(rank):
            break
    order = np.argsort(rank, kind="stable")
    return order, (begin + (place - 2) % size)[order]


def interleave(shards: list[tuple[np.ndarray, np.ndarray]], depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Merged suffix order of shards given as (symbols, offsets of strings), to ``depth``
    symbols: (shard, suffix) of every place and where a new prefix begins."""
    built = [(shard_transform(s, o, depth), s, o) for s, o in shards]
    wide = max(int(s.max()) for _, s, _ in built) + 1
    pairs = []  # each shard's transform over pairs of symbols
    for (_, before), s, o in built:
        n = np.diff(o)
        string = np.repeat(np.arange(len(n)), n)
        after = o[string] + (np.arange(len(s)) - o[string] + 1) % n[string]
        pair = s[before].astype(np.int64) * wide + s[after[before]]
        pairs.append(pair)
    dense, codes = np.unique(np.concatenate(pairs), return_inverse=True)
    codes = codes.astype(np.uint16 if len(dense) <= 1 << 16 else np.uint32)
    sizes = [len(p) for p in pairs]
    pairs = np.split(codes, np.cumsum(sizes)[:-1])
    order = np.repeat(np.arange(len(shards), dtype=np.uint8), sizes)  # all prefixes of no symbols are equal
    prefix = np.zeros(len(order), np.int32)
    merged = np.empty(len(order), codes.dtype)
    for _ in range(depth // 2):
        for k, p in enumerate(pairs):
            merged[order == k] = p
        by = np.argsort(merged, kind="stable")
        order = order[by]
        m, old = merged[by], prefix[by]
        new = np.empty(len(order), bool)
        new[0] = True
        np.not_equal(m[1:], m[:-1], out=new[1:])
        new[1:] |= old[1:] != old[:-1]
        prefix = np.cumsum(new, dtype=np.int32)
    suffix = np.empty(len(order), np.int64)
    for k, ((own, _), _, _) in enumerate(built):
        suffix[order == k] = own
    return order, suffix, new


def _may_repeat(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Stretches with a window whose hash another window shares: a filter that keeps most
    stretches with a common anchor in uncommon surroundings out of the suffix order."""
    hashes, of = [], []
    for i, j in tk.doc_groups(off):
        n = np.diff(off[i:j + 1]) - WINDOW + 1
        at = tk.ragged(off[i:j] - off[i], n)
        hashes.append(tk.span_hashes(raw[off[i]:off[j]], at, at + WINDOW))
        of.append(np.repeat(np.arange(i, j), n))
    h, of = np.concatenate(hashes), np.concatenate(of)
    order = np.argsort(h)
    h = h[order]
    twin = np.zeros(len(h), bool)
    same = h[1:] == h[:-1]
    twin[1:] |= same
    twin[:-1] |= same
    out = np.zeros(len(off) - 1, bool)
    out[of[order[twin]]] = True
    return out


def _judge(rows):
    """Repeated windows among the differing stretches of one bucket, as byte ranges."""
    raw, off = tk.flat_text(rows.column("bytes"))
    may = _may_repeat(raw, off)
    if not may.any():
        none = np.zeros(0, np.int64)
        return _span_table(0, none, none, none, none, np.zeros(0, bool))
    rows = rows.filter(pa.array(may))
    raw, off = tk.flat_text(rows.column("bytes"))
    ids = rows.column("doc_id").fill_null(_LAST).to_numpy()
    start, row = rows.column("start").to_numpy(), rows.column("row").to_numpy()
    n = np.diff(off)
    used, dense = np.unique(raw, return_inverse=True)
    shards, members = [], []
    for k in range(min(SHARDS, len(n))):
        mine = np.arange(k, len(n), SHARDS)
        size = n[mine] + 1
        ends = np.cumsum(size)
        s = np.zeros(int(ends[-1]), np.int64)  # 0 ends a string
        s[tk.ragged(ends - size, n[mine])] = dense[tk.ragged(off[mine], n[mine])] + 1
        shards.append((s, np.concatenate([[0], ends])))
        members.append(mine)
    order, suffix, new = interleave(shards, WINDOW)
    string, place = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
    for k, (mine, (_, o)) in enumerate(zip(members, shards)):
        at = order == k
        j = np.searchsorted(o, suffix[at], "right") - 1
        string[at], place[at] = mine[j], suffix[at] - o[j]
    # only windows that lie inside their stretch count
    whole = place + WINDOW <= n[string]
    prefix = np.cumsum(new)[whole]
    string, place = string[whole], place[whole]
    _, doc = np.unique(ids, return_inverse=True)
    where = (doc[string].astype(np.int64) << 32) + start[string] + place
    head = np.flatnonzero(np.concatenate([[True], prefix[1:] != prefix[:-1]]))
    least = np.repeat(np.minimum.reduceat(where, head), np.diff(np.append(head, len(where))))
    late = where > least
    place_of = np.sort((off[string] + place)[late])  # by stretch, then place
    cut = np.flatnonzero(np.diff(place_of, prepend=-2) != 1)
    first, last = place_of[cut], place_of[np.append(cut[1:], len(place_of)) - 1] if len(cut) else place_of[cut]
    of = np.searchsorted(off, first, "right") - 1
    same = np.searchsorted(off, last, "right") - 1
    if not np.array_equal(of, same):  # windows of a stretch never reach its last bytes
        raise AssertionError("a run of windows crosses stretches")
    a = first - off[of] + start[of]
    return _span_table(0, ids[of], row[of], a, a + (last - first) + WINDOW, np.zeros(len(of), bool))


def repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, row, start, stop): byte ranges to remove, which may overlap. ``docs`` has
    doc_id, text and row, a hash of both that tells rows of one doc_id apart."""
    _, size = tk.text_bytes(docs)
    n = tk.parts_for(size, _PART_TEXT, 12)
    runs = docs.mapInArrow(_scan(n, crowded_grams(docs)), _RUNS)
    found = tk.stored(runs.repartition(n, "bucket").groupBy("bucket").applyInArrow(_match, _SPANS), "stretches")
    part = F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    asked = found.filter("judge").withColumn("part", part)
    texts = docs.join(asked.select("row").distinct(), "row", "left_semi").withColumn("part", part)
    read = texts.groupBy("part").cogroup(asked.groupBy("part")).applyInArrow(
        lambda d, a: _read(d.select(["row", "text"]), a.drop_columns(["part"])), _READ)
    judged = read.repartition(n, "bucket").groupBy("bucket").applyInArrow(_judge, _SPANS)
    spans = ["doc_id", "row", "start", "stop"]
    return found.filter("NOT judge").select(spans).unionByName(judged.select(spans))


def _strip(docs, spans):
    """Documents of one part without their ranges."""
    buf, off = tk.flat_text(docs.column("text"))
    row = docs.column("row").to_numpy()
    r = spans.column("row").to_numpy()
    a, z = spans.column("start").to_numpy(), spans.column("stop").to_numpy()
    by = np.argsort(r, kind="stable")
    r, a, z = r[by], a[by], z[by]
    lo, hi = np.searchsorted(r, row, "left"), np.searchsorted(r, row, "right")
    removed, spans_of, kept, to = [], [], [], [np.zeros(1, np.int64)]
    for i, j in tk.doc_groups(off):
        part, o = buf[off[i]:off[j]], off[i:j + 1] - off[i]
        n = hi[i:j] - lo[i:j]
        at, doc = tk.ragged(lo[i:j], n), np.repeat(np.arange(j - i), n)
        change = np.zeros(len(part) + 1, np.int32)
        np.add.at(change, o[doc] + a[at], 1)
        np.add.at(change, o[doc] + z[at], -1)
        gone = np.cumsum(change[:-1], dtype=np.int32) > 0
        head = gone.copy()
        head[1:] &= ~gone[:-1]
        begin = o[:-1][np.diff(o) > 0]
        head[begin] = gone[begin]
        total, heads = np.searchsorted(np.flatnonzero(gone), o), np.searchsorted(np.flatnonzero(head), o)
        removed.append(np.diff(total))
        spans_of.append(np.diff(heads))
        kept.append(part[~gone])
        to.append((o - total)[1:] + to[-1][-1])
    join = lambda x, t: np.concatenate(x) if x else np.zeros(0, t)
    return pa.table({"doc_id": docs.column("doc_id"), "n_bytes": np.diff(off), "n_removed": join(removed, np.int64),
                     "n_spans": join(spans_of, np.int64), "kept": tk.blobs(join(kept, np.uint8), np.concatenate(to))})


def strip_repeats(docs: DataFrame, digest: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept: the remaining bytes) of every document;
    with ``digest`` kept_sha256 in place of kept."""
    def run(d, s):
        out = _strip(d, s)
        if digest:
            sha = [hashlib.sha256(x.as_buffer()).hexdigest() for x in out.column("kept")]
            out = out.drop_columns(["kept"]).append_column("kept_sha256", pa.array(sha, pa.string()))
        return out

    docs = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("row"))
    _, size = tk.text_bytes(docs)
    part = F.pmod(F.xxhash64("row"), F.lit(tk.parts_for(size, _PART_TEXT, 12))).cast("int")
    spans = tk.stored(repeats(docs), "repeats")
    both = docs.withColumn("part", part).groupBy("part").cogroup(spans.withColumn("part", part).groupBy("part"))
    last = "kept_sha256 string" if digest else "kept binary"
    return both.applyInArrow(run, f"doc_id long, n_bytes long, n_removed long, n_spans long, {last}")


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return strip_repeats(tk.read_table(spark, sf_dir, "documents"), digest=True)
