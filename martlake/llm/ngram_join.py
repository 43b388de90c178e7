"""N-gram Jaccard join: blocked sparse product of the document by n-gram incidence matrix.

A row of the matrix is a class of documents with one shingle set, a column a distinct 5-word
shingle (64-bit hash of the lower-cased words). Sets that link share 75 % of the larger one,
so each row only needs its size-derived prefix: its first n - ceil(0.75 n) + 1 shingles in one
global order (common shingles last, each other by hash). The prefix entries are dealt to
column blocks; a block sorts its columns and emits the row pairs that meet in a column and
fit by size. Overlaps of those pairs are then counted over the whole rows, and pairs under
the bound are discarded.

Columns with more than ``FEW`` rows are not squared, and those known to be hot never meet in a
block. Their rows are cut into cells of neighbouring sizes; every row of a cell is compared with
one pivot, and rows outside the pivot's component, in rounds, with the rows of other components
(``components.settle``). A pair counts only where the column can be its first one in common, and
where the parity bitmaps of its rows differ in no more bits than a link allows: the symmetric
difference has at least as many members. No link between components is lost, and copies are
never expanded into pairs.

Null, empty and wordless texts have no shingles and link with nothing. Very long texts are rows
like any other; a task holds the set of one text at least. Rows with a null doc_id take part but
can't name a component unless all its ids are null. Repeated rows are one class. Empty tables
give no rows. Extra columns are ignored, or kept by ``keep_one``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlake.llm import textkit as tk
from martlake.llm.components import Reader, class_names, components, groups_sql, named, rows_of, settle

WIDTH = 5
#: a link: PERCENT * union <= 100 * intersection
PERCENT = 75
#: shingles listed as common at most; their order matters for speed only
COMMON = 1 << 20
#: a shingle counted so often may be listed
LEAST = 9
#: a listed shingle counted so often (in more than FEW classes surely, or in copies) skips the blocks
HOT = 512
FEW = 12
_BLOCK_TEXT = 16 << 20
#: shingles a task holds before it reports them
_HELD = 1 << 20
_MASKS = 8


def _batch_sets(b):
    buf, off = tk.flat_text(b.column("text"))
    for i, j in tk.doc_groups(off):
        yield i, j, *tk.shingle_sets(buf[off[i]:off[j]], off[i:j + 1] - off[i], WIDTH)


_MASK_NAMES = [f"m{k}" for k in range(_MASKS)]
_CLASSIFIED = "doc_id long, rid long, text_hash long, class long, n long, " + ", ".join(f"{m} long" for m in _MASK_NAMES)


def _classify(batches):
    for b in batches:
        for i, j, sets, first in _batch_sets(b):
            masks = tk.parity_masks(sets, first, _MASKS).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c).slice(i, j - i) for c in ("doc_id", "rid", "text_hash")), pa.array(tk.set_keys(sets, first)), pa.array(np.diff(first)),
                 *map(pa.array, np.ascontiguousarray(masks.T))], names=["doc_id", "rid", "text_hash", "class", "n", *_MASK_NAMES])


def _new_classes(batches):
    """(keys, sets, first) of the classes of every piece of text that this task hasn't seen."""
    seen = np.zeros(0, np.int64)
    for b in batches:
        for _, _, sets, first in _batch_sets(b):
            keys, at = np.unique(tk.set_keys(sets, first), return_index=True)
            new = (np.diff(first)[at] > 0) & ~np.isin(keys, seen)
            keys, at = keys[new], at[new]
            if len(keys):
                seen = np.concatenate([seen, keys])
                n = np.diff(first)[at]
                yield keys, sets[tk.ragged(first[at], n)], np.concatenate([[0], np.cumsum(n)])


def _tally(bits):
    """The shingles of every class that a task sees, a row for each of 2^bits spans of their values
    that a piece of some million entries touches. Shingles go by their first 32 + bits bits, the
    last 32 of these beside the span."""
    cuts = np.arange((1 << bits) + 1, dtype=np.uint64) << np.uint64(32)

    def report(held):
        held = np.sort(np.concatenate(held))
        at = np.searchsorted(held, cuts)
        span = np.flatnonzero(np.diff(at))
        return pa.RecordBatch.from_arrays([pa.array(span.astype(np.int32)), tk.blobs(held.astype(np.uint32), np.append(at[span], len(held)))], names=["span", "h"])

    def run(batches):
        held, size = [], 0
        for _, sets, _ in _new_classes(batches):
            held.append(sets >> np.uint64(32 - bits))
            size += len(sets)
            if size > _HELD:
                yield report(held)
                held, size = [], 0
        if held:
            yield report(held)
    return run


def _counts(rows):
    """(h, c) of the shingles of one span that LEAST classes or more hold (or their copies in other tasks)."""
    h, c = np.unique(np.concatenate([np.frombuffer(x.as_buffer(), np.uint32) for x in rows.column("h")]), return_counts=True)
    h, c = h[c >= LEAST], c[c >= LEAST]
    return pa.table({"h": h.astype(np.int64) + (rows.column("span")[0].as_py() << 32), "c": c})


def common_shingles(texts: DataFrame, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first 32 + bits bits of shingles in ascending order, rank by falling count, whether hot) of
    the most common ones, COMMON at most: those above a count that a histogram of counts gives."""
    counts = tk.stored(texts.mapInArrow(tk.tidy(_tally(bits)), "span int, h binary").groupBy("span").applyInArrow(_counts, "h long, c long"), "counts")
    step = F.floor(F.log2("c") * 8).cast("int")
    total, least = 0, None
    for r in sorted(counts.groupBy(step.alias("step")).count().collect(), reverse=True):  # 512 rows at most
        total += r["count"]
        if total > COMMON:
            break
        least = r.step
    top = counts.filter(step >= least) if least is not None else counts.limit(0)
    top = top.toArrow()
    h, c = top["h"].to_numpy(), top["c"].to_numpy()
    order = np.argsort(h)
    h, c = h[order], c[order]
    rank = np.empty(len(h), np.int64)
    rank[np.lexsort((h, -c))] = np.arange(len(h))
    return h.view(np.uint64), len(h) - rank, c >= HOT


def _prefixes(sets, first, common, rank, shift=0):
    """(entries, doc, place, listed) of the prefix of every set; place counts the set's entries
    that come before in the global order, listed is an entry's place among the common ones or -1.
    Common ones go by their bits but the last ``shift``; of the same bits, the order is the hash's."""
    n = np.diff(first)
    need = np.where(n > 0, n - (n * PERCENT + 99) // 100 + 1, 0)
    doc = np.repeat(np.arange(len(n)), n)
    if len(common):
        short = sets >> np.uint64(shift)
        at = np.minimum(np.searchsorted(common, short), len(common) - 1)
        listed = common[at] == short
    else:
        at, listed = np.zeros(len(sets), int), np.zeros(len(sets), bool)
    rare = np.concatenate([[0], np.cumsum(~listed)])
    turn = rare[:-1] - rare[first[:-1]][doc]
    pick = ~listed & (turn < need[doc])
    place = turn.copy()
    short = need - (rare[first[1:]] - rare[first[:-1]])
    more = np.flatnonzero(listed & (short > 0)[doc])
    if len(more):
        more = more[np.lexsort((rank[at[more]], doc[more]))]
        d = doc[more]
        nth = np.arange(len(more)) - np.searchsorted(d, d)
        pick[more[nth < short[d]]] = True
        place[more] = nth + (rare[first[1:]] - rare[first[:-1]])[d]
    where = np.flatnonzero(pick)
    return where, doc[where], place[where], np.where(listed, at, -1)[where]


_DEALT = "block int, keys binary, sizes binary, h binary, row binary, place binary"


def _deal(n_blocks, table, shift=0):
    """The prefix entries of each piece of text, a row for each block they go to, with the keys
    and sizes of the classes that have entries there. Hot entries go to a block by their piece."""
    def run(batches):
        common, rank, hot = table.value
        for keys, sets, first in _new_classes(batches):
            n = np.diff(first)
            where, doc, place, listed = _prefixes(sets, first, common, rank, shift)
            h = sets[where]
            block = (h % np.uint64(n_blocks)).astype(np.int64)
            if len(hot):
                block[(listed >= 0) & hot[listed]] = n_blocks + int(keys[0]) % n_blocks
            order = np.lexsort((doc, block))
            h, doc, block, place = h[order], doc[order], block[order], place[order]
            new = np.concatenate([[True], (block[1:] != block[:-1]) | (doc[1:] != doc[:-1])])
            start = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))  # of each block
            member = np.cumsum(new) - 1
            row = (member - member[start][np.searchsorted(start, np.arange(len(h)), "right") - 1]).astype(np.uint32)
            ends, members = np.append(start, len(h)), np.append(member[start], member[-1] + 1)
            held = doc[new]
            yield pa.RecordBatch.from_arrays(
                [pa.array(block[start].astype(np.int32)), tk.blobs(keys[held], members), tk.blobs(n[held].astype(np.int32), members),
                 tk.blobs(h, ends), tk.blobs(row, ends), tk.blobs(np.minimum(place, 65535).astype(np.uint16), ends)],  # a lower place only filters less
                names=["block", "keys", "sizes", "h", "row", "place"])
    return run


_PAIRS = "a long, b long, na int, nb int, met int, lead boolean, cell long"


def _cells(key, size, h, place):
    """Entries of crowded columns h as rows of two cells each: (class, column, size, place, cell).
    A cell holds two neighbouring size bands, so rows that fit by size share a cell."""
    band = np.floor(np.log(size) / np.log(100 / PERCENT) + 1e-9).astype(np.int64)
    cell = np.concatenate([tk.mix(h * np.uint64(1024) + (band + k).astype(np.uint64)) for k in (0, 1)]).view(np.int64)
    return [np.concatenate([x, x]) for x in (key, h.view(np.int64), size, place)] + [cell]


def _block_pairs(n_blocks):
    """Row pairs of one column block with the number of columns they meet in, and whether one of
    these can be their first in common; with cell set, the entry of row a in cell ``cell`` of
    crowded column b, nb its place in the row."""
    def run(rows):
        def column(name, kind):
            return [np.frombuffer(x.as_buffer(), kind) for x in rows.column(name)]

        keys = column("keys", np.int64)
        base = np.concatenate([[0], np.cumsum([len(x) for x in keys])])
        key, size, h = np.concatenate(keys), np.concatenate(column("sizes", np.int32)), np.concatenate(column("h", np.uint64))
        row = np.concatenate([x.astype(np.int64) + s for x, s in zip(column("row", np.uint32), base)])
        place = np.concatenate(column("place", np.uint16)).astype(np.int32)
        if rows.column("block")[0].as_py() >= n_blocks:
            return table([], [], [], _cells(key[row], size[row], h, place))
        key_order, one = np.unique(key, return_index=True)  # one row number for each class
        row = np.searchsorted(key_order, key)[row]
        key, size = key_order, size[one]
        order = np.lexsort((row, h))
        h, row, place = h[order], row[order], place[order]
        new = np.concatenate([[True], (h[1:] != h[:-1]) | (row[1:] != row[:-1])])
        h, row, place = h[new], row[new], place[new]
        start = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        n = np.diff(np.append(start, len(h)))
        found, leads = [], []
        for k in range(2, FEW + 1):
            s = start[n == k]
            if len(s):
                at = s[:, None] + np.arange(k)
                members, rest = row[at], size[row[at]].astype(np.int64) - place[at]
                i, j = np.triu_indices(k, 1)
                a, b = members[:, i].ravel(), members[:, j].ravel()
                fit = 100 * np.minimum(size[a], size[b]).astype(np.int64) >= PERCENT * np.maximum(size[a], size[b]).astype(np.int64)
                found.append(a[fit] * np.int64(len(key)) + b[fit])
                lead = (100 + PERCENT) * np.minimum(rest[:, i], rest[:, j]).ravel() >= PERCENT * (size[a].astype(np.int64) + size[b])
                leads.append(lead[fit])
        pair, each, met = np.unique(np.concatenate(found or [np.zeros(0, np.int64)]), return_inverse=True, return_counts=True)
        lead = np.zeros(len(pair), bool)
        lead[each[np.concatenate(leads or [np.zeros(0, bool)])]] = True
        a, b = pair // len(key), pair % len(key)
        at = tk.ragged(start[n > FEW], n[n > FEW])
        return table([key[a], key[b], size[a], size[b]], met, lead, _cells(key[row[at]], size[row[at]], h[at], place[at]))

    def table(pairs, met, lead, cells):
        pairs = pairs or [np.zeros(0, np.int64)] * 4
        none = pa.nulls(len(pairs[0]), pa.int64())
        columns = [np.concatenate([x, y]) for x, y in zip(pairs, cells)]
        met = np.concatenate([met, np.zeros(len(cells[4]))]).astype(np.int32)
        lead = np.concatenate([lead, np.zeros(len(cells[4]))]).astype(bool)
        return pa.table({"a": columns[0], "b": columns[1], "na": columns[2].astype(np.int32), "nb": columns[3].astype(np.int32), "met": met, "lead": lead,
                         "cell": pa.concat_arrays([none, pa.array(cells[4])])})
    return run


def _overlaps(batches):
    """The links among pairs of classes with a text of each: overlaps counted over whole rows."""
    for b in batches:
        (x, xo), (y, yo) = tk.flat_text(b.column("text_a")), tk.flat_text(b.column("text_b"))
        for i, j in tk.doc_groups(xo + yo):
            a, af = tk.shingle_sets(x[xo[i]:xo[j]], xo[i:j + 1] - xo[i], WIDTH)
            c, cf = tk.shingle_sets(y[yo[i]:yo[j]], yo[i:j + 1] - yo[i], WIDTH)
            both = np.array([len(np.intersect1d(a[p:q], c[r:s], assume_unique=True)) for p, q, r, s in zip(af, af[1:], cf, cf[1:])], np.int64)
            part = b.slice(i, j - i)
            # of rows that share a row id only those of the classes asked for
            right = (tk.set_keys(a, af) == part.column("a").to_numpy()) & (tk.set_keys(c, cf) == part.column("b").to_numpy())
            right &= 100 * both >= PERCENT * (np.diff(af) + np.diff(cf) - both)
            yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b")], names=["u", "v"]).filter(pa.array(right))


_FITS = f"100 * least(n_a, n_b) >= {PERCENT} * greatest(n_a, n_b)"
# a pair that links has a first column in common, and the overlap is no more than the
# entries of either row from there on
_FIRST = f"{100 + PERCENT}L * least(rest_a, rest_b) >= {PERCENT}L * (n_a + n_b)"
# members of one row only, of a link: at most (100 - PERCENT) / (100 + PERCENT) of both sizes
_MASKED = (f"{100 + PERCENT}L * (" + " + ".join(f"bit_count({m}_a ^ {m}_b)" for m in _MASK_NAMES) + f") <= {100 - PERCENT}L * (n_a + n_b)")
# overlap needed for a link <= prefix columns met + entries behind the longer prefix
_WITHIN_BOUND = (f"{100 + PERCENT} * (met + greatest(floor(({PERCENT} * n_a + 99) / 100), floor(({PERCENT} * n_b + 99) / 100)) - 1)"
                 f" >= {PERCENT} * (n_a + n_b)")


def classes_of(docs: DataFrame) -> DataFrame:
    """(doc_id, rid, text_hash, class, n, masks): every document's class key, number of shingles
    and bitmap."""
    tk.small_batches(docs.sparkSession)
    return rows_of(docs).withColumn("text_hash", F.xxhash64("text")).mapInArrow(tk.tidy(_classify), _CLASSIFIED)


def class_components(docs: DataFrame, classified: DataFrame) -> DataFrame:
    """(v, root): the components of the classes of ``docs`` (doc_id, text), of those that
    aren't their component's root; ``classified`` is ``classes_of(docs)``, stored."""
    spark = docs.sparkSession
    _, size = tk.text_bytes(docs)
    n_blocks = tk.parts_for(size, _BLOCK_TEXT, 12)
    texts = docs.select("text")
    bits = (n_blocks - 1).bit_length()
    listed = spark.sparkContext.broadcast(common_shingles(texts, bits))
    dealt = texts.mapInArrow(tk.tidy(_deal(n_blocks, listed, 32 - bits)), _DEALT)
    met = tk.stored(dealt.groupBy("block").applyInArrow(_block_pairs(n_blocks), _PAIRS), "pairs")

    sides = tk.stored(classified.filter("n > 0").groupBy("class").agg(F.min("rid").alias("rid"), *[F.first(c).alias(c) for c in ("n", *_MASK_NAMES)]), "sides")
    masks = sides.select("class", *_MASK_NAMES)
    # where no row of fitting size can reach the bound from here on, the entry can't be a first one
    entries = (met.filter("cell IS NOT NULL").select(F.col("cell").alias("key"), F.col("b").alias("col"), F.col("a").alias("class"),
                                                     F.col("na").cast("long").alias("n"), (F.col("na") - F.col("nb")).alias("rest")).distinct())
    entries = tk.stored(entries, "entries")
    # columns a pair may meet in besides: no more than either row's entries in crowded columns
    crowded = entries.groupBy("class").agg(F.countDistinct("col").alias("k"))
    cells = entries.filter(f"100L * rest >= {PERCENT}L * n").drop("col")
    cells = cells.join(cells.groupBy("key").agg(F.min("class").alias("pivot"), F.count(F.lit(1)).alias("c")).filter("c > 1"), "key")
    cells = tk.stored(cells, "cells")

    # a pair whose first column in common is crowded is found there
    pairs = met.filter("cell IS NULL").groupBy("a", "b", F.col("na").alias("n_a"), F.col("nb").alias("n_b")) \
        .agg(F.sum("met").alias("met"), F.max("lead").alias("lead")).filter("lead").drop("lead")
    pairs = tk.stored(pairs, "met")
    also = lambda x: crowded.select(F.col("class").alias(x), F.col("k").alias(f"k{x}"))
    side = lambda x: named(masks, x).withColumnRenamed(f"class_{x}", x)
    # only the pairs below the bound need what their rows have in crowded columns
    more = (pairs.filter(f"NOT ({_WITHIN_BOUND})").join(also("a"), "a").withColumn("own", F.col("met")).withColumn("met", F.col("own") + F.col("ka"))
            .filter(_WITHIN_BOUND).join(also("b"), "b").withColumn("met", F.col("own") + F.least("ka", "kb")).filter(_WITHIN_BOUND))
    pairs = (pairs.filter(_WITHIN_BOUND).select("a", "b", "n_a", "n_b").unionByName(more.select("a", "b", "n_a", "n_b"))
             .join(side("a"), "a").join(side("b"), "b").filter(_MASKED).select("a", "b"))
    pivots = named(cells.filter("class = pivot").drop("pivot", "c"), "a", "key").dropDuplicates(["key"])
    stars = (pivots.join(named(cells.filter("class <> pivot").drop("pivot", "c"), "b", "key"), "key").filter(f"{_FITS} AND {_FIRST}")
             .select(F.col("class_a").alias("a"), F.col("class_b").alias("b"), "n_a", "n_b").distinct()
             .join(side("a"), "a").join(side("b"), "b").filter(_MASKED).select("a", "b"))
    pairs = tk.stored(pairs.unionByName(stars).distinct(), "candidates")

    wanted = pairs.select(F.col("a").alias("class")).unionByName(pairs.select(F.col("b").alias("class"))).unionByName(cells.select("class")).distinct()
    reader = Reader(rows_of(docs), wanted.join(sides.select("class", "rid"), "class"), _overlaps)
    return settle(cells, masks, components(reader.confirm(pairs)), f"{_FITS} AND {_FIRST} AND {_MASKED}", reader.confirm)


def groups(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document."""
    classified = tk.stored(classes_of(docs), "classes")
    rows = classified.select("doc_id", "class", "n")
    names = class_names(rows.filter("n > 0"), class_components(docs.select("doc_id", "text"), classified))
    return (rows.filter("n > 0").join(names, "class").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
            .unionByName(rows.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))))


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each group of linked documents: the smallest doc_id's (a null id comes last,
    then the text decides), once where it repeats. Rows without words all stay."""
    classified = tk.stored(classes_of(docs), "classes")
    rows = classified.filter("n > 0").groupBy("class", "doc_id", "text_hash").agg(F.count(F.lit(1)).alias("copies"))
    comp = class_components(docs.select("doc_id", "text"), classified)
    name = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    least = rows.groupBy("class").agg(F.min(name).alias("least")).join(comp.withColumnRenamed("v", "class"), "class", "left") \
        .withColumn("root", F.coalesce("root", "class"))
    first = least.groupBy("root").agg(F.min("least").alias("first"))
    judged = rows.join(least.join(first, "root").select("class", "first"), "class").withColumn("stays", name == F.col("first"))
    judged = tk.stored(judged.select(F.col("doc_id").alias("id"), "text_hash", "stays", "copies"), "judged")

    def among(table):
        return F.col("doc_id").cast("long").eqNullSafe(table["id"]) & (F.xxhash64("text") == table["text_hash"])

    gone, twice = judged.filter("NOT stays").select("id", "text_hash").distinct(), judged.filter("stays AND copies > 1")
    named_docs = docs.select(*[F.col(c).alias(f"_{i}") for i, c in enumerate(docs.columns)], F.col("doc_id"), F.col("text"))
    kept = named_docs.join(gone, among(gone), "left_anti")
    if not twice.isEmpty():
        kept = kept.join(twice, among(twice), "left_anti") \
            .unionByName(kept.join(twice, among(twice), "left_semi").dropDuplicates(["doc_id", "text"]))
    return kept.select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(docs.columns)])


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups(tk.read_table(spark, sf_dir, "documents"))


ORACLE_SQL = groups_sql(WIDTH, PERCENT)
