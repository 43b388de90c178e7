"""MinHash near-duplicates by a multi-index Hamming join.

A document's set holds its distinct ``WIDTH``-word shingles; documents with one set are one class.
A class's signature is ``SYMBOLS`` minima under fixed hash functions, cut to 16 bits each. Two
sets of similarity 0.8 differ in more than ``RADIUS`` of 64 symbols with a chance of 3e-7.

The join finds every pair of signatures that differ in at most RADIUS symbols: cut into chunks
whose allowed errors t satisfy sum(t + 1) = RADIUS + 1, such a pair has at least t_i or fewer
errors in some chunk i (pigeonhole). A chunk's allowed errors are enumerated: one key for each
choice of t_i symbols to leave out, so that such a pair shares a key. Pairs that share one are
tested by size and on four bit planes of the signature, in the join itself, and those that remain
are confirmed on their full sets.

Keys with more than ``FEW`` classes (copies of a template) aren't squared. All their rows are
compared with the key's first class. Then, in rounds, the next rows outside that class's
component, in order of their ids, are compared with all rows of other components, until each row
outside has had its turn: no link between components is lost, and a group that the first
comparison joins costs one pair a row.

Null, empty and wordless texts have no shingles and link with nothing. Very long texts are one
row like any other; a task holds the sets of one text at least. Rows with a null doc_id take part
but can't name a component unless all its ids are null; they are kept only then. Rows that repeat
(a doc_id, a text, or both) are one class where their sets agree, and each returned. Empty tables
give no rows. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlake.llm import textkit as tk
from martlake.llm.components import Reader, class_names, components, groups_sql, named, rows_of, settle

WIDTH = 4
#: a link: PERCENT * union <= 100 * intersection
PERCENT = 80
SYMBOLS, CHUNK = 64, 4
#: symbols that a pair of the join may differ in
RADIUS = 30
#: allowed errors of each chunk
ERRORS = (1,) * 15 + (0,)
#: rows of a key that are compared with each other at once
FEW = 12
PLANES, MASKS = 4, 8

_MULTIPLIERS = np.random.default_rng(20_04).integers(1, 1 << 32, SYMBOLS, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
_SALTS = np.random.default_rng(20_05).integers(0, 1 << 63, (SYMBOLS // CHUNK, CHUNK + 1), dtype=np.uint64)


def signatures(sets: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A row of SYMBOLS 16-bit minima for every set, none of them empty."""
    short = (sets >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(first) - 1, SYMBOLS), np.uint16)
    turned = np.empty_like(short)
    for k, m in enumerate(_MULTIPLIERS):
        np.multiply(short, m, out=turned)
        least = np.minimum.reduceat(turned, first[:-1]).astype(np.uint64) if len(out) else np.zeros(0, np.uint64)
        out[:, k] = (tk.mix(least + np.uint64(k + 1)) >> np.uint64(48)).astype(np.uint16)
    return out


def planes(signature: np.ndarray) -> np.ndarray:
    """The lowest PLANES bits of the symbols, a 64-bit word for each plane."""
    return np.stack([np.packbits((signature >> b) & 1, axis=1, bitorder="little").view(np.int64)[:, 0] for b in range(PLANES)])


def chunk_keys(signature: np.ndarray) -> np.ndarray:
    """The keys of every signature (a row each): for each chunk, one for every choice of its
    allowed errors. Signatures within RADIUS share one."""
    chunks = signature.reshape(len(signature), -1, CHUNK).astype(np.uint64)
    keys = []
    for i, errors in enumerate(ERRORS):
        for out in (range(CHUNK) if errors else [CHUNK]):  # the symbol left out; CHUNK: none
            kept = [chunks[:, i, j] for j in range(CHUNK) if j != out]
            packed = kept[0].copy()
            for x in kept[1:]:
                packed = (packed << np.uint64(16)) | x
            keys.append(tk.mix(packed ^ _SALTS[i, out]))
    return np.stack(keys, axis=1).view(np.int64)


_PLANES, _MASKS = [f"p{b}" for b in range(PLANES)], [f"m{b}" for b in range(MASKS)]
_SIGNED = "doc_id long, rid long, class long, n long, signature binary, " + ", ".join(f"{p} long" for p in _PLANES + _MASKS)


def _sign(batches):
    for b in batches:
        buf, off = tk.flat_text(b.column("text"))
        for i, j in tk.doc_groups(off):
            sets, first = tk.shingle_sets(buf[off[i]:off[j]], off[i:j + 1] - off[i], WIDTH)
            n, key = np.diff(first), tk.set_keys(sets, first)
            _, one, each = np.unique(key, return_index=True, return_inverse=True)
            some = one[n[one] > 0]
            held = sets[tk.ragged(first[some], n[some])]
            signed = signatures(held, np.concatenate([[0], np.cumsum(n[some])]))
            rows = np.zeros((len(one), SYMBOLS), np.uint16)
            rows[n[one] > 0] = signed
            rows = rows[each]
            masks = tk.parity_masks(sets, first, MASKS).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").slice(i, j - i), b.column("rid").slice(i, j - i), pa.array(key), pa.array(n),
                 tk.blobs(rows.ravel(), np.arange(len(rows) + 1) * SYMBOLS), *map(pa.array, planes(rows)),
                 *map(pa.array, np.ascontiguousarray(masks.T))], names=["doc_id", "rid", "class", "n", "signature", *_PLANES, *_MASKS])


def _list_keys(batches):
    for b in batches:
        data, _ = tk.flat_text(b.column("signature"))
        keys = chunk_keys(np.frombuffer(data.tobytes(), np.uint16).reshape(-1, SYMBOLS))
        yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(np.repeat(b.column("class").to_numpy(), keys.shape[1]))],
                                         names=["key", "class"])


def _overlaps(batches):
    """The links among pairs of classes with the text of a row of each."""
    for b in batches:
        (x, xo), (y, yo) = tk.flat_text(b.column("text_a")), tk.flat_text(b.column("text_b"))
        for i, j in tk.doc_groups(xo + yo):
            p, pf = tk.shingle_sets(x[xo[i]:xo[j]], xo[i:j + 1] - xo[i], WIDTH)
            q, qf = tk.shingle_sets(y[yo[i]:yo[j]], yo[i:j + 1] - yo[i], WIDTH)
            both = np.array([len(np.intersect1d(p[a:z], q[c:d], assume_unique=True)) for a, z, c, d in zip(pf, pf[1:], qf, qf[1:])], np.int64)
            part = b.slice(i, j - i)
            # of rows that share a row id only those of the classes asked for
            right = (tk.set_keys(p, pf) == part.column("a").to_numpy()) & (tk.set_keys(q, qf) == part.column("b").to_numpy())
            right &= 100 * both >= PERCENT * (np.diff(pf) + np.diff(qf) - both)
            yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b")], names=["u", "v"]).filter(pa.array(right))


#: a pair's sizes allow a link, no more than RADIUS symbols differ in the planes, and the masks in
#: no more bits than a link has members not in common
_FITS = (f"100 * least(n_a, n_b) >= {PERCENT} * greatest(n_a, n_b) AND bit_count("
         + " | ".join(f"({p}_a ^ {p}_b)" for p in _PLANES) + f") <= {RADIUS} AND {100 + PERCENT}L * ("
         + " + ".join(f"bit_count({m}_a ^ {m}_b)" for m in _MASKS) + f") <= {100 - PERCENT}L * (n_a + n_b)")


class Join:
    """The multi-index over the documents' classes."""

    def __init__(self, docs: DataFrame):
        tk.small_batches(docs.sparkSession)
        docs = rows_of(docs)
        self.signed = tk.stored(docs.mapInArrow(tk.tidy(_sign), _SIGNED), "signatures")
        first = [F.first(c).alias(c) for c in ("n", "signature", *_PLANES, *_MASKS)]
        self.classes = tk.stored(self.signed.filter("n > 0").groupBy("class").agg(F.min("rid").alias("rid"), *first), "classes")
        self.sides = self.classes.select("class", "n", *_PLANES, *_MASKS)
        keys = self.classes.select("class", "signature").mapInArrow(_list_keys, "key long, class long")
        counts = keys.groupBy("key").agg(F.count(F.lit(1)).alias("c"), F.min("class").alias("pivot")).filter("c > 1")
        self.cells = tk.stored(keys.join(counts, "key"), "cells")
        wanted = self.cells.select("class").distinct().join(self.classes.select("class", "rid"), "class")
        self.reader = Reader(docs, wanted, _overlaps)

    def small_cells(self) -> DataFrame:
        rows = self.cells.filter(F.col("c") <= FEW).select("key", "class").join(self.sides, "class")
        return named(rows, "a", "key").join(named(rows, "b", "key"), "key").filter(f"class_a < class_b AND {_FITS}") \
            .select(F.col("class_a").alias("a"), F.col("class_b").alias("b"))

    def stars(self) -> DataFrame:
        """Every row of a crowded key with its first class."""
        rows = self.cells.filter((F.col("c") > FEW) & (F.col("class") > F.col("pivot"))).select(F.col("pivot").alias("a"), F.col("class").alias("b"))
        b, a = (named(self.sides, x).withColumnRenamed(f"class_{x}", x) for x in ("b", "a"))
        return rows.distinct().join(b, "b").join(a, "a").filter(_FITS).select("a", "b")

    def components(self) -> DataFrame:
        """(v, root) of the classes that aren't their component's root."""
        links = self.reader.confirm(self.small_cells().unionByName(self.stars()).distinct())
        crowded = self.cells.filter(F.col("c") > FEW).select("key", "class", "pivot", "c")
        return settle(crowded, self.sides, components(links), _FITS, self.reader.confirm)


def groups(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every document: its component's smallest
    doc_id, kept where that is its own."""
    join = Join(docs)
    rows = join.signed.select("doc_id", "class", "n")
    names = class_names(rows.filter("n > 0"), join.components())
    out = rows.filter("n > 0").join(names, "class").select("doc_id", F.col("n").alias("n_shingles"), "component_id") \
        .unionByName(rows.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()))


def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups(tk.read_table(spark, sf_dir, "documents"))


ORACLE_SQL = f"SELECT *, doc_id = component_id AS kept FROM ({groups_sql(WIDTH, PERCENT)})"
