"""Connected components of an edge table by alternating large-star and small-star steps, and
the components of keys too crowded for all their pairs.

Between the steps each task contracts the edges it holds (some 100,000). A step is an aggregation
(minimum neighbour, combined before the shuffle) and a join that Spark can split on a hot vertex;
edges are written to the shared folder after it.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F

from martlake.llm import textkit as tk


def _forest(batches):
    """A task's edges, contracted: an edge from each vertex to the least one it reaches here."""
    edges = [(b.column("u").to_numpy(), b.column("v").to_numpy()) for b in batches]
    if not edges:
        return
    u, v = (np.concatenate(x) for x in zip(*edges))
    names, ends = np.unique(np.concatenate([u, v]), return_inverse=True)
    root = np.arange(len(names))
    a, b = ends[:len(u)], ends[len(u):]
    while True:  # hook every root to the least neighbouring one, then halve the paths
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        if (low == high).all():
            break
        np.minimum.at(root, high, low)
        while (root[root] != root).any():
            root = root[root]
    far = np.flatnonzero(root != np.arange(len(names)))
    yield pa.RecordBatch.from_arrays([pa.array(names[far]), pa.array(names[root[far]])], names=["u", "v"])


def _is_forest_of_stars(edges: DataFrame) -> bool:
    """Whether every vertex is the centre of a star or has one edge, to such a centre."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("leaf"), F.lit(0).alias("centre")) \
        .unionByName(edges.select(F.col("v").alias("x"), F.lit(0).alias("leaf"), F.lit(1).alias("centre")))
    bad = ends.groupBy("x").agg(F.sum("leaf").alias("leaf"), F.max("centre").alias("centre")).filter("leaf + centre > 1")
    return bad.isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(v, root) for every vertex v of ``edges`` (u, v) that isn't the least vertex of its
    component; root is that least vertex. Self loops and repeats don't matter."""
    e = edges.select(F.greatest("u", "v").cast("long").alias("u"), F.least("u", "v").cast("long").alias("v")).filter("u <> v")
    n = e.count()
    while True:
        # each task contracts its edges, so that few steps are left
        e = tk.stored(tk.narrow(e, n).mapInArrow(_forest, "u long, v long").distinct().transform(tk.narrow, n), "edges")
        if _is_forest_of_stars(e):
            return e.select(F.col("u").alias("v"), F.col("v").alias("root"))
        n = 2 * e.count()  # no step makes more edges than both directions of those before
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        large = tk.stored(tk.narrow(large, n), "edges")
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        e = (large.join(lower, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
             .unionByName(lower.select("u", F.col("m").alias("v"))).distinct())


def named(table: DataFrame, suffix: str, *keep: str) -> DataFrame:
    """``table`` with a suffix behind the names of all columns but those to keep."""
    return table.select(*[c if c in keep else F.col(c).alias(f"{c}_{suffix}") for c in table.columns])


def _labelled(rows: DataFrame, comp: DataFrame) -> DataFrame:
    """``rows`` with the label of their class: its component's root, or itself."""
    return rows.join(comp.select(F.col("v").alias("class"), "root"), "class", "left").withColumn("label", F.coalesce("root", "class")).drop("root")


def settle(crowded: DataFrame, sides: DataFrame, comp: DataFrame, fits: str, confirm: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The components (v, root) after ``comp`` when every pair of rows of a crowded key counts
    that ``fits``: a condition on both rows' columns and their ``sides`` (class, ...), with _a and
    _b behind their names.

    ``crowded`` holds (key, class, pivot, c, ...): the rows of each key, c in number, all compared
    with the key's pivot before. At first some rows of each key are compared with the rows that
    have no larger key, which finds most links once. Then, in rounds, the next rows outside the
    pivot's component, in order of class, are compared with all rows of other components;
    ``confirm`` returns the links (u, v) among such pairs (a, b), a < b. Rows that once belong to
    the pivot's component do so for good, so at the end every row outside has had its turn, and a
    link to any other row would have been found. Keys without a row outside leave the rounds.
    """
    extra = [c for c in crowded.columns if c not in ("key", "class", "pivot", "c")]

    def compared(turn, rows, comp):
        x, y = (named(t.select("key", "class", "label", *extra).join(sides, "class"), s, "key") for t, s in ((turn, "a"), (rows, "b")))
        pairs = x.join(y, "key").filter(f"label_a <> label_b AND {fits}") \
            .select(F.least("class_a", "class_b").alias("a"), F.greatest("class_a", "class_b").alias("b"))
        links = confirm(pairs.distinct())
        if links.isEmpty():
            return comp
        # the components' stars stand for the links before
        return components(comp.select(F.col("v").alias("u"), F.col("root").alias("v")).unionByName(links))

    def next_rows(rows, width):
        return rows.withColumn("nth", F.row_number().over(W.partitionBy("key").orderBy("class"))).filter(F.col("nth") <= width)

    width, had = 32, None
    crowded = tk.stored(crowded, "crowded")
    n = crowded.count()
    if not n:
        return comp
    largest = crowded.groupBy("class").agg(F.max(F.struct("c", "key", *extra)).alias("_k")).select("class", "_k.*").drop("c")
    largest = tk.stored(tk.narrow(_labelled(largest, comp), n), "largest")
    comp = compared(next_rows(largest, width), largest, comp)
    while True:
        rows = _labelled(crowded, comp)
        # keys whose rows are in several components, and the pivot's
        mixed = rows.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.max(F.when(F.col("class") == F.col("pivot"), F.col("label"))).alias("home")) \
            .filter("lo <> hi").select("key", "home")
        open_ = tk.stored(tk.narrow(rows.join(mixed, "key"), n), "open")
        n = open_.count()
        if not n:
            return comp
        waiting = open_.filter("label <> home")
        if had is not None:
            waiting = waiting.join(had, "key").filter("class > last")
        next_ = tk.stored(tk.narrow(next_rows(waiting, width + 1), n), "turn")
        turn = next_.filter(F.col("nth") <= width)
        comp = compared(turn, open_, comp)
        if next_.filter(F.col("nth") > width).isEmpty():
            return comp
        had = turn.groupBy("key").agg(F.max("class").alias("last"))  # a key without a turn has none left
        crowded, width = open_.drop("label", "home"), width * 64


class Reader:
    """The texts of some classes of documents, stored once, and the pairs of them confirmed so
    far. ``overlaps`` maps Arrow batches (a, b, text_a, text_b) to links (u, v)."""

    def __init__(self, docs: DataFrame, wanted: DataFrame, overlaps):
        """``docs`` (rid, text); ``wanted`` (class, rid). Texts of other classes with the same
        rid are left to ``overlaps`` to see."""
        wanted = tk.stored(wanted.select("class", "rid"), "wanted")
        # distinct while dealt by rid, which each class has one of
        texts = tk.screened(docs.select("rid", "text"), "rid", wanted).join(wanted, "rid").select("rid", "class", "text").distinct()
        self.texts = tk.stored(texts.select("class", "text"), "texts")
        self.overlaps, self.tried = overlaps, None

    def confirm(self, pairs: DataFrame) -> DataFrame:
        """The links among ``pairs`` (a, b) that weren't tried before."""
        if self.tried is not None:
            pairs = pairs.join(self.tried, ["a", "b"], "left_anti")
        pairs = tk.stored(pairs, "pairs")
        n = pairs.count()
        if not n:
            return pairs.select(F.col("a").alias("u"), F.col("b").alias("v"))
        self.tried = pairs if self.tried is None else self.tried.unionByName(pairs)
        # the side that may be shared by many pairs is joined last, so its text isn't shuffled for each
        b, a = (named(tk.screened(self.texts, "class", pairs.select(F.col(x).alias("class")).distinct()), x).withColumnRenamed(f"class_{x}", x)
                for x in ("b", "a"))
        read = pairs.join(b, "b").join(a, "a").select("a", "b", "text_a", "text_b")
        return tk.stored(tk.narrow(tk.narrow(read, n, 1000).mapInArrow(self.overlaps, "u long, v long").distinct(), n), "links")


def rows_of(docs: DataFrame) -> DataFrame:
    """(doc_id, rid, text): rid finds a row again, by its id, or where it has none by its text."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("rid", F.coalesce("doc_id", F.xxhash64("text")))


def class_names(rows: DataFrame, comp: DataFrame) -> DataFrame:
    """(class, component_id) from rows (doc_id, class) and components (v, root) of classes:
    the smallest doc_id of the component."""
    ids = rows.groupBy("class").agg(F.min("doc_id").alias("least"))
    ids = ids.join(comp.withColumnRenamed("v", "class"), "class", "left").select("class", "least", F.coalesce("root", "class").alias("root"))
    least = ids.groupBy("root").agg(F.min("least").alias("component_id"))
    return ids.join(least, "root").select("class", "component_id")


def groups_sql(width: int, percent: int) -> str:
    """DuckDB SQL for (doc_id, n_shingles, component_id) of ``documents``: sets of ``width``-word
    shingles, linked at ``percent`` percent similarity, named by the smallest doc_id reachable."""
    shingle = " || ' ' || ".join(f"w[i + {k}]" if k else "w[i]" for k in range(width))
    return f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{tk.UPPER}', '{tk.LOWER}'), '{tk.WORD}') AS w FROM documents
), sets AS (
  SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {width} THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - {width - 2}), lambda i: {shingle}) END)) AS s
  FROM words
), classes AS (
  SELECT min(doc_id) AS class, len(s) AS n, s FROM sets WHERE len(s) > 0 GROUP BY s
), entries AS (
  SELECT class, n, unnest(s) AS x FROM classes
), links AS (
  SELECT a.class AS u, b.class AS v FROM entries a JOIN entries b
    ON a.x = b.x AND a.class < b.class AND 100 * least(a.n, b.n) >= {percent} * greatest(a.n, b.n)
  GROUP BY a.class, b.class, a.n, b.n HAVING 100 * count(*) >= {percent} * (a.n + b.n - count(*))
), both_ways AS (
  SELECT u, v FROM links UNION ALL SELECT v, u FROM links
), reach AS (
  SELECT class AS v, class AS root FROM classes
  UNION
  SELECT e.v, r.root FROM reach r JOIN both_ways e ON e.u = r.v WHERE r.root < e.v
), named AS (
  SELECT c.s, min(r.root) AS component_id FROM classes c JOIN reach r ON r.v = c.class GROUP BY c.class, c.s
), found AS (
  SELECT d.doc_id, len(d.s)::BIGINT AS n_shingles, coalesce(named.component_id, d.doc_id) AS component_id
  FROM sets d LEFT JOIN named ON named.s = d.s
)
SELECT doc_id, n_shingles, component_id FROM found"""
