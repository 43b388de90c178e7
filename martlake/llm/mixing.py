"""Mixing sources to target weights, with DataFrame functions only.

Every document gets a hash-random key; within its source the documents are sorted by key.
The keys' leading digits deal each source into equal ranges, so the prefix sums of token
counts are a window inside each (source, range) plus the offset of the ranges before it: no
task holds a source, and a rerun or a lost executor gives the same order. A source's budget
takes whole epochs of the source first and cuts the remainder exactly, inside the document
where it ends.

Targets: the sources in code point order (null last) weigh 3, 1, 2, repeating, and share
150 % of all tokens; a target stops at twice its source's size and the excess is shared by
weight among the others. Null and empty texts have size 0 and nothing is taken of them.
Repeated rows are documents of their own. Rows with a null doc_id share one key. Extra
columns pass through ``mix``. Equal keys are ordered by doc_id and size; rows that agree in these
are interchangeable. Very long texts are rows like any other. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W
from pyspark.sql import functions as F

from martlake.llm import textkit as tk

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_EPOCHS = 2
SEED = "mix-1"
#: documents in one (source, key range)
_ROWS_PER_RANGE = 50_000


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, target): ``sizes`` has (source, source_size), one row a source.

    Sources are capped in order of cap / weight. With the first k capped the others get
    weight * level, level = (rest of the share) / (rest of the weights); that level is
    largest for the right k.
    """
    place = F.row_number().over(W.orderBy(F.col("source").isNull(), "source")) - 1
    t = (sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), place % len(WEIGHTS) + 1).cast("double"))
         .withColumn("cap", F.lit(float(MOST_EPOCHS)) * F.col("source_size")))
    order = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    before = order.rowsBetween(W.unboundedPreceding, -1)
    after = order.rowsBetween(0, W.unboundedFollowing)
    everything = W.partitionBy(F.lit(1))
    level = (F.lit(SHARE) * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) \
        / F.sum("weight").over(after)
    t = t.withColumn("level", level)
    t = t.withColumn("level", F.max("level").over(everything))
    return t.select("source", "source_size", F.least("cap", F.col("weight") * F.col("level")).alias("target"))


def takes(docs: DataFrame) -> DataFrame:
    """``docs`` plus size, source_size, target and taken (words the mix takes)."""
    sized = docs.withColumn("size", F.coalesce(F.regexp_count("text", F.lit(tk.WORD)), F.lit(0)).cast("long"))
    key = F.md5(F.concat(F.lit(f"{SEED}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    slim = sized.select("doc_id", "source", "size", key.alias("key"))
    n_ranges = max(64, -(-docs.count() // _ROWS_PER_RANGE))
    slice_ = F.floor(F.conv(F.substring("key", 1, 6), 16, 10).cast("long") * n_ranges / (1 << 24))
    slim = tk.stored(slim.withColumn("slice", slice_), "mix-sizes")
    part = slim.groupBy("source", "slice").agg(F.sum("size").alias("part"))
    goal = targets(part.groupBy("source").agg(F.sum("part").alias("source_size")))
    offsets = part.withColumn("offset", F.coalesce(F.sum("part").over(
        W.partitionBy("source").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))) \
        .select(F.col("source").alias("s"), F.col("slice").alias("p"), "offset")
    goal = goal.select(F.col("source").alias("g"), "source_size", "target")
    inner = W.partitionBy("source", "slice").orderBy("key", "doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
    budget = F.floor("target")
    before = F.col("offset") + F.col("before")
    rest = F.least(F.greatest(F.col("rest") - before, F.lit(0)), F.col("size"))
    return (slim.withColumn("before", F.coalesce(F.sum("size").over(inner), F.lit(0)))
            .join(offsets, F.col("source").eqNullSafe(F.col("s")) & (F.col("slice") == F.col("p")))
            .join(goal, F.col("source").eqNullSafe(F.col("g")))
            .withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0))
            .withColumn("rest", budget - F.col("epochs") * F.col("source_size"))
            .withColumn("taken", (F.col("epochs") * F.col("size") + rest).cast("long"))
            .select("doc_id", "size", "source_size", "target", "taken", "source"))


def mix(docs: DataFrame) -> DataFrame:
    """The mix itself: the columns of ``docs``, one row for each time a document is taken;
    the document where a source's budget ends is cut after its last taken word. Documents
    are told apart by (doc_id, source); rows that agree in both are taken alike."""
    plan = (takes(docs.select("doc_id", "source", "text")).filter("taken > 0").groupBy("doc_id", "source")
            .agg(F.max("taken").alias("_taken"), F.max("size").alias("_size"))
            .withColumnsRenamed({"doc_id": "_id", "source": "_src"}))
    whole = F.array_repeat(F.col("_size"), F.floor(F.col("_taken") / F.col("_size")).cast("int"))
    cut = F.when(F.col("_taken") % F.col("_size") > 0, F.array(F.col("_taken") % F.col("_size"))) \
        .otherwise(F.array().cast("array<bigint>"))
    rows = docs.select(F.struct(*docs.columns).alias("_row"), "doc_id", "source", "text") \
        .join(plan, F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("source").eqNullSafe(F.col("_src"))) \
        .withColumn("_words", F.explode(F.concat(whole, cut)))
    head = F.array_join(F.slice(F.regexp_extract_all("text", F.lit("[\\x20\\x09-\\x0D]*" + tk.WORD), F.lit(0)),
                                F.lit(1), F.col("_words").cast("int")), "")
    rows = rows.withColumn("text", F.when(F.col("_words") < F.col("_size"), head).otherwise(F.col("text")))
    made = {"text": F.col("text"), "n_chars": F.char_length("text").cast("long")}
    return rows.select(*[made.get(c, F.col("_row")[c]).alias(c) for c in docs.columns])


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tk.read_table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return takes(docs).select("doc_id", "size", "source_size", "target", "taken")


ORACLE_SQL = f"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         md5('{SEED}:' || coalesce(doc_id::VARCHAR, 'null')) AS key
  FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS source_size,
               CASE (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 WHEN 0 THEN 3.0 WHEN 1 THEN 1.0 ELSE 2.0 END::DOUBLE AS weight
        FROM sized GROUP BY source),
caps AS (SELECT *, (2.0 * source_size)::DOUBLE AS cap, (1.5 * sum(source_size) OVER ())::DOUBLE AS share FROM per),
levels AS (SELECT *, (share - coalesce(sum(cap) OVER (ORDER BY cap / weight, source IS NULL, source
                                                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
                  / sum(weight) OVER (ORDER BY cap / weight, source IS NULL, source
                                      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM caps),
goal AS (SELECT source, source_size, least(cap, weight * max(level) OVER ()) AS target FROM levels),
run AS (SELECT s.*, g.source_size, g.target, floor(g.target)::BIGINT AS budget,
               coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY key, doc_id, size
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
        FROM sized s JOIN goal g ON s.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
       CASE WHEN source_size = 0 THEN 0
            ELSE (budget // source_size) * size + least(greatest(budget % source_size - before, 0), size) END::BIGINT AS taken
FROM run
"""
