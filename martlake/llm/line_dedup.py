"""Line dedup by distinct-site spread, with DataFrame functions only.

A line (a ``\\n``-separated part of a text that holds a word) is boilerplate when it stands
on at least ``min_sites`` different sources. Per line hash, HyperLogLog sketches of the
sources merge by aggregation; an estimate clearly below or above ``min_sites`` decides, and
lines within the sketch's error of it get an exact distinct count. Of a boilerplate line one
occurrence in the corpus stays (smallest doc_id, first place), all others are removed.

Lines are compared whole by their 64-bit hash. Blank lines are never removed. A null source
is a site of its own, a null or empty text has no lines, rows with a null or repeated doc_id
are cleaned like others (rows of one doc_id hold the same decision). Documents whose lines
all go stay as empty texts. Extra columns pass through ``clean_lines`` untouched, but for
those named like its results, which replace them. A very long text's lines are looked up in its
own list of boilerplate lines, one by one. Of equal lines in one text the first stays. An empty
table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlake.llm import textkit as tk

MIN_SITES = 6
LG_K = 10
#: four standard errors of a sketch with 2**LG_K registers
_ERROR = 4 * 1.04 / 2 ** (LG_K / 2)

_HAS_WORD = tk.WORD


def _lines(docs: DataFrame) -> DataFrame:
    return docs.select(
        "doc_id", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")).alias("site"),
        F.explode(F.array_distinct(F.transform(
            F.filter(F.split("text", "\n", -1), lambda x: x.rlike(_HAS_WORD)), lambda x: F.xxhash64(x)))).alias("line"))


def boilerplate(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """(line hash, first_doc) of the lines on ``min_sites`` sources or more."""
    lines = _lines(docs)
    # a line needs as many documents as sites: most lines are settled by this count alone
    spread = (lines.groupBy("line").agg(F.count(F.lit(1)).alias("n_docs"), F.min("doc_id").alias("first_doc"),
                                        F.hll_sketch_agg("site", LG_K).alias("sketch"))
              .filter(F.col("n_docs") >= min_sites)
              .select("line", "first_doc", F.hll_sketch_estimate("sketch").alias("sites")))
    spread = tk.stored(spread, "line-spread")
    slack = max(1.0, _ERROR * min_sites)
    near = spread.filter(F.abs(F.col("sites") - min_sites) <= slack)
    exact = (lines.join(near.select("line", "first_doc"), "line")
             .groupBy("line", "first_doc").agg(F.countDistinct("site").alias("sites")).filter(F.col("sites") >= min_sites))
    return spread.filter(F.col("sites") > min_sites + slack).select("line", "first_doc") \
        .unionByName(exact.select("line", "first_doc"))


def clean_lines(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """``docs`` plus ``kept_text`` (null for a null text), ``n_lines`` and ``n_removed``."""
    bad = tk.stored(boilerplate(docs, min_sites), "boilerplate")
    per_doc = (_lines(docs).join(bad, "line")
               .groupBy(F.col("doc_id").alias("_hit_id"))
               .agg(F.collect_set(F.when(~F.col("doc_id").eqNullSafe(F.col("first_doc")), F.col("line"))).alias("_drop"),
                    F.collect_set(F.when(F.col("doc_id").eqNullSafe(F.col("first_doc")), F.col("line"))).alias("_once")))
    rows = docs.select(F.struct(*docs.columns).alias("_row"), "doc_id", "text")
    joined = rows.join(per_doc, F.col("doc_id").eqNullSafe(F.col("_hit_id")), "left")
    hashed = F.transform("_lines", lambda x: F.xxhash64(x))
    later = F.filter("_lines", lambda x, i: ~F.coalesce(
        F.array_contains("_drop", F.xxhash64(x))
        | (F.array_contains("_once", F.xxhash64(x)) & (F.array_position("_hashes", F.xxhash64(x)) <= i)), F.lit(False)))
    extra = [F.col("_row")[c].alias(c) for c in docs.columns if c not in ("kept_text", "n_lines", "n_removed")]
    return (joined.withColumn("_lines", F.split("text", "\n", -1))
            .withColumn("_hashes", F.when(F.size("_once") > 0, hashed))
            .withColumn("_kept", F.when(F.col("_drop").isNull(), F.col("_lines")).otherwise(later))
            .select(*extra, F.when(F.col("_drop").isNull(), F.col("text")).otherwise(F.array_join("_kept", "\n")).alias("kept_text"),
                    F.when(F.col("text").isNull(), 0).otherwise(F.size("_lines")).cast("long").alias("n_lines"),
                    F.when(F.col("text").isNull(), 0).otherwise(F.size("_lines") - F.size("_kept")).cast("long").alias("n_removed")))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tk.read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return clean_lines(docs).select("doc_id", "n_lines", "n_removed",
                                    F.sha2(F.coalesce("kept_text", F.lit("")), 256).alias("kept_sha256"))


_CTE = f"""
l AS (SELECT doc_id, site, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos
      FROM (SELECT doc_id, coalesce('s' || source, 'n') AS site, string_split(text, chr(10)) AS parts FROM documents)),
spread AS (SELECT line, min(doc_id) AS first_doc FROM l WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')
           GROUP BY line HAVING count(DISTINCT site) >= {MIN_SITES}),
marked AS (SELECT l.doc_id, l.line, l.pos,
                  spread.line IS NOT NULL AND NOT (l.doc_id = first_doc
                    AND row_number() OVER (PARTITION BY l.doc_id, l.line ORDER BY l.pos) = 1) AS gone
           FROM l LEFT JOIN spread ON l.line = spread.line),
cleaned AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed,
                   coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS kept
            FROM marked GROUP BY doc_id)
"""

ORACLE_SQL = f"""
WITH {_CTE}
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN cleaned c ON d.doc_id = c.doc_id
"""
