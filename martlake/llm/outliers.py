"""Quality rules by robust multivariate outliers, with DataFrame functions only.

Every text gives five statistics (length, word length, symbols, repeated lines, repeated
3-word windows). Documents that pass the base rule are grouped by (lang, source); for each
group the minimum covariance determinant estimate of the transformed statistics is found by
concentration steps: start from coordinate medians and median absolute deviations, then
again and again take mean and covariance of the ``COVER`` share of documents nearest by
Mahalanobis distance. A document whose squared distance exceeds ``CUTOFF`` is rejected.

Medians and the cut of a concentration step come from counts of fine bins, so a group of any
size is aggregated and never gathered; a step's share includes the whole bin at its edge.
A statistic that is (nearly) constant in the share gets a spread of its own (``SPREADS``), without
which it would reject every other value; elsewhere the estimated covariance holds. Groups under ``LEAST`` documents are pooled by
language, then all together; if the pool is smaller still, nobody in it is rejected.

Null and empty texts have no words and fail the base rule. Null langs and sources group
like values, apart from all others. Repeated rows count each, equal texts of one group get equal
verdicts. Very long texts are rows like any other. An empty table gives no rows. Extra columns are
ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window as W
from pyspark.sql import functions as F

from martlake.llm import textkit as tk

COVER = 0.75
#: chi-square quantile, 5 degrees of freedom, upper tail 1e-6
CUTOFF = 35.9
#: COVER / P(chi-square with 7 degrees <= its COVER quantile with 5 degrees)
_CONSISTENT = 1.41
_STEPS = 4
LEAST = 50
_SALTS = 32
_SPACES = " \t\n\u000b\f\r"
_SYMBOLS = "#*$%&|<>"
#: (name, transformed statistic, standard deviation where the estimate is below NEAR_ZERO of it)
SPREADS = (
    ("x0", "ln(n_words)", 0.2),
    ("x1", "ln(word_chars / n_words)", 0.03),
    ("x2", "ln(1 + 1000 * n_symbols / word_chars)", 0.6),
    ("x3", "ln(1 + 1000 * n_dup_lines / n_words)", 0.5),
    ("x4", "ln(1 + 100 * n_repeat_words / n_words)", 0.5),
)
NEAR_ZERO = 0.5
#: part of a variance that stays when a covariance is singular
_OWN = 0.05
_X = [x for x, _, _ in SPREADS]
_P = len(_X)


def let(value: Column, body) -> Column:
    """``body`` of ``value``, with the value computed once for each row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeat_words(words: Column) -> Column:
    """Words covered by a 3-word window that stands in ``words`` twice or more."""
    def covered(p):
        steps = F.transform(p, lambda x, k: F.coalesce(F.least(F.lit(3), F.get(p, k + 1) - x), F.lit(3)))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    def positions(s):
        twin = F.filter(s, lambda e, k: F.coalesce(e["h"] == F.get(s, k - 1)["h"], F.lit(False))
                        | F.coalesce(e["h"] == F.get(s, k + 1)["h"], F.lit(False)))
        return let(F.sort_array(F.transform(twin, lambda e: e["i"])), covered)

    def windows(w):
        return F.transform(F.slice(w, F.lit(1), F.size(w) - 2), lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))

    def counted(h):
        ranked = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(ranked, positions))

    return let(words, lambda w: F.when(F.size(w) < 4, F.lit(0)).otherwise(let(windows(w), counted)))


def statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed) of every document."""
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.length(F.translate(x, _SPACES, "")) > 0)
    out = docs.select(
        "doc_id", "lang", "source",
        F.regexp_count(text, F.lit(tk.WORD)).cast("long").alias("n_words"),
        F.length(F.translate(text, _SPACES, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, _SYMBOLS, ""))).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.regexp_extract_all(text, F.lit(tk.WORD), F.lit(0))).cast("long").alias("n_repeat_words"))
    return out.withColumn("base_failed", F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words"))


def _quantile_bins(df: DataFrame, keys: list[str], bin_: str, share: float) -> DataFrame:
    """(keys, bin_): the first bin up to which at least ``share`` of the rows of ``keys`` lie."""
    counts = df.groupBy(*keys, bin_).agg(F.count(F.lit(1)).alias("_c"))
    upto = F.sum("_c").over(W.partitionBy(*keys).orderBy(bin_))
    total = F.sum("_c").over(W.partitionBy(*keys))
    return (counts.select(*keys, bin_, upto.alias("_u"), total.alias("_t")).filter(F.col("_u") >= share * F.col("_t"))
            .groupBy(*keys).agg(F.min(bin_).alias(bin_)))


def _median(df: DataFrame, value: str, name: str, bins: int = 256) -> DataFrame:
    """(grp, dim, name): the median of ``value``, to half a bin of width 1 / bins."""
    b = _quantile_bins(df.withColumn("_b", F.floor(F.col(value) * bins)), ["grp", "dim"], "_b", 0.5)
    return b.select("grp", "dim", ((F.col("_b") + 0.5) / bins).alias(name))


def _spread(deviation: Column, k: int) -> Column:
    """A standard deviation of statistic k, replaced where it is near zero."""
    given = SPREADS[k][2]
    return F.when(deviation >= NEAR_ZERO * given, deviation).otherwise(F.lit(given))


def _start(x: DataFrame) -> DataFrame:
    """(grp, m0.., l00..): medians, and a diagonal factor from median absolute deviations."""
    long = x.select("doc_id", "grp", F.posexplode(F.array(*_X)).alias("dim", "v"))
    med = tk.stored(_median(long, "v", "med"), "medians")
    centre = med.groupBy("grp").agg(F.map_from_entries(F.collect_list(F.struct("dim", "med"))).alias("centre"))
    off = _with_group(long, centre).withColumn("v", F.abs(F.col("v") - F.element_at("centre", F.col("dim"))))
    mad = _median(off, "v", "mad")
    both = med.join(mad, ["grp", "dim"]).groupBy("grp")
    at = lambda c, k: F.max(F.when(F.col("dim") == k, F.col(c)))
    return both.agg(
        *[at("med", k).alias(f"m{k}") for k in range(_P)],
        *[(_spread(1.4826 * at("mad", i), i) if i == j else F.lit(0.0)).alias(f"l{i}{j}")
          for i in range(_P) for j in range(i + 1)])


def _factor(moments: DataFrame) -> DataFrame:
    """(grp, m.., l..): the Cholesky factors of the covariances c00, c10, c11, ..."""
    t = moments
    for j in range(_P):
        for i in range(j, _P):
            rest = reduce(lambda a, k: a - F.col(f"l{i}{k}") * F.col(f"l{j}{k}"), range(j), F.col(f"c{i}{j}"))
            t = t.withColumn(f"l{i}{j}", F.sqrt(F.greatest(rest, F.col(f"c{i}{i}") * _OWN)) if i == j else rest / F.col(f"l{j}{j}"))
    return t.select("grp", *[f"m{k}" for k in range(_P)], *[f"l{i}{j}" for i in range(_P) for j in range(i + 1)])


def _with_group(x: DataFrame, per_group: DataFrame, key: str = "grp", how: str = "inner") -> DataFrame:
    """``x`` joined to a row for each group, the groups split by a salt so that a large one
    is spread over tasks."""
    salted = x.withColumn("_salt", F.pmod(F.xxhash64("doc_id"), F.lit(_SALTS)))
    copies = per_group.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(_SALTS - 1).cast("long"))))
    return salted.join(copies, [key, "_salt"], how).drop("_salt")


def _distances(x: DataFrame, estimate: DataFrame) -> DataFrame:
    """``x`` plus d2, the squared Mahalanobis distance to its group's estimate."""
    t = _with_group(x, estimate, how="left")
    for i in range(_P):
        rest = reduce(lambda a, k: a - F.col(f"l{i}{k}") * F.col(f"y{k}"), range(i), F.col(f"x{i}") - F.col(f"m{i}"))
        t = t.withColumn(f"y{i}", rest / F.col(f"l{i}{i}"))
    d2 = reduce(lambda a, b: a + b, [F.col(f"y{i}") * F.col(f"y{i}") for i in range(_P)])
    return t.select(*x.columns, d2.alias("d2"))


def _concentrate(x: DataFrame, estimate: DataFrame) -> DataFrame:
    """One step: mean and covariance factor of each group's nearest share."""
    d = _distances(x, estimate).withColumn("_b", F.floor(F.log(F.col("d2") + 1e-6) * 64))
    edge = _quantile_bins(d, ["grp"], "_b", COVER).withColumnRenamed("_b", "_edge")
    near = _with_group(d, edge).filter("_b <= _edge")
    mean = [F.avg(c).alias(f"m{k}") for k, c in enumerate(_X)]
    cov = [(F.covar_pop(_X[i], _X[j]) * _CONSISTENT).alias(f"c{i}{j}") for i in range(_P) for j in range(i + 1)]
    m = near.groupBy("grp").agg(*mean, *cov)
    for k in range(_P):
        m = m.withColumn(f"c{k}{k}", F.pow(_spread(F.sqrt(f"c{k}{k}"), k), 2))
    return _factor(m)


def verdicts(docs: DataFrame) -> DataFrame:
    """``statistics`` plus distance (squared Mahalanobis, null without an estimate) and kept."""
    stats = tk.stored(statistics(docs), "statistics")
    # nulls are written out, and the levels have names of their own: no two groups share a key
    key = lambda *c: F.to_json(F.struct(*c), {"ignoreNullFields": "false"})
    own, lang = key("lang", "source"), F.concat(F.lit("pool "), key("lang"))
    passed = stats.filter("NOT base_failed")
    sizes = passed.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("c"))
    pool = F.sum(F.when(F.col("c") < LEAST, F.col("c"))).over(W.partitionBy("lang"))
    groups = sizes.select(own.alias("own"), F.when(F.col("c") >= LEAST, own).when(pool >= LEAST, lang).otherwise(F.lit("all")).alias("grp"), "c")
    known = groups.groupBy("grp").agg(F.sum("c").alias("c")).filter(F.col("c") >= LEAST).select("grp")
    x = _with_group(passed.withColumn("own", own), groups.join(known, "grp", "left_semi").select("own", "grp"), "own") \
        .select("doc_id", "grp", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                *[F.expr(e).alias(name) for name, e, _ in SPREADS])
    x = tk.stored(x, "transformed")
    estimate = tk.stored(_start(x), "estimate")
    for _ in range(_STEPS):
        estimate = tk.stored(_concentrate(x, estimate), "estimate")
    grp = groups.select("own", "grp")
    far = _distances(_with_group(passed.withColumn("own", own), grp, "own", "left")
                     .select("*", *[F.expr(e).alias(name) for name, e, _ in SPREADS]), estimate)
    columns = ["doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    judged = far.select(*columns, F.col("d2").alias("distance"), (F.coalesce("d2", F.lit(0.0)) <= CUTOFF).alias("kept"))
    failed = stats.filter("base_failed").select(*columns, F.lit(None).cast("double").alias("distance"), F.lit(False).alias("kept"))
    return judged.unionByName(failed)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tk.read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return verdicts(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                 "base_failed", "kept", "distance")
