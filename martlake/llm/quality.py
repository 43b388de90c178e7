"""Quality classifier: hashed word n-gram logistic regression, follow-the-regularised-leader.

Tokens are maximal runs of word bytes (letters, digits, any byte of a non-ASCII character)
or of punctuation; the features are the hashed 1- and 2-grams of a text, valued
count / sqrt(number of n-grams). All 2-grams of a word and itself share one feature. Training takes a bounded sample (``max_labelled`` rows, the
smallest id hashes), dealt to ``shards`` tasks that each run FTRL-proximal over their rows;
the weights are the mean of the shards' weights. A score is a sparse dot product with the
weight table, whose size is fixed by ``bits`` and therefore broadcast.

Null and empty texts have no n-gram and score the intercept. Repeated rows are scored each;
repeated labels are learned from once per distinct (doc_id, label). Extra columns are
ignored. With no usable labels every score is 0.5. Equal texts get equal scores; labels of one
doc_id that contradict each other are both learned from. A very long text is one row of n-grams
like any other. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlake.llm import textkit as tk

BITS = 18
MAX_LABELLED = 16_000
SHARDS = 8
THRESHOLD = 0.3
_ALPHA, _BETA, _L1, _L2, _EPOCHS = 0.5, 1.0, 0.02, 1.0, 3


def _classes() -> np.ndarray:
    kind = np.full(256, 2, np.uint8)
    kind[128:] = 1
    for a, b in ((48, 58), (65, 91), (97, 123)):
        kind[a:b] = 1
    kind[tk.IS_SPACE] = 0
    return kind


def features(buf: np.ndarray, off: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashed n-gram ids, first): the n-grams of document d are ids[first[d]:first[d+1]]."""
    kind = _classes()[buf]
    cuts = np.concatenate([off, np.flatnonzero(kind[1:] != kind[:-1]) + 1])
    s, e = tk.runs(kind > 0, cuts)
    h = tk.span_hashes(buf, s, e)
    doc = np.searchsorted(off, s, "right") - 1
    pair = np.flatnonzero(doc[1:] == doc[:-1])
    same = h[pair] == h[pair + 1]
    two = tk.mix(np.where(same, np.uint64(1), h[pair]) * np.uint64(0x9E3779B97F4A7C15)
                 + np.where(same, np.uint64(1), h[pair + 1]))
    order = np.argsort(np.concatenate([s, s[pair]]), kind="stable")
    ids = np.concatenate([h, two])[order] >> np.uint64(64 - bits)
    first = np.searchsorted(np.concatenate([s, s[pair]])[order], off)
    return ids.astype(np.int32), first


def _featurize(bits):
    def run(batches):
        for b in batches:
            buf, off = tk.flat_text(b.column("text"))
            idx, val, n = [], [], [0]
            for i, j in tk.doc_groups(off):
                ids, first = features(buf[off[i]:off[j]], off[i:j + 1] - off[i], bits)
                for d in range(j - i):
                    u, c = np.unique(ids[first[d]:first[d + 1]], return_counts=True)
                    idx.append(u)
                    val.append((c / np.sqrt(max(c.sum(), 1))).astype(np.float32))
                    n.append(n[-1] + len(u))
            off2 = np.array(n)
            yield pa.RecordBatch.from_arrays(
                [b.column("shard"), b.column("turn"), b.column("y"),
                 tk.blobs(np.concatenate(idx or [np.zeros(0, np.int32)]), off2),
                 tk.blobs(np.concatenate(val or [np.zeros(0, np.float32)]), off2)],
                names=["shard", "turn", "y", "idx", "val"])
    return run


def _ftrl(bits):
    def run(pdf):
        import pandas as pd
        pdf = pdf.sort_values(["turn", "y"], kind="stable")
        rows = [(np.append(np.frombuffer(i, np.int32), 1 << bits), np.append(np.frombuffer(v, np.float32), 1).astype(float), y)
                for i, v, y in zip(pdf["idx"], pdf["val"], pdf["y"])]
        z, n, w = (np.zeros((1 << bits) + 1) for _ in range(3))
        for _ in range(_EPOCHS):
            for i, x, y in rows:
                p = 1 / (1 + np.exp(-np.clip(w[i] @ x, -35, 35)))
                g = (p - y) * x
                ni = n[i] + g * g
                z[i] += g - (np.sqrt(ni) - np.sqrt(n[i])) / _ALPHA * w[i]
                n[i] = ni
                l1 = np.where(i == 1 << bits, 0, _L1)
                w[i] = np.where(np.abs(z[i]) <= l1, 0,
                                (np.sign(z[i]) * l1 - z[i]) / ((_BETA + np.sqrt(ni)) / _ALPHA + _L2))
        return pd.DataFrame({"w": [w.astype(np.float32).tobytes()]})
    return run


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED,
          shards: int = SHARDS, bits: int = BITS) -> np.ndarray:
    """Weights (2**bits hashed n-grams, then the intercept) learned from ``labels``
    (doc_id, y) joined to ``docs`` (doc_id, text); at most ``max_labelled`` label rows, those
    with the smallest hash of (doc_id, y), are learned from."""
    tk.small_batches(docs.sparkSession)
    sample = (labels.select("doc_id", F.col("y").cast("double").alias("y")).dropna().distinct()
              .select("*", F.xxhash64("doc_id", "y").alias("turn")).orderBy("turn", "doc_id").limit(max_labelled))
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    rows = rows.select(F.pmod("turn", F.lit(shards)).cast("int").alias("shard"), "turn", "y", "text")
    models = (rows.mapInArrow(tk.tidy(_featurize(bits)), "shard int, turn long, y double, idx binary, val binary")
              .groupBy("shard").applyInPandas(_ftrl(bits), "w binary").collect())
    if not models:
        return np.zeros((1 << bits) + 1, np.float32)
    return np.mean([np.frombuffer(m.w, np.float32) for m in models], axis=0, dtype=np.float64).astype(np.float32)


def score(docs: DataFrame, weights: np.ndarray, keep: list[str], bits: int = BITS) -> DataFrame:
    """``docs`` columns ``keep`` plus score (probability of label 1) of every text."""
    table = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches):
        w = table.value
        for b in batches:
            buf, off = tk.flat_text(b.column("text"))
            out = np.zeros(len(off) - 1)
            for i, j in tk.doc_groups(off):
                ids, first = features(buf[off[i]:off[j]], off[i:j + 1] - off[i], bits)
                sums = np.concatenate([[0.0], np.cumsum(w[ids], dtype=np.float64)])
                out[i:j] = (sums[first[1:]] - sums[first[:-1]]) / np.sqrt(np.maximum(np.diff(first), 1))
            p = 1 / (1 + np.exp(-np.clip(out + w[-1], -35, 35)))
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in keep), pa.array(p)], names=[*keep, "score"])

    picked = docs.select(*keep) if "text" in keep else docs.select(*keep, "text")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    return picked.mapInArrow(tk.tidy(run), f"{schema}, score double")


def quality_scores(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted. Labels are learned only from rows
    whose crc32(doc_id) mod 5 is not 0."""
    known = labels.select("doc_id", F.col("quality").alias("y")).filter(tk.crc_bucket(F.col("doc_id")) != 0)
    scored = score(docs.select("doc_id", "text"), train(docs, known), ["doc_id"])
    return scored.select("doc_id", F.coalesce(tk.crc_bucket(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"),
                         "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` (its own columns) whose text the classifier doesn't reject."""
    known = labels.select("doc_id", F.col("quality").alias("y")).filter(tk.crc_bucket(F.col("doc_id")) != 0)
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    return score(docs, train(docs, known), columns).filter(F.col("score") >= THRESHOLD).select(*columns)


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(spark, tk.read_table(spark, sf_dir, "documents"), tk.read_table(spark, sf_dir, "labels"))
