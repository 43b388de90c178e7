"""Quality classifier, lattice model and quality rules against brute force and held-out labels."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from martlake.llm import lattice_lm, outliers, quality, textkit
from tests.llm import frames

WORD = re.compile("[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def crc(i, n=5):
    return zlib.crc32(str(i).encode()) % n


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in quality.op1_quality_classifier(spark, sf).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    held = [(got[i], y) for i, y in labels.items() if i in got and got[i].held_out]
    assert all(r.held_out == (crc(i) == 0) for i, r in got.items())
    assert np.mean([r.predicted == y for r, y in held]) > 0.9
    assert np.mean([r.predicted for r, y in held if y == 1]) > 0.97


def test_quality_awkward_rows(spark):
    docs = frames.table(spark)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)] + [(None, 1, 0), (3, None, 0), (4, 0, 0), (4, 0, 0), (9999, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    out = quality.quality_scores(spark, docs, labels).collect()
    assert len(out) == docs.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in out)
    none = quality.quality_scores(spark, docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    assert quality.quality_scores(spark, frames.empty(spark), labels).count() == 0
    assert quality.keep_good(docs, labels).columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_quality_ignores_held_out_labels(spark):
    docs = frames.table(spark)
    rows = [(i, i % 2, 0) for i in range(60)]
    flipped = [(i, 1 - y if crc(i) == 0 else y, t) for i, y, t in rows]
    a, b = ({(r.doc_id, r.score) for r in quality.quality_scores(spark, docs, spark.createDataFrame(x, "doc_id long, quality int, toxic int")).collect()}
            for x in (rows, flipped))
    assert a == b


def test_lattice_is_the_sum_over_segmentations():
    pieces, logp = lattice_lm.vocabulary(textkit.tokenizer_path(lattice_lm.VOCABULARY))
    p = dict(zip(pieces, logp))
    words = [b"the", b"thndhain", "été".encode(), "日".encode(), b"q" * 400, b"a"]
    got = lattice_lm.lattice(np.frombuffer(b"".join(words), np.uint8), np.concatenate([[0], np.cumsum([len(w) for w in words])]),
                             lattice_lm.Pieces(pieces, logp))
    for w, g in zip(words, got):
        t, a = b" " + w, [0.0]
        for e in range(1, len(t) + 1):
            x = [a[s] + p[t[s:e]] for s in range(e) if t[s:e] in p and a[s] > -math.inf]
            a.append(max(x) + math.log(sum(math.exp(v - max(x)) for v in x)) if x else -math.inf)
        assert g == pytest.approx(a[-1], abs=1e-8)


def check_lm(docs, out, key):
    tokens = [(r.doc_id, WORD.findall((r.text or "").translate(LOWER)) + [None]) for r in docs]
    c = Counter(t for i, ts in tokens if i is not None and crc(i) != 1 for t in ts)
    n, v = sum(c.values()), len(c)
    want = sorted((str(i), i is not None and crc(i) == 1, len(ts), sum(c[t] > 0 for t in ts),
                   round(sum(math.log10((c[t] + 0.5) / (n + 0.5 * (v + 1))) for t in ts), 6)) for i, ts in tokens)
    got = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in out)
    assert [w[:4] for w in want] == [g[:4] for g in got]
    assert all(abs(w[4] - g[4]) < 1e-4 for w, g in zip(want, got))
    assert all(r.train_tokens == n and r.score < 0 and math.isfinite(r.score) for r in out)


def lm(docs):
    from pyspark.sql import functions as F
    held = F.coalesce(textkit.crc_bucket(F.col("doc_id")) == 1, F.lit(False))
    return lattice_lm.score(docs, F.col("doc_id").isNotNull() & ~held, held).collect()


def test_lattice_model_counts(spark):
    docs = frames.table(spark)
    check_lm(docs.collect(), lm(docs), None)
    assert lm(frames.empty(spark)) == []


def test_lattice_model_prefers_corpus_words(spark):
    docs = spark.createDataFrame([(i, "alpha beta gamma delta " * 20) for i in range(40)] + [(900, "alpha beta"), (901, "zzqxj vvkwp")],
                                 "doc_id long, text string")
    out = {r.doc_id: r.score for r in lm(docs)}
    assert out[900] > out[901]


def brute_rules(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[k:k + 3]) for k in range(len(words) - 2)]
    n, covered, seen, dup = Counter(windows), set(), set(), 0
    for k, w in enumerate(windows):
        if n[w] > 1:
            covered |= {k, k + 1, k + 2}
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (len(words), sum(map(len, words)), sum(ch in "#*$%&|<>" for ch in text or ""), dup, len(covered), failed)


def test_rules_statistics(spark):
    docs = frames.table(spark)
    repeated = [(500, "a b c " * 40), (501, "x y z\nx y z\n\n\nx y z"), (502, "a a a a"), (503, "#|# " * 60), (504, "p q r s p q r")]
    docs = docs.unionByName(spark.createDataFrame(repeated, "doc_id long, text string"), allowMissingColumns=True)
    want = sorted((str(r.doc_id), *brute_rules(r.text)) for r in docs.collect())
    got = sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
                 for r in outliers.verdicts(docs).collect())
    assert got == want


def test_rules_reject_outliers_only(spark):
    rng = __import__("random").Random(5)
    plain = [(i, frames.sentence(rng, rng.randrange(60, 400)), "en", "s") for i in range(300)]
    junk = [(1000 + i, " ".join(f"w{rng.randrange(9999)}###" for _ in range(100)), "en", "s") for i in range(8)]
    out = {r.doc_id: r for r in outliers.verdicts(spark.createDataFrame(plain + junk, "doc_id long, text string, lang string, source string")).collect()}
    assert not any(out[i].kept for i, *_ in junk)
    assert sum(out[i].kept or out[i].base_failed for i, *_ in plain) >= 299
    assert outliers.verdicts(frames.empty(spark)).count() == 0


def test_rules_reject_each_kind_of_outlier(spark):
    """In a group of usual spread: much repetition, long words, great length; no plain text."""
    rng = __import__("random").Random(7)
    letters = "abcdefghijklmnopqrstuvwxyz"
    word = lambda lo, hi: "".join(rng.choices(letters, k=rng.randrange(lo, hi)))
    text = lambda n, lo=3, hi=8: " ".join(word(lo, hi) for _ in range(n))
    plain = [(i, text(int(200 * 2 ** rng.gauss(0, 0.5)) + 60)) for i in range(300)]
    phrase = text(12)
    odd = [(1000, text(80) + " " + " ".join([phrase] * 5)), (1001, text(200, 6, 12)), (1002, text(20_000)),
           (1003, "\n".join([text(4) for _ in range(40)] + ["more here"] * 8))]
    docs = spark.createDataFrame([(i, x, "en", "s") for i, x in plain + odd], "doc_id long, text string, lang string, source string")
    out = {r.doc_id: r for r in outliers.verdicts(docs).collect()}
    assert not any(out[i].base_failed for i in range(1000, 1004))
    assert [i for i, _ in odd if out[i].kept] == []
    assert sum(out[i].kept for i, _ in plain) >= 298


def test_rules_keep_null_keys_apart(spark):
    """The group (en, null) and the pool of small groups of en are different populations."""
    rng = __import__("random").Random(11)
    words = [f"w{k:03d}" for k in range(400)]
    plain = [(i, " ".join(rng.choices(words, k=rng.randrange(90, 110))), "en", None) for i in range(80)]
    # the pool: small groups of another length, usual among themselves
    pool = [(200 + i, " ".join(rng.choices(words, k=rng.randrange(900, 1100))), "en", f"s{i % 4}") for i in range(80)]
    odd = [(900, pool[0][1], "en", None), (901, plain[0][1], "en", "s1")]
    docs = spark.createDataFrame(plain + pool + odd, "doc_id long, text string, lang string, source string")
    out = {r.doc_id: r.kept for r in outliers.verdicts(docs).collect()}
    assert not out[900] and not out[901]
    assert sum(out[i] for i, *_ in plain) >= 78 and sum(out[i] for i, *_ in pool) >= 78
