"""Hard negatives against exhaustive search; the intervals hold every score; awkward rows."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from martlake.llm import hard_negatives as hn

SCHEMA = "vec_id long, label int, embedding array<float>, z string, rank int, akey string, b int, positives int"


def brute_force(rows, is_anchor, n_positives=5, n_negatives=10):
    """(anchor, positive, rank, negative, scores) by plain loops over (id, label, integers)."""
    out = []
    for own, label, q in {(i, y, tuple(z)) for i, y, z in rows if is_anchor(i)}:
        scored = [(-sum(a * b for a, b in zip(q, z)), i, y) for i, y, z in rows if i != own and len(z) == len(q)]
        positives = sorted((s, i) for s, i, y in scored if y == label)[:n_positives]
        for s, p in positives:
            inside = sorted((t, i) for t, i, y in scored if y != label and 30 * -s <= 100 * -t <= 90 * -s)[:n_negatives]
            out += [(own, p, k + 1, i, -s, -t) for k, (t, i) in enumerate(inside)]
    return sorted(out)


def mined(frame, is_anchor):
    return sorted(tuple(r) for r in hn.mine(hn.integers(frame, "vec_id", "label", "embedding"), is_anchor).collect())


def as_integers(data):
    return [(i, y, [int(np.floor(256.0 * float(np.float32(x)))) for x in v]) for i, y, v in data]


def test_clustered_vectors(spark):
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((12, 48)) * 0.3 + 0.4  # a mean far from zero
    data = []
    for i in range(1500):
        v = centres[i % 12] + rng.standard_normal(48) * 0.15
        data.append((i, int(i % 12 // 2 if i % 3 else 1), v.astype(np.float32).tolist()))  # label 1 holds over a third
    frame = spark.createDataFrame([r + ("z", 1, "a", 2, 3) for r in data], SCHEMA)
    assert mined(frame, "id % 25 = 0") == brute_force(as_integers(data), lambda i: i % 25 == 0)


def test_filter_leaves_few_in_many_dimensions():
    """Clustered vectors of 512 dimensions: most intervals are ruled out by their codes."""
    rng = np.random.default_rng(6)
    centres = rng.standard_normal((40, 512))
    z = np.floor(40 * (centres[np.arange(4000) % 40] + rng.standard_normal((4000, 512)) * 0.6)).astype(np.int64)
    mean = z.mean(axis=0)
    block = hn.Block(np.arange(4000), np.arange(4000) % 40, z, *hn.encode(z.astype(float), mean), mean)
    shown = block.ids != np.arange(16)[:, None]
    found = block.search(z[:16], shown, [[hn._EVERY]] * 16, 5)
    scores = z[:16] @ block.z.astype(np.int64).T
    for a, ((ids, score),) in enumerate(found):
        s = np.where(shown[a], scores[a], -(1 << 60))
        order = np.lexsort((block.ids, -s))[:5]
        assert ids.tolist() == block.ids[order].tolist() and score.tolist() == s[order].tolist()
    assert block.seen[1] < 0.1 * block.seen[0]


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 150), st.integers(0, 1000), st.sampled_from([1, 40, 10_000]))
def test_intervals_hold_the_scores(dim, seed, size):
    rng = np.random.default_rng(seed)
    z = rng.integers(-size, size + 1, (30, dim)) + rng.integers(-size, size + 1, dim)
    z[0] = 0
    mean = z.mean(axis=0)
    codes, sizes = hn.encode(z.astype(float), mean)
    block = hn.Block(np.arange(30), np.zeros(30, int), z, codes, sizes, mean)
    est, half = block.intervals(z.astype(float))
    assert (np.abs(est - z @ z.T) <= half).all()
    assert np.allclose(np.linalg.norm(z - mean, axis=1) ** 2, (sizes ** 2).sum(axis=1))


def test_awkward_rows(spark):
    rng = np.random.default_rng(7)
    data = [(i, int(rng.integers(3)), rng.integers(0, 4, 4).astype(float).tolist()) for i in range(300)]  # many ties
    data += [(300, 1, [1.0, 1.0]), (301, 1, [2.0, 2.0]), (302, 2, [0.5, 1.0]), (400, 7, [1.0] * 4), (500, 1, [-1.0] * 4)]
    data += [data[100], data[100], data[200]]  # rows that repeat as a whole
    odd = [(None, 1, [1.0] * 4), (600, None, [1.0] * 4), (700, 1, None), (800, 1, []), (900, 1, [1.0, None, 1.0, 1.0]),
           (1000, 1, [float("nan"), 1.0, 1.0, 1.0]), (1100, 1, [float("inf"), 1.0, 1.0, 1.0])]
    frame = spark.createDataFrame([r + ("z", 1, "a", 2, 3) for r in data + odd], SCHEMA)
    got = mined(frame, "id % 100 = 0")
    assert got == brute_force(as_integers(data), lambda i: i % 100 == 0)
    assert {r[0] for r in got} <= {0, 100, 200, 300, 500}
    assert hn.mine(hn.integers(frame.filter("false"), "vec_id", "label", "embedding"), "id % 100 = 0").count() == 0


def test_large_components(spark):
    """Scores beyond a double's whole numbers stay exact."""
    rng = np.random.default_rng(8)
    data = [(i, i % 2, (rng.integers(0, 1 << 18, 6) + 0.5).tolist()) for i in range(240)]
    frame = spark.createDataFrame([r + ("z", 1, "a", 2, 3) for r in data], SCHEMA.replace("float", "double"))
    ints = [(i, y, [int(256 * x) for x in v]) for i, y, v in data]
    assert mined(frame, "id % 40 = 0") == brute_force(ints, lambda i: i % 40 == 0)
    assert hn.integers(frame.withColumn("embedding", F.array(F.lit(1e300), F.lit(-1e300))), "vec_id", "label", "embedding").first().z == [1 << 27, -(1 << 27)]


def test_components_beyond_27_bits(spark):
    """Neither components nor anchors much larger than a block's rows saturate or lose digits."""
    rng = np.random.default_rng(9)
    scale = np.where(np.arange(360) % 9 == 0, 1e9, np.where(np.arange(360) % 4 == 0, 1e6, 3.0))  # wide, beyond 2^27, small
    data = [(i, i % 3, (rng.random(5) * scale[i]).astype(np.float32).tolist()) for i in range(360)]
    data += [(1001 + i, i % 3, (rng.random(5) * 1e4).astype(np.float32).tolist()) for i in range(300)]
    frame = spark.createDataFrame([r + ("z", 1, "a", 2, 3) for r in data], SCHEMA)
    most = max(abs(x) for _, _, v in as_integers(data) for x in v)
    assert most >= 1 << 31 and 5 * most * most < 1 << 127
    exact = brute_force(as_integers(data), lambda i: i % 20 == 0)
    fit = {r[0] for r in exact} - {r[0] for r in exact if max(abs(r[4]), abs(r[5])) >= 1 << 63}
    got = sorted(tuple(r) for r in hn.mine(hn.integers(frame, "vec_id", "label", "embedding", limit=hn.LONG), "id % 20 = 0").collect())
    assert len(fit) > 5 and [r for r in got if r[0] in fit] == [r for r in exact if r[0] in fit]
    assert {r[0] for r in exact} >= {r[0] for r in got}


def test_sums_that_wrap():
    """Partial sums beyond a long cancel exactly; a score beyond it stands at its end."""
    z = np.array([[1 << 40, 1 << 40, 3], [1 << 40, -(1 << 40), 3], [5, 6, 7]])
    block = hn.Block(np.arange(3), np.zeros(3, int), z, *hn.encode(z.astype(float), z.mean(axis=0)), z.mean(axis=0))
    q = np.array([[1 << 40, 1 << 40, 2], [1, 1, 1]])
    assert block.scorer(q)(0, np.arange(3)).tolist() == [(1 << 63) - 1, 6, 11 * (1 << 40) + 14]
    assert block.scorer(q)(1, np.arange(3)).tolist() == [(1 << 41) + 3, 3, 18]


def test_query_keeps_large_components(spark, tmp_path):
    """The query's scores of vectors beyond 2^19 are those of its contract."""
    rng = np.random.default_rng(10)
    data = [(i, i % 10, (rng.random(8) * 4e6).astype(np.float32).tolist()) for i in range(400)]
    spark.createDataFrame(data, "vec_id long, label int, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    rows = [(i, (y + 1) % 10 if i % 7 == 0 else y, z) for i, y, z in as_integers(data)]
    got = sorted(tuple(r) for r in hn.op11_hard_negatives(spark, str(tmp_path)).collect())
    assert got == brute_force(rows, lambda i: i % 100 == 0)
