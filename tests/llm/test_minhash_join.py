"""MinHash join against brute force; the pigeonhole guarantee; crowded keys."""

import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from martlake.llm import minhash_join as mj, textkit as tk
from tests.llm import frames

WORD = re.compile("[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, width=mj.WIDTH):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[k:k + width]) for k in range(max(1, len(w) - width + 1))) if w else frozenset()


def brute_force(rows):
    """Sorted (doc_id, n, component, kept) of (doc_id, text) rows."""
    sets = [(i, shingles(t)) for i, t in rows]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and 100 * min(len(a), len(b)) >= 80 * max(len(a), len(b)):
                n = len(a & b)
                if 100 * n >= 80 * (len(a) + len(b) - n):
                    x, y = find(i), find(j)
                    root[max(x, y)] = min(x, y)
    least = {}
    for i, (d, a) in enumerate(sets):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    out = []
    for i, (d, a) in enumerate(sets):
        c = least.get(find(i)) if a else d
        out.append((str(d), len(a), str(c), c is None if d is None or c is None else d == c))
    return sorted(out)


def found(docs):
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in mj.groups(docs).collect())


def test_awkward_rows(spark):
    docs = frames.table(spark)
    assert found(docs) == brute_force([(r.doc_id, r.text) for r in docs.collect()])
    assert mj.groups(frames.empty(spark)).count() == 0
    assert mj.groups(docs.limit(1)).count() == 1


def edited(rng, words, changes):
    words = list(words)
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
    return " ".join(words)


def test_crowded_keys(spark):
    """Templates whose copies link in chains, not all with one of them; texts of stock sentences
    that share keys and link with nothing; exact copies."""
    rng = random.Random(11)
    rows = []
    for t in range(2):
        base = [f"b{t}w{rng.randrange(3000)}" for _ in range(150)]
        rows += [edited(rng, base, rng.randrange(1, 9)) for _ in range(90)]
    stock = [" ".join(f"s{k}v{rng.randrange(900)}" for _ in range(12)) for k in range(14)]
    rows += [" ".join(rng.sample(stock, 7)) for _ in range(120)]
    rows += [rows[3]] * 40 + ["same words here"] * 20
    order = list(range(len(rows)))
    rng.shuffle(order)
    rows = [(i, rows[k]) for i, k in enumerate(order)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    join = mj.Join(docs)
    assert join.cells.selectExpr("max(c)").first()[0] > mj.FEW
    assert found(docs) == brute_force(rows)


def test_similarity_at_the_bound(spark):
    """Pairs at 100 * intersection = 80 * union, and one shingle below."""
    word = iter(f"w{i}" for i in range(10**6))
    rows, want = [], []
    for k in range(60):
        # sets of 4m + r shingles: the first 4m in common, the rest of b only
        m = 5 + k % 7
        a = [next(word) for _ in range(4 * m + 3)]
        b = a + [next(word) for _ in range(m + k % 2)]
        rows += [(2 * k, " ".join(a)), (2 * k + 1, " ".join(b))]
        want += [(2 * k, 2 * k), (2 * k + 1, 2 * k + k % 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((r.doc_id, r.component_id) for r in mj.groups(docs).collect()) == want


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(0, mj.RADIUS))
def test_signatures_within_the_radius_share_a_key(seed, errors):
    rng = np.random.default_rng(seed)
    a = rng.integers(0, 1 << 16, (1, mj.SYMBOLS)).astype(np.uint16)
    b = a.copy()
    # the worst places: errors gathered where a chunk bears them, or spread evenly
    at = rng.choice(mj.SYMBOLS, errors, replace=False) if seed % 2 else (np.arange(errors) * mj.CHUNK % mj.SYMBOLS + np.arange(errors) * mj.CHUNK // mj.SYMBOLS)
    b[0, at] ^= rng.integers(1, 1 << 16, errors).astype(np.uint16)
    assert set(mj.chunk_keys(a)[0]) & set(mj.chunk_keys(b)[0])
    assert sum(e + 1 for e in mj.ERRORS) == mj.RADIUS + 1 and len(mj.ERRORS) * mj.CHUNK == mj.SYMBOLS


def test_signature_estimates_similarity():
    rng = np.random.default_rng(4)
    differ = []
    for _ in range(300):
        h = rng.integers(0, 1 << 63, 500).astype(np.uint64)
        a, b = np.sort(h[:450]), np.sort(h[50:])
        s = mj.signatures(np.concatenate([a, b]), np.array([0, 450, 900]))
        differ.append((s[0] != s[1]).sum())
    assert np.mean(differ) == pytest.approx(mj.SYMBOLS * 0.2, rel=0.05) and max(differ) <= mj.RADIUS
    assert np.std(differ) == pytest.approx(np.sqrt(mj.SYMBOLS * 0.2 * 0.8), rel=0.15)


@settings(max_examples=50, deadline=None)
@given(st.lists(st.text(st.sampled_from("aAbB é \n\t"), max_size=40), min_size=1, max_size=6), st.integers(1, 5))
def test_shingle_sets(texts, width):
    import pyarrow as pa
    buf, off = tk.flat_text(pa.array(texts))
    sets, first = tk.shingle_sets(buf, off, width)
    want = [shingles(t, width) for t in texts]
    assert np.diff(first).tolist() == [len(w) for w in want]
    for i in range(len(texts)):
        for j in range(i):
            assert len(np.intersect1d(sets[first[i]:first[i + 1]], sets[first[j]:first[j + 1]])) == len(want[i] & want[j])
    masks = tk.parity_masks(sets, first, 2)
    for i in range(len(texts)):
        for j in range(i):
            assert np.bitwise_count(masks[i] ^ masks[j]).sum() <= len(want[i] ^ want[j])
    keys = tk.set_keys(sets, first)
    assert all((keys[i] == keys[j]) == (want[i] == want[j]) for i in range(len(texts)) for j in range(i))
