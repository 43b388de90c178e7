"""Line dedup, n-gram join and byte-string dedup against brute force."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from martlake.llm import components, line_dedup, ngram_join, suffix_dedup
from tests.llm import frames

WORD = re.compile("[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_lines(spark):
    docs = frames.table(spark)
    rows = docs.collect()
    sites, first = defaultdict(set), {}
    for r in rows:
        for line in (r.text or "").split("\n"):
            if WORD.search(line):
                sites[line].add(r.source)
                if r.doc_id is not None:
                    first[line] = min(first.get(line, r.doc_id), r.doc_id)
    want = []
    for r in rows:
        kept, once = [], set()
        lines = [] if r.text is None else r.text.split("\n")
        for line in lines:
            bad = len(sites[line]) >= line_dedup.MIN_SITES
            if not bad or (first.get(line) == r.doc_id and line not in once):
                kept.append(line)
            once.add(line)
        want.append((str(r.doc_id), len(lines), len(lines) - len(kept), None if r.text is None else "\n".join(kept)))
    out = line_dedup.clean_lines(docs)
    assert out.columns == docs.columns + ["kept_text", "n_lines", "n_removed"]
    got = [(str(r.doc_id), r.n_lines, r.n_removed, r.kept_text) for r in out.collect()]
    assert sorted(got, key=str) == sorted(want, key=str) and any(w[2] for w in want)
    assert line_dedup.clean_lines(frames.empty(spark)).count() == 0


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def brute_groups(rows):
    sets = [(r.doc_id, shingles(r.text)) for r in rows]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            n = len(a & b)
            if a and b and 100 * n >= 75 * (len(a) + len(b) - n):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    least = {}
    for i, (d, a) in enumerate(sets):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted((str(d), len(a), least.get(find(i)) if a else d) for i, (d, a) in enumerate(sets))


def test_groups(spark):
    docs = frames.table(spark)
    got = sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in ngram_join.groups(docs).collect())
    assert got == brute_groups(docs.collect())
    assert ngram_join.groups(frames.empty(spark)).count() == 0


def test_groups_of_many_near_copies(spark, monkeypatch):
    """Crowded columns: chains of near copies, a passage that unlike documents share."""
    rng = random.Random(3)
    word = lambda: f"{rng.choice('abcdefgh')}{rng.randrange(5000)}"
    base, passage = [word() for _ in range(100)], [word() for _ in range(60)]
    rows = []
    for i in range(60):  # drifting copies: far ends don't link, neighbours do
        for _ in range(2):
            base[rng.randrange(100)] = word()
        rows.append((i, " ".join(base)))
    rows += [(100 + i, " ".join(passage + [word() for _ in range(rng.randrange(5, 40))])) for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(ngram_join, "FEW", 3)
    got = sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in ngram_join.groups(docs).collect())
    assert got == brute_groups(docs.collect())


def stock_texts(n, seed=5, of=30, take=8):
    """Texts of ``take`` out of ``of`` stock sentences: they share columns and link with nothing."""
    rng = random.Random(seed)
    stock = [" ".join(f"s{k}v{rng.randrange(900)}" for _ in range(12)) for k in range(of)]
    return [(i, " ".join(rng.sample(stock, take))) for i in range(n)]


@pytest.mark.parametrize("hot", [3, ngram_join.HOT])
def test_hot_columns(spark, monkeypatch, hot):
    """Columns that skip the blocks give the same components."""
    monkeypatch.setattr(ngram_join, "HOT", hot)
    rng = random.Random(8)
    base = [f"b{rng.randrange(4000)}" for _ in range(90)]
    rows = [t for _, t in stock_texts(60, of=12, take=6)]
    for _ in range(60):
        words = list(base)
        for _ in range(rng.randrange(1, 6)):
            words[rng.randrange(90)] = f"x{rng.randrange(10**6)}"
        rows.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(3)
    got = sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in ngram_join.groups(docs).collect())
    assert got == brute_groups(docs.collect())


def test_unlinked_texts_of_stock_sentences_make_few_pairs(spark, monkeypatch):
    """Candidate pairs grow no faster than the texts where nothing links."""
    confirm, tried = ngram_join.Reader.confirm, []

    def counting(self, pairs):
        out = confirm(self, pairs)
        tried[-1] += pairs.count()
        return out

    monkeypatch.setattr(ngram_join.Reader, "confirm", counting)
    for n in (300, 600):
        docs = spark.createDataFrame(stock_texts(n), "doc_id long, text string")
        tried.append(0)
        ngram_join.groups(docs).count()
    assert tried[0] <= 300 and tried[1] <= 600


def test_a_piece_sends_its_own_rows_only():
    """What a piece of text sends to the blocks is bounded by its entries, for any number of blocks."""
    from types import SimpleNamespace
    texts = pa.table({"text": [" ".join(f"{i}w{k}" for k in range(200)) for i in range(300)]}).to_batches()
    none = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, bool)
    sent = {}
    for n_blocks in (12, 1920, 30_000):
        sent[n_blocks] = sum(b.get_total_buffer_size() for b in ngram_join._deal(n_blocks, SimpleNamespace(value=none))(texts))
    entries = 300 * 50
    assert all(s < entries * 60 for s in sent.values()) and sent[30_000] < 4 * sent[12]


def test_a_passage_is_counted_over_all_tasks(spark, monkeypatch):
    """A passage of many texts crowds no column, also where no task sees it twice."""
    rng = random.Random(11)
    word = lambda: f"w{rng.randrange(10**7)}"
    passage = [word() for _ in range(30)]
    rows = [(i, " ".join([word() for _ in range(150)] + passage)) for i in range(40)]
    docs = spark.createDataFrame(spark.sparkContext.parallelize(rows, 40), "doc_id long, text string")
    settle, crowded = ngram_join.settle, []

    def counting(cells, *rest):
        crowded.append(cells.count())
        return settle(cells, *rest)

    monkeypatch.setattr(ngram_join, "settle", counting)
    got = sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in ngram_join.groups(docs).collect())
    assert crowded == [0] and got == brute_groups(docs.collect())


def test_keep_one(spark):
    docs = frames.table(spark)
    kept = ngram_join.keep_one(docs)
    groups = {r.doc_id: r.component_id for r in ngram_join.groups(docs).collect()}
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    # the repeated row 7 stays once; the row with a null id links with none
    assert sorted(map(str, ids)) == sorted(["None", *(str(i) for i, c in groups.items() if i is not None and c == i)])
    assert ngram_join.keep_one(frames.empty(spark)).count() == 0


def test_keep_one_of_rows_that_share_an_id(spark):
    long = lambda k: " ".join(f"{k}w{i}" for i in range(40))
    rows = [(1, long("a"), "x"), (5, long("a"), "y"), (5, long("b"), "z"), (9, long("b"), "z"), (9, long("b"), "z"),
            (7, long("c"), "q"), (7, long("c"), "q"), (None, long("d"), "n"), (None, long("d"), "n"), (None, long("a"), "n"),
            (3, "", "e"), (3, "", "e"), (4, None, "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, id string")
    got = sorted((str(r.doc_id), r.text, r.id) for r in ngram_join.keep_one(docs).collect() if r.text)
    assert got == sorted([("1", long("a"), "x"), ("5", long("b"), "z"), ("7", long("c"), "q"), ("None", long("d"), "n")])
    assert ngram_join.keep_one(docs).filter("text = '' OR text IS NULL").count() == 3


def test_texts_that_no_pair_names_stay_where_they_are(spark):
    """Only texts of the classes asked for are dealt out, in each round."""
    docs = spark.range(20_000).selectExpr("id AS rid", "concat('text ', id) AS text")
    wanted = spark.range(0, 20_000, 50).selectExpr("id AS rid", "id + 7 AS class")
    kept = {r.rid for r in components.tk.screened(docs, "rid", wanted).collect()}
    assert kept >= set(range(0, 20_000, 50)) and len(kept) < 1000
    crowded = {r.rid for r in components.tk.screened(docs, "rid", wanted, 256).collect()}  # a bitmap too small loses nothing
    assert crowded >= set(range(0, 20_000, 50))
    reader = components.Reader(docs, wanted.unionByName(wanted.selectExpr("rid + 1 AS rid", "class")), None)
    assert reader.texts.count() == 800
    pairs = spark.createDataFrame([(7, 57)], "a long, b long")
    assert components.tk.screened(reader.texts, "class", pairs.selectExpr("a AS class")).count() < 20


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (203, 201), (202, 203)]
    got = {r.v: r.root for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    want = {i: 0 for i in range(1, 41)} | {100 + i: 100 for i in range(1, 30)} | {202: 201, 203: 201}
    assert got == want


def brute_strip(rows):
    """Rows in place order; rows of one doc_id judged against earlier ids and themselves."""
    seen, out = set(), []
    by_id = defaultdict(list)
    for r in rows:
        by_id[(r.doc_id is None, r.doc_id)].append((r.text or "").encode())
    for key in sorted(by_id, key=lambda k: (k[0], k[1] or 0)):
        new = set()
        starts = defaultdict(lambda: 1 << 60)  # within one id: the earliest start of a string
        for b in by_id[key]:
            for k in range(len(b) - 99):
                starts[b[k:k + 100]] = min(starts[b[k:k + 100]], k)
        for b in by_id[key]:
            gone = np.zeros(len(b) + 1, bool)
            for k in range(len(b) - 99):
                w = b[k:k + 100]
                if w in seen or starts[w] < k:
                    gone[k:k + 100] = True
                new.add(w)
            gone = gone[:-1]
            out.append((str(key[1]), len(b), int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum()),
                        hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest()))
        seen |= new
    return sorted(out)


def strip(docs):
    return sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
                  for r in suffix_dedup.strip_repeats(docs, digest=True).collect())


def test_byte_strings(spark):
    docs = frames.table(spark)
    extra = [(300, "ab" * 400), (301, "z" * 5000), (302, "z" * 99), (303, "é" * 200), (304, "tail " + "ab" * 60 + " end")]
    docs = docs.unionByName(spark.createDataFrame(extra, "doc_id long, text string"), allowMissingColumns=True)
    assert strip(docs) == brute_strip(docs.collect())
    assert strip(frames.empty(spark)) == []


def test_byte_strings_in_segments(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "_SEGMENT", 3000)
    docs = frames.table(spark, seed=4, n=24)
    assert strip(docs) == brute_strip(docs.collect())


def licensed(n):
    """Texts with one line, shorter than a window, in different surroundings."""
    rnd = random.Random(n)
    letters = lambda k: "".join(rnd.choices("abcdefghijklmnopqrstuvwxyz ", k=k))
    return [f"{letters(150)}\n{'licensed to all readers under the usual terms of the house'}\n{letters(150)}" for _ in range(n)]


def largest_group(texts, crowded):
    buf, off = suffix_dedup.tk.flat_text(pa.array(texts))
    anchor, text, *_ = suffix_dedup._stretches(buf, off, crowded)
    pairs = np.unique(np.stack([anchor, text]), axis=1)
    return int(np.unique(pairs[0], return_counts=True)[1].max())


def test_a_common_line_is_no_anchor(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CROWD", 20)
    texts = licensed(300)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    crowded = suffix_dedup.crowded_grams(docs)
    assert largest_group(texts, np.zeros(0, np.uint64)) > 200
    assert largest_group(texts, crowded) <= 20


def test_byte_strings_with_crowded_anchors(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CROWD", 5)
    texts = licensed(40)
    texts += [texts[3][100:260], texts[5], "x" + texts[7][90:], texts[9][:205] + texts[11][150:], texts[3][160:] * 2]
    docs = frames.table(spark, seed=6, n=24).select("doc_id", "text") \
        .unionByName(spark.createDataFrame([(1000 + i, x) for i, x in enumerate(texts)], "doc_id long, text string"))
    assert len(suffix_dedup.crowded_grams(docs.repartition(2)))
    assert strip(docs) == brute_strip(docs.collect())


def test_copies_are_dealt_by_document():
    texts = ["".join(random.Random(1).choices("abcdefghij", k=400))] * 200
    rows = np.random.default_rng(1).integers(-2**63, 2**63 - 1, 200)
    b = pa.RecordBatch.from_pydict({"doc_id": list(range(200)), "text": texts, "row": rows})
    runs = suffix_dedup._runs(b, 16, np.zeros(0, np.uint64)).to_pylist()
    sizes = [len(r["doc"]) // 4 for r in runs if r["gone"]]
    assert len(sizes) == 16 and max(sizes) < sum(sizes) / 4


@pytest.mark.parametrize("wide", [40, 300])
def test_interleave_orders_suffixes(wide):
    rng = np.random.default_rng(wide)
    strings = [rng.integers(1, wide, rng.integers(30, 60)) for _ in range(12)]
    strings += [s.copy() for s in strings[:3]]
    shards = []
    for k in range(3):
        part = [np.append(s, 0) for s in strings[k::3]]
        shards.append((np.concatenate(part), np.concatenate([[0], np.cumsum([len(p) for p in part])])))
    order, suffix, new = suffix_dedup.interleave(shards, 10)

    def prefix(k, i):
        s, o = shards[k]
        j = np.searchsorted(o, i, "right") - 1
        r = s[o[j]:o[j + 1]]
        return tuple(np.tile(r, 2)[i - o[j]:i - o[j] + 10])
    got = [prefix(k, i) for k, i in zip(order, suffix)]
    assert got == sorted(got)
    assert list(new) == [True] + [a != b for a, b in zip(got, got[1:])]
