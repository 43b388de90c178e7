"""BPE, token files and mixing: library results, exact round trips, budgets."""

import hashlib
import zlib

import numpy as np
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from martlake.llm import bpe, huffman, mixing, pieces, textkit, token_files
from tests.llm import frames


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(textkit.tokenizer_path(bpe.VOCABULARY))


@pytest.fixture(scope="module")
def library(codec):
    import public_tokenizers
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.rank, special_tokens={})


def test_bpe_is_the_librarys(spark, library):
    docs = frames.table(spark)
    want = []
    for r in docs.collect():
        ids = np.array(library.encode_ordinary(r.text or ""), "<u4")
        want.append((str(r.doc_id), len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()))
    got = [(str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.digests(docs).collect()]
    assert sorted(got) == sorted(want)
    assert bpe.digests(frames.empty(spark)).count() == 0
    whole = bpe.encode_decode(docs.filter("doc_id = 105")).first()
    assert whole.decoded.decode() == docs.filter("doc_id = 105").first().text


PARTS = st.sampled_from(["a", "b", "Next", " ", " ", "  ", "\n", "\n", "\n\n", "\r\n", "\r", "\t", "'s", "'ll", "'", "st", "!", "?.", ",", "12", "é", "ß",
                         "日本", "\u0085", "\u00a0", "\u2028", "\u3000", "\x1c", "~|<>", "<|", "|>", "<|endoftext|>", "endoftext"])


@settings(max_examples=400, deadline=None)
@given(st.lists(PARTS, max_size=25).map("".join))
def test_pieces_encode_like_the_text(codec, library, text):
    buf, off = textkit.flat_text(__import__("pyarrow").array([text, "x", text, "", "\n" + text]))
    (ids, at), (raw, to) = pieces.encoded_docs(codec.cache, buf, off)
    assert ids[at[0]:at[1]].tolist() == ids[at[2]:at[3]].tolist() == library.encode_ordinary(text)
    assert ids[at[4]:].tolist() == library.encode_ordinary("\n" + text)
    assert raw[to[0]:to[1]].astype(np.uint8).tobytes() == text.encode()


@pytest.fixture(scope="module")
def plain():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(textkit.tokenizer_path(token_files.VOCABULARY))


@settings(max_examples=400, deadline=None)
@given(st.lists(PARTS, max_size=25).map("".join))
def test_pieces_encode_like_the_plain_library_call(plain, text):
    cache = token_files._encoder(textkit.tokenizer_path(token_files.VOCABULARY))
    buf, off = textkit.flat_text(__import__("pyarrow").array([text, "x", text + "\n", "", text]))
    (ids, at), = pieces.encoded_docs(cache, buf, off)
    for i, t in enumerate([text, "x", text + "\n", "", text]):
        assert ids[at[i]:at[i + 1]].tolist() == plain.encode(t, add_special_tokens=False).ids


def test_cache_runs_and_refills():
    import pyarrow as pa
    cache = pieces.PieceCache(lambda ps: [[np.frombuffer(p, np.uint8).astype(np.int32) for p in ps]], remember=300)
    rng = np.random.default_rng(1)
    for _ in range(40):
        texts = [" ".join(f"w{k}" for k in rng.integers(0, 400, rng.integers(0, 60))) for _ in range(5)]
        buf, off = textkit.flat_text(pa.array(texts))
        (ids, at), = pieces.encoded_docs(cache, buf, off)
        assert [bytes(ids[a:b].astype(np.uint8)).decode() for a, b in zip(at, at[1:])] == texts


@settings(max_examples=40, deadline=None)
@given(st.text(st.sampled_from("abcdehilnorstu"), min_size=1, max_size=160))
def test_contractions_agree(codec, word):
    assert codec.contract_long(word.encode()) == codec.encode_words([word.encode()])[0].tolist()


def test_words_are_asked_of_duckdb_once(codec, monkeypatch):
    """New words take one recursive query; decoding them, and meeting them again, takes none."""
    asked = []

    class Counting:
        def __init__(self, db):
            self.db = db

        def __getattr__(self, name):
            return getattr(self.db, name)

        def execute(self, sql):
            if not sql.startswith("CREATE"):
                asked.append(sql)
            return self.db.execute(sql)

    monkeypatch.setattr(codec, "db", Counting(codec.db))
    given = [f" qz{i}xv don't \u00e9{i}\u4e2d".encode() for i in range(300)]
    for _ in range(2):
        ids, text = codec.encode_pieces(given)
        assert [t.tobytes() for t in text] == given and all(len(x) for x in ids)
        assert len(asked) == 1


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2000), max_size=300), st.integers(4, 15), st.integers(0, 9))
def test_huffman_round_trip(counts, limit, seed):
    counts = np.array(counts, np.int64)
    used = np.flatnonzero(counts)
    lengths = huffman.code_lengths(counts, limit)
    assert (lengths > 0).sum() == len(used)
    if len(used):
        assert lengths.max() <= max(limit, np.ceil(np.log2(max(len(used), 2))))
        assert (2.0 ** -lengths[used].astype(float)).sum() <= 1
    rng = np.random.default_rng(seed)
    n = rng.integers(0, 1500, 6) * bool(len(used))
    off = np.concatenate([[0], np.cumsum(n)])
    ids = rng.choice(used, off[-1]) if len(used) else np.zeros(0, np.int64)
    data, starts, checks, _ = huffman.pack(ids, off, huffman.canonical(lengths), lengths)
    assert np.array_equal(huffman.unpack(data, starts, n, checks, huffman.decode_table(lengths)), ids)


def test_code_is_optimal_without_a_limit():
    import heapq
    counts = np.random.default_rng(2).integers(1, 1000, 200)
    heap, cost = sorted(counts.tolist()), 0
    while len(heap) > 1:
        a = heapq.heappop(heap) + heapq.heappop(heap)
        cost += a
        heapq.heappush(heap, a)
    assert int((huffman.code_lengths(counts, 40).astype(int) * counts).sum()) == cost


def test_token_files(spark, tmp_path):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(textkit.tokenizer_path(token_files.VOCABULARY))
    more = [(200, "para\n\nNext"), (201, "\n\nfoo \n\nA"), (202, "<|endoftext|> hi<|endoftext|>there"), (203, "a <|endof"), (204, "text|> b")]
    docs = frames.table(spark).select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    token_files.write_files(docs, str(tmp_path / "a"))
    got = sorted(((r.doc_id is None, r.doc_id or 0, r.start, r.n_tokens, r.ids_crc32)
                  for r in token_files.with_starts(token_files.read_files(spark, str(tmp_path / "a"))).collect()))
    start, want = 0, []
    for r in sorted(docs.collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0)):
        ids = np.array(t.encode(r.text or "", add_special_tokens=False).ids + [token_files.END_ID], "<u4")
        want.append((r.doc_id is None, r.doc_id or 0, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert got == want
    token_files.write_files(frames.empty(spark), str(tmp_path / "b"))
    assert token_files.read_files(spark, str(tmp_path / "b")).count() == 0


def test_blocks_are_independent(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "_BLOCK", 500)
    docs = frames.table(spark)
    token_files.write_files(docs, str(tmp_path / "c"))
    files = spark.read.parquet(str(tmp_path / "c/blocks"))
    assert files.count() > 12
    out = token_files.with_starts(token_files.read_files(spark, str(tmp_path / "c"))).orderBy("start").collect()
    assert [r.start for r in out] == [0, *np.cumsum([r.n_tokens for r in out])[:-1]]


def test_mix_budgets(spark):
    docs = frames.table(spark)
    out = mixing.takes(docs.select("doc_id", "text", "source")).collect()
    again = mixing.takes(docs.select("doc_id", "text", "source").repartition(5)).collect()
    key = lambda r: (str(r.doc_id), r.size, r.taken)
    assert sorted(map(key, out)) == sorted(map(key, again))
    sizes = {}
    for r in out:
        s = sizes.setdefault(r.source, [0, 0, r.target, r.source_size])
        s[0], s[1] = s[0] + r.size, s[1] + r.taken
        assert 0 <= r.taken <= 2 * r.size
    total = sum(s[0] for s in sizes.values())
    names = sorted(sizes, key=lambda n: (n is None, n or ""))
    weight = {n: (3, 1, 2)[i % 3] for i, n in enumerate(names)}
    goal, left, free = {}, 1.5 * total, set(names)
    while True:  # share, cap, share the excess again
        level = left / sum(weight[n] for n in free)
        over = {n for n in free if weight[n] * level > 2 * sizes[n][0]}
        if not over:
            break
        for n in over:
            goal[n] = 2 * sizes[n][0]
            left -= goal[n]
        free -= over
    goal |= {n: weight[n] * level for n in free}
    for n, (size, taken, target, source_size) in sizes.items():
        assert source_size == size and target == pytest.approx(goal[n]) and abs(taken - target) < 1
    assert mixing.takes(frames.empty(spark)).count() == 0


def test_mix_rows(spark):
    docs = frames.table(spark).filter("doc_id <> 7")
    plan = {r.doc_id: r.taken for r in mixing.takes(docs).collect()}
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    words = {}
    for r in mixed.collect():
        words[r.doc_id] = words.get(r.doc_id, 0) + len(r.text.split())
        assert r.n_chars == len(r.text)
    ascii_only = {i for i in plan if i != 105}  # str.split knows more white space
    assert {i: n for i, n in words.items() if i in ascii_only} == {i: n for i, n in plan.items() if n and i in ascii_only}
    assert mixing.mix(frames.empty(spark)).count() == 0
