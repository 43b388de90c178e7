"""Byte-level BPE encoding and decoding with recursive queries inside each partition.

Spark deals the documents; each task turns its texts into distinct pieces, splits them by the
pre-tokenizer pattern and hands the distinct matches to an in-memory DuckDB as a table of
token positions (word, pos, token), one token for each byte. A recursive query joins
neighbouring positions to the merge table, contracts each word's leftmost pair of minimum
rank, and repeats until no pair of the word merges. The ids are turned back into bytes by the
vocabulary's bytes and their offsets. Documents are put together from their pieces.

The recursion keeps every step's rows, which for one word grow with the square of its length;
words of more than ``LONG`` bytes are contracted by the same rule with a heap instead.

Null and empty texts have no ids and decode to no bytes. Rows, repeated or with a null
doc_id, are encoded each, equal texts alike. Very long texts are rows like any other. An empty
table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from martlake.llm import textkit as tk
from martlake.llm.pieces import PieceCache, encoded_docs

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
LONG = 100
#: words of one recursive query
_WORDS = 20_000
#: bytes of text whose new pieces are encoded at once: their words and the recursion's steps are what a
#: worker holds most of
_CHUNK = 1 << 20
#: distinct pieces a worker remembers, with ids and bytes
_REMEMBER = 400_000

# a position's id is word * 128 + its place in the word's bytes; a pair of tokens goes by one number
# a word without a pair left is done: it's given out once more and not looked at again
_CONTRACT = """
WITH RECURSIVE step(done, id, tok) AS (
  SELECT false, id, tok FROM start
  UNION ALL
  (WITH pairs AS MATERIALIZED (
     SELECT p.id, p.tok, p.next_id, m.made
     FROM (SELECT id, tok, next_id, CASE WHEN id >> 7 = next_id >> 7 THEN tok::BIGINT << 32 | next END AS pair
           FROM (SELECT id, tok, lead(tok) OVER w AS next, lead(id) OVER w AS next_id FROM step WHERE NOT done WINDOW w AS (ORDER BY id))) p
     LEFT JOIN merges m ON m.pair = p.pair),
   least AS MATERIALIZED (
     SELECT id >> 7 AS word, min(made * 128 + (id & 127)) AS pair, arg_min(next_id, made * 128 + (id & 127)) AS gone
     FROM pairs GROUP BY id >> 7)
   SELECT pair IS NULL, id, CASE WHEN id & 127 = pair & 127 THEN pair >> 7 ELSE tok END
   FROM pairs JOIN least ON id >> 7 = word WHERE pair IS NULL OR id <> gone)
)
SELECT id >> 7 AS word, tok FROM step WHERE done ORDER BY id
"""


class Codec:
    """The vocabulary, its merge table and a DuckDB connection of one worker."""

    def __init__(self, path: str):
        import duckdb
        import public_tokenizers
        import regex
        with open(path, "rb") as f:
            self.rank = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.byte = np.array([self.rank[bytes([i])] for i in range(256)], np.int32)
        # every way in which a token's bytes are two tokens' bytes merges to it
        merges = np.array([(self.rank[t[:i]], self.rank[t[i:]], r) for t, r in self.rank.items()
                           for i in range(1, len(t)) if t[:i] in self.rank and t[i:] in self.rank], np.int64)
        self.db = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "400MB", "temp_directory": ""})
        self._table("merges", pair=merges[:, 0] << 32 | merges[:, 1], made=merges[:, 2].astype(np.int32))
        # the bytes of id i are vocabulary[first[i]:first[i + 1]]
        size = np.zeros(max(self.rank.values()) + 1, np.int64)
        size[list(self.rank.values())] = [len(t) for t in self.rank]
        self.first = np.concatenate([[0], np.cumsum(size)])
        self.vocabulary = np.frombuffer(b"".join(sorted(self.rank, key=self.rank.get)), np.uint8)
        self.cache = PieceCache(self.flat_pieces, 2, remember=_REMEMBER)
        self._forget()
        del merges
        tk.release()  # the table was built of some hundred thousand Python objects

    def _forget(self):
        # the ids of the word of slot i are ids[ends[i]:ends[i + 1]]
        self.known: dict[str, int] = {}
        self.ids, self.ends = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def _table(self, name, **columns):
        self.db.register("given", pa.table(columns))
        self.db.execute(f"CREATE OR REPLACE TEMP TABLE {name} AS SELECT * FROM given")
        self.db.unregister("given")

    def contract_long(self, word: bytes) -> list[int]:
        """The leftmost minimum-rank contraction of one word, with a heap of pairs."""
        tok = [word[i:i + 1] for i in range(len(word))]
        after, before = list(range(1, len(tok) + 1)), list(range(-1, len(tok) - 1))
        heap = [(r, i, 2) for i in range(len(tok) - 1) if (r := self.rank.get(tok[i] + tok[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, size = heapq.heappop(heap)
            j = after[i] if tok[i] else len(tok)
            if j >= len(tok) or len(tok[i]) + len(tok[j]) != size or self.rank.get(tok[i] + tok[j]) != r:
                continue
            tok[i], tok[j] = tok[i] + tok[j], b""
            after[i] = after[j]
            if after[j] < len(tok):
                before[after[j]] = i
            for p, q in ((before[i], i), (i, after[i])):
                if p >= 0 and q < len(tok) and (r := self.rank.get(tok[p] + tok[q])) is not None:
                    heapq.heappush(heap, (r, p, len(tok[p]) + len(tok[q])))
        return [self.rank[t] for t in tok if t]

    def flat_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words one after another, number of ids of each), of distinct pre-tokenizer
        matches."""
        n = np.zeros(len(words), np.int64)
        whole, todo, found = {}, [], []  # found: words, their ids
        for i, w in enumerate(words):
            if (r := self.rank.get(w)) is not None:
                whole[i] = r
            elif len(w) > LONG:
                ids = self.contract_long(w)
                n[i] = len(ids)
                found.append(([i], ids))
            else:
                todo.append(i)
        n[list(whole)] = 1
        found.append((list(whole), list(whole.values())))
        for k in range(0, len(todo), _WORDS):
            part = todo[k:k + _WORDS]
            size = np.fromiter((len(words[i]) for i in part), np.int64, len(part))
            raw = np.frombuffer(b"".join(words[i] for i in part), np.uint8)
            self._table("start", id=tk.ragged(np.arange(len(part)) * 128, size).astype(np.int32), tok=self.byte[raw])
            r = self.db.execute(_CONTRACT).fetchnumpy()
            n[part] = np.bincount(r["word"], minlength=len(part))
            found.append((part, r["tok"]))
        first = np.cumsum(n) - n
        out = np.empty(int(n.sum()), np.int32)
        for part, ids in found:
            out[tk.ragged(first[part], n[part])] = ids
        return out, n

    def encode_words(self, words: list[bytes]) -> list[np.ndarray]:
        """Token ids of distinct pre-tokenizer matches."""
        return _cut(*self.flat_words(words))

    def flat_pieces(self, pieces: list[bytes]):
        """(values, number of them) of every piece's ids and of its decoded bytes."""
        split = [self.pattern.findall(p.decode("utf-8", "surrogateescape")) for p in pieces]
        if len(self.known) > _REMEMBER // 3:
            self._forget()
        known = self.known
        words = [w for ws in split for w in ws]
        new = list({w: None for w in words if w not in known})
        if new:
            ids, n = self.flat_words([w.encode("utf-8", "surrogateescape") for w in new])
            known.update(zip(new, range(len(known), len(known) + len(new))))
            self.ids, self.ends = np.concatenate([self.ids, ids]), np.concatenate([self.ends, self.ends[-1] + np.cumsum(n)])
        slot = np.fromiter((known[w] for w in words), np.int64, len(words))
        n = self.ends[slot + 1] - self.ends[slot]
        ids = self.ids[tk.ragged(self.ends[slot], n)]
        size = self.first[ids + 1] - self.first[ids]
        ends = np.concatenate([[0], np.cumsum(n)])[np.cumsum(np.fromiter(map(len, split), np.int64, len(split)))]
        return (ids, np.diff(ends, prepend=0)), \
            (self.vocabulary[tk.ragged(self.first[ids], size)], np.diff(np.concatenate([[0], np.cumsum(size)])[ends], prepend=0))

    def encode_pieces(self, pieces: list[bytes]):
        """(ids, decoded bytes) of every piece."""
        return tuple(_cut(*x) for x in self.flat_pieces(pieces))


def _cut(values: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    """``values`` in parts of the given sizes."""
    ends = np.cumsum(sizes).tolist()
    return [values[i:j] for i, j in zip([0, *ends], ends)]


def _codec(path: str) -> Codec:
    held = tk.worker_cache("bpe")
    if path not in held:
        held[path] = Codec(path)
    return held[path]


def encode_decode(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, ids binary: little-endian uint32, decoded binary) of every document."""
    path = tk.tokenizer_path(vocabulary)
    tk.small_batches(docs.sparkSession)

    def run(batches):
        codec = _codec(path)
        for b in batches:
            buf, off = tk.flat_text(b.column("text"))
            for i, j in tk.doc_groups(off, _CHUNK):
                (ids, at), (text, to) = encoded_docs(codec.cache, buf[off[i]:off[j]], off[i:j + 1] - off[i])
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(i, j - i), tk.blobs(ids.astype("<u4"), at), tk.blobs(text.astype(np.uint8), to)],
                    names=["doc_id", "ids", "decoded"])

    return docs.select("doc_id", "text").mapInArrow(tk.tidy(run), "doc_id long, ids binary, decoded binary")


def digests(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): ``encode_decode`` digested in the
    worker, so that ids and texts don't travel."""
    path = tk.tokenizer_path(vocabulary)
    tk.small_batches(docs.sparkSession)

    def run(batches):
        codec = _codec(path)
        for b in batches:
            buf, off = tk.flat_text(b.column("text"))
            for i, j in tk.doc_groups(off, _CHUNK):
                (ids, at), (text, to) = encoded_docs(codec.cache, buf[off[i]:off[j]], off[i:j + 1] - off[i])
                ids, text = ids.astype("<u4"), text.astype(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(i, j - i), pa.array(np.diff(at)),
                     pa.array([hashlib.sha256(ids[x:y]).hexdigest() for x, y in zip(at, at[1:])]),
                     pa.array([hashlib.sha256(text[x:y]).hexdigest() for x, y in zip(to, to[1:])])],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(tk.tidy(run), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(tk.read_table(spark, sf_dir, "documents"))
