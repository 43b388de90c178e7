"""Language-model scoring with a subword lattice.

Tokens are lower-cased words and one end per text. The model interpolates absolute-discounted
word counts with a subword lattice: P(w) = max(c - d, 0) / N + (d V / N) L(w), where L(w) is
the marginal probability of w's characters over all its segmentations into pieces of an
existing public vocabulary, by a forward recursion in log space. The vocabulary's own scores
weight the pieces at first (p ~ 1 / (rank + 10), as the scores are merge ranks); one pass of
expectation over every distinct training word then re-weights them. Single bytes are pieces
too, so every word has a segmentation.

Documents are dealt to chunks. A chunk sends its distinct words once, dealt by word hash to
buckets; a bucket adds up their training counts, and each chunk gets back count and lattice
probability of its own words. So a frequent word costs one entry for each chunk, and no task
holds the whole vocabulary.

Null and empty texts hold the end token only. Rows with a null doc_id are neither held out
nor learned from. Repeated rows count each, equal texts get equal scores. Very long texts are
rows like any other, a chunk holds one at least; a word of any length has a lattice. An empty table
gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlake.llm import textkit as tk

VOCABULARY = "piece_bpe_32k.model"
#: probability of the end token in the lattice's own distribution
_END = 1e-3
_CHUNK_TEXT = 8 << 20
_WORDS = 25_000  # of one lattice


class Pieces:
    """Piece hashes by length in bytes, with ids and log probabilities."""

    def __init__(self, pieces: list[bytes], logp: np.ndarray):
        raw, size = np.frombuffer(b"".join(pieces), np.uint8), np.array([len(p) for p in pieces])
        ends = np.cumsum(size)
        h = tk.span_hashes(raw, ends - size, ends)
        self.logp, self.by_size = logp, {}
        for n in np.unique(size):
            at = np.flatnonzero(size == n)
            at = at[np.argsort(h[at])]
            self.by_size[int(n)] = (h[at], at)


def vocabulary(path: str) -> tuple[list[bytes], np.ndarray]:
    """Pieces as bytes (a leading space for the word start mark) and log probabilities from
    the vocabulary's scores."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    score = {bytes([b]): None for b in range(256)}
    for i in range(sp.get_piece_size()):
        if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i):
            continue
        p = sp.id_to_piece(i).replace("▁", " ").encode()
        if b" " not in p[1:]:
            score[p] = sp.get_score(i)
    worst = min(s for s in score.values() if s is not None) - 1
    pieces = sorted(score)
    rank = -np.array([worst if score[p] is None else score[p] for p in pieces])
    weight = 1 / (rank - rank.min() + 10)
    return pieces, np.log(weight / weight.sum())


def _edges(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, pieces: Pieces):
    """All (start, end, piece) of pieces standing in the words raw[starts:ends]."""
    at = tk.ragged(starts, ends - starts)
    stop = np.repeat(ends, ends - starts)
    up, down = tk._powers(len(raw))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:len(raw)], dtype=np.uint64)])
    s, e, k = [], [], []
    for n, (hashes, ids) in sorted(pieces.by_size.items()):
        fits = at + n <= stop
        at, stop = at[fits], stop[fits]
        if not len(at):
            break
        # as textkit.span_hashes, with the sums shared by all lengths
        h = tk.mix((sums[at + n] - sums[at]) * down[at] + np.uint64(n * 0xD6E8FEB86659FD93 % 2**64))
        j = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
        hit = np.flatnonzero(hashes[j] == h)
        s.append(at[hit])
        e.append(at[hit] + n)
        k.append(ids[j[hit]])
    return np.concatenate(s), np.concatenate(e), np.concatenate(k)


def _recursion(into: np.ndarray, out_of: np.ndarray, weight: np.ndarray, depth: np.ndarray, place: np.ndarray, first: np.ndarray):
    """Log-space sums over all paths: value[p] = logsumexp of value[out_of] + weight over the
    edges into p, by ``depth`` of p; value is 0 at ``first``."""
    value = np.full(place, -np.inf)
    value[first] = 0.0
    by = np.lexsort((into, depth))
    into, out_of, weight, depth = into[by], out_of[by], weight[by], depth[by]
    level = np.searchsorted(depth, np.arange(1, (depth[-1] if len(depth) else 0) + 2))
    for a, b in zip(level, level[1:]):
        if a == b:
            continue
        x = value[out_of[a:b]] + weight[a:b]
        p = into[a:b]
        cut = np.flatnonzero(np.concatenate([[True], p[1:] != p[:-1]]))
        top = np.maximum.reduceat(x, cut)
        n = np.diff(np.append(cut, b - a))
        value[p[cut]] = top + np.log(np.add.reduceat(np.exp(x - np.repeat(top, n)), cut))
    return value


def lattice(raw: np.ndarray, off: np.ndarray, pieces: Pieces, expect: bool = False):
    """Log probability of every word raw[off[i]:off[i+1]]; with ``expect`` instead the
    expected number of every piece in one occurrence of each word."""
    out, total = np.empty(len(off) - 1), np.zeros(len(pieces.logp))
    for a in range(0, len(off) - 1, _WORDS):
        z = min(a + _WORDS, len(off) - 1)
        n = np.diff(off[a:z + 1]) + 1
        ends = np.cumsum(n)
        starts = ends - n
        text = np.full(int(ends[-1]), 32, np.uint8)
        text[tk.ragged(starts + 1, n - 1)] = raw[off[a]:off[z]]
        s, e, k = _edges(text, starts, ends, pieces)
        # node p of a word is the place before its byte p; a word's last node has one of its own
        word = np.searchsorted(ends, s, "right")
        s, e = s + word, e + word
        first, last = starts + np.arange(z - a), ends + np.arange(z - a)
        w = pieces.logp[k]
        alpha = _recursion(e, s, w, e - first[word], len(text) + z - a, first)
        out[a:z] = alpha[last]
        if expect:
            beta = _recursion(s, e, w, last[word] - s, len(text) + z - a, last)
            total += np.bincount(k, np.exp(alpha[s] + w + beta[e] - alpha[last][word]), len(total))
    return total if expect else out


def _tokens(texts):
    """Lower-cased bytes, word spans, first word of each document, and their hashes."""
    buf, off = tk.flat_text(texts)
    buf = tk.TO_LOWER[buf]
    s, e, first, h = [], [], [np.zeros(1, np.int64)], []
    for i, j in tk.doc_groups(off, 1 << 20):
        part = buf[off[i]:off[j]]
        a, b, f = tk.words(part, off[i:j + 1] - off[i])
        h.append(tk.span_hashes(part, a, b))
        first.append(f[1:] + first[-1][-1])
        s.append(a + off[i])
        e.append(b + off[i])
    join = lambda x, t: np.concatenate(x) if x else np.zeros(0, t)
    return buf, join(s, np.int64), join(e, np.int64), np.concatenate(first), join(h, np.uint64)


def _distinct(h: np.ndarray, n_buckets: int):
    """Distinct hashes by bucket: (hashes, one occurrence of each, entry of every word, cuts)."""
    u, one, each = np.unique(h, return_index=True, return_inverse=True)
    bucket = (u % np.uint64(n_buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    entry = np.empty(len(u), np.int64)
    entry[order] = np.arange(len(u))
    return u[order], one[order], entry[each], np.searchsorted(bucket[order], np.arange(n_buckets + 1))


_SENT = "chunk int, bucket int, hashes binary, sizes binary, words binary, counts binary, n_docs long"


def _send(n_buckets):
    def run(rows):
        buf, s, e, first, h = _tokens(rows.column("text"))
        learn = rows.column("learn").to_numpy()
        u, one, entry, cut = _distinct(h, n_buckets)
        counts = np.bincount(entry[np.repeat(learn, np.diff(first))], minlength=len(u))
        size = (e - s)[one]
        at = np.concatenate([[0], np.cumsum(size)])
        words = buf[tk.ragged(s[one], size)]
        n_docs = np.zeros(n_buckets, np.int64)
        n_docs[0] = learn.sum()
        return pa.table({"chunk": pa.array(np.full(n_buckets, rows.column("chunk")[0].as_py(), np.int32)),
                         "bucket": pa.array(np.arange(n_buckets, dtype=np.int32)), "hashes": tk.blobs(u, cut),
                         "sizes": tk.blobs(size.astype(np.uint32), cut), "words": tk.blobs(words, at[cut]),
                         "counts": tk.blobs(counts.astype(np.int64), cut), "n_docs": n_docs})
    return run


def _column(rows, name, kind):
    return [np.frombuffer(x.as_buffer(), kind) for x in rows.column(name)]


_BUCKET = "bucket int, chunks binary, cuts binary, entries binary, sizes binary, words binary, counts binary, expected binary, n_docs long"


def _collect(sent):
    def run(rows):
        pieces = Pieces(*sent.value)
        h = _column(rows, "hashes", np.uint64)
        cuts = np.concatenate([[0], np.cumsum([len(x) for x in h])])
        u, one, entry = np.unique(np.concatenate(h), return_index=True, return_inverse=True)
        counts = np.bincount(entry, np.concatenate(_column(rows, "counts", np.int64)).astype(np.float64), len(u)).astype(np.int64)
        size = np.concatenate(_column(rows, "sizes", np.uint32)).astype(np.int64)
        at = np.concatenate([[0], np.cumsum(size)])
        words = np.concatenate(_column(rows, "words", np.uint8))[tk.ragged(at[one], size[one])]
        size = size[one]
        known = counts > 0
        keep = np.repeat(known, size)
        expected = lattice(words[keep], np.concatenate([[0], np.cumsum(size[known])]), pieces, True)
        one_row = lambda x: pa.array([x.tobytes()], pa.binary())
        return pa.table({"bucket": pa.array([rows.column("bucket")[0].as_py()], pa.int32()),
                         "chunks": one_row(rows.column("chunk").to_numpy().astype(np.int32)), "cuts": one_row(cuts),
                         "entries": one_row(entry.astype(np.uint32)), "sizes": one_row(size.astype(np.uint32)), "words": one_row(words),
                         "counts": one_row(counts), "expected": one_row(expected),
                         "n_docs": pa.array([int(rows.column("n_docs").to_numpy().sum())], pa.int64())})
    return run


def _sums(batches):
    """Word statistics and expected piece numbers of the buckets."""
    for b in batches:
        for c, x, n in zip(_column(b, "counts", np.int64), _column(b, "expected", np.float64), b.column("n_docs").to_pylist()):
            key = np.concatenate([np.arange(-5, 0), np.arange(len(x))])
            value = np.concatenate([[c.sum(), (c > 0).sum(), (c == 1).sum(), (c == 2).sum(), n], x])
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(value)], names=["k", "v"])


def _answer(sent):
    def run(batches):
        pieces = Pieces(*sent.value)
        for b in batches:
            cols = [_column(b, c, t) for c, t in (("chunks", np.int32), ("cuts", np.int64), ("entries", np.uint32),
                                                  ("sizes", np.uint32), ("words", np.uint8), ("counts", np.int64))]
            for bucket, chunks, cuts, entry, size, words, counts in zip(b.column("bucket").to_pylist(), *cols):
                logp = lattice(words, np.concatenate([[0], np.cumsum(size.astype(np.int64))]), pieces)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(chunks), pa.array(np.full(len(chunks), bucket, np.int32)), tk.blobs(counts[entry], cuts),
                     tk.blobs(logp[entry].astype(np.float32), cuts)], names=["chunk", "bucket", "counts", "logp"])
    return run


def _score(n_buckets, stats):
    n, v, d, c_end = stats

    def run(rows, answers):
        _, _, _, first, h = _tokens(rows.column("text"))
        _, _, entry, _ = _distinct(h, n_buckets)
        answers = answers.sort_by("bucket")
        c = np.concatenate(_column(answers, "counts", np.int64) or [np.zeros(0, np.int64)])
        logp = np.concatenate(_column(answers, "logp", np.float32) or [np.zeros(0, np.float32)]).astype(float)
        with np.errstate(divide="ignore"):
            base = np.log10((np.append(c, c_end) + 0.5) / (n + 0.5 * (v + 1)))
            inside = np.append(np.exp(logp) * (1 - _END), _END)
            # far below the smallest double only the logarithm is left
            deep = np.append(logp + np.log1p(-_END), np.log(_END)) / np.log(10)
            seen, left = (np.maximum(np.append(c, c_end) - d, 0) / n, d * v / n) if n else (0.0, 1.0)
            p = seen + left * inside
            model = np.where(p > 1e-290, np.log10(np.maximum(p, 1e-300)), np.log10(left) + deep)
        size = np.diff(first)
        doc = np.repeat(np.arange(len(size)), size)
        add = lambda x: np.bincount(doc, x[:-1][entry], len(size)) + x[-1]
        return pa.table({"doc_id": rows.column("doc_id"), "held_out": rows.column("held_out"), "n_tokens": size + 1,
                         "n_known": add((np.append(c, c_end) > 0).astype(float)).astype(np.int64),
                         "train_tokens": np.full(len(size), int(n)), "base_score": add(base), "score": add(model)})
    return run


def score(docs: DataFrame, learn, held_out, path: str | None = None) -> DataFrame:
    """Scores all ``docs`` (doc_id, text) by the model of the rows for which the boolean
    column ``learn`` holds; ``held_out`` is passed through."""
    spark = docs.sparkSession
    send = spark.sparkContext.broadcast
    _, size = tk.text_bytes(docs)
    n_chunks = tk.parts_for(size, _CHUNK_TEXT, 12)
    rows = docs.select("doc_id", "text", learn.alias("learn"), held_out.alias("held_out"),
                       F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_chunks)).cast("int").alias("chunk"))
    pieces, logp = vocabulary(path or tk.tokenizer_path(VOCABULARY))
    sent = rows.select("chunk", "text", "learn").repartition(n_chunks, "chunk").groupBy("chunk").applyInArrow(_send(n_chunks), _SENT)
    buckets = tk.stored(sent.repartition(n_chunks, "bucket").groupBy("bucket").applyInArrow(_collect(send((pieces, logp))), _BUCKET), "words")
    # five statistics and one number for each piece of the vocabulary
    sums = buckets.select("counts", "expected", "n_docs").mapInArrow(_sums, "k long, v double").groupBy("k").agg(F.sum("v").alias("v")).toPandas()
    by = dict(zip(sums["k"], sums["v"]))
    expected = np.array([by.get(i, 0.0) for i in range(len(pieces))])
    logp = np.log((expected + 0.5 * np.exp(logp) * len(pieces)) / (expected.sum() + 0.5 * len(pieces)))
    words, distinct, once, twice, n_docs = (by.get(k, 0.0) for k in range(-5, 0))
    d = once / (once + 2 * twice) if once else 0.5
    stats = (words + n_docs, distinct + (n_docs > 0), d, n_docs)
    answers = buckets.mapInArrow(_answer(send((pieces, logp))), "chunk int, bucket int, counts binary, logp binary")
    both = rows.groupBy("chunk").cogroup(answers.groupBy("chunk"))
    return both.applyInArrow(_score(n_chunks, stats), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                                                      "base_score double, score double")


def op2_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tk.read_table(spark, sf_dir, "documents").select("doc_id", "text")
    held = F.coalesce(tk.crc_bucket(F.col("doc_id")) == 1, F.lit(False))
    return score(docs, F.col("doc_id").isNotNull() & ~held, held)
