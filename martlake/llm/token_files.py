"""Token-id files: canonical length-limited Huffman coding of ids from global counts.

Documents are encoded by the tokenizers library (an end id behind each) into a table of raw
ids. Their counts over the whole corpus give one codebook. Coded documents are dealt to
shards of ascending doc_id ranges, sorted there and written as blocks, rows of a Parquet
data set: document ids, numbers of ids, coded bytes, bit-offset checkpoints. The codebook
(id, length) is written beside them. Reading needs the files only; blocks are independent
and decoded by table, wherever Spark reads them.

The string of an added token in a text is that token, as in the library's plain call. Null and
empty texts hold the end id only; very long texts are coded by pieces, one text's ids in a task
at once. Empty tables give an empty codebook and no blocks. Rows that repeat a doc_id stand next to each other, in no fixed order; rows with a null
doc_id come last. Extra columns are ignored.
"""

from __future__ import annotations

import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window as W
from pyspark.sql import functions as F

from martlake.llm import huffman, textkit as tk
from martlake.llm.pieces import PieceCache, encoded_docs

VOCABULARY = "byte_bpe_50k.json"
END_ID = 0
#: longest code; ids need 16 bits uncoded
LIMIT = 18
#: ids in a shard, and in a block of one
_SHARD, _BLOCK = 12_000_000, 400_000


def _encoder(path: str) -> PieceCache:
    held = tk.worker_cache("tokenizers")
    if path not in held:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        t = Tokenizer.from_file(path)
        literals = tuple(token.content.encode() for token in t.get_added_tokens_decoder().values())

        def encode(pieces):
            texts = [p.decode("utf-8", "replace") for p in pieces]
            return [[np.array(e.ids, np.int32) for e in t.encode_batch_fast(texts, add_special_tokens=False)]]
        held[path] = PieceCache(encode, literals=literals)
    return held[path]


def token_ids(docs: DataFrame, vocabulary: str = VOCABULARY, end_id: int = END_ID) -> DataFrame:
    """(doc_id, n, ids binary: little-endian uint16, which holds every id of the vocabulary)."""
    path = tk.tokenizer_path(vocabulary)

    def run(batches):
        cache = _encoder(path)
        for b in batches:
            buf, off = tk.flat_text(b.column("text"))
            for i, j in tk.doc_groups(off):
                (ids, at), = encoded_docs(cache, buf[off[i]:off[j]], off[i:j + 1] - off[i])
                n = np.diff(at)
                ends = np.cumsum(n + 1)
                out = np.full(int(ends[-1]), end_id, "<u2")
                out[np.arange(len(ids)) + np.repeat(np.arange(len(n)), n)] = ids
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(i, j - i), pa.array(n + 1),
                                                  tk.blobs(out, np.concatenate([[0], ends]))], names=["doc_id", "n", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n long, ids binary")


def _counts(batches):
    total = np.zeros(1 << 16, np.int64)
    for b in batches:
        data, _ = tk.flat_text(b.column("ids"))
        total += np.bincount(np.frombuffer(data.tobytes(), "<u2"), minlength=1 << 16)
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["id", "count"])


def _coded(code, bounds):
    def run(batches):
        lengths, edges = code.value, bounds.value
        codes = huffman.canonical(lengths)
        for b in batches:
            raw, off = tk.flat_text(b.column("ids"))
            for i, j in tk.doc_groups(off):
                ids = np.frombuffer(raw[off[i]:off[j]].tobytes(), "<u2")
                data, starts, checks, marks = huffman.pack(ids, (off[i:j + 1] - off[i]) // 2, codes, lengths)
                doc = b.column("doc_id").slice(i, j - i)
                shard = np.searchsorted(edges, doc.fill_null(np.iinfo(np.int64).max).to_numpy(), "right")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard.astype(np.int32)), doc, b.column("n").slice(i, j - i), tk.blobs(data, starts), tk.blobs(checks, marks)],
                    names=["shard", "doc_id", "n", "bits", "checks"])
    return run


_FILE = "shard int, block int, doc_ids binary, known binary, n binary, bytes binary, bits binary, checks binary"


def _blocks(rows):
    """The blocks of one shard, its documents in ascending doc_id order, null ids last."""
    rows = rows.sort_by([("doc_id", "ascending")])
    n = rows.column("n").to_numpy()
    block = (np.cumsum(n) - n) // _BLOCK
    cuts = np.append(np.flatnonzero(np.diff(block, prepend=-1)), len(n))
    out = {k: [] for k in ("shard", "block", "doc_ids", "known", "n", "bytes", "bits", "checks")}
    for k, (i, j) in enumerate(zip(cuts, cuts[1:])):
        part = rows.slice(i, j - i)
        ids = part.column("doc_id").combine_chunks()
        bits, starts = tk.flat_text(part.column("bits"))
        checks, _ = tk.flat_text(part.column("checks"))
        for name, value in (("shard", part.column("shard")[0].as_py()), ("block", k), ("doc_ids", ids.fill_null(0).to_numpy().astype("<i8").tobytes()),
                            ("known", ids.is_valid().to_numpy(zero_copy_only=False).tobytes()), ("n", n[i:j].astype("<u4").tobytes()),
                            ("bytes", np.diff(starts).astype("<u4").tobytes()), ("bits", bits.tobytes()), ("checks", checks.tobytes())):
            out[name].append(value)
    return pa.table(out, schema=pa.schema([("shard", pa.int32()), ("block", pa.int32()),
                                           *[(k, pa.binary()) for k in list(out)[2:]]]))


def write_files(docs: DataFrame, folder: str, vocabulary: str = VOCABULARY) -> None:
    """Encodes ``docs`` and writes ``folder``/codebook and ``folder``/blocks."""
    spark = docs.sparkSession
    raw = tk.scratch(spark, "ids")
    token_ids(docs, vocabulary).write.option("compression", "zstd").parquet(raw)
    ids = spark.read.parquet(raw)
    # at most one row for each id of the vocabulary
    found = ids.select("ids").mapInArrow(_counts, "id long, count long").groupBy("id").agg(F.sum("count").alias("count")).toPandas()
    counts = np.zeros(1 << 16, np.int64)
    counts[found["id"].to_numpy(int)] = found["count"].to_numpy(int)
    lengths = huffman.code_lengths(counts, LIMIT)
    used = np.flatnonzero(lengths)
    spark.createDataFrame([(int(i), int(lengths[i])) for i in used], "id long, length int").coalesce(1).write.parquet(f"{folder}/codebook")
    n_shards = tk.parts_for(int(counts.sum()), _SHARD, 12)
    edges = ids.approxQuantile("doc_id", [k / n_shards for k in range(1, n_shards)], 0.1 / n_shards) if n_shards > 1 else []
    edges = np.unique(np.array(edges or [], float)).astype(np.int64)
    send = spark.sparkContext.broadcast
    coded = ids.mapInArrow(_coded(send(lengths), send(edges)), "shard int, doc_id long, n long, bits binary, checks binary")
    # already coded: Parquet's own compression would find nothing
    (coded.repartition(n_shards, "shard").groupBy("shard").applyInArrow(_blocks, _FILE)
     .write.option("compression", "none").parquet(f"{folder}/blocks"))


def read_files(spark: SparkSession, folder: str) -> DataFrame:
    """(shard, doc_id, start within the shard, n_tokens, ids_crc32) of every document."""
    book = spark.read.parquet(f"{folder}/codebook").collect()
    lengths = np.zeros(max([r.id for r in book], default=0) + 1, np.uint8)
    for r in book:
        lengths[r.id] = r.length
    sent = spark.sparkContext.broadcast(lengths)

    def run(batches):
        table = huffman.decode_table(sent.value)
        for b in batches:
            for row in b.to_pylist():
                n = np.frombuffer(row["n"], "<u4").astype(np.int64)
                starts = np.concatenate([[0], np.cumsum(np.frombuffer(row["bytes"], "<u4").astype(np.int64))])
                ids = huffman.unpack(np.frombuffer(row["bits"], np.uint8), starts, n, np.frombuffer(row["checks"], np.uint32), table)
                ids, off = ids.astype("<u4"), np.concatenate([[0], np.cumsum(n)])
                crc = [zlib.crc32(ids[x:y]) for x, y in zip(off, off[1:])]
                doc = pa.array(np.frombuffer(row["doc_ids"], "<i8"), mask=~np.frombuffer(row["known"], bool))
                one = np.ones(len(n), np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(one * row["shard"]), pa.array(one * row["block"]), doc, pa.array(off[:-1]),
                                                  pa.array(n), pa.array(crc, pa.int64())],
                                                 names=["shard", "block", "doc_id", "at", "n_tokens", "ids_crc32"])

    return spark.read.parquet(f"{folder}/blocks").mapInArrow(run, "shard int, block int, doc_id long, at long, n_tokens long, ids_crc32 long")


def with_starts(read: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32): start counts the ids of all documents before."""
    size = read.groupBy("shard", "block").agg(F.sum("n_tokens").alias("size"))
    shards = size.groupBy("shard").agg(F.sum("size").alias("size"))  # one row a shard file
    before = lambda w: F.coalesce(F.sum("size").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    base = shards.select("shard", before(W.orderBy("shard")).alias("base"))
    inner = size.select("shard", "block", before(W.partitionBy("shard").orderBy("block")).alias("inner"))
    return read.join(inner, ["shard", "block"]).join(base, "shard").select(
        "doc_id", (F.col("base") + F.col("inner") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = tk.scratch(spark, "token-files")
    write_files(tk.read_table(spark, sf_dir, "documents"), folder)
    return with_starts(tk.stored(read_files(spark, folder), "decoded"))
