"""The pipeline's stages, each judged on its own input, and the registered SQL."""

import hashlib

import duckdb
import numpy as np
import pytest
import tiktoken

import __spark_entry__ as E
import corpus_pipeline
from martlake.llm import bpe, line_dedup, mixing, quality, registry, textkit
from tests.helpers import canon
from tests.llm import frames
from tests.llm.test_dedup import brute_groups

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_parity(spark, name):
    df = E.queries()[name](spark, SMALL)
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    res = con.execute(E.oracle_sql()[name])
    columns = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(columns)
    assert canon(df.columns, [tuple(r) for r in df.collect()]) == canon(columns, res.fetchall())


def test_every_operator_is_registered():
    names = [n for n in E.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in E.queries()


def test_stages(spark):
    docs = textkit.read_table(spark, SMALL, "documents")
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = textkit.stored(stage(spark, docs, SMALL), "stage")
        out[name] = docs
    first, lines, near, mixed, tokens = (out[n] for n, _ in corpus_pipeline.STAGES)
    for stage in (first, lines, near, mixed):
        assert stage.columns == corpus_pipeline.COLUMNS
    labels = textkit.read_table(spark, SMALL, "labels")
    scores = {r.doc_id: r.predicted for r in quality.quality_scores(spark, textkit.read_table(spark, SMALL, "documents"), labels).collect()}
    assert {r.doc_id for r in first.collect()} == {i for i, p in scores.items() if p}
    kept = {r.doc_id: r.kept_text for r in line_dedup.clean_lines(first).collect()}
    assert {r.doc_id: r.text for r in lines.collect()} == kept
    assert {r.doc_id for r in near.collect()} == {int(i) for i, _, c in brute_groups(lines.collect()) if str(c) == i}
    taken = {r.doc_id: r.taken for r in mixing.takes(near).collect()}
    words = {}
    for r in mixed.collect():
        words[r.doc_id] = words.get(r.doc_id, 0) + len(r.text.split())
    assert words == {i: n for i, n in taken.items() if n}
    import public_tokenizers
    codec = bpe.Codec(textkit.tokenizer_path(bpe.VOCABULARY))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.rank, special_tokens={})
    want = sorted((r.doc_id, hashlib.sha256(np.array(library.encode_ordinary(r.text), "<u4").tobytes()).hexdigest()) for r in mixed.collect())
    assert sorted((r.doc_id, r.ids_sha256) for r in tokens.collect()) == want
    assert sorted(map(tuple, corpus_pipeline.run(spark, SMALL).collect())) == sorted(map(tuple, tokens.collect()))


def test_stages_take_awkward_rows(spark):
    docs = frames.table(spark).select(*corpus_pipeline.COLUMNS)
    for _, stage in corpus_pipeline.STAGES:
        docs = textkit.stored(stage(spark, docs, SMALL), "stage")
    assert docs.count() > 0
    empty = frames.empty(spark).select(*corpus_pipeline.COLUMNS)
    for _, stage in corpus_pipeline.STAGES:
        empty = textkit.stored(stage(spark, empty, SMALL), "stage")
    assert empty.count() == 0
