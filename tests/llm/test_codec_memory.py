"""The codec keeps words and pieces in flat arrays; a mask's bits are counted as they are."""

import numpy as np
import pyarrow as pa
import pytest
import tiktoken

from martlake.llm import bpe, pieces, textkit as tk


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(tk.tokenizer_path(bpe.VOCABULARY))


def test_words_are_no_objects_of_their_own(codec):
    import public_tokenizers
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.rank, special_tokens={})
    texts = [f"qz{i}xv don't the of é{i}中 " + "ab" * (i % 90) for i in range(400)] + ["", "the"]
    buf, off = tk.flat_text(pa.array(texts))
    (ids, at), (raw, to) = pieces.encoded_docs(codec.cache, buf, off)
    for i, t in enumerate(texts):
        assert ids[at[i]:at[i + 1]].tolist() == library.encode_ordinary(t) and raw[to[i]:to[i + 1]].tobytes() == t.encode()
    assert all(isinstance(slot, int) for slot in codec.known.values()) and codec.ends[-1] == len(codec.ids)
    words = ["the", "x" * 300, "qz7xv", "zzqj"]
    assert [x.tolist() for x in codec.encode_words([w.encode() for w in words])] == [library.encode_ordinary(w) for w in words]
    assert codec.encode_words([]) == []


def test_a_chunk_is_small(monkeypatch, spark):
    """No more than a megabyte of text (or one long text) is encoded at once."""
    seen = []
    groups = tk.doc_groups
    monkeypatch.setattr(tk, "doc_groups", lambda off, *size: seen.append(size) or groups(off, *size))
    class Docs:  # the function that runs in a worker, run here
        sparkSession = spark

        def select(self, *_):
            return self

        def mapInArrow(self, run, _):
            return run
    text = "word " * 20_000
    run = bpe.digests(Docs())
    out = list(run(iter([pa.RecordBatch.from_arrays([pa.array(range(40)), pa.array([text] * 40)], names=["doc_id", "text"])])))
    assert sum(b.num_rows for b in out) == 40 and len(out) == 4 and seen == [(1 << 20,)]


def test_masks_with_the_top_bit_count_right():
    buf, off = tk.flat_text(pa.array(["A", "ABéABB"]))
    masks = tk.parity_masks(*tk.shingle_sets(buf, off, 1), 2)
    assert np.bitwise_count(masks[0] ^ masks[1]).sum() <= 2
