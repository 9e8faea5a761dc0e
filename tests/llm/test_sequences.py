"""Every token of every document lies in a bin once, in order."""

from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.llm.sentencepiece_codec import decode_documents, encode_documents
from basketry.llm.sequences import packed_sequences

SMALL = {"lengths": (8, 16, 32), "overhead": 1.0, "block": 40}


def _unpacked(bins, id_col="doc_id"):
    """Lists of tokens by id, put together from the pieces; a repeated id has as many copies of each piece."""
    found = defaultdict(list)
    for b in bins:
        assert b.bin_used <= b.bin_capacity and len(b.token_ids) in (b.bin_used, b.bin_capacity)
        at = 0
        for p in b.pieces:
            assert p.bin_offset == at
            found[p[id_col]].append((p.first_token, b.token_ids[at:at + p.n_tokens]))
            at += p.n_tokens
        assert at == b.bin_used
    return found


@pytest.mark.parametrize("kind", ["long", "string"])
def test_all_tokens_once(spark, kind):
    rng = np.random.default_rng(2)
    rows = [(i if kind == "long" else f"k{i}", rng.integers(1, 999, rng.integers(0, 90)).tolist()) for i in range(150)]
    df = spark.createDataFrame(rows, f"doc_id {kind}, token_ids array<int>").repartition(5)
    for c in ("row", "tokens", "bin_id", "pieces", "p"):
        df = df.withColumn(c, F.lit("clash"))
    bins = packed_sequences(df, pad_token=0, **SMALL).collect()
    assert all(len(b.token_ids) == b.bin_capacity and set(b.token_ids[b.bin_used:]) <= {0} for b in bins)
    found = _unpacked(bins)
    for i, tokens in rows:
        whole = [t for _, part in sorted(found.get(i, [])) for t in part]
        assert whole == tokens
        assert [f for f, _ in sorted(found.get(i, []))] == list(range(0, len(tokens), 32))


def test_repeats_nulls_and_marks(spark):
    rows = [(1, [5, 6]), (1, [5, 6]), (1, [7]), (None, [8]), (2, None), (3, [])]
    df = spark.createDataFrame(rows, "doc_id long, token_ids array<int>")
    found = _unpacked(packed_sequences(df, **SMALL).collect())
    assert Counter(tuple(t) for _, t in found[1]) == {(5, 6): 2, (7,): 1}
    assert found[None] == [(0, [8])] and 2 not in found and 3 not in found
    marked = _unpacked(packed_sequences(df, end_token=99, **SMALL).collect())
    assert marked[2] == marked[3] == [(0, [99])] and marked[None] == [(0, [8, 99])]
    assert packed_sequences(df.limit(0), end_token=99).count() == 0


def test_real_tokens_round_trip(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").limit(60).cache()
    bins = packed_sequences(encode_documents(docs)).collect()
    found = _unpacked(bins)
    back = spark.createDataFrame([(i, [t for _, p in sorted(parts) for t in p]) for i, parts in found.items()],
                                 "doc_id long, token_ids array<int>")
    texts = {r.doc_id: r.text for r in decode_documents(back).collect()}
    same = {r.doc_id for r in encode_documents(docs).where("round_trip AND n_tokens > 0").collect()}
    assert same and all(texts[r.doc_id] == r.text for r in docs.collect() if r.doc_id in same)
    # bins are nearly full
    assert sum(b.bin_used for b in bins) > 0.9 * sum(b.bin_capacity for b in bins)
