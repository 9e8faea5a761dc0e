"""run() against a plain version of the same five decisions."""

from collections import Counter

import pytest

import corpus_pipeline as P
from tests.llm.test_simhash import slow_components
from tests.llm.test_suffix_dedup import slow_strip


@pytest.fixture(scope="module")
def stages(spark, sf_small):
    """Rows after each stage over sf0.001, as {doc_id: text}, and the packed pieces."""
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").cache()
    out, columns = [{r.doc_id: r.text for r in docs.collect()}], docs.columns
    for _, stage in P.STAGES[:-1]:
        docs = P.shared_table(stage(spark, docs, sf_small), "test-stage")
        assert docs.columns == columns
        rows = docs.collect()
        assert all(r.n_chars == len(r.text) for r in rows)
        out.append({r.doc_id: r.text for r in rows})
    return out, P.STAGES[-1][1](spark, docs, sf_small).collect()


def test_exact_stage_keeps_largest_id_of_equal_texts(stages):
    before, after = stages[0][1], stages[0][2]
    best = {}
    for d, t in before.items():
        key = "".join(c.lower() if c.isascii() else c for c in t)
        best[key] = max(best.get(key, d), d)
    assert set(after) == set(best.values())


def test_near_stage_keeps_least_id_of_components(stages):
    before, after = stages[0][2], stages[0][3]
    assert set(after) == {c for _, _, c in slow_components(list(before.items()))}


def test_repeat_stage_removes_what_brute_force_removes(stages):
    before, after = stages[0][3], stages[0][4]
    assert after == slow_strip(list(before.items()), 200, 51)
    shared = Counter()
    for text in after.values():
        words = text.split()
        shared.update({tuple(words[i:i + 52]) for i in range(len(words) - 51)})
    assert max(shared.values()) == 1


def test_packing_holds_every_token_once(stages):
    texts, pieces = stages[0][4], stages[1]
    total = Counter()
    for p in pieces:
        total[p.doc_id] += p.n_tokens
        assert p.bin_offset + p.n_tokens <= p.bin_used <= p.bin_capacity
    assert total == {d: len(t.encode().split()) + 1 for d, t in texts.items()}


def test_run_is_the_same_as_the_stages(spark, sf_small, stages):
    got = {(r.doc_id, r.piece, r.n_tokens) for r in P.run(spark, sf_small).collect()}
    assert got == {(r.doc_id, r.piece, r.n_tokens) for r in stages[1]}


SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, kept boolean, n int, "
          "id_ int, sha_ int, n_ int, kept_id int, spans_ int, id int, bin_id int, digest int, fp int")
CLASH = (False, 1, 1, 1, 1, 1, 1, 1, 1, 1, 1)


def test_repeated_rows_nulls_and_clashing_columns(spark, sf_small):
    rows = [(1, "A b"), (1, "a B"), (2, "c"), (2, "c"), (3, "x y"), (3, "z"), (None, "n"), (None, None),
            (4, ""), (4, None)]
    df = spark.createDataFrame([(d, t, None, "s", len(t or ""), *CLASH) for d, t in rows], SCHEMA)
    got = [(r.doc_id, (r.text or "").lower()) for r in P.exact(spark, df, sf_small).collect()]
    assert sorted(got, key=str) == sorted(
        [(1, "a b"), (2, "c"), (3, "x y"), (3, "z"), (None, "n"), (4, "")], key=str)


def test_empty_table(spark, sf_small):
    df = spark.createDataFrame([], SCHEMA)
    for _, stage in P.STAGES:
        assert stage(spark, df, sf_small).count() == 0


def test_every_stage_with_clashing_columns(spark, sf_small):
    text = " ".join(f"word{i}" for i in range(200))
    rows = [(i, f"{text} {i}" if i % 3 else None, None, None, 0, *CLASH) for i in range(6)]
    df = spark.createDataFrame(rows, SCHEMA)
    for name, stage in P.STAGES[:-1]:
        got = stage(spark, df, sf_small)
        assert got.columns == df.columns, name
        assert all(r.spans_ == 1 and r.n == 1 for r in got.collect())
    assert P.STAGES[-1][1](spark, df, sf_small).count() == 6
