"""Every operator over documents: text ids, columns of clashing names and a very long text."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.llm.exact_dedup import exact_dedup
from basketry.llm.language_id import identify_languages
from basketry.llm.lm_score import stupid_backoff
from basketry.llm.merkle import merkle_manifest
from basketry.llm.packing import best_fit_pack, word_tokens
from basketry.llm.quality import quality_rules
from basketry.llm.sentencepiece_codec import encode_documents
from basketry.llm.simhash import simhash_components
from basketry.llm.spelling import spelled_words
from basketry.llm.suffix_dedup import strip_repeats, suffix_dedup
from basketry.llm.toxicity import toxicity_scores
from tests.llm.test_simhash import slow_fingerprint

CLASHING = ["id", "rid", "key", "digest", "size", "winner", "kept", "fp", "root", "block", "ids", "words", "body", "spans",
            "n", "word", "h", "th", "y", "fold", "held_out", "score", "label", "toxic", "total", "piece", "first_token",
            "bin_id", "_id", "_text", "_raw", "g_0", "found", "sha", "leaf", "node", "features", "lang_pred", "top",
            "component_id", "group_size", "keep_id", "n_words", "text_sha256", "base_failed", "distance2", "ID_", "Spans_"]
LONG = 7


def _rows():
    rng = np.random.default_rng(5)
    words = ["".join(rng.choice(list("abcdeilnorst"), rng.integers(3, 9))) for _ in range(3000)]
    text = lambda n: " ".join(rng.choice(words, n))
    rows = {i: text(60 + i) for i in range(40)}
    rows[3], rows[4] = rows[2].upper(), rows[2]
    rows[LONG] = text(300_000)  # 2 MB without a line break
    rows[8] = text(20) + " " + rows[LONG][1_000_000:1_000_900] + " " + text(30)
    rows[9], rows[10], rows[11] = None, "", " \t\n "
    rows[12] = "x" * 200_000  # one word
    return rows


ROWS = _rows()


def _docs(spark, text_ids):
    name = (lambda i: f"d{i:03d}") if text_ids else int
    rows = [(name(i), ["a", None, "b"][i % 3], ["en", "de"][i % 2], None if t is None else len(t), t)
            for i, t in ROWS.items()]
    kind = "string" if text_ids else "long"
    df = spark.createDataFrame(rows, f"doc_id {kind}, source string, lang string, n_chars long, text string")
    if text_ids:
        df = df.withColumns({c: F.lit(f"clash {c}") for c in CLASHING})
    return df


@pytest.fixture(scope="module")
def plain(spark):
    return _docs(spark, False).cache()


@pytest.fixture(scope="module")
def clashing(spark):
    return _docs(spark, True).cache()


def _same(op, plain, clashing, ids=("doc_id",), drop=()):
    """Both give the same rows, ids translated; returns those of the plain table."""
    number = lambda v: None if v is None else int(v[1:]) if isinstance(v, str) else v
    got = []
    for docs in (plain, clashing):
        rows = [r.asDict(recursive=True) for r in op(docs).collect()]
        for r in rows:
            r.update({c: number(r[c]) for c in ids})
            r.update({c: round(v, 6) for c, v in r.items() if isinstance(v, float)})
            for c in drop:
                r.pop(c)
        got.append(sorted(rows, key=lambda r: tuple(str(r[c]).zfill(6) for c in r)))
    assert got[0] == got[1]
    return {r["doc_id"]: r for r in got[0]}, got[0]


def test_exact_dedup(plain, clashing):
    by, rows = _same(exact_dedup, plain, clashing, ("doc_id", "keep_id"))
    assert len(rows) == len(ROWS) and [by[i]["keep_id"] for i in (2, 3, 4, 9, 10, LONG)] == [4, 4, 4, 10, 10, LONG]
    assert by[LONG]["text_sha256"] == hashlib.sha256(ROWS[LONG].lower().encode()).hexdigest()


def test_lm_scoring(plain, clashing):
    by, rows = _same(stupid_backoff, plain, clashing)
    assert {i: r["n_tokens"] for i, r in by.items()} == {i: len((t or "").split()) for i, t in ROWS.items()}


def test_simhash(plain, clashing):
    by, rows = _same(simhash_components, plain, clashing, ("doc_id", "component_id"))
    assert len(rows) == len(ROWS)
    for i in (2, LONG, 9, 12):
        assert by[i]["fingerprint"] == f"{slow_fingerprint(ROWS[i]):016x}"


def test_quality(plain, clashing):
    by, rows = _same(quality_rules, plain, clashing)
    assert {i: r["n_words"] for i, r in by.items()} == {i: len((t or "").split()) for i, t in ROWS.items()}
    assert by[12]["word_chars"] == 200_000 and by[12]["base_failed"]


def test_repeats(plain, clashing):
    by, rows = _same(suffix_dedup, plain, clashing)
    assert {i: r["n_bytes"] for i, r in by.items()} == {i: len(t or "") for i, t in ROWS.items()}
    # the passage taken from the long text, and the word of one letter, go
    assert by[LONG]["n_removed"] >= 900 and by[LONG]["n_spans"] == 1 and by[12]["n_removed"] == 200_000
    _, stripped = _same(lambda d: strip_repeats(d).select("doc_id", "text"), plain, clashing)
    left = {r["doc_id"]: r["text"] for r in stripped}
    assert left[9] is None and len(left[LONG]) == len(ROWS[LONG]) - by[LONG]["n_removed"]
    kept = strip_repeats(clashing)
    assert kept.columns == clashing.columns
    assert kept.select("spans", "ID_").distinct().collect() == [("clash spans", "clash ID_")]


def test_languages(plain, clashing):
    by, rows = _same(lambda d: identify_languages(d, F.lit(False)), plain, clashing)
    assert len(rows) == len(ROWS) and by[9]["lang_pred"] == by[11]["lang_pred"] == "und"


def test_packing(plain, clashing):
    op = lambda d: best_fit_pack(d, word_tokens(F.col("text"))).select("doc_id", "piece", "first_token", "n_tokens")
    _, rows = _same(op, plain, clashing)
    found = {}
    for r in rows:
        found[r["doc_id"]] = found.get(r["doc_id"], 0) + r["n_tokens"]
    assert found == {i: len((t or "").split()) + 1 for i, t in ROWS.items()}


def test_sentencepiece(plain, clashing):
    by, rows = _same(encode_documents, plain, clashing)
    assert len(rows) == len(ROWS)


def test_manifest(plain, clashing):
    # ids are part of the leaves, so only the shape is the same
    for docs in (plain, clashing):
        got = merkle_manifest(docs).collect()
        assert len(got) == len(ROWS) and all(r.verified for r in got) and len({r.root for r in got}) == 1


def test_spelled_words(plain, clashing):
    # the slips depend on the id, so only the words that no slip can touch are the same
    for docs in (plain, clashing):
        n = {r.word: r.n for r in spelled_words(docs, slips=10 ** 12).collect()}
        runs = [w for t in ROWS.values() for w in re.findall("[A-Za-zÀ-ÿ]+", t or "") if len(w) >= 6]
        assert sum(n.values()) == len(runs) and n["x" * 200_000] == 1


def test_toxicity(spark, plain, clashing):
    for docs in (plain, clashing):
        labels = docs.select("doc_id", F.when(F.col("text").startswith(ROWS[5][:4]), 1).otherwise(0).alias("toxic"))
        got = toxicity_scores(docs, labels, F.lit(False)).collect()
        assert len(got) == len(ROWS) and all(0 <= r.score <= 1 for r in got)
        by = {str(r.doc_id).lstrip("d").zfill(3): r.score for r in got}
        assert by["009"] == by["010"] == by["011"]
