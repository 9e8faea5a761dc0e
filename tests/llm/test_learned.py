"""Toxicity and language identification: held-out accuracy and defined results."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.llm import language_id as G, toxicity as T
from basketry.llm.queries import QUERIES

DOCS = "doc_id long, text string, lang string, score string"


def test_kneser_ney_is_a_distribution():
    words = {0: "the cat sat on the mat then ran", 1: "bad cat bad hat sad rat the"}
    counts = {c: Counter(T.padded(w, 4)[i:i + 4] for w in t.split() for i in range(len(w) + 1)) for c, t in words.items()}
    model = T.KneserNey(counts, 4, 3)
    letters = set("".join(words.values()).replace(" ", "")) | {T.END}
    for c in (0, 1):
        for h in ("\x02\x02\x02", "\x02ca", "the", "zzz"):
            total = sum(model.probability(c, h + x) for x in letters)
            # one more symbol stands for every character not seen
            assert total + model.probability(c, h + "☃") == pytest.approx(1.0)
    assert model.evidence("bad") > 0 > model.evidence("mat")
    assert model.evidence("qqq") == pytest.approx(
        sum(math.log(model.probability(1, g) / model.probability(0, g)) for g in
            (T.padded("qqq", 4)[i:i + 4] for i in range(4))))


def test_toxicity_held_out(spark):
    rng = np.random.default_rng(0)
    word = lambda: "".join(rng.choice(list("abcdehilnorst"), rng.integers(2, 7)))
    rows, labels = [], []
    for i in range(400):
        words = [word() for _ in range(40)]
        y = int(i % 5 == 0)
        for j in range(3 * y):
            words[5 * j] = "xqz" + word()
        rows.append((i, " ".join(words), "en", "x"))
        labels.append((i, y))
    rows += [(900, None, None, "x"), (901, "", None, "x"), (None, "xqzabc xqzab xqzb", None, "x"), (0, rows[0][1], "en", "x")]
    labels += [(0, 7), (1, None)]
    docs = spark.createDataFrame(rows, DOCS)
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    held = F.col("doc_id") % 4 == 2
    got = T.toxicity_scores(docs, lab, held).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    truth = dict(labels[:400])
    test = [r for r in got if r.held_out]
    assert np.mean([r.predicted == truth[r.doc_id] for r in test]) > 0.97
    by = {r.doc_id: r for r in got}
    assert by[900].score == by[901].score and by[None].predicted == 1 and not by[None].held_out
    flipped = lab.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = {r.doc_id: r.score for r in T.toxicity_scores(docs, flipped, held).collect()}
    assert again == {r.doc_id: r.score for r in got}  # held-out labels are not looked at
    none = T.toxicity_scores(docs, lab.filter("toxic = 0"), held).collect()
    assert {(r.score, r.predicted) for r in none} == {(0.0, 0)}
    assert T.toxicity_scores(docs.limit(0), lab, held).count() == 0


def test_mixture_finds_proportions():
    rng = np.random.default_rng(1)
    like = rng.dirichlet(np.ones(200), 3).T + 1e-9
    count = np.round(20_000 * like @ [0.7, 0.3, 0.0])
    share, fit = G.mixture(like, count, steps=500)
    assert share == pytest.approx([0.7, 0.3, 0.0], abs=0.03)
    grid = [count @ np.log(like @ [a, b, 1 - a - b]) for a in np.linspace(0.01, 0.98, 30)
            for b in np.linspace(0.01, 0.99 - a, 30)]
    assert fit >= max(grid) - 1e-6


def test_language_sets(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text", "lang").cache()
    both = {}
    for r in docs.filter("length(text) > 1500").orderBy("doc_id").collect():
        both.setdefault(r.lang, r.text[:1500])
    rows = [(5000, both["en"] + "\n" + both["de"], None, "x"), (5001, None, "en", "x"), (5002, "", "en", "x"),
            (5003, "123 -- !!", "en", "x"), (None, both["fr"], None, "x"), (5004, both["es"] * 30, None, "x")]
    df = docs.withColumn("score", F.lit("x")).unionByName(spark.createDataFrame(rows, DOCS))
    got = {r.doc_id: r for r in G.identify_languages(df, F.col("doc_id") % 3 == 1).collect()}
    assert [x.lang for x in got[5000].languages][:2] in (["en", "de"], ["de", "en"])
    assert 0.3 < got[5000].score < 0.7
    assert [(got[i].lang_pred, got[i].score) for i in (5001, 5002, 5003)] == [("und", 0.0)] * 3
    assert got[None].lang_pred == "fr" and not got[None].held_out and got[5004].lang_pred == "es"
    untaught = G.identify_languages(df.withColumn("lang", F.lit(None).cast("string")), F.lit(False))
    assert {r.lang_pred for r in untaught.collect()} == {"und"}
    assert G.identify_languages(df.limit(0), F.lit(False)).count() == 0
    with pytest.raises(ValueError, match="languages"):
        G.identify_languages(df, F.lit(False), most_languages=2)


def test_registered_language_query_on_held_out_rows(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    got = QUERIES["op10_language_id"](spark, sf_small).join(docs, "doc_id").filter("held_out")
    assert got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.95
