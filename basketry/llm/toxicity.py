"""Toxicity by class-conditional Kneser-Ney models over the characters of words.

Two interpolated Kneser-Ney models, of toxic and of ordinary labelled texts, share their short
contexts: below ``shared_below`` characters the continuation counts of both classes are
pooled, so an expression that is rare in both gets the same estimate from both. A word's
evidence is the difference of its two log-likelihoods. A document is judged by the
length-normalised difference over the whole text and by its strongest words, which a logistic
curve turns into a score.

Counts and curve are learnt on at most ``most_rows`` labelled rows of each class, the rows of least
hash, so the model has a bounded size. Scoring covers every row and whole text.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import shared_table

START, END = "\x02", "\x03"
DISCOUNT = 0.75
WORD_CACHE = 200_000
TOP = 4
FOLDS = 4


def padded(word: str, order: int) -> str:
    return START * (order - 1) + word + END


class KneserNey:
    """Interpolated Kneser-Ney models of two classes with shared short contexts."""

    def __init__(self, counts: dict[int, Counter], order: int, shared_below: int):
        """``counts``: for class 0 and 1 the counts of n-grams of ``order`` characters."""
        self.order = order
        tables: dict[int, dict[int, Counter]] = {c: {order: counts[c]} for c in (0, 1)}
        for n in range(order - 1, 0, -1):
            if n < shared_below:
                above = tables[0][n + 1].keys() | tables[1][n + 1].keys()
                both = Counter(g[1:] for g in above)
                tables[0][n] = tables[1][n] = both
            else:
                for c in (0, 1):
                    tables[c][n] = Counter(g[1:] for g in tables[c][n + 1])
        self.tables = tables
        self.total: dict[int, dict[int, Counter]] = {0: {}, 1: {}}
        self.types: dict[int, dict[int, Counter]] = {0: {}, 1: {}}
        for c in (0, 1):
            for n, table in tables[c].items():
                total, types = Counter(), Counter()
                for g, k in table.items():
                    total[g[:-1]] += k
                    types[g[:-1]] += 1
                self.total[c][n], self.types[c][n] = total, types
        self.alphabet = len(tables[0][1].keys() | tables[1][1].keys()) + 1
        self.grams: dict[str, float] = {}
        self.words: dict[str, float] = {}

    def probability(self, c: int, gram: str) -> float:
        """Of the last character after those before it, under class ``c``."""
        p = 1.0 / self.alphabet
        for n in range(1, self.order + 1):
            part = gram[-n:]
            total = self.total[c][n].get(part[:-1])
            if total:
                k = self.tables[c][n].get(part, 0)
                p = (max(k - DISCOUNT, 0.0) + DISCOUNT * self.types[c][n][part[:-1]] * p) / total
        return p

    def evidence(self, word: str) -> float:
        """Log-likelihood of the word in class 1 less that in class 0."""
        got = self.words.get(word)
        if got is None:
            got, text = 0.0, padded(word, self.order)
            for i in range(len(text) - self.order + 1):
                gram = text[i:i + self.order]
                x = self.grams.get(gram)
                if x is None:
                    x = math.log(self.probability(1, gram) / self.probability(0, gram))
                    if len(self.grams) < WORD_CACHE:
                        self.grams[gram] = x
                got += x
            if len(self.words) >= WORD_CACHE:
                self.words.clear()
            self.words[word] = got
        return got

    def features(self, text: str | None) -> list[float]:
        words = (text or "").lower().split()
        if not words:
            return [0.0] * 4
        e = np.array([self.evidence(w) for w in words])
        size = sum(map(len, words)) + len(words)
        top = np.sort(e)[::-1][:TOP]
        return [100.0 * float(e.sum()) / size, float(top[0]), float(top.sum()) / TOP,
                float(np.maximum(e - 3.0, 0.0).sum()) / math.sqrt(len(words))]


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1, steps: int = 50) -> dict:
    """Logistic curve by Newton's method on standardised columns."""
    centre, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
    z = np.column_stack([(x - centre) / scale, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        hessian = (z * (p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, z.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return {"centre": centre, "scale": scale, "weights": w}


def logistic(curve: dict, x: np.ndarray) -> np.ndarray:
    z = np.column_stack([(x - curve["centre"]) / curve["scale"], np.ones(len(x))])
    return 1 / (1 + np.exp(-np.clip(z @ curve["weights"], -30, 30)))


def _grams(order: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: Counter = Counter()
        for frame in frames:
            for fold, y, text in zip(frame["fold"], frame["y"], frame["text"]):
                for word, k in Counter((text or "").lower().split()).items():
                    s = padded(word, order)
                    for i in range(len(s) - order + 1):
                        found[fold, y, s[i:i + order]] += k
        yield pd.DataFrame([(*key, n) for key, n in found.items()],
                           columns=["fold", "y", "gram", "n"])
    return run


def packed_counts(found: DataFrame) -> dict[tuple[int, int], tuple[str, np.ndarray]]:
    """Counts by (fold, class) as one string of n-grams and one array: the driver handles a few
    compact rows whose size the bounded sample limits; models are built in the workers."""
    rows = found.groupBy("fold", "y").agg(F.collect_list(F.struct("gram", "n")).alias("l")).select(
        "fold", "y", F.array_join(F.transform("l", lambda x: x["gram"]), "\n").alias("grams"),
        F.transform("l", lambda x: x["n"].cast("int")).alias("n")).toPandas()
    return {(int(f), int(y)): (g, np.asarray(n, dtype=np.int32))
            for f, y, g, n in zip(rows["fold"], rows["y"], rows["grams"], rows["n"])}


def merged(packed: dict[tuple[int, int], tuple[str, np.ndarray]],
           without: int | None = None) -> dict[int, Counter]:
    """Counts by class over all folds but one."""
    out: dict[int, Counter] = {0: Counter(), 1: Counter()}
    for (fold, y), (grams, n) in packed.items():
        if fold != without:
            out[y].update(dict(zip(grams.split("\n"), n.tolist())))
    return out


_MODELS: dict[tuple, KneserNey] = {}


def worker_model(name: str, given, without: int | None, order: int, shared_below: int) -> KneserNey:
    """The worker's model of broadcast counts; one at a time is kept."""
    key = (name, without)
    if key not in _MODELS:
        _MODELS.clear()
        _MODELS[key] = KneserNey(merged(given.value, without), order, shared_below)
    return _MODELS[key]


def bounded_sample(rows: DataFrame, marked: DataFrame, most_rows: int) -> tuple[DataFrame, dict]:
    """Texts of at most ``most_rows`` labelled rows of each class (those of least hash), and
    the number of labelled rows of each class. Only ids and hashes are sorted; the chosen ones,
    2 * most_rows at most, are broadcast to fetch their texts."""
    texts = rows.filter(~F.col("held_out")).select("key", "text", F.xxhash64("text").alias("th"))
    narrow = shared_table(texts.select("key", "th").join(marked, "key").distinct()
                          .withColumn("h", F.xxhash64(F.col("key").cast("string"), "th")), "labelled")
    parts = [narrow.filter(F.col("y") == y).orderBy("h", "key", "th").limit(most_rows) for y in (0, 1)]
    chosen = shared_table(parts[0].union(parts[1]), "chosen")
    sample = texts.join(F.broadcast(chosen), ["key", "th"]).dropDuplicates(["key", "th", "y"])
    rate = {r["y"]: r["count"] for r in narrow.groupBy("y").count().collect()}
    return shared_table(sample.repartition(16, "h"), "sample"), rate


def train(rows: DataFrame, marked: DataFrame, order: int, shared_below: int, most_rows: int):
    """(a function that gives a worker its model, curve); None if a class has too few rows.

    The curve is fitted to evidence that each fold of the sample gets from a model of the other
    folds; the model itself then takes the counts of all folds.
    """
    sample, rate = bounded_sample(rows, marked, most_rows)
    sample = sample.withColumn("fold", F.pmod(F.col("h"), F.lit(FOLDS)).cast("int"))
    found = (sample.select("fold", "y", "text")
             .mapInPandas(_grams(order), "fold int, y int, gram string, n long")
             .groupBy("fold", "y", "gram").agg(F.sum("n").alias("n")))
    packed = packed_counts(found)
    if {y for _, y in packed} != {0, 1}:
        return None
    given, name = sample.sparkSession.sparkContext.broadcast(packed), uuid.uuid4().hex

    def out_of_fold(frames):
        for f in frames:
            for fold, part in f.groupby("fold"):
                model = worker_model(name, given, int(fold), order, shared_below)
                yield pd.DataFrame({"y": part["y"], "x": [model.features(t) for t in part["text"]]})

    got = (sample.select("fold", "y", "text").repartition(FOLDS, "fold").sortWithinPartitions("fold")
           .mapInPandas(out_of_fold, "y int, x array<double>")).toPandas()
    y = got["y"].to_numpy()
    if len(set(y.tolist())) < 2:
        return None
    curve = fit_logistic(np.array(got["x"].tolist(), dtype=float), y)
    # back from the share of class 1 in the sample to its share in the labelled rows
    curve["weights"][-1] += math.log(rate[1] / rate[0]) - math.log((y == 1).sum() / (y == 0).sum())
    return lambda: worker_model(name, given, None, order, shared_below), curve


def toxicity_scores(docs: DataFrame, labels: DataFrame, held_out: Column, id_col: str = "doc_id",
                    text_col: str = "text", label_col: str = "toxic", order: int = 5,
                    shared_below: int = 3, most_rows: int = 4000, cut: float = 0.3) -> DataFrame:
    """One row per row of ``docs``: id, held_out, score, predicted.

    ``held_out`` is a condition on the id; such rows (and rows of null id) teach nothing. ``labels``
    has the id and a label 0 or 1; other labels are ignored, and a row with several labels
    teaches each. Null and empty texts get the score of a text without evidence. If the training
    rows lack a class, every score is 0. Other columns are ignored. An empty table gives no rows.
    """
    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("text"),
                       F.coalesce(held_out, F.lit(False)).alias("held_out"))
    marked = labels.select(F.col(id_col).alias("key"), F.col(label_col).cast("int").alias("y"))
    trained = train(rows, marked.filter("y in (0, 1)"), order, shared_below, most_rows)
    if trained is None:
        return rows.select(F.col("key").alias(id_col), "held_out", F.lit(0.0).alias("score"),
                           F.lit(0).alias("predicted"))
    model, curve = trained

    def run(frames):
        for f in frames:
            x = np.array([model().features(t) for t in f["text"]], dtype=float).reshape(-1, 4)
            yield pd.DataFrame({"key": f["key"], "held_out": f["held_out"], "score": logistic(curve, x)})
    scored = rows.mapInPandas(run, f"key {kind}, held_out boolean, score double")
    return scored.select(F.col("key").alias(id_col), "held_out", "score",
                         (F.col("score") >= cut).cast("int").alias("predicted"))
