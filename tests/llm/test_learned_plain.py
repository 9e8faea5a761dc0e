"""Toxicity scores and languages of whole tables against plain versions of their definitions."""

import math
from collections import Counter
from functools import cache

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.llm import language_id as G, toxicity as T


# ---------------------------------------------------------------- toxicity
class PlainModel:
    """Kneser-Ney from its recursion, counting in lists of n-grams."""

    def __init__(self, texts, order, shared_below):
        self.order, self.shared = order, shared_below
        self.grams = {c: Counter() for c in (0, 1)}
        for y, text in texts:
            for word in text.lower().split():
                s = "\x02" * (order - 1) + word + "\x03"
                self.grams[y].update(s[i:i + order] for i in range(len(s) - order + 1))
        self.count = cache(self._count)
        self.letters = len({g[-1] for c in (0, 1) for g in self.grams[c]}) + 1
        self.p = cache(self._p)

    def _count(self, c, n):
        """Counts of n-grams: those of the highest order, else the number of longer ones that end so."""
        if n == self.order:
            return self.grams[c]
        longer = set(self.count(c, n + 1))
        if n < self.shared:
            longer = set(self.count(0, n + 1)) | set(self.count(1, n + 1))
        return Counter(g[1:] for g in longer)

    def _p(self, c, gram):
        if not gram:
            return 1 / self.letters
        lower = self.p(c, gram[1:])
        after = {g: k for g, k in self.count(c, len(gram)).items() if g[:-1] == gram[:-1]}
        total = sum(after.values())
        if not total:
            return lower
        return (max(after.get(gram, 0) - 0.75, 0) + 0.75 * len(after) * lower) / total

    def evidence(self, word):
        s = "\x02" * (self.order - 1) + word + "\x03"
        return sum(math.log(self.p(1, s[i:i + self.order]) / self.p(0, s[i:i + self.order]))
                   for i in range(len(s) - self.order + 1))

    def features(self, text):
        words = (text or "").lower().split()
        if not words:
            return [0, 0, 0, 0]
        e = sorted((self.evidence(w) for w in words), reverse=True)
        return [100 * sum(e) / sum(len(w) + 1 for w in words), e[0], sum(e[:4]) / 4,
                sum(max(x - 3, 0) for x in e) / math.sqrt(len(words))]


def plain_curve(x, y, ridge=0.1):
    """Ridge logistic regression by reweighted least squares; the constant comes last."""
    centre, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
    z = np.column_stack([(x - centre) / scale, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    for _ in range(200):
        p = 1 / (1 + np.exp(-z @ w))
        v = p * (1 - p) + 1e-300
        a = np.vstack([z * np.sqrt(v)[:, None], math.sqrt(ridge) * np.eye(len(w))])
        b = np.concatenate([(z @ w + (y - p) / v) * np.sqrt(v), np.zeros(len(w))])
        new = np.linalg.lstsq(a, b, rcond=None)[0]
        w = w + 0.5 * (new - w)
    return centre, scale, w


@pytest.mark.parametrize("most_rows", [1000, 20])
def test_toxicity_matches_plain_version(spark, most_rows):
    rng = np.random.default_rng(3)
    word = lambda: "".join(rng.choice(list("abdeinost"), rng.integers(2, 6)))
    rows, labels = [], []
    for i in range(120):
        y = int(i % 3 == 0)
        words = [word() for _ in range(8)]
        if y and i % 2:
            words[3] = "zqx" + word()
        rows.append((i, " ".join(words)))
        labels.append((i, y))
    rows += [(200, None), (201, ""), (202, "Only NEW wörds")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    held = F.col("doc_id") % 4 == 1
    got = {r.doc_id: r.score for r in T.toxicity_scores(
        docs, spark.createDataFrame(labels, "doc_id long, toxic int"), held, order=4, most_rows=most_rows).collect()}
    # the hash that deals rows into folds and orders the sample is Spark's own
    th = F.xxhash64("text")
    hashes = {r.doc_id: (r.h, r.th) for r in docs.select(
        "doc_id", th.alias("th"), F.xxhash64(F.col("doc_id").cast("string"), th).alias("h")).collect()}
    text, truth = dict(rows), dict(labels)
    taught = [i for i in truth if i % 4 != 1]
    sample = [i for y in (0, 1) for i in sorted((i for i in taught if truth[i] == y),
                                                key=lambda i: (hashes[i][0], i))[:most_rows]]
    x, y = [], []
    for fold in range(4):
        own = [i for i in sample if hashes[i][0] % 4 == fold]
        model = PlainModel([(truth[i], text[i]) for i in sample if i not in own], 4, 3)
        x += [model.features(text[i]) for i in own]
        y += [truth[i] for i in own]
    x, y = np.array(x, dtype=float), np.array(y)
    centre, scale, w = plain_curve(x, y)
    n = Counter(truth[i] for i in taught)
    w[-1] += math.log(n[1] / n[0]) - math.log((y == 1).sum() / (y == 0).sum())
    model = PlainModel([(truth[i], text[i]) for i in sample], 4, 3)
    want = {i: 1 / (1 + math.exp(-float(((np.array(model.features(t)) - centre) / scale) @ w[:-1] + w[-1])))
            for i, t in rows}
    assert got.keys() == want.keys()
    assert all(got[i] == pytest.approx(want[i], abs=1e-6) for i in want)


# ---------------------------------------------------------------- languages
def plain_trigrams(text):
    if not any(c.isalpha() for c in text or ""):
        return []
    low = [(c.lower() if len(c.lower()) == 1 else c) if c.isalpha() else " " for c in text]
    s = " " + "".join(low) + " "
    while "  " in s:
        s = s.replace("  ", " ")
    mask = (1 << 64) - 1
    out = []
    for a, b, c in zip(s, s[1:], s[2:]):
        h = ((ord(a) * 0x9E3779B1 + ord(b)) * 0x85EBCA77 + ord(c)) & mask
        out.append((h * 0xC2B2AE3D27D4EB4F & mask) >> 48)
    return out


def plain_mixture(model, names, found):
    """Shares and log-likelihood of the named languages for a list of trigrams, one by one."""
    share = {k: 1 / len(names) for k in names}
    for _ in range(30):
        new = dict.fromkeys(names, 0.0)
        for t, n in found.items():
            each = {k: share[k] * model[k][t] for k in names}
            total = sum(each.values())
            for k in names:
                new[k] += n * each[k] / total / sum(found.values())
        moved = max(abs(new[k] - share[k]) for k in names)
        share = new
        if moved < 1e-4:
            break
    return share, sum(n * math.log(sum(share[k] * model[k][t] for k in names)) for t, n in found.items())


def plain_languages(model, text, penalty=3.0):
    found = Counter(plain_trigrams(text))
    if not found:
        return []
    names, price = sorted(model), penalty * math.log(sum(found.values()) + 1)
    share, fit = plain_mixture(model, names, found)
    while len(names) > 1:
        least = max(1e-3, min(share.values()))
        keep = [k for k in names if share[k] > least] or names[:-1]
        less, fit_less = plain_mixture(model, keep, found)
        if 2 * (fit - fit_less) >= price * (len(names) - len(keep)):
            break
        names, share, fit = keep, less, fit_less
    return sorted(((k, share[k]) for k in names), key=lambda p: (-p[1], p[0]))


def test_languages_match_plain_version(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text", "lang").limit(60).collect()
    rows = [(r.doc_id, r.text[:700], r.lang) for r in docs]
    rows += [(9000 + i, rows[i][1][:200] + " " + rows[i + 1][1][:120], None) for i in range(0, 40, 4)]
    rows += [(9900, None, "en"), (9901, "12 §", "en"), (9902, "İSTANBUL ǅ ﬁ ß", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in G.identify_languages(df, F.col("doc_id") % 3 == 1).collect()}
    counts = {}
    for i, text, lang in rows:
        if i % 3 != 1 and lang is not None and plain_trigrams(text):
            counts.setdefault(lang, Counter()).update(plain_trigrams(text))
    model = {}
    for lang, n in counts.items():
        total = sum(n.values()) + 0.05 * 65536
        model[lang] = {t: (n[t] + 0.05) / total for t in range(65536)}
    for i, text, _ in rows:
        want = plain_languages(model, text)
        assert [x.lang for x in got[i].languages] == [k for k, _ in want], i
        assert [x.share for x in got[i].languages] == pytest.approx([s for _, s in want], abs=1e-6)
        assert got[i].lang_pred == (want[0][0] if want else "und")
