import random
import re
import zlib
from collections import Counter

import pytest

from basketry.llm import spelling as S


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(counts):
    out = []
    form = {}
    for w, n in counts.items():
        close = [v for v in counts if near(v, w)]
        best = min(close, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 5 * n else None
        out.append([w, n, len(close), form[w], counts[form[w]] if form[w] else None])
    for row in out:
        w = row[0]
        while form[w]:
            w = form[w]
        row.append(w)
    return sorted(map(tuple, out), key=str)


def got(spark, counts, **kw):
    words = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    return sorted((tuple(r) for r in S.spelling_variants(words, **kw).select(
        "word", "n", "n_near", "form", "form_n", "root").collect()), key=str)


def test_composition_finds_each_pair_once():
    rng = random.Random(3)
    for _ in range(100):
        words = sorted({"".join(rng.choices("abc", k=rng.randint(0, 6))) for _ in range(60)})
        pairs = [tuple(sorted(p)) for p in S.Acceptor(words).one_edit_pairs()]
        assert len(pairs) == len(set(pairs))
        assert set(pairs) == {(a, b) for a in words for b in words if a < b and near(a, b)}


def test_acceptor_is_minimal():
    a = S.Acceptor(sorted(x + "ing" for x in ("walk", "talk", "work")))
    reachable, stack = set(), [0]
    while stack:
        s = stack.pop()
        if s not in reachable:
            reachable.add(s)
            stack += a.arcs[s].values()
    shapes = {(a.final[s], *a.arcs[s].items()) for s in reachable}
    assert len(shapes) == len(reachable)


def test_very_long_words():
    words = ["a" * 100_000, "a" * 100_001, "ab" * 50_000]
    assert len(list(S.Acceptor(sorted(words)).one_edit_pairs())) == 1


@pytest.mark.parametrize("most", [5, 40, 4000])
def test_matches_brute_force(spark, most):
    rng = random.Random(5)
    words = {"".join(rng.choices("ab", k=rng.randint(6, 9))) for _ in range(90)}
    words |= {"prefix" + "".join(rng.choices("xyé", k=rng.randint(0, 3))) for _ in range(60)}
    counts = {w: rng.choice([5, 6, 30, 200, 1000]) for w in words}
    assert got(spark, counts, most=most) == brute(counts)


def test_ties_chains_and_words_alone(spark):
    counts = {"colour": 30, "colours": 150, "coloury": 150, "color": 5, "solitary": 7, "coloursz": 750}
    rows = {r[0]: r for r in got(spark, counts)}
    assert rows["colour"][3:] == ("colours", 150, "coloursz")
    assert rows["color"][3:] == ("colour", 30, "coloursz")
    assert rows["solitary"][1:] == (7, 0, None, None, "solitary")
    assert sorted(rows.values(), key=str) == brute(counts)


def test_words_of_texts(spark):
    texts = [(i, t) for i, t in enumerate(
        ["Straße STRASSE straße été", "garçon garçonÀ x1garçon", None, "", "short words only", "ÀÉÎÕÜà" * 3] * 60)]
    texts += [(7, "repeated row"), (7, "repeated row"), (None, "nobody"), (8, "lengthy " * 100_000)]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in texts],
                               "doc_id long, text string, n int, word string").repartition(3)
    want = Counter()
    for i, t in texts:
        low = "".join(c.lower() if c.isascii() else c for c in t or "")
        for run in re.findall("[a-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 3 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 6:
                want[run] += 1
    assert {r.word: r.n for r in S.spelled_words(df, slips=3).collect()} == want


def test_empty_and_text_ids(spark):
    assert S.spelling_variants(spark.createDataFrame([], "word string, n long")).count() == 0
    docs = spark.createDataFrame([("a", "lettered")], "doc_id string, text string")
    assert [tuple(r) for r in S.spelled_words(docs).collect()] == [("lettered", 1)]
