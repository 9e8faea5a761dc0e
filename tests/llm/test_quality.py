import math
import re

import numpy as np
import pytest

from basketry.llm import quality as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow_statistics(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    hit = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in (i, i + 1, i + 2)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(hit))


TEXTS = [None, "", " ", "one", "a b", "a b c", "a b c a b c", "a a a a a a", "x " * 70, "é𝒳 # $\n\n# $\r\nq",
         "l1\nl1\nl2\n\n \nl2", "a b c d a b c e a b c", "\x0b\x0ca\x1fb\x85c", "a b c", " lead trail \n"]


def test_statistics_match_brute_force(spark):
    rng = np.random.default_rng(0)
    texts = TEXTS + ["".join(rng.choice(list("ab \n|"), rng.integers(0, 80))) for _ in range(80)]
    df = spark.createDataFrame([(i, t, 9) for i, t in enumerate(texts)], "doc_id long, text string, n_words int")
    got = Q.text_statistics(df.select("doc_id", "text")).collect()
    for r in got:
        assert tuple(r[c] for c in Q.BASE) == slow_statistics(texts[r.doc_id]), repr(texts[r.doc_id])


def slow_mcd(x, names, share):
    """Concentration steps in NumPy, with the same starts and the same histogram cut."""
    floor = np.array([Q.VECTOR[n] for n in names], float)
    centre = np.median(x, axis=0)
    z = np.abs(x - centre) / np.maximum(1.4826 * np.median(np.round(np.abs(x - centre)), axis=0), floor)
    best = None
    for name, d2 in (("l1", z.sum(1)), ("l2", (z * z).sum(1)), ("max", z.max(1))):
        last = None
        while True:
            bins = np.floor(np.log2(d2 + 1e-3) * Q.BINS_PER_DOUBLING).astype(int)
            cut = np.sort(bins)[math.ceil(len(x) * share) - 1]
            part = x[bins <= cut].astype(float)
            m = part.mean(0)
            cov = part.T @ part / len(part) - np.outer(m, m) + np.diag(floor ** 2)
            det = np.linalg.slogdet(cov)[1]
            if last is not None and not last[0] - det > Q.FALL:
                break
            y = np.linalg.solve(np.linalg.cholesky(cov), (x - m).T)
            d2 = (y * y).sum(0)
            last = (det, name, d2)
        if best is None or last[:2] < best[:2]:
            best = last
    return best[2]


@pytest.mark.parametrize("few", [20_000, 0])
def test_mcd_matches_numpy(spark, monkeypatch, few):
    monkeypatch.setattr(Q, "FEW_GROUPS", few)
    rng = np.random.default_rng(4)
    names = list(Q.VECTOR)
    clean = rng.multivariate_normal([1500, 100, 0, 200, 300], np.diag([9e4, 1e4, 1e3, 4e4, 4e4]), 160)
    bad = rng.multivariate_normal([1500, 2500, 0, 200, 900], np.diag([9e4, 1e4, 1e3, 4e4, 4e4]), 40)
    x = np.round(np.vstack([clean, bad])).astype(int)
    df = spark.createDataFrame([("g", *map(int, r)) for r in x], ["k", *names])
    found = Q.mcd(df, ["k"], names, 0.75)
    far = df.join(found, "k")
    for name, col in Q._distance(names):
        far = far.withColumn(name, col)
    got = {tuple(r[n] for n in names): r.d2 for r in far.collect()}
    want = slow_mcd(x, names, 0.75)
    for r, d in zip(x, want):
        assert got[tuple(int(v) for v in r)] == pytest.approx(d, rel=1e-6, abs=1e-9)
    cut = Q.quality_rules.__defaults__[4]
    assert (want[160:] > cut).all() and (want[:160] < cut).mean() > 0.98


def test_rules_nulls_and_small_groups(spark):
    rng = np.random.default_rng(5)
    word = lambda: "".join(rng.choice(list("abcdefghij"), rng.integers(2, 8)))
    good = [" ".join(word() for _ in range(80)) for _ in range(80)]
    junk = [" | ".join(word() + "###" for _ in range(60)) for _ in range(3)]
    rows = [(i, t, "en", "s") for i, t in enumerate(good + junk)]
    rows += [(500, good[0], None, None), (501, None, "en", "s"), (502, "short", "en", "s"),
             (503, "a b c " * 40, "en", "s"), (None, good[1], "en", "s"), (0, good[0], "en", "s")]
    df = spark.createDataFrame([(*r, True) for r in rows],
                               "doc_id long, text string, lang string, source string, kept boolean")
    got = Q.quality_rules(df).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert all(by[i].kept for i in range(80)) and not any(by[80 + i].kept for i in range(3))
    assert by[500].kept and by[500].distance2 is not None
    assert [(by[i].kept, by[i].base_failed) for i in (501, 502, 503)] == [(False, True)] * 3


def test_small_groups_are_judged_by_coarser_ones(spark):
    rng = np.random.default_rng(6)
    names = list(Q.VECTOR)

    def rows(k, lang, source, mean):
        x = np.round(rng.multivariate_normal(mean, np.diag([9e4, 1e4, 1e3, 4e4, 4e4]), k)).astype(int)
        return [(lang, source, *map(int, r)) for r in x]

    low, high = [1500, 100, 0, 200, 300], [3000, 900, 0, 300, 300]
    given = (rows(80, "=a", "=big", low) + rows(9, "=a", "=s1", high) + rows(5, "=a", "null", high)
             + rows(60, "=b", "=big", low) + rows(3, "=c", "=s1", high))
    df = spark.createDataFrame(given, ["g_0", "g_1", *names])
    groups, judges = Q.judging_groups(df, ["g_0", "g_1"], 50)
    assert {tuple(r) for r in groups.collect()} == {
        ("=a", "=big", "=a", "=big"), ("=a", "=s1", "=a", "*"), ("=a", "null", "=a", "*"),
        ("=b", "=big", "=b", "=big"), ("=c", "=s1", "*", "*")}
    found = Q.mcd(Q._members(df, groups, ["g_0", "g_1"], judges, names, True), judges, names)
    sizes = {(r.j_0, r.j_1): r["size"] for r in found.collect()}
    assert sizes == {("=a", "=big"): 80, ("=a", "*"): 94, ("=b", "=big"): 60, ("*", "*"): 157}


def test_every_text_that_passes_has_a_distance(spark):
    rng = np.random.default_rng(7)
    rows = [(f"id{i}", " ".join(_words(rng, 60)), "en" if i % 2 else None, f"s{i}", 1, "x") for i in range(12)]
    rows.append(("long", " ".join(_words(rng, 60)) + " word" * 40 + "\n" + "ab " * 300_000, "en", "s0", 1, "x"))
    df = spark.createDataFrame(rows, "doc_id string, text string, lang string, source string, j_0 int, d2 string")
    got = Q.quality_rules(df).collect()
    assert len(got) == 13 and all(r.distance2 is not None for r in got if not r.base_failed)
    assert sum(r.base_failed for r in got) == 1


def _words(rng, n):
    return ["".join(rng.choice(list("abcdefghij"), rng.integers(4, 8))) for _ in range(n)]


def test_one_extreme_statistic_rejects(spark):
    rng = np.random.default_rng(8)
    good = ["\n".join(" ".join(_words(rng, 10)) for _ in range(10)) for _ in range(100)]
    rows = [(i, t, "en", "s") for i, t in enumerate(good)]
    part = " ".join(_words(rng, 7))
    rows.append((200, " ".join([part] * 7 + _words(rng, 51)), "en", "s"))
    # lines of one word, of five words in all, in an order that repeats no three in a row
    order, seen = [0, 0], set()
    while (n := next((x for x in range(4, -1, -1) if (*order[-2:], x) not in seen), None)) is not None:
        seen.add((*order[-2:], n))
        order.append(n)
    five = _words(rng, 5)
    rows.append((201, "\n".join(five[i] for i in order), "en", "s"))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    by = {r.doc_id: r for r in Q.quality_rules(df).collect()}
    assert not by[200].base_failed and by[200].n_dup_lines == 0 and not by[200].kept
    assert not by[201].base_failed and by[201].n_dup_lines > 100
    assert by[201].n_repeat_words == 0 and not by[201].kept
    assert all(by[i].kept for i in range(100))


def test_consistency_factor():
    assert Q._chi2_below(11.0705, 5) == pytest.approx(0.95, abs=1e-5)
    assert Q._chi2_below(30.86, 5) == pytest.approx(0.99999, abs=1e-6)
    assert Q.consistency_factor(0.75, 5) == pytest.approx(1.41, abs=0.02)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert Q.quality_rules(df).count() == 0
