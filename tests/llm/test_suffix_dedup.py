import hashlib
from collections import Counter

import numpy as np
import pytest

from basketry.llm import run_index, suffix_dedup as S


def slow(rows, length):
    raw = [(t or "").encode() for _, t in rows]
    seen = Counter(b[i:i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for (d, _), b in zip(rows, raw):
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = True
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out.append((d, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(),
                    kept.decode("utf-8", "ignore")))
    return sorted(out, key=str)


def slow_strip(rows, length, words):
    """Texts without the covered runs that hold at least ``words`` words."""
    raw = [(t or "").encode() for _, t in rows]
    seen = Counter(b[i:i + length] for b in raw for i in range(len(b) - length + 1))
    out = {}
    for (d, _), b in zip(rows, raw):
        spans = []
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                if spans and i <= spans[-1][1]:
                    spans[-1][1] = i + length
                else:
                    spans.append([i, i + length])
        at, kept = 0, b""
        for start, end in spans:
            if len(b[start:end].split()) >= words:
                kept, at = kept + b[at:start], end
        out[d] = (kept + b[at:]).decode("utf-8", "ignore")
    return out


def fixture(rng, n=60):
    word = lambda: "".join(rng.choice(list("abcdeé"), rng.integers(1, 6)))
    text = lambda k: " ".join(word() for _ in range(k))
    common = [text(12) for _ in range(4)]
    rows = []
    for i in range(n):
        parts = [text(int(rng.integers(0, 30)))]
        for _ in range(int(rng.integers(0, 3))):
            parts += [common[int(rng.integers(0, 4))], text(int(rng.integers(0, 9)))]
        rows.append((i, " ".join(parts)))
    rows += [(1000 + i, rows[0][1]) for i in range(5)]
    rows += [(2000, None), (2001, ""), (2002, "ab" * 100), (2003, "z" * 75), (2004, "short"), (2005, "short")]
    return rows


def test_matching_statistics_match_brute_force():
    rng = np.random.default_rng(0)
    for _ in range(20):
        texts = ["".join(rng.choice(list("ab"), rng.integers(0, 40))).encode() for _ in range(6)]
        index = run_index.build(texts)
        got = run_index.matching_statistics(index)
        at = 0
        for t in texts:
            for i in range(len(t)):
                best = 0
                for u_at, u in enumerate(texts):
                    for j in range(len(u)):
                        if u is t and texts.index(t) == u_at and j == i:
                            continue
                        k = 0
                        while i + k < len(t) and j + k < len(u) and t[i + k] == u[j + k]:
                            k += 1
                        if not (u_at == texts.index(t) and j == i):
                            best = max(best, k)
                if texts.count(t) == 1:
                    assert got[at + i] == best
            at += len(t) + 1


def test_repetitive_collection_has_few_runs():
    base = bytes(np.random.default_rng(0).integers(97, 101, 500).astype(np.uint8))
    assert run_index.build([base] * 20).runs < 2 * run_index.build([base]).runs + 40


def test_windows_are_covered_once():
    rng = np.random.default_rng(3)
    for t in (b"", b"x" * 19, b"x" * 300, b"ab" * 200, bytes(rng.integers(97, 100, 3000).astype(np.uint8))):
        _, first, last = S.super_windows(t, 20, 8)
        cover = [i for a, b in zip(first, last) for i in range(a, b + 1)]
        assert cover == list(range(max(0, len(t) - 19)))


@pytest.mark.parametrize("most", [4096, 3])
def test_matches_brute_force(spark, most):
    rows = fixture(np.random.default_rng(5))
    df = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, spans int")
    got = [tuple(r) for r in S.suffix_dedup(df, length=20, gram=8, most=most).collect()]
    assert sorted(got, key=str) == slow(rows, 20)


def test_production_length(spark):
    rng = np.random.default_rng(9)
    a = "".join(rng.choice(list("abcdefgh "), 1500))
    b = "".join(rng.choice(list("abcdefgh "), 900))
    rows = [(1, a), (2, b + a[200:700]), (3, b[:399]), (4, "x" + b[100:500]), (5, b[:398] + "é"), (None, a[:50])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in S.suffix_dedup(df).collect()]
    assert sorted(got, key=str) == slow(rows, 400)
    left = {r.doc_id: r.text for r in S.strip_repeats(df).collect()}
    assert left[1] == a[:200] + a[700:] and left[None] == a[:50]


@pytest.mark.parametrize("most", [4096, 3])
def test_periodic_runs_that_come_once(spark, most):
    rng = np.random.default_rng(11)
    rows = []
    for p in (1, 3, 7, 200):
        for n in (400, 400 + p - 1, 400 + p, 450 + p, 600, 704, 705, 800):
            unit = bytes(rng.integers(33, 126, p).astype(np.uint8)).decode()
            # a letter of its own, so that no other run holds the same grams
            unit = chr(0x4E00 + len(rows)) if p == 1 else unit
            rows.append((len(rows), f"<{len(rows)}>" + (unit * n)[:n] + "."))
    rows.append((len(rows), "z" * 450))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in S.suffix_dedup(df, most=most).collect()]
    assert sorted(got, key=str) == slow(rows, 400)
    assert [r[2:4] for r in got if r[0] == len(rows) - 1] == [(450, 1)]


def test_stripping_by_words(spark):
    rng = np.random.default_rng(13)
    prose = [" ".join("".join(rng.choice(list("abcdeé"), rng.integers(1, 9))) for _ in range(400)) for _ in range(6)]
    words = [p.split() for p in prose]
    rows = [(i, " ".join(words[i] + words[(i + 1) % 6][20:20 + k]))
            for i, k in enumerate((70, 51, 50, 30, 52, 200))]
    rows += [(6, "abcdefgh" * 400), (7, None), (8, "x " * 300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    got = {r.doc_id: r.text or "" for r in S.strip_repeats(df, length=100, gram=32, words=51).collect()}
    assert got == slow_strip(rows, 100, 51)


def test_texts_longer_than_a_chunk_and_text_ids(spark):
    rng = np.random.default_rng(17)
    long = bytes(rng.integers(97, 123, S.CHUNK + 3000).astype(np.uint8)).decode()
    edge = long[S.CHUNK - 500:S.CHUNK + 400]
    rows = [("long", long), ("edge", edge), ("tail", long[-450:]), ("no", long[:399])]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    got = {r.doc_id: r for r in S.suffix_dedup(df).collect()}
    assert {d: (r.n_removed, r.n_spans) for d, r in got.items()} == {
        "long": (1350, 2), "edge": (900, 1), "tail": (450, 1), "no": (0, 0)}
    assert got["long"].kept_text == long[:S.CHUNK - 500] + long[S.CHUNK + 400:-450]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert S.suffix_dedup(df).count() == 0 and S.strip_repeats(df).count() == 0
