import math
from collections import Counter

import numpy as np
import pytest

from basketry.llm import lm_score as L

SCHEMA = "doc_id long, text string, n_tokens string"


def slow(rows, order, backoff=0.4, least=2):
    docs = [(d, (t or "").encode().lower().split()) for d, t in rows]
    counts = [Counter(tuple(w[i:i + n]) for _, w in docs for i in range(len(w) - n + 1)) for n in range(1, order + 1)]
    total = sum(counts[0].values())
    out = []
    for d, w in docs:
        score, off = 0.0, 0
        for i in range(len(w)):
            levels = 0
            for n in range(min(order, i + 1), 0, -1):
                g = tuple(w[i - n + 1:i + 1])
                if n == 1:
                    score += math.log(counts[0][g] / total)
                elif counts[n - 1][g] >= least:
                    score += math.log(counts[n - 1][g] / counts[n - 2][g[:-1]])
                else:
                    levels += 1
                    continue
                break
            score += levels * math.log(backoff)
            off += levels > 0
        out.append((d, len(w), off, score))
    return out


@pytest.mark.parametrize("order,block,group", [(2, 24_000_000, 4096), (3, 200, 4096), (1, 50, 4096),
                                               (3, 100, 3), (2, 50, 1)])
def test_matches_brute_force(spark, monkeypatch, order, block, group):
    monkeypatch.setattr(L, "BLOCK_BYTES", block)
    monkeypatch.setattr(L, "SUPER_BLOCKS", group)
    if group < 4096:  # ranges of groups and global buckets do not coincide
        monkeypatch.setattr(L, "BUCKET_GRAMS", 100)
    rng = np.random.default_rng(order)
    rows = [(i, " ".join(rng.choice(["the", "The", "of", "and", "cat", "x1", "é"], rng.integers(0, 30)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "alone"), (103, "the of " * 50), (103, "the of " * 50), (None, "cat cat")]
    df = spark.createDataFrame([(d, t, "clash") for d, t in rows], SCHEMA)
    got = sorted(((r.doc_id, r.n_tokens, r.n_backoff, r.log_score) for r in L.stupid_backoff(df, order=order).collect()), key=str)
    want = sorted(slow(rows, order), key=str)
    for g, w in zip(got, want, strict=True):
        assert g[:3] == w[:3] and g[3] == pytest.approx(w[3], abs=1e-9)


def test_columns_survive_narrowing():
    rng = np.random.default_rng(0)
    for n in (0, 1, 7, 1000):
        x = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        assert (L._wide(L._narrow(x)) == x).all() and len(L._wide(L._narrow(x))) == len(x)
        c = rng.integers(0, 70_000, n)
        assert (L._counts_in(L._counts_out(c)) == c).all()


def test_requests_are_cut_at_the_bounds():
    rng = np.random.default_rng(1)
    for buckets in (1, 3, 8, 13):
        edges = [int(L._least(b, buckets)) for b in range(buckets)]
        h = {e + d for e in edges for d in (-1, 0, 1)} | {0, 2**64 - 1}
        h = np.unique(np.array([x for x in h if 0 <= x < 2**64] + list(rng.integers(0, 2**64, 50, dtype=np.uint64)), dtype=np.uint64))
        got = L._requests(h, np.arange(len(h)), buckets)
        back = [L._wide(x) + L._least(b, buckets) for b, x in zip(got["bucket"], got["hashes"])]
        assert (np.concatenate(back) == h).all()
        assert (np.concatenate([L._counts_in(c) for c in got["counts"]]) == np.arange(len(h))).all()
        for b, x in zip(got["bucket"], back):
            assert all(edges[b] <= int(v) < (edges + [2**64])[b + 1] for v in x)
    assert len(L._requests(h[:0], h[:0], 8)["bucket"]) == 0


def test_text_ids_and_a_very_long_text(spark):
    rows = [("a", "x y z " * 200_000), ("b", "x y z"), (None, "w" * 3_000_000)]
    df = spark.createDataFrame([(d, t, "clash") for d, t in rows], "doc_id string, text string, log_score string")
    got = {r.doc_id: r for r in L.stupid_backoff(df).collect()}
    for d, n, off, score in slow(rows, 3):
        assert (got[d].n_tokens, got[d].n_backoff) == (n, off)
        assert got[d].log_score == pytest.approx(score, rel=1e-9)


def test_empty_table(spark):
    assert L.stupid_backoff(spark.createDataFrame([], SCHEMA)).count() == 0
