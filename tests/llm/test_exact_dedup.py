import hashlib
from collections import Counter

import numpy as np
import pytest

from basketry.llm import exact_dedup as D

SCHEMA = "doc_id long, text string, kept string, digest int"


def fold(t):
    return "".join(c.lower() if c.isascii() else c for c in t or "")


def check(spark, rows, k):
    df = spark.createDataFrame([(d, t, "clash", 1) for d, t in rows], SCHEMA).repartition(3)
    got = D.exact_dedup(df, k=k).collect()
    groups = {}
    for d, t in rows:
        groups.setdefault(fold(t), []).append(d)
    assert len(got) == len(rows)
    kept = Counter(r.text_sha256 for r in got if r.kept)
    for text, ids in groups.items():
        sha = hashlib.sha256(text.encode()).hexdigest()
        mine = [r for r in got if r.text_sha256 == sha]
        known = [i for i in ids if i is not None]
        top = max(known) if known else None
        assert sorted(map(str, (r.doc_id for r in mine))) == sorted(map(str, ids))
        assert {(r.keep_id, r.group_size) for r in mine} == {(top, len(ids))}
        assert kept[sha] == 1 and all(r.doc_id == top for r in mine if r.kept)


@pytest.mark.parametrize("k", [1024, 4, 1])
def test_matches_brute_force(spark, k):
    rng = np.random.default_rng(0)
    rows = [(i, f"Text {int(rng.integers(0, 40))}") for i in range(300)]
    rows += [(1000 + i, "HOT") for i in range(200)] + [(2000 + i, "Ä" if i % 2 else "ä") for i in range(6)]
    rows += [(3000, None), (3001, ""), (5, "dup row"), (5, "dup row"), (None, "n"), (None, "n"), (None, "Text 1")]
    check(spark, rows, k)


def test_empty_table(spark):
    assert D.exact_dedup(spark.createDataFrame([], SCHEMA)).count() == 0


def test_misra_gries_keeps_heavy_digests():
    rng = np.random.default_rng(1)
    data = ["hot"] * 400 + [f"x{i}" for i in range(600)]
    rng.shuffle(data)
    held = Counter()
    for at in range(0, 1000, 50):
        held.update(data[at:at + 50])
        held = D.misra_gries(held, 9)
        assert len(held) <= 9
    assert 400 - 1000 / 10 <= held["hot"] <= 400


def test_heavy_digests_are_exact(spark):
    df = spark.createDataFrame([("hot", i, i) for i in range(50)] + [(f"d{i}", i, i) for i in range(50)],
                               "digest string, id long, rid long")
    got = D.heavy_digests(df, 7).collect()
    assert [(r.digest, r["size"], r.winner.id) for r in got] == [("hot", 50, 49)]
