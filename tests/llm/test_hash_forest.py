import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.llm import hash_forest as H

SCHEMA = "vec_id long, embedding array<float>"


def exact(ids, vectors, queries, k):
    """Ids and scores of the k largest inner products for each query position."""
    out = {}
    for q in queries:
        s = vectors @ vectors[q]
        order = [i for i in np.lexsort((ids, -s)) if ids[i] != ids[q]][:k]
        out[ids[q]] = [(ids[i], s[i]) for i in order]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        assert r["rank"] == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r[2], r.score))
    return out


def recall(got, want):
    """Share of the true neighbours' places filled with scores as good."""
    hit = total = 0
    for q, best in want.items():
        floor = best[-1][1] - 1e-9
        hit += sum(s >= floor for _, s in got.get(q, []))
        total += len(best)
    return hit / total


@pytest.mark.parametrize("scaled", [False, True])
def test_recall_against_brute_force(spark, scaled):
    rng = np.random.default_rng(0)
    x = rng.standard_normal((1500, 24)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1)[:, None]
    if scaled:
        x *= rng.uniform(0.2, 3.0, (1500, 1)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], SCHEMA)
    got = found(H.nearest_neighbours(df, df.filter(F.col("vec_id") % 20 == 0), rows=500))
    want = exact(np.arange(1500), x.astype(np.float64), range(0, 1500, 20), 20)
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    assert recall(got, want) >= 0.9
    for q, rows in got.items():
        assert rows == sorted(rows, key=lambda r: (-r[1], r[0]))
        for i, s in rows:
            assert abs(s - float(x[i].astype(np.float64) @ x[q].astype(np.float64))) < 1e-12


def test_near_vectors_need_few_candidates():
    rng = np.random.default_rng(1)
    centre = rng.standard_normal((200, 32))
    x = np.repeat(centre, 30, axis=0) + 0.05 * rng.standard_normal((6000, 32))
    longest = np.linalg.norm(x, axis=1).max()
    forest = H.Forest(np.arange(6000), x / longest, 1.0, H.planes(32, 64, 33))
    seen, best = [], H.Forest.best

    def counted(self, query, own, first, last, k):
        seen.append((last - first).sum())
        return best(self, query, own, first, last, k)

    H.Forest.best = counted
    try:
        got = forest.search(np.arange(0, 6000, 60), x[::60] / longest, 5, 0.06)
    finally:
        H.Forest.best = best
    assert np.median(seen) < 32 * 6000 / 4
    assert all(set(ids // 30) == {q // 30} for (ids, _), q in zip(got, range(0, 6000, 60)))


def test_copies_ties_and_bad_rows(spark):
    rows = [(i, [1.0, 0.0]) for i in range(50)] + [(100 + i, [0.0, 1.0 + i]) for i in range(3)]
    rows += [(200, None), (201, []), (202, [0.0, 0.0]), (203, [None, 1.0]), (204, [float("nan"), 1.0]),
             (205, [float("inf"), 1.0]), (None, [9.0, 9.0]), (7, [1.0, 0.0]), (8, [2.0, 0.0])]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", score int, shard string")
    got = found(H.nearest_neighbours(df, df.filter("vec_id in (0, 100, 200, 202, 204)"), k=5))
    assert got == {0: [(8, 2.0), (1, 1.0), (2, 1.0), (3, 1.0), (4, 1.0)],
                   100: [(102, 3.0), (101, 2.0), (0, 0.0), (1, 0.0), (2, 0.0)]}


def test_few_candidates_empty_tables_and_text_ids(spark):
    df = spark.createDataFrame([("a", [1.0, 2.0]), ("b", [2.0, 1.0]), ("c", [-1.0, 0.5])],
                               "vec_id string, embedding array<double>")
    got = found(H.nearest_neighbours(df, df.filter("vec_id = 'a'")))
    assert got == {"a": [("b", 4.0), ("c", 0.0)]}
    none = spark.createDataFrame([], SCHEMA)
    assert H.nearest_neighbours(none, none).count() == 0
    assert H.nearest_neighbours(df, df.limit(0)).count() == 0


def test_shared_bits():
    a = np.array([0, 1 << 63, 5, 2 ** 64 - 1, 6], dtype=np.uint64)
    b = np.array([0, 0, 4, 2 ** 64 - 1, 1], dtype=np.uint64)
    assert H.shared_bits(a, b, 64).tolist() == [64, 0, 63, 64, 61]
