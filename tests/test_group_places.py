"""Places of rows in groups of any size."""

import pytest
from pyspark.sql import functions as F

from basketry.operators import metrics as M
from basketry.operators import windows as Wn


@pytest.mark.parametrize("small", [True, False])
def test_places_span_ranges_and_null_groups(spark, monkeypatch, small):
    if not small:
        monkeypatch.setattr(Wn, "broadcast_if_small", lambda df: df)
    rows = [(("hot", None, "b")[0 if i < 700 else 1 + i % 2], i, None if i % 50 == 7 else (i * 37) % 101)
            for i in range(1000)]
    df = spark.createDataFrame(rows, "g string, k int, v int").repartition(7)
    out = Wn.group_places(df, ["g"], {"at": ["k"], "by_v": ["v", "k"]}, rows=60)
    assert out.columns == ["g", "k", "v", "at", "by_v"]
    got = {(r.g, r.k): (r["at"], r.by_v) for r in out.collect()}
    assert len(got) == len(rows)
    for g in ("hot", None, "b"):
        mine = [(k, v) for h, k, v in rows if h == g]
        by_v = sorted(mine, key=lambda r: (r[1] is not None, r[1] or 0, r[0]))
        assert [got[g, k][0] for k, _ in sorted(mine)] == list(range(len(mine)))
        assert [got[g, k][1] for k, _ in by_v] == list(range(len(mine)))


def test_places_without_groups_or_rows(spark):
    df = spark.range(500).select((F.col("id") * 7 % 500).alias("k"))
    assert all(r.k == r.p for r in Wn.group_places(df, [], {"p": ["k"]}, rows=90, size=500).collect())
    assert Wn.group_places(df.where("k < 0"), [], {"p": ["k"]}).collect() == []


def test_written_rows_of_residual_ranks_do_not_travel_again(spark):
    df = spark.range(300).select(F.col("id").alias("k"), (F.col("id") % 7).cast("double").alias("y"),
                                 F.lit(1.0).alias("p"), (F.col("id") % 2).alias("g"))
    out = M.residual_table(df, "y", "p", ["k"], by=["g"])
    assert out.count() == 300
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "hashpartitioning" not in plan
