"""Jobs on exact nearest neighbours: KNN imputation (P10) and SMOTE.

The search itself, with its pruning, is ``neighbours.exact_knn``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .neighbours import exact_knn


def knn_impute(df: DataFrame, cols: Sequence[str], key: Sequence[str], k: int = 5) -> DataFrame:
    """Fill the nulls of ``cols``, column by column, from the k nearest rows that have the column (P10).

    Distances are Euclidean on z-scored columns over the coordinates that both rows have, scaled
    up to all of them. A row that shares no coordinate with any donor gets the column's mean; a
    column without any value stays null. Ties go by a hash of ``key``, then by row.
    """
    cols = list(cols)
    d = df.withColumns({"_rid": F.monotonically_increasing_id(),
                        "_tie": F.xxhash64(*[F.col(c) for c in key])})
    d = cut_lineage(d)  # row ids are fixed from here on
    stats = d.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)],
                  *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(cols)],
                  *[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(cols)]).first()
    z = {f"_z{i}": (F.when(F.col(c).isNotNull(), 0.0) if not stats[f"s{i}"]
                    else (F.col(c) - F.lit(stats[f"m{i}"])) / F.lit(stats[f"s{i}"]))
         for i, c in enumerate(cols)}
    d = d.withColumns(z)
    out = d
    for i, c in enumerate(cols):
        if not stats[f"n{i}"] or stats[f"m{i}"] is None:
            continue
        gaps = d.where(F.col(c).isNull()).withColumn("_val", F.lit(None).cast("double"))
        donors = d.where(F.col(c).isNotNull()).withColumn("_val", F.col(c))
        fill = (exact_knn(donors, gaps, list(z), k).groupBy("q_rid").agg(F.avg("val").alias(f"_f{i}"))
                .withColumnRenamed("q_rid", "_rid"))
        out = out.join(fill, "_rid", "left").withColumn(
            c, F.coalesce(F.col(c), F.col(f"_f{i}"), F.lit(stats[f"m{i}"])))
    return out.select(*df.columns)


def smote(df: DataFrame, label: str, key: str, features: str = "features", k: int = 5,
          seed: int = 42) -> DataFrame:
    """Oversample every class to the size of the largest.

    For a row x with its k nearest rows of the same class, a synthetic row is x + u·(n − x) with one
    of these n and u in [0, 1), both drawn from a hash of (row, copy, seed). Copies are spread evenly
    over the rows of a class; a class of one row is repeated as it is. Returns the original
    rows and the synthetic ones (columns: key, label, features); synthetic keys are −1, −2, ….
    """
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from ..operators.windows import prefix_sums
    base = df.select(F.col(key).cast("long").alias(key), label, features)
    counts = {r[label]: r["n"] for r in base.where(F.col(label).isNotNull())
              .groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per class
    most = max(counts.values(), default=0)
    out, used = base, 0
    for value, n in sorted(counts.items(), key=lambda x: (x[1], str(x[0]))):
        need = most - n
        if not need:
            continue
        own = base.where(F.col(label) == value).withColumns({
            "_rid": F.monotonically_increasing_id(), "_tie": F.col(key).cast("long"),
            "_v": vector_to_array(features), "_val": F.lit(0.0),
            "_h": F.xxhash64(F.col(key), F.lit(seed)).cast("double"), "_one": F.lit(1)})
        own = cut_lineage(own)
        dim = len(own.select("_v").first()["_v"])
        xs = [f"_x{i}" for i in range(dim)]
        own = own.withColumns({x: F.col("_v")[i] for i, x in enumerate(xs)})
        near = exact_knn(own, own, xs, k, exclude_same=True)
        # exactly ``need`` rows: every row makes need // n copies, the first need % n (in hash
        # order, by a distributed prefix count) one more
        ranked = prefix_sums(own.select("_rid", key, "_v", "_h", "_one"), "_h", ["_one"],
                             prefix="_r", tiebreak=["_rid"])
        per_row, extra = divmod(need, n)
        copies = F.lit(per_row) + F.when(F.col("_r__one") < extra, 1).otherwise(0)
        rows = ranked.withColumn("_copies", copies).where("_copies > 0").withColumn(
            "_c", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))))
        has = near.groupBy("q_rid").agg(F.max("rank").alias("_kk"))
        rows = rows.join(has, rows["_rid"] == has["q_rid"], "left").drop("q_rid")
        pick = F.pmod(F.xxhash64("_rid", "_c", F.lit(seed + 1)), F.coalesce("_kk", F.lit(1))) + 1
        rows = rows.withColumns({"_pick": pick.cast("int"), "_u": F.pmod(
            F.xxhash64("_rid", "_c", F.lit(seed + 2)), F.lit(1_000_000)) / 1_000_000.0})
        rows = rows.join(near.select("q_rid", "rank", "r_rid"),
                         (rows["_rid"] == F.col("q_rid")) & (rows["_pick"] == F.col("rank")), "left")
        other = own.select(F.col("_rid").alias("r_rid"), F.col("_v").alias("_n"))
        rows = rows.join(other, "r_rid", "left")
        vec = F.zip_with("_v", F.coalesce("_n", "_v"), lambda a, b: a + F.col("_u") * (b - a))
        made = rows.select(
            (-(F.lit(used + 1) + (F.col("_c") - 1) * n + F.col("_r__one"))).cast("long").alias(key),
            F.lit(value).cast(df.schema[label].dataType).alias(label),
            array_to_vector(vec).alias(features))
        out = out.unionByName(made)
        used += need + n  # the last round of copies may leave numbers unused
    return out
