"""Exact quantiles of unbounded columns, per group, by narrowing histograms.

Every wanted rank of a group keeps a range of values that holds it. A pass counts the rows of each
range in equal bins (added up before the shuffle) and keeps the bin that holds the rank; its least and
greatest value are the next range. When a range holds few rows, they are numbered and the rank is
picked. No buffer grows with the data: a task holds counts of ``BINS`` bins per rank, or ``few`` rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import cut_lineage

BINS = 1024
FEW = 4096


def exact_quantiles(df: DataFrame, value: str, quantiles: Sequence[float], by: Sequence[str] = (),
                    few: int = FEW, bins: int = BINS) -> DataFrame:
    """(by…, quantile, value): quantiles with linear interpolation between the two nearest ranks.

    Null and NaN values are ignored; a group without values has no rows. Null is a group.
    """
    by = list(by)
    rows = df.select(F.struct(*[F.col(c) for c in by]).alias("g") if by else F.lit(0).alias("g"),
                     F.col(value).cast("double").alias("v")).where("v IS NOT NULL AND NOT isnan(v)")
    rows = rows.withColumn("g", F.to_json("g") if by else F.lit("{}"))
    spans = rows.groupBy("g").agg(F.count(F.lit(1)).alias("rows"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    place = F.explode(F.array(*[F.struct(F.lit(float(q)).alias("q"),
                                         (F.lit(float(q)) * (F.col("rows") - 1)).alias("at"))
                                for q in quantiles]))
    wanted = spans.select("*", place.alias("p")).select("*", "p.q", "p.at")
    targets = wanted.select("g", F.explode(F.array_distinct(F.array(
        F.floor("at"), F.ceil("at")))).alias("rank"), "rows", "lo", "hi").distinct()
    open_ = cut_lineage(targets.withColumns({"below": F.lit(0).cast("long")}))
    wanted = cut_lineage(wanted.select("g", "q", "at"))
    known = []
    while True:
        known.append(open_.where("lo = hi").select("g", "rank", F.col("lo").alias("v")))
        small = open_.where((F.col("lo") < F.col("hi")) & (F.col("rows") <= few))
        inside = small.join(rows, "g").where("v BETWEEN lo AND hi")
        number = F.row_number().over(W.partitionBy("g", "rank").orderBy("v")) - 1
        known.append(inside.withColumn("i", number).where(F.col("i") == F.col("rank") - F.col("below"))
                     .select("g", "rank", "v"))
        large = open_.where((F.col("lo") < F.col("hi")) & (F.col("rows") > few))
        if large.isEmpty():
            break
        width = F.col("hi") - F.col("lo")
        bin_ = F.least(F.floor((F.col("v") - F.col("lo")) / width * bins), F.lit(bins - 1))
        counts = (large.join(rows, "g").where("v BETWEEN lo AND hi").withColumn("bin", bin_)
                  .groupBy("g", "rank", "below", "bin").agg(F.count(F.lit(1)).alias("rows"),
                                                            F.min("v").alias("lo"), F.max("v").alias("hi")))
        upto = F.sum("rows").over(W.partitionBy("g", "rank").orderBy("bin"))  # at most ``bins`` rows
        open_ = cut_lineage(
            counts.withColumn("upto", F.col("below") + upto)
            .where((F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("rows")))
            .select("g", "rank", "rows", "lo", "hi", (F.col("upto") - F.col("rows")).alias("below")))
    found = known[0]
    for part in known[1:]:
        found = found.unionByName(part)
    found = cut_lineage(found)
    low = found.select("g", F.col("rank").alias("r0"), F.col("v").alias("v0"))
    high = found.select("g", F.col("rank").alias("r1"), F.col("v").alias("v1"))
    out = (wanted.withColumns({"r0": F.floor("at"), "r1": F.ceil("at")})
           .join(low, ["g", "r0"]).join(high, ["g", "r1"]))
    mixed = F.col("v0") + (F.col("v1") - F.col("v0")) * (F.col("at") - F.col("r0"))
    schema = df.select(*by).schema.simpleString()
    keys = F.from_json("g", schema).alias("k") if by else F.lit(None).alias("k")
    return out.select(keys, F.col("q").alias("quantile"), mixed.alias("value")).select(
        *[F.col(f"k.{c}").alias(c) for c in by], "quantile", "value")
