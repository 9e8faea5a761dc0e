"""Exact dedup with a heavy-hitter split.

A Misra-Gries summary finds the few digests that may hold a large share of all rows. Their
exact counts and winners are verified by one map-side aggregation and broadcast (a bounded
number of rows), so rows of such digests never meet in one task. All other digests take the
ordinary shuffle, where no group is larger than ``2 / (k + 1)`` of the rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, shared_table


def misra_gries(counts: Counter, k: int) -> Counter:
    """Cut a summary down to ``k`` counters; estimates fall by at most ``total / (k + 1)``."""
    if len(counts) <= k:
        return counts
    cut = sorted(counts.values(), reverse=True)[k]
    return Counter({key: n - cut for key, n in counts.items() if n > cut})


def _summarise(k: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Counter = Counter()
        for frame in frames:
            held.update(frame["digest"].value_counts().to_dict())
            held = misra_gries(held, k)
        yield pd.DataFrame({"digest": list(held), "est": list(held.values())}).astype(
            {"digest": "object", "est": "int64"})
    return run


def heavy_digests(digests: DataFrame, k: int) -> DataFrame:
    """Digests held by at least ``2 / (k + 1)`` of the rows: digest, size, winner.

    Merged estimates lie at most ``n / (k + 1)`` under the true counts and sum to at most n,
    so at most k + 1 candidates pass the cut, and every digest of ``2n / (k + 1)`` rows does.
    """
    n = digests.count()
    candidates = (digests.select("digest").mapInPandas(_summarise(k), "digest string, est long")
                  .groupBy("digest").agg(F.sum("est").alias("est"))
                  .filter(F.col("est") >= n / (k + 1)).select("digest"))
    candidates = shared_table(candidates, "heavy-candidates")  # at most k + 1 rows
    verified = (digests.join(F.broadcast(candidates), "digest").groupBy("digest")
                .agg(F.count(F.lit(1)).alias("size"),
                     F.max(F.struct("id", "rid")).alias("winner"))
                .filter(F.col("size") >= 2 * n / (k + 1)))
    return shared_table(verified, "heavy-digests")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                k: int = 1024) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; null counts as empty. Of equal
    texts the row with the largest id stays; among repeated rows with that id exactly one
    stays. A null id is smaller than any other; a group of null ids has a null keep_id. Other
    columns are ignored, whatever their names. An empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = shared_table(
        docs.select(F.col(id_col).alias("id"), F.sha2(ascii_lower(text), 256).alias("digest"))
        .withColumn("rid", F.monotonically_increasing_id()), "digests")
    heavy = heavy_digests(rows, k)
    few = heavy.limit(k + 1)  # all of it: the summary bounds it by (k + 1) / 2 rows
    light = rows.join(F.broadcast(few.select("digest")), "digest", "left_anti")
    groups = light.groupBy("digest").agg(F.count(F.lit(1)).alias("size"),
                                         F.max(F.struct("id", "rid")).alias("winner"))
    done = rows.join(F.broadcast(few), "digest").unionByName(light.join(groups, "digest"))
    return done.select(
        F.col("id").alias(id_col), F.col("winner.id").alias("keep_id"),
        F.col("size").alias("group_size"), (F.col("rid") == F.col("winner.rid")).alias("kept"),
        F.col("digest").alias("text_sha256"))
