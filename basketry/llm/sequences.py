"""Packed training sequences: token ids laid into the bins of best-fit packing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import shared_table
from .packing import best_fit_pack


def packed_sequences(docs: DataFrame, tokens_col: str = "token_ids", id_col: str = "doc_id",
                     end_token: int | None = None, pad_token: int | None = None, **packing) -> DataFrame:
    """One row per bin: bin_id, bin_capacity, bin_used, token_ids, pieces.

    ``tokens_col`` holds each document's token ids; ``end_token`` is put after the last of a document.
    token_ids are the pieces of the bin one after another, filled up to its capacity with ``pad_token`` if
    that is given. ``pieces`` lists (id, first_token, n_tokens, bin_offset) in this order, so attention can be
    kept within a piece and positions can start anew. ``packing`` are further arguments of ``best_fit_pack``.

    Null and empty lists give no piece (with ``end_token``: the mark alone). Repeated rows and null ids
    are packed like any other; other columns are ignored. An empty table gives no rows. The lists
    are written once with a row number and meet their pieces by it, whatever the ids are; a bin, the only
    group that is gathered, holds no more than its capacity.
    """
    tokens: Column = F.coalesce(F.col(tokens_col).cast("array<int>"), F.array().cast("array<int>"))
    if end_token is not None:
        tokens = F.concat(tokens, F.array(F.lit(int(end_token))))
    rows = shared_table(docs.select(F.col(id_col).alias("id"), tokens.alias("tokens"))
                        .withColumn("row", F.monotonically_increasing_id()), "token-lists")
    pieces = best_fit_pack(rows, F.size("tokens"), id_col="row", **packing)
    cut = F.slice("tokens", F.col("first_token").cast("int") + 1, F.col("n_tokens"))
    laid = pieces.join(rows, "row").select(
        "bin_id", "bin_capacity", "bin_used",
        F.struct("bin_offset", "row", "id", "first_token", "n_tokens", cut.alias("tokens")).alias("p"))
    # the row number settles the order, so that ids of any type will do
    bins = laid.groupBy("bin_id", "bin_capacity", "bin_used").agg(F.sort_array(F.collect_list("p")).alias("p"))
    ids = F.flatten(F.transform("p", lambda x: x["tokens"]))
    if pad_token is not None:
        ids = F.concat(ids, F.array_repeat(F.lit(int(pad_token)), F.col("bin_capacity") - F.col("bin_used")))
    return bins.select(
        "bin_id", "bin_capacity", "bin_used", ids.alias("token_ids"),
        F.transform("p", lambda x: F.struct(
            x["id"].alias(id_col), x["first_token"].alias("first_token"), x["n_tokens"].alias("n_tokens"),
            x["bin_offset"].alias("bin_offset"))).alias("pieces"))
