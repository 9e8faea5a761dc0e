"""Variable-capacity best-fit packing of token sequences.

Several sequence lengths are permitted at once, each with a cost. Pieces go, longest first,
into the open bin that they fill best. When none fits, the bin size opened is the one whose
cost per token is least for what it would then hold of the pieces still to come. At the end
each bin is cut down to the cheapest permitted length that holds its contents.

Rows are dealt into blocks of at most ``block`` pieces, packed independently; only the last
few bins of a block can stay poorly filled, so the loss is about ``1 / block``.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, partitions_for, shared_table

LENGTHS = (512, 1024, 2048, 4096)
PIECES = ("piece int, first_token long, n_tokens int, bin_id string, "
          "bin_capacity int, bin_used int, bin_offset int")


def word_tokens(text: Column) -> Column:
    """Length of a text in words, plus one end mark."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)) + 1


def bin_costs(lengths, overhead: float) -> dict[int, float]:
    """Cost of a sequence: its tokens, and a fixed price for each sequence."""
    return {int(c): c + overhead for c in sorted(lengths)}


class _Pool:
    """Pieces not yet placed, as counts by length."""

    def __init__(self, sizes: np.ndarray):
        values, counts = np.unique(sizes, return_counts=True)
        self.values = values.tolist()
        self.counts = dict(zip(self.values, counts.tolist()))

    def take(self, size: int) -> None:
        self.counts[size] -= 1
        if not self.counts[size]:
            del self.values[bisect_left(self.values, size)]

    def fill(self, room: int) -> int:
        """Tokens that longest-first filling would put into ``room``."""
        used, top = 0, len(self.values)
        while top:
            top = bisect_right(self.values, room - used, 0, top)
            if not top:
                break
            size = self.values[top - 1]
            used += size * min(self.counts[size], (room - used) // size)
            top -= 1
        return used


def pack_block(sizes: np.ndarray, costs: dict[int, float]) -> tuple[np.ndarray, np.ndarray, list]:
    """Bin of each piece, its offset in the bin, and (capacity, used) of each bin."""
    order = np.argsort(-sizes, kind="stable")
    where, offset = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    pool, used = _Pool(sizes), []
    open_bins: list[tuple[int, int]] = []  # (room left, bin), sorted
    for i in order.tolist():
        size = int(sizes[i])
        pool.take(size)
        at = bisect_left(open_bins, (size, -1))
        if at < len(open_bins):
            room, b = open_bins.pop(at)
        else:
            room = min((c for c in costs if c >= size),
                       key=lambda c: (costs[c] / (size + pool.fill(c - size)), c))
            b = len(used)
            used.append(0)
        where[i], offset[i] = b, used[b]
        used[b] += size
        if room > size:
            insort(open_bins, (room - size, b))
    cut = [min((c for c in costs if c >= u), key=lambda c: (costs[c], c)) for u in used]
    return where, offset, list(zip(cut, used))


def _pack(costs: dict[int, float], block: int):
    def pack(held: list[pd.DataFrame]) -> pd.DataFrame:
        rows = pd.concat(held, ignore_index=True)
        where, offset, bins = pack_block(rows["n_tokens"].to_numpy(), costs)
        shape = np.array(bins, dtype="int64").reshape(-1, 2)
        name = f"{rows['slot'].iloc[0]}-{rows['rid'].iloc[0]}-"
        return rows.drop(columns=["slot", "rid"]).assign(
            bin_id=[f"{name}{b}" for b in where.tolist()],
            bin_capacity=shape[where, 0], bin_used=shape[where, 1], bin_offset=offset)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        n = 0
        for frame in frames:
            while len(frame):
                part, frame = frame.iloc[:block - n], frame.iloc[block - n:]
                held.append(part)
                n += len(part)
                if n == block:
                    yield pack(held)
                    held, n = [], 0
        if held:
            yield pack(held)
    return run


def best_fit_pack(docs: DataFrame, tokens: Column, id_col: str = "doc_id", lengths=LENGTHS,
                  overhead: float = 16.0, block: int = 32768) -> DataFrame:
    """One row per piece: id, piece, first_token, n_tokens, bin_id, bin_capacity, bin_used,
    bin_offset.

    ``tokens`` is the length of a document; null or 0 gives no piece. A document longer than
    the largest permitted length is cut into pieces of that length and a rest. Equal lengths
    keep their order in the block; repeated rows are packed as often as they come, and null ids
    are packed like any other. Other columns are ignored. An empty table gives no rows. The
    table of pieces is written once and dealt evenly, whatever the ids are.
    """
    costs = bin_costs(lengths, overhead)
    longest = max(costs)
    pieces = (docs.select(F.col(id_col).alias("doc_id"), tokens.cast("long").alias("total"))
              .filter("total > 0")
              .withColumn("piece", F.explode(F.sequence(
                  F.lit(0), F.floor((F.col("total") - 1) / longest).cast("int"))))
              .withColumn("first_token", F.col("piece").cast("long") * longest)
              .select("doc_id", "piece", "first_token",
                      F.least(F.lit(longest).cast("long"), F.col("total") - F.col("first_token"))
                      .cast("int").alias("n_tokens"))
              .withColumn("rid", F.monotonically_increasing_id()))
    pieces = shared_table(pieces, "pieces")
    n = partitions_for(pieces.count(), block)
    dealt = (pieces.withColumn("slot", F.pmod(F.xxhash64("rid"), F.lit(n)))
             .repartition(n, "slot").sortWithinPartitions("slot", "rid"))
    packed = dealt.mapInPandas(_pack(costs, block), f"doc_id {dict(docs.dtypes)[id_col]}, {PIECES}")
    return packed.withColumnRenamed("doc_id", id_col)
