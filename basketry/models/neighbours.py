"""Exact k nearest neighbours with pruning by bounding boxes.

Rows are ordered by a k-d split and packed into blocks of bounded size, each with the box of its
coordinates. A block of queries first reads the reference blocks nearest to its box that hold
enough rows; the k-th distance found there bounds the search of each row. Then a row reads only those blocks
whose box lies within its own bound; a far row does not make its whole block read on. The result is exact,
whatever the cuts: they come from a bounded sample and decide only how tight the boxes are.

Of reference rows at one point only the first k + 1 in tie order can ever be chosen, so the others
are left out beforehand: a point that holds a third of all rows does not fill the blocks.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..session import cut_lineage

BLOCK_ROWS = 1024       # rows of a block
MOST_LEAVES = 32_768    # leaves of the k-d split; beyond, blocks grow instead
SAMPLE_ROWS = 65_536    # rows that the cuts are made from
SLAB = 64               # queries compared with a block at once


def kd_cuts(sample: np.ndarray, leaves: int) -> tuple[np.ndarray, np.ndarray]:
    """Coordinate and value of each cut of a balanced k-d split, in heap order."""
    depth = max(0, int(np.ceil(np.log2(max(1, leaves)))))
    axis, value = np.zeros(2 ** depth - 1, np.int64), np.full(2 ** depth - 1, np.inf)
    parts = {0: sample}
    for node in range(len(axis)):
        part = parts.pop(node)
        if len(part):
            seen = ~np.isnan(part)
            width = np.where(seen.any(axis=0), np.nanmax(np.where(seen, part, -np.inf), axis=0)
                             - np.nanmin(np.where(seen, part, np.inf), axis=0), 0.0)
            axis[node] = int(np.argmax(width))
            x = part[:, axis[node]]
            if seen[:, axis[node]].any():
                value[node] = np.nanmedian(x)
            right = x > value[node]
            parts[2 * node + 1], parts[2 * node + 2] = part[~right], part[right]
        else:
            parts[2 * node + 1] = parts[2 * node + 2] = part
    return axis, value


def _leaf(x: np.ndarray, axis: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Leaf of each row; an unknown coordinate goes left."""
    node = np.zeros(len(x), np.int64)
    for _ in range(int(np.log2(len(axis) + 1))):
        right = x[np.arange(len(x)), axis[node]] > value[node]
        node = 2 * node + 1 + right
    return node - len(axis)


def box_distances(lo: np.ndarray, hi: np.ndarray, los: np.ndarray, his: np.ndarray) -> np.ndarray:
    """Least distance of a box from each of several, over the coordinates both have (NaN: has not),
    scaled up to all; inf without a shared one. A little is taken off for rounding."""
    gap = np.maximum(np.maximum(los - hi, lo - his), 0.0)
    both = ~np.isnan(gap)
    shared = both.sum(axis=1)
    total = np.where(both, gap * gap, 0.0).sum(axis=1)
    with np.errstate(divide="ignore", invalid="ignore"):
        out = np.sqrt(total * (gap.shape[1] / shared)) * (1 - 1e-9)
    return np.where(shared > 0, out, np.inf)


def _blocks(df: DataFrame, cols: list[str], cuts, rows: int, name: str) -> DataFrame:
    """Rows (_rid, _tie, cols…, _val) packed as bytes, with boxes; at most about ``rows`` to a block."""
    axis, value = cuts

    def place(frames):
        for frame in frames:
            x = frame[cols].to_numpy(float)
            unknown = np.isnan(x) @ (1 << np.arange(len(cols), dtype=np.int64))
            yield frame.assign(_leaf=_leaf(x, axis, value), _unknown=unknown)

    schema = ", ".join([f.simpleString().replace(":", " ", 1) for f in df.schema.fields])
    placed = df.mapInPandas(place, f"{schema}, _leaf long, _unknown long")
    placed = cut_lineage(placed)
    sizes = placed.groupBy("_leaf", "_unknown").agg(F.count(F.lit(1)).alias("_n"))
    placed = placed.join(sizes, ["_leaf", "_unknown"]).withColumn(
        "_part", F.pmod(F.xxhash64("_rid"), F.ceil(F.col("_n") / rows)).cast("int"))

    def pack(frame):
        frame = frame.sort_values(["_tie", "_rid"], kind="stable")
        x = frame[cols].to_numpy(float)
        return pd.DataFrame({
            f"{name}_n": [len(frame)], f"{name}_lo": [x.min(axis=0).tobytes()],
            f"{name}_hi": [x.max(axis=0).tobytes()],
            f"{name}_rid": [frame["_rid"].to_numpy(np.int64).tobytes()],
            f"{name}_tie": [frame["_tie"].to_numpy(np.int64).tobytes()],
            f"{name}_vec": [x.tobytes()], f"{name}_val": [frame["_val"].to_numpy(float).tobytes()]})

    packed = placed.groupBy("_leaf", "_unknown", "_part").applyInPandas(
        pack, ", ".join([f"{name}_n long"] + [f"{name}_{x} binary"
                                              for x in ("lo", "hi", "rid", "tie", "vec", "val")]))
    return cut_lineage(packed.withColumn(f"{name}_block", F.monotonically_increasing_id()))


def _distances(q: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Euclidean over the coordinates both have, scaled up to all; inf if there are none."""
    if np.isfinite(q).all() and np.isfinite(r).all():  # all coordinates known
        total = np.zeros((len(q), len(r)))
        for i in range(q.shape[1]):
            gap = q[:, i][:, None] - r[:, i][None, :]
            total += gap * gap
        return np.sqrt(total)
    total, both = np.zeros((len(q), len(r))), np.zeros((len(q), len(r)))
    for i in range(q.shape[1]):
        gap = q[:, i][:, None] - r[:, i][None, :]
        has = ~np.isnan(gap)
        total += np.where(has, gap * gap, 0.0)
        both += has
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(both > 0, np.sqrt(total * (q.shape[1] / both)), np.inf)


def _compare(d: int, k: int, exclude_same: bool):
    """The k nearest rows of a reference block for each row of a query block."""
    def run(frames):
        for frame in frames:
            for row in frame.itertuples(index=False):
                q_rid, r_rid, r_tie = (np.frombuffer(x, np.int64)
                                       for x in (row.q_rid, row.r_rid, row.r_tie))
                r_val = np.frombuffer(row.r_val, float)
                q, r = (np.frombuffer(x, float).reshape(-1, d) for x in (row.q_vec, row.r_vec))
                out = []
                for at in range(0, len(q), SLAB):
                    ids = q_rid[at:at + SLAB]
                    dist = _distances(q[at:at + SLAB], r)
                    if exclude_same:
                        dist[ids[:, None] == r_rid[None, :]] = np.inf
                    edge = (np.partition(dist, k - 1, axis=1)[:, k - 1:k] if len(r) > k
                            else np.full((len(dist), 1), np.inf))
                    if row.q_edge is not None:  # rows beyond what was found before are of no use
                        edge = np.minimum(edge, np.frombuffer(row.q_edge, float)[at:at + SLAB, None])
                    i, j = np.nonzero((dist <= edge) & np.isfinite(dist))
                    # block rows come in tie order, so a stable sort settles ties
                    order = np.lexsort((dist[i, j], i))
                    i, j = i[order], j[order]
                    place = np.arange(len(i)) - np.searchsorted(i, i)
                    i, j = i[place < k], j[place < k]
                    out.append(pd.DataFrame({
                        "q_block": row.q_block, "q_rid": ids[i], "distance": dist[i, j],
                        "tie": r_tie[j], "r_rid": r_rid[j], "val": r_val[j]}))
                yield pd.concat(out, ignore_index=True)
    return run


def _nearest(boxes, enough: int, lo: np.ndarray, hi: np.ndarray):
    """All reference blocks that share a coordinate with a box, nearest first, their distances, and how
    many of them hold ``enough`` rows."""
    _, n, los, his = boxes.value
    far = box_distances(lo, hi, los, his)
    order = np.argsort(far, kind="stable")
    order = order[np.isfinite(far[order])]
    return order, far, int(np.searchsorted(np.cumsum(n[order]), enough)) + 1


def _near_pairs(boxes, enough: int):
    """The nearest reference blocks of a query block that hold ``enough`` rows."""
    def run(frames):
        for frame in frames:
            for row in frame.itertuples(index=False):
                lo, hi = (np.frombuffer(x, float) for x in (row.q_lo, row.q_hi))
                order, _, upto = _nearest(boxes, enough, lo, hi)
                yield pd.DataFrame({"q_block": row.q_block, "r_block": boxes.value[0][order[:upto]]})
    return run


def _further_pairs(boxes, enough: int, d: int):
    """The other reference blocks that some rows of a query block must read, with these rows: those
    whose own k-th distance reaches the block's box."""
    def run(frames):
        blocks, _, los, his = boxes.value
        for frame in frames:
            for row in frame.itertuples(index=False):
                lo, hi, x = (np.frombuffer(b, float) for b in (row.q_lo, row.q_hi, row.q_vec))
                rid, x = np.frombuffer(row.q_rid, np.int64), x.reshape(-1, d)
                edge = np.full(len(rid), np.inf)
                if row.found_rid is not None:
                    found = np.asarray(row.found_rid, np.int64)
                    by = np.argsort(rid)
                    edge[by[np.searchsorted(rid, found, sorter=by)]] = np.asarray(row.found_edge, float)
                order, far, upto = _nearest(boxes, enough, lo, hi)
                out = []
                for at in order[upto:]:
                    if far[at] > edge.max():
                        break
                    use = box_distances(los[at], his[at], x, x) <= edge
                    if use.any():
                        out.append((row.q_block, blocks[at], rid[use].tobytes(), x[use].tobytes(),
                                    edge[use].tobytes()))
                        if len(out) == SLAB:
                            yield pd.DataFrame(out, columns=["q_block", "r_block", "q_rid", "q_vec", "q_edge"])
                            out = []
                yield pd.DataFrame(out, columns=["q_block", "r_block", "q_rid", "q_vec", "q_edge"])
    return run


def exact_knn(reference: DataFrame, queries: DataFrame, cols: Sequence[str], k: int = 5,
              exclude_same: bool = False, rows: int = BLOCK_ROWS,
              stats: dict | None = None) -> DataFrame:
    """(q_rid, rank, distance, r_rid, val): the k nearest reference rows of every query row.

    Both frames have a row id ``_rid``, a tie-break number ``_tie``, the coordinates ``cols`` (null:
    unknown) and a payload ``_val``. Order: distance, tie-break number, row id. Queries that
    share no coordinate with any reference row get no row. The table of boxes (at most
    ``MOST_LEAVES`` leaves for each set of known coordinates) is broadcast. ``stats`` receives the
    numbers of block pairs read and of all block pairs.
    """
    cols = list(cols)
    shape = [F.col("_rid").cast("long"), F.col("_tie").cast("long"),
             *[F.col(c).cast("double").alias(c) for c in cols], F.col("_val").cast("double")]
    first = W.partitionBy(*cols).orderBy("_tie", "_rid")
    ref = (reference.select(*shape).withColumn("_same", F.row_number().over(first))
           .where(F.col("_same") <= k + 1).drop("_same"))
    ref = cut_lineage(ref)
    n = ref.count()
    spark = reference.sparkSession
    empty = "q_rid long, rank int, distance double, r_rid long, val double"
    if not n:
        return spark.createDataFrame([], empty)
    rows = max(rows, -(-n // MOST_LEAVES))
    sample = (ref.orderBy(F.xxhash64("_rid")).limit(SAMPLE_ROWS).select(*cols).toPandas()
              .to_numpy(float))  # a bounded sample
    cuts = kd_cuts(sample, -(-n // rows))
    rb = _blocks(ref, cols, cuts, rows, "r")
    qb = _blocks(queries.select(*shape), cols, cuts, rows, "q")
    boxes = rb.select("r_block", "r_n", "r_lo", "r_hi").orderBy("r_block").toPandas()  # one row per block
    los, his = (np.stack([np.frombuffer(x, float) for x in boxes[c]]) for c in ("r_lo", "r_hi"))
    shared = spark.sparkContext.broadcast(
        (boxes["r_block"].to_numpy(np.int64), boxes["r_n"].to_numpy(np.int64), los, his))
    pair = "q_block long, r_block long"
    found = "q_block long, q_rid long, distance double, tie long, r_rid long, val double"

    def compare(pairs: DataFrame) -> DataFrame:
        both = pairs.join(rb.select("r_block", "r_rid", "r_tie", "r_vec", "r_val"), "r_block")
        return cut_lineage(both.mapInPandas(_compare(len(cols), k, exclude_same), found))

    near = cut_lineage(qb.select("q_block", "q_lo", "q_hi").mapInPandas(
        _near_pairs(shared, k + 1), pair))
    one = compare(near.join(qb.select("q_block", "q_rid", "q_vec", F.lit(None).cast("binary").alias("q_edge")),
                            "q_block"))
    kth = one.groupBy("q_block", "q_rid").agg(
        F.try_element_at(F.sort_array(F.collect_list("distance")), F.lit(k)).alias("edge"))
    kth = kth.where("edge IS NOT NULL").groupBy("q_block").agg(  # at most a block's rows
        F.collect_list(F.struct("q_rid", "edge")).alias("_e")).select(
        "q_block", F.col("_e.q_rid").alias("found_rid"), F.col("_e.edge").alias("found_edge"))
    asked = qb.select("q_block", "q_lo", "q_hi", "q_rid", "q_vec").join(kth, "q_block", "left")
    further = cut_lineage(asked.mapInPandas(_further_pairs(shared, k + 1, len(cols)),
                                            f"{pair}, q_rid binary, q_vec binary, q_edge binary"))
    if stats is not None:
        stats["pairs_read"] = near.count() + further.count()
        stats["pairs"] = qb.count() * len(boxes)
    w = W.partitionBy("q_rid").orderBy("distance", "tie", "r_rid")
    return (one.unionByName(compare(further)).withColumn("rank", F.row_number().over(w))
            .where(F.col("rank") <= k).select("q_rid", "rank", "distance", "r_rid", "val"))
