"""Nearest neighbours by inner product with a hash-prefix forest.

A tree gives each vector a long string of bits, the sides of random hyperplanes on which it lies, and keeps
the strings in a sorted array. The longest prefix that a query shares with the array, and every shorter
one, is a run of the array, found by binary search. From the longest prefixes all trees ascend together,
one bit at a time, and the runs widen to more candidates.

How far to ascend follows from what has been found. Vectors at angle t agree on a bit with probability
p = 1 - t / pi, so one is missed by all trees at depth d with probability (1 - p^d)^trees. A
query goes up until that is at most ``miss`` at the angle of its k-th best vector so far; nearer ones are
missed less often. So near neighbours cost few candidates and far ones many, at any size, and
no number of candidates is fixed.

Inner products are searched as angles: vectors get one more coordinate that makes all as long as the
longest, queries get 0 there. Candidates are scored on the original vectors in double precision.

Rows are dealt into shards of about ``rows`` vectors by the hash of their ids, each with a whole
forest, so equal vectors do not gather in one place. The stated query set goes through every shard:
queries travel once per shard, and the work is queries x shards visits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import partitions_for, shared_table

TREES = 32
BITS = 64
MISS = 0.06
SHARD = 8192            # vectors of a shard
BLOCK = 1024            # queries that go through a shard at once
FEW = 4                 # candidates for each neighbour wanted before distances are looked at


def planes(trees: int, bits: int, dim: int, seed: int = 11) -> np.ndarray:
    """Normals of the hyperplanes, (trees, bits, dim); the same in every task."""
    return np.random.default_rng(seed).standard_normal((trees, bits, dim))


def hash_strings(vectors: np.ndarray, normals: np.ndarray) -> np.ndarray:
    """Bit strings of the vectors as numbers, first bit highest: (trees, n) uint64."""
    weights = np.uint64(1) << np.arange(normals.shape[1] - 1, -1, -1, dtype=np.uint64)
    return np.stack([((vectors @ h.T > 0) * weights).sum(axis=1, dtype=np.uint64) for h in normals])


def lift(vectors: np.ndarray, longest: float) -> np.ndarray:
    """One more coordinate, so that all vectors are as long as the longest."""
    rest = longest ** 2 - np.einsum("ij,ij->i", vectors, vectors)
    return np.hstack([vectors, np.sqrt(np.maximum(rest, 0.0))[:, None]])


def shared_bits(a: np.ndarray, b: np.ndarray, bits: int) -> np.ndarray:
    """Length of the common prefix of bit strings."""
    x = a ^ b
    length = np.zeros(x.shape, dtype=np.int64)
    for step in (32, 16, 8, 4, 2, 1):
        high = x >> np.uint64(step) != 0
        x = np.where(high, x >> np.uint64(step), x)
        length += step * high
    return np.where(a == b, bits, bits - 1 - length)


class Forest:
    """Sorted arrays of hash strings of one shard."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, longest: float, normals: np.ndarray):
        self.ids, self.vectors, self.longest, self.normals = ids, vectors, longest, normals
        self.bits = normals.shape[1]
        self.repeated = len(np.unique(ids)) < len(ids)
        strings = hash_strings(lift(vectors, longest), normals)
        self.order = np.argsort(strings, axis=1, kind="stable")
        self.strings = np.take_along_axis(strings, self.order, axis=1)

    def longest_match(self, strings: np.ndarray) -> np.ndarray:
        """Length of the longest prefix shared with any string of any tree, for each query."""
        out = np.zeros(strings.shape[1], dtype=np.int64)
        top = len(self.ids) - 1
        for a, s in zip(self.strings, strings):
            at = np.searchsorted(a, s)
            for near in (a[np.minimum(at, top)], a[np.maximum(at - 1, 0)]):
                out = np.maximum(out, shared_bits(near, s, self.bits))
        return out

    def runs(self, strings: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of the run that shares ``depth`` bits with each query, (trees, n) each."""
        if depth == 0:
            return np.zeros(strings.shape, np.int64), np.full(strings.shape, len(self.ids))
        below = np.uint64((1 << (self.bits - depth)) - 1)
        first = [np.searchsorted(a, s & ~below) for a, s in zip(self.strings, strings)]
        last = [np.searchsorted(a, s | below, side="right") for a, s in zip(self.strings, strings)]
        return np.stack(first), np.stack(last)

    def best(self, query: np.ndarray, own, first: np.ndarray, last: np.ndarray, k: int):
        """The k best candidates in the runs of a query: (ids, scores), ties to the smaller id."""
        seen = np.zeros(len(self.ids), dtype=bool)
        for order, a, b in zip(self.order, first, last):
            seen[order[a:b]] = True
        found = np.flatnonzero(seen)
        ids = self.ids[found]
        scores = np.einsum("ij,j->i", self.vectors[found], query)
        other = ids != own
        ids, scores = ids[other], scores[other]
        if len(ids) > k and not self.repeated:
            enough = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
            ids, scores = ids[enough], scores[enough]
        order = np.lexsort((ids, -scores))
        if self.repeated:  # of a repeated id, its best row
            order = order[np.sort(np.unique(ids[order], return_index=True)[1])]
        order = order[:k]
        return ids[order], scores[order]

    def depth_for(self, cos: float, miss: float) -> int:
        """The deepest level at which vectors of this cosine are missed rarely enough."""
        agree = 1.0 - np.arccos(min(max(cos, -1.0), 1.0)) / np.pi
        need = 1.0 - miss ** (1.0 / len(self.normals))
        if agree >= 1.0:
            return self.bits
        return max(0, min(self.bits, int(np.log(need) / np.log(agree)))) if agree > 0 else 0

    def search(self, ids: np.ndarray, queries: np.ndarray, k: int, miss: float) -> list:
        """For each query the k best vectors found: (ids, scores)."""
        strings = hash_strings(np.hstack([queries, np.zeros((len(queries), 1))]), self.normals)
        lengths = np.linalg.norm(queries, axis=1) * self.longest
        out: list = [None] * len(queries)
        # all trees go up together until there are a few candidates
        depth = self.longest_match(strings)
        open_ = np.arange(len(queries))
        while len(open_):
            at = int(depth[open_].max())
            now = open_[depth[open_] == at]
            first, last = self.runs(strings[:, now], at)
            enough = (last - first).sum(axis=0) >= FEW * k
            if at == 0:
                enough[:] = True
            for q, a, b in zip(now[enough], first.T[enough], last.T[enough]):
                out[q] = self.best(queries[q], ids[q], a, b, k)
            depth[now[~enough]] -= 1
            open_ = np.flatnonzero([x is None for x in out])
        # and on, as far as the k-th best asks for
        need = np.array([self.depth_for(f[1][-1] / n, miss) if len(f[0]) == k else 0
                         for f, n in zip(out, lengths)])
        for at in np.unique(need[need < depth]):
            now = np.flatnonzero((need < depth) & (need == at))
            first, last = self.runs(strings[:, now], int(at))
            for q, a, b in zip(now, first.T, last.T):
                out[q] = self.best(queries[q], ids[q], a, b, k)
        return out


def usable(vector: Column) -> Column:
    """Vectors without null or non-finite components that are not zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x)
                   | (F.abs(x) == F.lit(float("inf"))))
    return vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0)


def _search(k: int, trees: int, bits: int, miss: float, longest: float):
    """Rows come by shard, vectors before queries: the forest is made, then queries stream through."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        forest, shard = None, None
        for frame in frames:
            for name, rows in frame.groupby("shard", sort=False):
                if name != shard:
                    held, forest, shard = [], None, name
                held.append(rows[~rows["asked"]])
                asked = rows[rows["asked"]]
                if not len(asked):
                    continue
                if forest is None:
                    own = pd.concat(held)
                    if not len(own):
                        continue
                    vectors = np.stack(own["v"].to_numpy()).astype(np.float64)
                    forest = Forest(own["id"].to_numpy(), vectors, longest,
                                    planes(trees, bits, vectors.shape[1] + 1))
                    held = []
                for at in range(0, len(asked), BLOCK):
                    part = asked.iloc[at:at + BLOCK]
                    ids = part["id"].to_numpy()
                    queries = np.stack(part["v"].to_numpy()).astype(np.float64)
                    found = forest.search(ids, queries, k, miss)
                    yield pd.DataFrame({
                        "query_id": np.repeat(ids, [len(f[0]) for f in found]),
                        "id": np.concatenate([f[0] for f in found]),
                        "score": np.concatenate([f[1] for f in found])})
    return run


def nearest_neighbours(vectors: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id",
                       vector_col: str = "embedding", trees: int = TREES, bits: int = BITS,
                       miss: float = MISS, rows: int = SHARD) -> DataFrame:
    """One row per query and neighbour: query_id, rank, vec_id (the id column), score.

    ``queries`` are rows like those of ``vectors``; a query's own id is no candidate. The k largest
    inner products found, largest first, ties to the smaller id; fewer if there are fewer. Rows
    whose vector is null, empty, zero, or holds null or non-finite components take no part, nor do
    null ids. Of a repeated id the best row counts; a repeated query is asked once. All vectors
    must be of one length (else an error). Other columns are ignored, whatever their names. Empty
    tables give no rows.
    """
    kind = dict(vectors.dtypes)[id_col]

    def clean(df: DataFrame) -> DataFrame:
        return df.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v")).filter(
            F.col("id").isNotNull() & usable(F.col("v")))

    base = shared_table(clean(vectors), "vectors")
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    facts = base.agg(F.count(F.lit(1)).alias("n"), F.sqrt(F.max(square)).alias("longest"),
                     F.min(F.size("v")).alias("least"), F.max(F.size("v")).alias("most")).first()
    if facts["n"] and facts["least"] != facts["most"]:
        raise ValueError(f"vectors of {facts['least']} to {facts['most']} components")
    shards = partitions_for(facts["n"], rows)
    asked = clean(queries).dropDuplicates(["id", "v"])
    both = base.select(F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int").alias("shard"),
                       F.lit(False).alias("asked"), "id", "v").unionByName(
        asked.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
                     F.lit(True).alias("asked"), "id", "v"))
    found = (both.repartition(shards, "shard").sortWithinPartitions("shard", "asked")
             .mapInPandas(_search(k, trees, bits, miss, facts["longest"] or 0.0),
                          f"query_id {kind}, id {kind}, score double"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return (shared_table(found, "found").withColumn("rank", F.row_number().over(order))
            .filter(F.col("rank") <= k)
            .select("query_id", "rank", F.col("id").alias(id_col), "score"))
