"""SimHash near-duplicates by a distributed vantage-point tree.

Distances to vantage points are taken on disjoint groups of bits. Each is a Hamming distance of
its own, so the triangle bound holds in every group, and over disjoint groups the bounds add up:
two fingerprints within ``radius`` have distance vectors within ``radius`` in the L1 norm.

The upper levels of the tree deal distinct fingerprints into shards by their distance vector.
A fingerprint is at home in one shard and visits each shard whose boundary it overlaps (vectors
within ``radius`` that come later in order), so every near pair meets exactly once. Inside a
shard a finer tree over all bit groups prunes branch pairs and the rest is compared
exactly. Shards with too many members are cut into cells of bounded size.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import partitions_for, shared_table
from .components import connected_components

SEED = 42
BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
LANES = (np.arange(8) * 256).astype(np.int64)
TOP_BITS = 16           # bits of each upper level
LEAF_BITS = 8           # bits of each level inside a shard
BRUTE = 1 << 16         # branch pairs with so few pairs of points are compared directly
HELD = 1 << 20          # pairs held before they are folded into a forest


def fingerprint(text: str | None, shingle: int) -> int:
    """64-bit SimHash of the word shingles, repeats included, as an unsigned number."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    k = min(shingle, len(words))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:len(words) - k] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends[k - 1:].tolist())],
                 dtype="<u8")
    lanes = h.view(np.uint8).reshape(-1, 8) + LANES
    ones = np.bincount(lanes.ravel(), minlength=2048).reshape(8, 256) @ BYTE_BITS
    return int.from_bytes(np.packbits(2 * ones.ravel() > len(h), bitorder="little").tobytes(),
                          "little")


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(id, rid, fp): fp is the fingerprint's 64 bits as a signed long."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(frames):
        for frame in frames:
            fp = np.array([fingerprint(t, shingle) for t in frame["text"]], dtype=np.uint64)
            yield pd.DataFrame({"id": frame["id"], "fp": fp.view(np.int64)})
    kind = dict(rows.dtypes)["id"]
    return (rows.mapInPandas(run, f"id {kind}, fp long")
            .withColumn("rid", F.monotonically_increasing_id()))


def _masks(bits: int) -> list[int]:
    return [((1 << bits) - 1) << at for at in range(0, 64, bits)]


def distances(fp: np.ndarray, vantage: int, bits: int) -> np.ndarray:
    """Distance to the vantage point on each group of ``bits`` bits: one column per group."""
    apart = fp ^ np.uint64(vantage)
    return np.stack([np.bitwise_count(apart & np.uint64(m)) for m in _masks(bits)],
                    axis=1).astype(np.int64)


def choose_vantage(sample: np.ndarray) -> int:
    """Of the first 32 sampled points the one whose group distances spread most."""
    if not len(sample):
        return 0
    spread = [distances(sample, int(v), TOP_BITS).var(axis=0).sum() for v in sample[:32]]
    return int(sample[int(np.argmax(spread))])


def visit_offsets(levels: int, radius: int) -> np.ndarray:
    """Offsets of the shards a point visits: L1 norm within the radius, later in order."""
    steps = product(range(-radius, radius + 1), repeat=levels)
    return np.array([s for s in steps if 0 < sum(map(abs, s)) <= radius and s > (0,) * levels],
                    dtype=np.int64).reshape(-1, levels)


def forest_labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n points the least point of its component under the edges (a, b)."""
    label = np.arange(n)
    while True:
        low, high = np.minimum(label[a], label[b]), np.maximum(label[a], label[b])
        if not (low < high).any():
            return label
        np.minimum.at(label, high, low)
        while (label[label] != label).any():
            label = label[label]


class Forest:
    """Pairs among n points; all of them, or folded into a spanning forest as they come."""

    def __init__(self, n: int, fold: bool):
        self.n, self.fold, self.held, self.pairs = n, fold, 0, []

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        if len(a):
            self.pairs.append((a, b))
            self.held += len(a)
            if self.fold and self.held > HELD:
                self.pairs = [self.edges()]
                self.held = len(self.pairs[0][0])

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.pairs:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        a, b = (np.concatenate(x) for x in zip(*self.pairs))
        if not self.fold:
            return a, b
        label = forest_labels(self.n, a, b)
        child = np.flatnonzero(label != np.arange(self.n))
        return child, label[child]


def _branches(at: np.ndarray, level: int, d: np.ndarray) -> list[tuple[int, np.ndarray]]:
    shell = d[at, level]
    order = np.argsort(shell, kind="stable")
    at, shell = at[order], shell[order]
    cuts = np.flatnonzero(np.diff(shell)) + 1
    return [(int(shell[s]), part) for s, part in zip([0, *cuts.tolist()], np.split(at, cuts))]


def search(fp: np.ndarray, left: np.ndarray, right: np.ndarray, d: np.ndarray, radius: int,
           found: Forest, itself: bool) -> None:
    """Add all pairs within ``radius`` of a point in ``left`` and one in ``right``.

    Descends both trees at once: a pair of shells may hold a near pair only if their distances
    differ by no more than what the levels above have left of the radius.
    """
    work = [(left, right, 0, radius, itself)]
    while work:
        a, b, level, rest, same = work.pop()
        if len(a) * len(b) <= BRUTE or level == d.shape[1]:
            step = max(1, (16 * BRUTE) // len(b))
            for at in range(0, len(a), step):
                part = a[at:at + step]
                near = np.bitwise_count(fp[part][:, None] ^ fp[b][None, :]) <= radius
                i, j = np.nonzero(near)
                i, j = part[i], b[j]
                keep = i < j if same else slice(None)
                found.add(i[keep], j[keep])
            continue
        ours = _branches(a, level, d)
        theirs = ours if same else _branches(b, level, d)
        for x, (s, p) in enumerate(ours):
            for y, (t, q) in enumerate(theirs):
                if abs(s - t) <= rest and not (same and y < x):
                    work.append((p, q, level + 1, rest - abs(s - t), same and x == y))


def _search_cell(vantage: int, radius: int, fold: bool):
    def run(cell: pd.DataFrame) -> pd.DataFrame:
        fp = cell["fp"].to_numpy().view(np.uint64)
        role = cell["role"].to_numpy()
        d = distances(fp, vantage, LEAF_BITS)
        homes, guests = np.flatnonzero(role < 2), np.flatnonzero(role == 2)
        found = Forest(len(fp), fold)
        if (role == 0).any():  # the cell that also compares homes among themselves
            search(fp, homes, homes, d, radius, found, True)
        if len(guests) and len(homes):
            search(fp, guests, homes, d, radius, found, False)
        a, b = found.edges()
        return pd.DataFrame({"a": fp[a].view(np.int64), "b": fp[b].view(np.int64)})
    return run


def near_pairs(points: DataFrame, radius: int, fold: bool = False, per_cell: int = 50_000,
               sample: int = 1000) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints in ``points`` (column fp) that differ in at most
    ``radius`` bits. With ``fold``, a spanning forest of the pairs of each cell instead: it
    connects the same points and has fewer rows than the cell has points.

    The vantage point is chosen on at most ``sample`` fingerprints; it affects balance only.
    """
    points = shared_table(points.select("fp").distinct(), "fingerprints")
    n = points.count()
    some = points.orderBy(F.xxhash64("fp"), "fp").limit(sample).toPandas()["fp"]
    vantage = choose_vantage(some.to_numpy(np.int64).view(np.uint64))
    # a level more makes shards about 8 times smaller, but a point then visits 3 times as many
    levels = 2
    while levels < 4 and n > 80 * per_cell * 8 ** (levels - 2):
        levels += 1
    offsets = visit_offsets(levels, radius)
    size = TOP_BITS + 1
    radix = size ** np.arange(levels)

    def deal(frames):
        for frame in frames:
            fp = frame["fp"].to_numpy(np.int64)
            d = distances(fp.view(np.uint64), vantage, TOP_BITS)[:, :levels]
            yield pd.DataFrame({"shard": d @ radix, "fp": fp, "guest": False})
            for off in offsets:
                to = d + off
                ok = ((to >= 0) & (to < size)).all(axis=1)
                yield pd.DataFrame({"shard": to[ok] @ radix, "fp": fp[ok], "guest": True})

    dealt = points.mapInPandas(deal, "shard long, fp long, guest boolean")
    # at most 17 ** levels rows
    load = shared_table(dealt.groupBy("shard").agg(
        F.sum((~F.col("guest")).cast("long")).alias("homes"),
        F.count(F.lit(1)).alias("all")).filter("homes > 0").withColumns({
            "s": F.ceil(F.col("homes") / per_cell).cast("int"),
            "t": F.ceil(F.col("all") / (4 * per_cell)).cast("int")}).select("shard", "s", "t"),
        "shard-load")
    salt = F.xxhash64("fp", F.lit(7))
    cells = (dealt.join(F.broadcast(load), "shard")
             .withColumns({"hs": F.pmod(salt, F.col("s")).cast("int"),
                           "ht": F.pmod(F.shiftright(salt, 20), F.col("t")).cast("int")}))

    def cell(s, t, role):
        return F.struct(s.alias("cs"), t.alias("ct"), F.lit(role).alias("role"))

    def each(n_col, body):
        return F.when(n_col > 0, F.transform(F.sequence(F.lit(0), n_col - 1), body)).otherwise(
            F.array().cast("array<struct<cs:int,ct:int,role:int>>"))

    hs, ht = F.col("hs"), F.col("ht")
    at_home = each(F.col("t"), lambda t: F.struct(
        hs.alias("cs"), t.alias("ct"), F.when(t == 0, 0).otherwise(1).alias("role")))
    other = each(hs, lambda s: cell(s, ht, 2))
    visits = each(F.col("s"), lambda s: cell(s, ht, 2))
    cells = (cells.withColumn("c", F.explode(F.when(F.col("guest"), visits).otherwise(
        F.concat(at_home, other)))).select("shard", "c.*", "fp"))
    # few bytes and much work: the number of tasks follows the cells, not the bytes
    n_cells = load.agg(F.coalesce(F.sum(F.col("s") * F.col("t")), F.lit(0))).first()[0]
    cells = cells.repartition(partitions_for(n_cells, 4), "shard", "cs", "ct")
    return cells.groupBy("shard", "cs", "ct").applyInPandas(
        _search_cell(vantage, radius, fold), "a long, b long")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       shingle: int = 4, radius: int = 4, per_cell: int = 50_000) -> DataFrame:
    """One row per input row: id, fingerprint, component_id, component_size, kept.

    Rows are linked when their fingerprints differ in at most ``radius`` bits; component_id is
    the least id that can be reached. Null and empty texts have fingerprint zero and are linked
    like any other. ``kept`` marks one row of each component: the one with the least id (among
    repeated rows with that id, exactly one; a null id only if all are null). Other columns
    are ignored. An empty table gives no rows.
    """
    rows = shared_table(fingerprints(docs, id_col, text_col, shingle), "simhash")
    roots = connected_components(near_pairs(rows, radius, fold=True, per_cell=per_cell))
    of_fp = rows.groupBy("fp").agg(
        F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "rid")).alias("first"),
        F.count(F.lit(1)).alias("n"))
    rooted = of_fp.join(roots, of_fp["fp"] == roots["node"], "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "first", "n")
    rooted = shared_table(rooted, "rooted")
    best = rooted.groupBy("root").agg(F.min("first").alias("first"), F.sum("n").alias("size"))
    named = rooted.select("fp", "root").join(best, "root").select("fp", "first", "size")
    return rows.join(named, "fp").select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("first.id").alias("component_id"), F.col("size").alias("component_size"),
        (F.col("rid") == F.col("first.rid")).alias("kept"))
