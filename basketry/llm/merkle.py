"""Merkle manifest of a dataset: one tree per source, one tree over the sources' roots.

A node's digest is the SHA-256 of its children's digests as hex text. A digest in hex is 64 bytes,
one block of SHA-256, so the state of a parent's hash before each child slot is eight words. These
states are kept with the tree. Folding a changed leaf resumes the kept state before its slot, takes
in the new digest and the siblings to the right, and goes on one level up; what lies to the left
is never hashed again.

Leaves are numbered per source by a range sort and prefix counts, and cut into groups of
``3 ** levels`` neighbours. A group's subtree is one row of a table; the groups' tops are the leaves of the next
tier, so a source of any size takes part in groups of one size only, and the number of tiers is its
logarithm. Paths go down from the top the same way, one row per group.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import in_blocks, partitions_for, shared_table

ARITY = 3
LEVELS = 6              # levels of a tree that one group spans
BATCH = 16              # groups whose leaves are folded at once
ROWS = 30_000           # leaves to a task
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
RECORD = 34 + 32 * ARITY  # a level of a path: state, number of children, slot, children


# SHA-256 over many messages at once --------------------------------------------------------

def _primes(n: int) -> list[int]:
    found: list[int] = []
    x = 2
    while len(found) < n:
        if all(x % p for p in found):
            found.append(x)
        x += 1
    return found


# the first 32 bits of the fractions of square and cube roots of the first primes
START = np.array([isqrt(p << 64) & 0xFFFFFFFF for p in _primes(8)], dtype=np.uint32)


def _round_constants() -> list[np.uint32]:
    out = []
    for p in _primes(64):
        whole = int(p ** (1 / 3))
        x = p << 96
        low, high = whole << 32, (whole + 1) << 32
        while high - low > 1:  # integer cube root by halving
            mid = (low + high) // 2
            low, high = (mid, high) if mid ** 3 <= x else (low, mid)
        out.append(np.uint32(low & 0xFFFFFFFF))
    return out


ROUNDS = _round_constants()
DIGITS = np.frombuffer(b"0123456789abcdef", dtype=np.uint8)


def _turn(x: np.ndarray, n: int) -> np.ndarray:
    return (x >> np.uint32(n)) | (x << np.uint32(32 - n))


def _compress(state: np.ndarray, block: np.ndarray) -> np.ndarray:
    w = [block[:, i] for i in range(16)]
    for i in range(16, 64):
        x, y = w[i - 15], w[i - 2]
        w.append(w[i - 16] + (_turn(x, 7) ^ _turn(x, 18) ^ (x >> np.uint32(3))) + w[i - 7]
                 + (_turn(y, 17) ^ _turn(y, 19) ^ (y >> np.uint32(10))))
    a, b, c, d, e, f, g, h = (state[:, i] for i in range(8))
    for k, x in zip(ROUNDS, w):
        t = h + (_turn(e, 6) ^ _turn(e, 11) ^ _turn(e, 25)) + (g ^ (e & (f ^ g))) + k + x
        u = (_turn(a, 2) ^ _turn(a, 13) ^ _turn(a, 22)) + ((a & b) | (c & (a | b)))
        a, b, c, d, e, f, g, h = t + u, a, b, c, d + t, e, f, g
    return np.stack([a, b, c, d, e, f, g, h], axis=1) + state


def compress(state: np.ndarray, block: np.ndarray, step: int = 4096) -> np.ndarray:
    """States (n, 8) after one more block (n, 16) each."""
    if len(state) <= step:
        return _compress(state, block)
    return np.concatenate([_compress(state[i:i + step], block[i:i + step])
                           for i in range(0, len(state), step)])


def hex_block(raw: np.ndarray) -> np.ndarray:
    """Digests (n, 32) as blocks (n, 16) of their hex text."""
    text = np.empty((len(raw), 64), dtype=np.uint8)
    text[:, 0::2], text[:, 1::2] = DIGITS[raw >> 4], DIGITS[raw & 15]
    return text.view(">u4").astype(np.uint32)


def finish(state: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """Digests (n, 32) of messages of whole blocks."""
    pad = np.zeros((len(state), 16), dtype=np.uint32)
    pad[:, 0] = 0x80000000
    pad[:, 15] = blocks.astype(np.uint32) * np.uint32(512)
    return compress(state, pad).astype(">u4").view(np.uint8)


# Trees --------------------------------------------------------------------------------------

def depth(size: int) -> int:
    """Levels from ``size`` nodes to one."""
    n = 0
    while size > 1:
        size, n = -(-size // ARITY), n + 1
    return n


def grow(leaves: np.ndarray, sizes: np.ndarray, depths: np.ndarray):
    """Subtrees of several groups at once.

    ``leaves`` (n, 32) holds the groups one after the other. Returns the groups' tops (g, 32) and, for
    each level, (nodes, sizes, states): states (parents, slots, 8) before each child slot.
    """
    tops = np.zeros((len(sizes), 32), dtype=np.uint8)
    levels = []
    now, n, level = leaves, sizes.astype(np.int64), 0
    while True:
        group = np.repeat(np.arange(len(n)), n)
        done = (depths == level) & (n > 0)
        tops[done] = now[np.isin(group, np.flatnonzero(done))]
        live = depths > level
        if not live.any():
            return tops, levels
        use = live[group]
        now, n, group = now[use], np.where(live, n, 0), group[use]
        own = np.arange(len(group)) - (np.cumsum(n) - n)[group]
        parents = -(-n // ARITY)
        parent = (np.cumsum(parents) - parents)[group] + own // ARITY
        count = np.bincount(parent, minlength=int(parents.sum()))
        words = np.zeros((len(count), ARITY, 16), dtype=np.uint32)
        words[parent, own % ARITY] = hex_block(now)
        state = np.repeat(START[None], len(count), axis=0)
        kept = np.zeros((len(count), ARITY, 8), dtype=np.uint32)
        for slot in range(ARITY):
            kept[:, slot] = state
            more = count > slot
            state[more] = compress(state[more], words[more, slot])
        levels.append((now, n, kept))
        now, n, level = finish(state, count), parents, level + 1


def _grow(span_levels: int):
    """One row per group: its leaves, nodes and states, packed level after level."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block in in_blocks(frames, "cell", ARITY ** span_levels * BATCH):
            first = np.flatnonzero(~block["cell"].duplicated().to_numpy())
            sizes = np.diff(np.append(first, len(block)))
            heads = block.iloc[first]
            depths = np.array([min(span_levels, depth(s)) for s in heads["size"]])
            tops, levels = grow(_unpack(block["digest"], 32), sizes, depths)
            nodes, states = [[] for _ in sizes], [[] for _ in sizes]
            for now, n, kept in levels:
                parents = -(-n // ARITY)
                at, up = np.cumsum(n) - n, np.cumsum(parents) - parents
                raw = kept.astype(">u4")
                for g in np.flatnonzero(n):
                    nodes[g].append(now[at[g]:at[g] + n[g]].tobytes())
                    states[g].append(raw[up[g]:up[g] + parents[g]].tobytes())
            cuts = list(zip(first, first + sizes))
            yield pd.DataFrame({
                "key": heads["key"].to_numpy(), "block": heads["block"].to_numpy(),
                "size": heads["size"].to_numpy(), "n": sizes,
                "ids": [block["id"].iloc[a:b].tolist() for a, b in cuts],
                "leaves": [b"".join(block["digest"].iloc[a:b]) for a, b in cuts],
                "found": [b"".join(block["found"].iloc[a:b]) for a, b in cuts],
                "nodes": [b"".join(x) for x in nodes], "states": [b"".join(x) for x in states],
                "top": [t.tobytes() for t in tops]})
    return run


def _unpack(column: pd.Series, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype=np.uint8).reshape(-1, width)


def _level_sizes(n: int, size: int, span_levels: int) -> list[int]:
    """Number of nodes on each level under the top of a group of ``n`` leaves."""
    out = []
    for _ in range(min(span_levels, depth(size))):
        out.append(n)
        n = -(-n // ARITY)
    return out


def _own_path(at: int, sizes: list[int], nodes: bytes, states: bytes) -> bytes:
    """Records of the levels from leaf ``at`` of a group up to its top."""
    out, down, up = [], 0, 0
    for n in sizes:
        parent, slot = divmod(at, ARITY)
        children = nodes[32 * (down + ARITY * parent):32 * (down + min(ARITY * parent + ARITY, n))]
        state = states[32 * (up + ARITY * parent + slot):][:32]
        out.append(state + bytes([len(children) // 32, slot]) + children.ljust(32 * ARITY, b"\0"))
        down, up, at = down + n, up + ARITY * -(-n // ARITY), parent
    return b"".join(out)


def _descend(span_levels: int):
    """Paths of the leaves of upper groups: their own, then the group's."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for r in frame.itertuples(index=False):
                sizes = _level_sizes(r.n, r.size, span_levels)
                first = r.block * ARITY ** span_levels
                yield pd.DataFrame({
                    "key": r.key, "block": range(first, first + r.n),
                    "path": [_own_path(i, sizes, r.nodes, r.states) + r.path for i in range(r.n)],
                    "subroot": r.subroot, "root": r.root, "id": r.ids})
    return run


def _siblings(path: bytes) -> str:
    """Hex text of the siblings along a path."""
    out = []
    for i in range(0, len(path), RECORD):
        n, slot = path[i + 32], path[i + 33]
        at = i + 34
        out += [path[at:at + 32 * slot].hex(), path[at + 32 * (slot + 1):at + 32 * n].hex()]
    return "".join(out)


def _fold_groups(rows: list, span_levels: int) -> tuple[np.ndarray, list[str]]:
    """Folded roots (n, 32) and proof digests of all leaves of some groups."""
    n = np.array([r.n for r in rows])
    group = np.repeat(np.arange(len(rows)), n)
    at = np.concatenate([np.arange(x) for x in n])
    value = np.concatenate([np.frombuffer(r.found, np.uint8).reshape(-1, 32) for r in rows])
    sizes = [_level_sizes(r.n, r.size, span_levels) for r in rows]
    down, up = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
    bases = np.cumsum([0] + [len(r.nodes) // 32 for r in rows])[:-1]
    nodes = np.frombuffer(b"".join(r.nodes for r in rows), np.uint8).reshape(-1, 32)
    starts = np.cumsum([0] + [len(r.states) // 32 for r in rows])[:-1]
    states = np.frombuffer(b"".join(r.states for r in rows), ">u4").astype(np.uint32).reshape(-1, 8)
    for level in range(max(map(len, sizes))):
        width = np.array([s[level] if level < len(s) else 0 for s in sizes])
        live = width[group] > 0
        g, i, total = group[live], at[live], width[group][live]
        state = compress(states[starts[g] + up[g] + i], hex_block(value[live]))
        last = np.minimum(i // ARITY * ARITY + ARITY, total)
        for step in range(1, ARITY):
            right = i + step < last
            node = nodes[bases[g[right]] + down[g[right]] + i[right] + step]
            state[right] = compress(state[right], hex_block(node))
        value[live] = finish(state, last - i // ARITY * ARITY)
        at[live] = i // ARITY
        down += width
        up += ARITY * -(-width // ARITY)
    above = [np.frombuffer(r.path, np.uint8).reshape(-1, RECORD) for r in rows]
    for level in range(max(map(len, above))):
        record = np.zeros((len(rows), RECORD), np.uint8)
        for g, path in enumerate(above):
            if level < len(path):
                record[g] = path[level]
        live = record[group, 32] > 0
        mine = record[group[live]]
        words = np.ascontiguousarray(mine[:, :32]).view(">u4").astype(np.uint32)
        state = compress(words, hex_block(value[live]))
        for slot in range(1, ARITY):
            right = (mine[:, 33] < slot) & (slot < mine[:, 32])
            state[right] = compress(state[right], hex_block(
                mine[right, 34 + 32 * slot:66 + 32 * slot]))
        value[live] = finish(state, mine[:, 32])
    proofs = []
    for r, s in zip(rows, sizes):
        hexes, tail = r.nodes.hex(), _siblings(r.path)
        for i in range(r.n):
            parts, low = [], 0
            for width in s:
                a, b = i // ARITY * ARITY, min(i // ARITY * ARITY + ARITY, width)
                parts += [hexes[64 * (low + a):64 * (low + i)], hexes[64 * (low + i + 1):64 * (low + b)]]
                low, i = low + width, i // ARITY
            proofs.append(hashlib.sha256(("".join(parts) + tail).encode()).hexdigest())
    return value, proofs


def _verify(span_levels: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = list(frame.itertuples(index=False))
            for i in range(0, len(rows), BATCH):
                part = rows[i:i + BATCH]
                folded, proofs = _fold_groups(part, span_levels)
                n = [r.n for r in part]
                out = pd.DataFrame({
                    "id": [x for r in part for x in r.ids],
                    "leaf": [x.tobytes().hex() for r in part
                             for x in np.frombuffer(r.leaves, np.uint8).reshape(-1, 32)],
                    "subroot": np.repeat([r.subroot for r in part], n),
                    "root": np.repeat([r.root for r in part], n),
                    "proof_sha256": proofs, "folded_root": [x.tobytes().hex() for x in folded]})
                yield out.assign(verified=out["folded_root"] == out["root"])
    return run


# Spark side ---------------------------------------------------------------------------------

def _digest(fields: list[Column]) -> Column:
    """SHA-256 of the fields, each ``-`` if null, else its byte count, a colon and its text."""
    text = [f.cast("string") for f in fields]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
             for t in text]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def numbered(rows: DataFrame, key: str, order: list[str], tag: str) -> DataFrame:
    """``rows`` with ``idx``, the place among the rows of the same key, and ``size``, their number.

    A range sort deals the rows out (by ``order`` too, so a key may span tasks); each task numbers
    its own, and counts by task and key give the offsets. A window sees one row per task and key.
    """
    n = partitions_for(rows.count(), ROWS)
    dealt = shared_table(
        rows.repartitionByRange(n, key, *order).sortWithinPartitions(key, *order)
        .withColumns({"part": F.spark_partition_id(),
                      "pos": F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)}),
        tag)
    runs = dealt.groupBy("part", key).agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("low"))
    before = Window.partitionBy(key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("part", key, (F.coalesce(F.sum("n").over(before), F.lit(0))
                                     - F.col("low")).alias("shift"),
                       F.sum("n").over(Window.partitionBy(key)).alias("size"))
    return (dealt.join(runs, ["part", key]).withColumn("idx", F.col("pos") + F.col("shift"))
            .drop("part", "pos", "shift"))


def _tiers(leaves: DataFrame, kind: str, levels: int, tag: str) -> list[DataFrame]:
    """Tables of groups, from the leaves up to one group per key. ``leaves``: key, idx, size, id,
    digest, found."""
    schema = (f"key string, block long, size long, n long, ids array<{kind}>, leaves binary, "
              "found binary, nodes binary, states binary, top binary")
    out = []
    span = ARITY ** levels
    while True:
        cells = leaves.withColumn("block", F.expr(f"idx div {span}")).withColumn(
            "cell", F.concat("key", F.lit("/"), F.col("block").cast("string")))
        n = partitions_for(cells.count(), ROWS)
        out.append(shared_table(
            cells.select("cell", "key", "block", "idx", "size", "id", "digest", "found")
            .repartition(n, "cell").sortWithinPartitions("cell", "idx")
            .drop("idx").mapInPandas(_grow(levels), schema), tag))
        higher = out[-1].filter(F.col("size") > span)
        if higher.isEmpty():
            return out
        leaves = higher.select(
            "key", F.col("block").alias("idx"), F.expr(f"(size + {span - 1}) div {span}").alias("size"),
            F.lit(None).cast(kind).alias("id"), F.col("top").alias("digest"),
            F.lit(b"").alias("found"))


def _above(tiers: list[DataFrame], tops: DataFrame, kind: str, levels: int, tag: str) -> DataFrame:
    """The lowest tier with the path, subroot and root above each group. ``tops``: key, path,
    subroot and root of each key's last group."""
    span = ARITY ** levels
    given = None
    for i in range(len(tiers) - 1, -1, -1):
        last = tops.select("key", F.lit(0).cast("long").alias("block"), "path", "subroot", "root")
        groups = tiers[i]
        done = groups.filter(F.col("size") <= span).join(last, ["key", "block"])
        if given is not None:
            done = done.unionByName(groups.filter(F.col("size") > span).join(given, ["key", "block"]))
        if i == 0:
            return done
        given = shared_table(done.mapInPandas(
            _descend(levels), f"key string, block long, path binary, subroot string, root string, id {kind}"
        ).drop("id"), tag)


def merkle_manifest(docs: DataFrame, found: dict[str, Column] | None = None,
                    fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id",
                    source_col: str = "source", levels: int = LEVELS) -> DataFrame:
    """One row per input row: id, leaf, subroot, root, proof_sha256, folded_root, verified.

    A leaf hashes ``fields`` in order. Leaves ascend by id within their source (null ids first; equal ids
    by digest, so repeated rows lie side by side, each a leaf of its own). Every three neighbours make a
    node, the last run fewer; sources are ordered bytewise, the null source first (it is not the empty
    one). ``found`` gives other values of fields, as met when checking a copy: their leaves are
    folded with the original siblings, and ``verified`` tells whether that gives the root.
    proof_sha256 hashes the siblings from leaf to root (nothing, where a tree of one leaf has none).
    Other columns are ignored, whatever their names. An empty table gives no rows.
    """
    kind = dict(docs.dtypes)[id_col]
    now = [(found or {}).get(f, F.col(f)) for f in fields]
    rows = shared_table(docs.select(
        F.coalesce(F.concat(F.lit("s"), F.col(source_col).cast("string")), F.lit("n")).alias("key"),
        F.col(id_col).alias("id"), _digest([F.col(f) for f in fields]).alias("digest"),
        _digest(now).alias("found"), F.monotonically_increasing_id().alias("rid")), "leaves")
    leaves = numbered(rows, "key", ["id", "digest", "rid"], "leaf-order")
    tiers = _tiers(leaves, kind, levels, "groups")
    span = ARITY ** levels
    subroots = tiers[0].filter(F.col("size") <= span).select("key", "top")
    for t in tiers[1:]:
        subroots = subroots.union(t.filter(F.col("size") <= span).select("key", "top"))
    ordered = numbered(subroots.select(F.lit("").alias("all"), F.col("key").alias("id"),
                                       F.col("top").alias("digest")), "all", ["id"], "sources")
    upper = _tiers(ordered.select(F.col("all").alias("key"), "idx", "size", "id", "digest",
                                  F.lit(b"").alias("found")), "string", levels, "source-groups")
    end = upper[-1].select("key", F.lit(b"").alias("path"), F.lit("").alias("subroot"),
                           F.lower(F.hex("top")).alias("root"))
    paths = shared_table(_above(upper, end, "string", levels, "source-paths").mapInPandas(
        _descend(levels), "key string, block long, path binary, subroot string, root string, id string"),
        "root-paths")
    tops = paths.select(F.col("id").alias("key"), "path", "root").join(subroots, "key").select(
        "key", "path", F.lower(F.hex("top")).alias("subroot"), "root")
    checked = _above(tiers, shared_table(tops, "subroots"), kind, levels, "group-paths").mapInPandas(
        _verify(levels), f"id {kind}, leaf string, subroot string, root string, proof_sha256 string, "
        "folded_root string, verified boolean")
    return checked.withColumnRenamed("id", id_col)
