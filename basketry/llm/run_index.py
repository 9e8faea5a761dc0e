"""Run-length index of a small collection of byte strings.

The Burrows-Wheeler transform of the collection is held as runs. For the ends of each run the
text position and the length of the common prefix with the neighbouring suffix are sampled.
Inside a run these lengths follow from the position before them (they fall by one), so
streaming over the text from sample to sample gives the matching statistics of every position
against the rest of the collection. Repetitive collections have few runs and few samples.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class RunIndex:
    n: int                  # symbols of the collection, separators included
    runs: int               # runs of the transform
    head_at: np.ndarray     # text positions at run starts
    head_lcp: np.ndarray    # common prefix with the suffix before them in order
    tail_at: np.ndarray     # text positions at run ends
    tail_lcp: np.ndarray    # common prefix with the suffix after them in order


def _symbols(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols with a separator of its own after each text, and the bytes left at each place."""
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    ends = np.cumsum(lengths + 1) - 1
    raw = np.frombuffer(b"\0".join(texts) + b"\0", dtype=np.uint8)
    symbols = raw.astype(np.int64) + len(texts)
    symbols[ends] = np.arange(len(texts))
    left = np.repeat(ends, lengths + 1) - np.arange(len(raw))
    return symbols, left


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Order of all suffixes. Ranks of a prefix length are packed two or more to a key and
    sorted, which multiplies the prefix length each round."""
    n = len(symbols)
    rank, depth = symbols, 1
    while True:
        bits = max(1, int(rank.max()).bit_length() + 1)
        take = max(2, 62 // bits)
        key = np.zeros(n, dtype=np.int64)
        for i in range(take):
            key <<= bits
            if i * depth < n:
                key[:n - i * depth] |= rank[i * depth:] + 1
        order = np.argsort(key, kind="stable")
        ranked = key[order]
        fresh = np.concatenate(([0], np.cumsum(ranked[1:] != ranked[:-1])))
        if int(fresh[-1]) == n - 1:
            return order
        rank = np.empty(n, dtype=np.int64)
        rank[order] = fresh
        depth *= take


def _common_prefix(words: np.ndarray, left: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of the suffixes at a and b, eight bytes at a time."""
    most = np.minimum(left[a], left[b])
    out = most.copy()
    live, at = np.arange(len(a)), 0
    while len(live):
        x = words[a[live] + at] ^ words[b[live] + at]
        apart = x != 0
        low = x[apart]
        same = np.bitwise_count((low & (~low + np.uint64(1))) - np.uint64(1)).astype(np.int64) >> 3
        hit = live[apart]
        out[hit] = np.minimum(most[hit], at + same)
        at += 8
        live = live[~apart]
        live = live[most[live] > at]
    return out


def build(texts: list[bytes]) -> RunIndex:
    symbols, left = _symbols(texts)
    n = len(symbols)
    order = suffix_array(symbols)
    bwt = symbols[order - 1]  # the symbol before the first one is the last separator
    breaks = np.flatnonzero(bwt[1:] != bwt[:-1]) + 1
    raw = np.where(symbols >= len(texts), symbols - len(texts), 0).astype(np.uint8)
    padded = np.concatenate((raw, np.zeros(8, np.uint8)))
    words = np.zeros(n, dtype=np.uint64)
    for i in range(8):
        words |= padded[i:i + n].astype(np.uint64) << np.uint64(8 * i)
    lcp = _common_prefix(words, left, order[breaks - 1], order[breaks])
    return RunIndex(n, len(breaks) + 1, np.concatenate((order[:1], order[breaks])),
                    np.concatenate(([0], lcp)), np.concatenate((order[breaks - 1], order[-1:])),
                    np.concatenate((lcp, [0])))


def _stream(n: int, at: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    value = np.zeros(n, dtype=np.int64)
    value[at] = lcp
    sampled = np.zeros(n, dtype=np.int64)
    sampled[at] = at
    last = np.maximum.accumulate(sampled)
    return value[last] - (np.arange(n) - last)


def matching_statistics(index: RunIndex) -> np.ndarray:
    """For each position the longest match that also starts at another position."""
    return np.maximum(_stream(index.n, index.head_at, index.head_lcp),
                      _stream(index.n, index.tail_at, index.tail_lcp))


def long_matches(texts: list[bytes], length: int) -> list[np.ndarray]:
    """For each text the starts of strings of ``length`` bytes that also start elsewhere."""
    if not texts:
        return []
    long = matching_statistics(build(texts)) >= length
    cuts = np.cumsum([len(t) + 1 for t in texts])
    return [np.flatnonzero(part) for part in np.split(long, cuts[:-1])]
