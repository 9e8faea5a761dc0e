"""Stupid-backoff language-model scores of all documents, from n-gram counts of all documents.

Documents are gathered into blocks of bounded text. Each block asks for the counts of its
distinct n-grams: their hashes, dealt by hash into buckets, go out once per block with the number
of times the block holds them, as sorted columns without their common high bits. Each bucket
adds up the n-gram count table of its hashes and answers every block in the block's own order. A
block then joins the answers to its exploded n-grams and sums the scores per document. So a very
frequent n-gram is one entry per block, not one row per occurrence, and no text is shuffled.

A bucket with a very frequent n-gram is asked by every block. So blocks form groups of about
``SUPER_BLOCKS``: the requests of a group are first added up by hash range within the group, each
range asks the global buckets once, and hands the answers on to its blocks. No task gets more
than about ``SUPER_BLOCKS`` rows, or two rows a group, of one bucket. With one group its sums are
the totals.
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import partitions_for, shared_table

BLOCK_BYTES = 8_000_000     # text of a block
BUCKET_GRAMS = 1_000_000    # requests that a bucket holds at once
SUPER_BLOCKS = 4096         # blocks whose requests are added up before they go to the global buckets
MIX = np.uint64(0x9E3779B97F4A7C15)


def _gather(most: int):
    """Blocks: ids, compressed lower-cased words of the documents, and sizes."""
    def pack(rows: list[tuple[object, bytes]]) -> pd.DataFrame:
        body = b"\n".join(t for _, t in rows)
        return pd.DataFrame({"block": [uuid.uuid4().hex], "ids": [[d for d, _ in rows]],
                             "words": [sum(t.count(b" ") + bool(t) for _, t in rows)],
                             "body": [zstandard.ZstdCompressor(level=1).compress(body)]})

    def run(frames):
        held: list[tuple[object, bytes]] = []
        size = 0
        for frame in frames:
            for d, t in zip(frame["id"], frame["text"]):
                words = b" ".join((t or "").encode().lower().split())
                held.append((None if pd.isna(d) else d, words))
                size += len(words) + 1
                if size >= most:
                    yield pack(held)
                    held, size = [], 0
        if held:
            yield pack(held)
    return run


def _unpack(body: bytes) -> list[bytes]:
    return zstandard.ZstdDecompressor().decompress(body).split(b"\n")


class _Grams:
    """n-grams of a block: hashes of the distinct ones by order, and where each token has its own."""

    def __init__(self, texts: list[bytes], order: int):
        numbers: dict[bytes, int] = {}
        number = numbers.setdefault
        # one text at a time, so that the words of a block never exist as objects together
        each = [np.array([number(w, len(numbers)) for w in t.split()], dtype=np.int64) for t in texts]
        self.lengths = np.array([len(t) for t in each], dtype=np.int64)
        word = np.concatenate(each)
        own = np.array([xxhash.xxh3_64_intdigest(w) for w in numbers], dtype=np.uint64)
        place = np.arange(len(word)) - np.repeat(np.cumsum(self.lengths) - self.lengths, self.lengths)
        h = own[word] if len(word) else np.empty(0, np.uint64)
        self.order, self.place = order, place
        self.hashes, self.counts, self.of_token = [], [], []
        gram = h.copy()
        for n in range(1, order + 1):
            if n > 1:  # token i gets the hash of the n words that end with it
                before = np.concatenate((np.zeros(1, np.uint64), gram[:-1]))
                gram = ((before ^ (before >> np.uint64(29))) * MIX + np.uint64(n)) ^ h
                gram ^= gram >> np.uint64(32)
                gram *= MIX
            has = place >= n - 1
            distinct, index, count = np.unique(gram[has], return_inverse=True, return_counts=True)
            at = np.full(len(h), -1, dtype=np.int64)
            at[has] = index
            self.hashes.append(distinct)
            self.counts.append(count)
            self.of_token.append(at)


def _planes(values: np.ndarray) -> bytes:
    """Numbers as byte planes, lowest first, as many as the largest needs.

    The highest plane and the others are each compressed if that is shorter.
    """
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T)
    raw = planes[:-1].tobytes(), planes[-1].tobytes()
    small = [zstandard.compress(x, 1) if len(x) > 32 else x for x in raw]
    flags = [len(z) < len(x) for x, z in zip(raw, small)]
    if not any(flags):
        return bytes([width]) + b"".join(raw)
    low, top = (z if f else x for x, z, f in zip(raw, small, flags))
    return bytes([width + 16 * flags[0] + 32 * flags[1]]) + len(low).to_bytes(4, "little") + low + top


def _numbers(blob: bytes) -> np.ndarray:
    width, flags = blob[0] & 15, blob[0] >> 4
    raw = blob[1:]
    if flags:
        end = 5 + int.from_bytes(blob[1:5], "little")
        parts = blob[5:end], blob[end:]
        raw = b"".join(zstandard.decompress(x) if flags >> i & 1 else x for i, x in enumerate(parts))
    planes = np.frombuffer(raw, dtype=np.uint8).reshape(width, -1)
    full = np.zeros((planes.shape[1], 8), dtype=np.uint8)
    full[:, :width] = planes.T
    return full.view("<u8").ravel()


def _narrow(values: np.ndarray) -> bytes:
    """Sorted numbers as differences: their high planes are nearly empty."""
    return _planes(np.diff(values, prepend=np.uint64(0)))


def _wide(blob: bytes) -> np.ndarray:
    return np.cumsum(_numbers(blob), dtype=np.uint64)


def _counts_out(counts: np.ndarray) -> bytes:
    return _planes(counts)


def _counts_in(blob: bytes) -> np.ndarray:
    return _numbers(blob).astype(np.int64)


def _least(bucket: int, buckets: int) -> np.uint64:
    """Least hash of a bucket; buckets are equal ranges of hashes."""
    return np.uint64((int(bucket) << 64) // buckets)


def _requests(hashes: np.ndarray, counts: np.ndarray, buckets: int) -> dict[str, object]:
    """Sorted hashes and their counts, cut at the bounds of the buckets that hold any."""
    first, last = (int(h) * buckets >> 64 for h in (hashes[0], hashes[-1])) if len(hashes) else (0, -1)
    # the product tells the bucket but for a rounding of its bounds
    near = np.arange(first, min(last + 1, buckets - 1) + 1)
    edges = np.array([_least(b, buckets) for b in near], dtype=np.uint64)
    cut = np.append(np.searchsorted(hashes, edges), len(hashes))
    full = np.flatnonzero(np.diff(cut))
    return {"bucket": near[full],
            # counted from the bucket's least hash, so that few bytes are needed
            "hashes": [_narrow(hashes[cut[i]:cut[i + 1]] - edges[i]) for i in full],
            "counts": [_counts_out(counts[cut[i]:cut[i + 1]]) for i in full]}


def _ask(order: int, buckets: int):
    def run(frames):
        for frame in frames:
            for part, block, body in zip(frame["part"], frame["block"], frame["body"]):
                grams = _Grams(_unpack(body), order)
                for n in range(order):
                    yield pd.DataFrame({"part": part, "gram": n + 1, "block": block}
                                       | _requests(grams.hashes[n], grams.counts[n], buckets))
    return run


def _table(frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Hashes asked for, the sums of their counts, and where each request has its own."""
    asked = [_wide(x) for x in frame["hashes"]]
    table, index = np.unique(np.concatenate(asked), return_inverse=True)
    total = np.bincount(index, weights=np.concatenate([_counts_in(x) for x in frame["counts"]]),
                        minlength=len(table)).astype(np.int64)
    return table, total, np.split(index, np.cumsum([len(a) for a in asked])[:-1])


def _answer(frame: pd.DataFrame) -> pd.DataFrame:
    """The count table of one bucket, as answers to those that asked."""
    _, total, places = _table(frame)
    return pd.DataFrame({"gram": frame["gram"], "bucket": frame["bucket"], "block": frame["block"],
                         "answer": [_counts_out(total[i]) for i in places]})


def _add_up(buckets: int, all_buckets: int):
    """Requests of a group of blocks for one range of hashes, as the range's own requests."""
    def run(key, frame: pd.DataFrame) -> pd.DataFrame:
        part, gram, bucket = (int(k) for k in key)
        table, total, _ = _table(frame)
        return pd.DataFrame({"gram": gram, "block": f"{part}/{bucket}"}
                            | _requests(table + _least(bucket, buckets), total, all_buckets))
    return run


def _hand_on(key, frame: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
    """Answers that a range of a group got, to the blocks of the group."""
    table, _, places = _table(frame)
    got = np.concatenate([_counts_in(x) for x in answers.sort_values("bucket")["answer"]])
    if len(got) != len(table):
        raise ValueError("a range did not get an answer for each of its n-grams")
    return pd.DataFrame({"gram": frame["gram"], "bucket": frame["bucket"], "block": frame["block"],
                         "answer": [_counts_out(got[i]) for i in places]})


def _written(df: DataFrame, tag: str) -> DataFrame:
    """A shared table; the shuffle files of making it go when it is written, not at some later collection."""
    conf, name = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(name)
    conf.set(name, "true")
    try:
        return shared_table(df, tag)
    finally:
        conf.set(name, before)


def _counted(blocks: DataFrame, order: int, words: int) -> DataFrame:
    """Total counts of the n-grams that each block asked for, in its own order."""
    out = "gram int, bucket int, block string, answer binary"
    ask = "gram int, bucket int, block string, hashes binary, counts binary"
    parts = partitions_for(blocks.count(), SUPER_BLOCKS)
    buckets = partitions_for(words // parts, BUCKET_GRAMS, 8)
    asked = blocks.select(F.pmod(F.xxhash64("block"), F.lit(parts)).cast("int").alias("part"),
                          "block", "body").mapInPandas(_ask(order, buckets), f"part int, {ask}")
    if parts == 1:
        return asked.groupBy("gram", "bucket").applyInPandas(_answer, out)
    asked = shared_table(asked, "asked")
    ranges = asked.groupBy("part", "gram", "bucket")
    all_buckets = partitions_for(words, BUCKET_GRAMS, 8)
    totals = ranges.applyInPandas(_add_up(buckets, all_buckets), ask).groupBy("gram", "bucket").applyInPandas(
        _answer, out)
    range_of = F.split("block", "/")
    totals = totals.select(range_of[0].cast("int").alias("part"), "gram", range_of[1].cast("int").alias("range"),
                           "bucket", "answer")
    return ranges.cogroup(totals.groupBy("part", "gram", "range")).applyInPandas(_hand_on, out)


def _score(order: int, words: int, backoff: float, least: int):
    def run(key, blocks: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        grams = _Grams(_unpack(blocks["body"].iloc[0]), order)
        total = []
        for n in range(order):
            mine = answers[answers["gram"] == n + 1].sort_values("bucket")
            got = [_counts_in(x) for x in mine["answer"]]
            got = np.concatenate(got) if got else np.empty(0, np.int64)
            if len(got) != len(grams.hashes[n]):
                raise ValueError("a block did not get an answer for each of its n-grams")
            at = grams.of_token[n]
            total.append(np.where(at >= 0, got[at] if len(got) else 0, 0))
        size = len(grams.place)
        score = np.zeros(size)
        levels = np.zeros(size, dtype=np.int64)     # times the score was backed off
        open_ = np.ones(size, dtype=bool)
        for n in range(order, 0, -1):
            here = open_ & (grams.place >= n - 1)
            if n > 1:
                ok = here & (total[n - 1] >= least)
                i = np.flatnonzero(ok)
                score[i] = np.log(total[n - 1][i] / total[n - 2][i - 1])
                levels[here & ~ok] += 1
                open_ &= ~ok
            else:
                score[open_] = np.log(total[0][open_] / words)
        score += levels * np.log(backoff)
        document = np.repeat(np.arange(len(grams.lengths)), grams.lengths)
        add = lambda x: np.bincount(document, weights=x, minlength=len(grams.lengths))
        return pd.DataFrame({"id": list(blocks["ids"].iloc[0]), "n_tokens": grams.lengths,
                             "n_backoff": add(levels > 0).astype(np.int64),
                             "log_score": add(score)})
    return run


def stupid_backoff(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   order: int = 3, backoff: float = 0.4, least: int = 2) -> DataFrame:
    """One row per input row: id, n_tokens, n_backoff, log_score, mean_log_score.

    Words are lower-cased (A-Z). The score of a word is the count of its n-gram over the count of
    the n-gram's context; n-grams of two or more words that come fewer than ``least`` times in the
    whole corpus are not used, and the score is ``backoff`` times that of the next shorter n-gram,
    down to the word's share of all words. Counts are over all rows, copies and repeated
    rows included. log_score sums natural logarithms over the document; n_backoff counts words
    that were backed off. Null and empty texts have no tokens, log_score 0 and a null mean. A null
    id is kept. Other columns are ignored. An empty table gives no rows. N-grams are told apart by
    64-bit hashes per order: among N distinct ones about N * N / 2 ** 65 pairs share a count (3 pairs
    of 10 ** 10).
    """
    kind = dict(docs.dtypes)[id_col]
    blocks = shared_table(
        docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        .mapInPandas(_gather(BLOCK_BYTES), f"block string, ids array<{kind}>, words long, body binary"),
        "blocks")
    words = blocks.agg(F.coalesce(F.sum("words"), F.lit(0))).first()[0]
    answers = _written(_counted(blocks, order, words), "answers")
    scored = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(
        _score(order, words, backoff, least),
        f"id {kind}, n_tokens long, n_backoff long, log_score double")
    return scored.select(F.col("id").alias(id_col), "n_tokens", "n_backoff", "log_score",
                         F.try_divide("log_score", "n_tokens").alias("mean_log_score"))
