"""Removal of long repeated byte strings with run-length indexes.

1. One scan cuts every text into super-windows: runs of neighbouring ``length``-byte windows whose
   least ``gram``-byte hash is the same. Equal windows have the same least hash, so they lie in
   super-windows with the same key; and every window lies in exactly one super-window.
2. Keys that come once cannot hold a repeat, unless their super-window is periodic (merged from
   several places of the least hash). Only super-windows of repeated keys and periodic ones travel,
   dealt by key. Of texts that are equal as a whole one stands for all.
3. Each task builds run-length indexes over blocks of whole keys, streams matching statistics and
   marks window starts that match elsewhere over the full length.
4. A key with very many super-windows is first reduced to distinct strings by aggregation; if too
   many are left, they are cut anew by a longer gram and dealt by the new keys, of which those
   that come once and are not periodic drop out. The gram nears ``length`` by halves, where a key is a window, so
   this ends after log2(length) rounds and is exact, whatever the size of a group.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, in_blocks, partitions_for, shared_table
from .run_index import long_matches

LENGTH = 400
GRAM = 160
MULTIPLIER = 0x9E3779B97F4A7C15 | 1
CHUNK = 1 << 22         # windows handled at once in a very long text
PLACE = 24              # bits of a place inside a chunk
BLOCK_ROWS = 3000       # super-windows to an index, about 1.5 MB
MOST_ROWS = 4096        # super-windows of a key that one index takes
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


class _Powers:
    """Powers of the multiplier and of its inverse modulo 2**64, grown as needed."""

    def __init__(self):
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), 1 << 16)
            inverse = pow(MULTIPLIER, -1, 1 << 64)
            for name, base in (("up", MULTIPLIER), ("down", inverse)):
                steps = np.full(size, base, dtype=np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self.up[:n], self.down[:n]


POWERS = _Powers()


def gram_hashes(raw: np.ndarray, gram: int) -> np.ndarray:
    """A mixed 64-bit hash of the ``gram`` bytes at each place."""
    n = len(raw)
    up, down = POWERS.get(n)
    total = np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up, dtype=np.uint64)
    h = total[gram - 1:].copy()
    h[1:] -= total[:n - gram]
    h *= down[:n - gram + 1]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    return h


def _window_minimum(key: np.ndarray, w: int) -> np.ndarray:
    n = len(key)
    rows = -(-n // w)
    grid = np.full(rows * w, np.iinfo(np.uint64).max, dtype=np.uint64)
    grid[:n] = key
    grid = grid.reshape(rows, w)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n - w + 1], ahead[w - 1:n])


def _super_windows(text: bytes, length: int, gram: int):
    """(keys, first window, last window, periodic) of the super-windows of a text, in order.

    A periodic one holds several places of its least hash, so its windows may equal each other.
    In any other one all windows differ: equal windows have the least hash at the same offset.
    """
    keys, first, last, periodic = [], [], [], []
    raw = np.frombuffer(text, dtype=np.uint8)
    w = length - gram + 1
    for at in range(0, len(raw) - length + 1, CHUNK):
        h = gram_hashes(raw[at:at + CHUNK + length - 1], gram)
        place = np.arange(len(h), dtype=np.uint64)
        low = np.uint64((1 << PLACE) - 1)
        least = _window_minimum((h & ~low) | (low - place), w)
        spot = (low - (least & low)).astype(np.int64)  # the last place of the least hash
        start = np.concatenate(([0], np.flatnonzero(np.diff(spot)) + 1))
        end = np.concatenate((start[1:], [len(spot)])) - 1
        spot = spot[start]
        key = h[spot]
        many = np.zeros(len(key), dtype=bool)
        again = np.flatnonzero(key[1:] == key[:-1]) + 1
        if len(again):  # periodic text: one place serves all windows that hold it
            use = np.ones(len(key), dtype=bool)
            kept = 0
            for i in range(1, len(key)):
                if key[i] == key[kept] and end[i] <= spot[kept]:
                    use[i] = False
                    end[kept] = end[i]
                    many[kept] = True
                else:
                    kept = i
            key, start, end, many = key[use], start[use], end[use], many[use]
        keys.append(key.view(np.int64))
        first.append(start + at)
        last.append(end + at)
        periodic.append(many)
    if not keys:
        return (*(np.empty(0, np.int64),) * 3, np.empty(0, bool))
    return tuple(np.concatenate(x) for x in (keys, first, last, periodic))


def super_windows(text: bytes, length: int = LENGTH, gram: int = GRAM):
    """(keys, first window, last window) of the super-windows of a text, in order."""
    return _super_windows(text, length, gram)[:3]


def _scan(length: int, gram: int):
    def run(frames):
        for frame in frames:
            found = [_super_windows(t, length, gram) for t in frame["text"]]
            yield pd.DataFrame({"id": frame["id"], "sha": frame["sha"],
                                "n_bytes": [len(t) for t in frame["text"]],
                                "keys": [f[0] for f in found], "first": [f[1] for f in found],
                                "last": [f[2] for f in found],
                                "periodic": [f[3] for f in found]})
    return run


def _cut(length: int):
    """The bytes of the wanted super-windows."""
    def run(frames):
        for frame in frames:
            for ref, text, wanted in zip(frame["ref"], frame["text"], frame["wanted"]):
                yield pd.DataFrame({
                    "key": [x["key"] for x in wanted], "ref": ref,
                    "first": [x["first"] for x in wanted],
                    "periodic": [x["periodic"] for x in wanted],
                    "busy": [x["busy"] for x in wanted],
                    "bytes": [text[x["first"]:x["last"] + length] for x in wanted]})
    return run


def _runs(starts: np.ndarray) -> list[tuple[int, int]]:
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > 1) + 1
    return [(int(p[0]), int(p[-1])) for p in np.split(starts, cut)]


def _mark(length: int):
    """Runs of repeated window starts in a stream of super-windows sorted by key."""
    def run(frames):
        for block in in_blocks(frames, "key", BLOCK_ROWS):
            # all windows of a string that comes twice are repeats; it is indexed once
            same = block.groupby(["key", "bytes"], sort=False)["ref"].transform("size").to_numpy()
            only = ~block.duplicated(["key", "bytes"]).to_numpy()
            distinct = block["key"].map(block.loc[only, "key"].value_counts()).to_numpy()
            out = []
            for ref, first, raw in zip(block["ref"][same > 1], block["first"][same > 1],
                                       block["bytes"][same > 1]):
                out.append((ref, first, first + len(raw) - length))
            # a string that comes once, alone under its key, can still repeat itself
            alone = (same == 1) & block["periodic"].to_numpy(dtype=bool)
            part = block[only & ((distinct > 1) | alone)]
            found = long_matches(part["bytes"].tolist(), length)
            for ref, first, n, starts in zip(part["ref"], part["first"], same[part.index], found):
                if n == 1:
                    out += [(ref, first + a, first + b) for a, b in _runs(starts)]
            yield pd.DataFrame(out, columns=["ref", "first", "last"]).astype("int64")
    return run


def _recut(length: int, gram: int):
    """Super-windows under a longer gram, within those given."""
    def run(frames):
        for frame in frames:
            out = []
            for ref, at, raw in zip(frame["ref"], frame["first"], frame["bytes"]):
                for key, a, b, many in zip(*(x.tolist() for x in _super_windows(raw, length, gram))):
                    out.append((key, ref, at + a, many, raw[a:b + length]))
            yield pd.DataFrame(out, columns=["key", "ref", "first", "periodic", "bytes"])
    return run


WINDOW = "key long, ref long, first long, periodic boolean, bytes binary"
MARK = "ref long, first long, last long"


def _index(windows: DataFrame, rows: int, length: int) -> DataFrame:
    n = partitions_for(rows, 4 * BLOCK_ROWS)
    return (windows.repartition(n, "key").sortWithinPartitions("key")
            .mapInPandas(_mark(length), MARK))


def _busy_keys(windows: DataFrame, length: int, gram: int, most: int) -> list[DataFrame]:
    """Marks in groups that are too large for one index; see step 4 above."""
    marks = []
    while not windows.isEmpty():
        digest = F.sha2("bytes", 256)
        now = shared_table(windows.withColumn("digest", digest), "busy")
        classes = now.groupBy("key", "digest").agg(
            F.count(F.lit(1)).alias("n"), F.min(F.struct("ref", "first")).alias("one"),
            F.max("periodic").alias("periodic"))
        sizes = classes.groupBy("key").agg(F.count(F.lit(1)).alias("classes"))
        classes = shared_table(classes.join(sizes, "key").filter("n > 1 or classes > 1 or periodic"),
                               "busy-classes")
        both = now.drop("periodic").join(classes, ["key", "digest"])
        marks.append(shared_table(both.filter("n > 1").select(
            "ref", "first", (F.col("first") + F.length("bytes") - length).alias("last")),
            "busy-marks"))
        one = both.filter((F.col("one.ref") == F.col("ref")) & (F.col("one.first") == F.col("first")))
        cold = one.filter(((F.col("classes") > 1) & (F.col("classes") <= most))
                          | ((F.col("classes") == 1) & (F.col("n") == 1) & F.col("periodic"))).select(
            "key", "ref", "first", "periodic", "bytes")
        cold = shared_table(cold, "busy-cold")
        marks.append(shared_table(_index(cold, cold.count(), length), "busy-cold-marks"))
        gram += -(-(length - gram) // 2)
        finer = shared_table(one.filter(F.col("classes") > most).select("ref", "first", "bytes")
                             .mapInPandas(_recut(length, gram), WINDOW), "busy-finer")
        again = finer.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("periodic").alias(
            "periodic")).filter("n > 1 or periodic")
        windows = finer.join(again.select("key"), "key", "left_semi")
    return marks


def _raw(col: str) -> Column:
    return F.coalesce(F.col(col).cast("binary"), F.lit(b""))


def repeat_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 length: int = LENGTH, gram: int = GRAM, most: int = MOST_ROWS) -> DataFrame:
    """(id, sha, n_bytes, spans) for each distinct id and text: the byte runs to remove.

    ``spans`` is a sorted array of (start, end); null or empty when nothing is removed.
    """
    texts = docs.select(F.col(id_col).alias("id"), _raw(text_col).alias("text"))
    texts = texts.withColumn("sha", F.sha2("text", 256))
    kind = dict(texts.dtypes)["id"]
    scanned = shared_table(texts.mapInPandas(
        _scan(length, gram), f"id {kind}, sha string, n_bytes long, keys array<long>, "
        "first array<long>, last array<long>, periodic array<boolean>"), "super-windows")
    # tables by themselves, so that joins with them can split a hot key
    groups = shared_table(scanned.groupBy("sha").agg(F.count(F.lit(1)).alias("copies"),
                                                     F.max("id").alias("one")), "groups")
    known = shared_table(scanned.select("id", "sha", "n_bytes").join(groups, "sha")
                         .groupBy("id", "sha", "n_bytes")
                         .agg(F.first("copies").alias("copies"), F.first("one").alias("one")),
                         "copies")
    one = known.filter(F.col("id").eqNullSafe(F.col("one"))).select(
        F.monotonically_increasing_id().alias("ref"), F.col("id").alias("id_"),
        F.col("sha").alias("sha_"), "copies")
    one = shared_table(one, "texts")
    here = scanned.join(one, scanned["id"].eqNullSafe(one["id_"]) & (scanned["sha"] == one["sha_"]))
    each = here.select("ref", F.explode(F.arrays_zip("keys", "first", "last", "periodic")).alias("w")).select(
        "ref", F.col("w.keys").alias("key"), F.col("w.first").alias("first"),
        F.col("w.last").alias("last"), F.col("w.periodic").alias("periodic"))
    each = shared_table(each, "keys")
    repeated = shared_table(each.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.max("periodic").alias("any")).filter("n > 1 or any")
        .select("key", "n"), "repeated")
    wanted = (each.join(repeated, "key")
              .groupBy("ref").agg(F.collect_list(F.struct(
                  "key", "first", "last", "periodic", (F.col("n") > most).alias("busy"))).alias("wanted"))
              .join(one, "ref"))
    cut = (texts.join(wanted, texts["id"].eqNullSafe(wanted["id_"]) & (texts["sha"] == wanted["sha_"]))
           .select("ref", "text", "wanted")
           .mapInPandas(_cut(length), "key long, ref long, first long, periodic boolean, busy boolean, bytes binary"))
    cut = shared_table(cut, "windows")
    counts = {r["busy"]: r["count"] for r in cut.groupBy("busy").count().collect()}
    marks = _index(cut.filter("not busy").drop("busy"), counts.get(False, 0), length)
    marks = [shared_table(marks, "marks")]
    if counts.get(True):
        marks += _busy_keys(cut.filter("busy").drop("busy"), length, gram, most)
    marked = marks[0]
    for m in marks[1:]:
        marked = marked.union(m)
    spans = (marked.groupBy("ref").agg(F.sort_array(F.collect_list(F.struct(
        F.col("first").alias("start"), (F.col("last") + length).alias("end")))).alias("spans"))
        .join(one, "ref").filter("copies = 1").select("id_", "sha_", "spans"))
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end")))
    return known.join(spans, known["id"].eqNullSafe(spans["id_"]) & (known["sha"] == spans["sha_"]),
                      "left").select(
        "id", "sha", "n_bytes",
        F.when((F.col("copies") > 1) & (F.col("n_bytes") >= length), whole)
        .otherwise(F.col("spans")).alias("spans"))


def union_spans(spans) -> list[tuple[int, int]]:
    """Maximal runs of sorted, possibly overlapping or touching spans."""
    out: list[list[int]] = []
    for s in spans if spans is not None else []:
        if out and s["start"] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], s["end"])
        else:
            out.append([s["start"], s["end"]])
    return [(a, b) for a, b in out]


def long_spans(raw: bytes, spans: list[tuple[int, int]], words: int) -> list[tuple[int, int]]:
    """Spans that hold at least ``words`` words, cut ones included."""
    return [(a, b) for a, b in spans if not words or len(raw[a:b].split()) >= words]


def strip_spans(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    at, parts = 0, []
    for a, b in spans:
        parts.append(raw[at:a])
        at = b
    return b"".join([*parts, raw[at:]])


def _strip(frames):
    for frame in frames:
        spans = [union_spans(s) for s in frame["spans"]]
        kept = [strip_spans(t, s) for t, s in zip(frame["text"], spans)]
        yield pd.DataFrame({
            "id": frame["id"], "n_bytes": [len(t) for t in frame["text"]],
            "n_removed": [len(t) - len(k) for t, k in zip(frame["text"], kept)],
            "n_spans": [len(s) for s in spans],
            "kept_sha256": [hashlib.sha256(k).hexdigest() for k in kept],
            "kept_text": [k.decode("utf-8", "ignore") for k in kept]})


def _matched(docs: DataFrame, id_col: str, text_col: str, found: DataFrame) -> DataFrame:
    """Texts of ``docs`` that ``found`` names, with their spans."""
    found = found.withColumnsRenamed({"id": "id_", "sha": "sha_"}).drop("n_bytes")
    texts = docs.select(F.col(id_col).alias("id"), _raw(text_col).alias("text"))
    texts = texts.withColumn("sha", F.sha2("text", 256))
    return texts.join(found, texts["id"].eqNullSafe(found["id_"]) & (texts["sha"] == found["sha_"]))


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 length: int = LENGTH, gram: int = GRAM, most: int = MOST_ROWS) -> DataFrame:
    """One row per input row: id, n_bytes, n_removed, n_spans, kept_sha256, kept_text.

    Every byte that is covered by a string of ``length`` bytes which also starts anywhere else
    is removed (same text included, overlaps count, texts are judged as given). Null text is
    empty. Equal texts of at least ``length`` bytes are removed as a whole, repeated rows
    included; shorter ones are kept. Texts are UTF-8 bytes; n_spans counts maximal removed runs.
    kept_text is what remains, less bytes left of characters that were cut in two (kept_sha256 is of
    all remaining bytes).
    Other columns are ignored. An empty table gives no rows.
    """
    found = shared_table(repeat_spans(docs, id_col, text_col, length, gram, most), "spans")
    n = F.col("n_bytes")
    is_whole = (F.size("spans") == 1) & (F.col("spans")[0]["start"] == 0) & (F.col("spans")[0]["end"] == n)
    is_part = F.coalesce(F.size("spans") > 0, F.lit(False))
    rows = docs.select(F.col(id_col).alias("id"), F.sha2(_raw(text_col), 256).alias("sha"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rest = found.filter(~is_part | is_whole).withColumnsRenamed({"id": "id_", "sha": "sha_"})
    plain = rows.join(rest, rows["id"].eqNullSafe(rest["id_"]) & (rows["sha"] == rest["sha_"])).select(
        "id", "n_bytes", F.when(is_part, n).otherwise(0).cast("long").alias("n_removed"),
        F.when(is_part, 1).otherwise(0).cast("long").alias("n_spans"),
        F.when(is_part, F.lit(EMPTY_SHA)).otherwise(F.col("sha")).alias("kept_sha256"),
        F.when(is_part, F.lit("")).otherwise(F.col("text")).alias("kept_text"))
    kind = dict(rows.dtypes)["id"]
    part = _matched(docs, id_col, text_col, found.filter(is_part & ~is_whole)).select(
        "id", "text", "spans").mapInPandas(
            _strip, f"id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
            "kept_text string")
    return plain.unionByName(part).withColumnRenamed("id", id_col)


def strip_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  length: int = LENGTH, gram: int = GRAM, words: int = 0) -> DataFrame:
    """``docs`` with repeated strings taken out of the text column; other columns as they are.

    Of the runs of bytes covered by repeated strings, those with at least ``words`` words go.

    Bytes left of a character that was cut in two are dropped, so the text stays valid. Rows
    are never dropped: a text that repeats as a whole becomes empty. A null text stays null.
    """
    found = shared_table(repeat_spans(docs, id_col, text_col, length, gram).filter("size(spans) > 0"),
                         "spans")
    names = [free_name(docs, x) for x in ("id_", "sha_", "spans_")]
    found = found.select("id", "sha", "spans").toDF(*names)
    key, sha, spans_ = (found[x] for x in names)
    joined = docs.join(found, docs[id_col].eqNullSafe(key)
                       & (F.sha2(_raw(text_col), 256) == sha), "left")

    @F.pandas_udf("string")
    def cut(text: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([t if t is None or s is None else strip_spans(
            t.encode(), long_spans(t.encode(), union_spans(s), words)).decode("utf-8", "ignore")
            for t, s in zip(text, spans)], dtype="object")
    return joined.select(*(F.when(spans_.isNull(), docs[c]).otherwise(cut(docs[c], spans_)).alias(c)
                           if c == text_col else docs[c] for c in docs.columns))
