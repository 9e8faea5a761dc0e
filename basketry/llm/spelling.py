"""Spelling variants by composing finite-state machines.

The vocabulary is a minimised acceptor. Composed with a transducer that makes exactly one edit, and
with the acceptor again, it accepts the pairs of words that are one inserted, deleted or replaced
character apart. States are pairs (state, state); before the edit both are the same state, so the
edits that may come first at a state are found once for all words that pass it.

Pairs are enumerated per initial state, the state after a common prefix. Words whose prefix is
shared by at most ``most`` words are composed under it. A prefix with more words is taken one character further:
pairs whose edit lies behind that character are found under the longer prefixes, and pairs whose
edit is that character under the initial states that share all the rest (at most two words per
letter). So no acceptor ever holds an unbounded part of the vocabulary, however its prefixes are
spread, and no pair is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, in_blocks, partitions_for, shared_table

RUN = r"[A-Za-zÀ-ÿ]+"
MOST = 4000             # words under one initial state
LEAST_LENGTH = 6
LEAST_COUNT = 5
RATIO = 5


class Acceptor:
    """Minimised acyclic acceptor of a sorted list of distinct words."""

    def __init__(self, words: list[str]):
        self.arcs: list[dict[str, int]] = [{}]
        self.final: list[bool] = [False]
        known: dict[tuple, int] = {}
        path = [0]          # states of the last word that may still change
        last = ""

        def settle(down_to: int) -> None:
            for at in range(len(path) - 1, down_to, -1):
                state = path[at]
                shape = (self.final[state], *self.arcs[state].items())
                same = known.setdefault(shape, state)
                if same != state:
                    self.arcs[path[at - 1]][last[at - 1]] = same
            del path[down_to + 1:]

        for word in words:
            same = 0
            for x, y in zip(word, last):
                if x != y:
                    break
                same += 1
            settle(same)
            for c in word[same:]:
                self.arcs.append({})
                self.final.append(False)
                self.arcs[path[-1]][c] = len(self.arcs) - 1
                path.append(len(self.arcs) - 1)
            self.final[path[-1]] = True
            last = word
        settle(0)

    def shared(self, a: int, b: int, but: str = "") -> Iterator[str]:
        """Texts, not starting with ``but``, that lead from both states to an accepting one."""
        stack = [(a, b, "")]
        while stack:
            a, b, text = stack.pop()
            if self.final[a] and self.final[b]:
                yield text
            theirs = self.arcs[b]
            for c, to in self.arcs[a].items():
                if c in theirs and (text or c != but):
                    stack.append((to, theirs[c], text + c))

    def edits(self, state: int) -> list[tuple[str, str]]:
        """(text, text) accepted from a state whose first difference is one edit right there.

        A character put in before its like counts behind it, so each pair comes once.
        """
        out = []
        arcs = list(self.arcs[state].items())
        for i, (x, to) in enumerate(arcs):
            for y, other in arcs[i + 1:]:
                out += [(x + t, y + t) for t in self.shared(to, other)]
            out += [(t, x + t) for t in self.shared(state, to, x)]
        return out

    def one_edit_pairs(self) -> Iterator[tuple[str, str]]:
        """Pairs of accepted words one edit apart, once each, in one of the two orders."""
        made: dict[int, list[tuple[str, str]]] = {}
        path: list[str] = []
        stack = [(0, 0, "")]
        while stack:
            state, length, char = stack.pop()
            path[length - 1 if length else 0:] = char
            found = made.get(state)
            if found is None:
                found = made[state] = self.edits(state)
            if found:
                prefix = "".join(path)
                for a, b in found:
                    yield prefix + a, prefix + b
            stack += [(to, length + 1, c) for c, to in self.arcs[state].items()]


def _compose(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pairs of all initial states of a block; words of several are composed together."""
    for block in in_blocks(frames, "start", MOST):
        n = dict(zip(block["word"], block["n"]))
        pairs = {(a, b) if a < b else (b, a) for a, b in Acceptor(sorted(n)).one_edit_pairs()}
        ends = [*pairs, *((b, a) for a, b in pairs)]
        yield pd.DataFrame({"word": [a for a, _ in ends], "near": [b for _, b in ends],
                            "near_n": [n[b] for _, b in ends]}).astype({"near_n": "int64"})


def near_pairs(vocabulary: DataFrame, most: int = MOST) -> DataFrame:
    """(word, near, near_n) for every two words one edit apart, both ways round.

    ``vocabulary``: distinct words with their counts n. No words, no pairs.
    """
    parts = []
    open_ = vocabulary.select("word", "n").withColumn("start", F.lit(""))
    size = 0
    while True:
        open_ = shared_table(open_, "open-prefixes")
        sizes = open_.groupBy("start").agg(F.count(F.lit(1)).alias("words"))
        sizes = shared_table(sizes, "prefix-sizes")
        full = sizes.filter(F.col("words") > most).select("start")
        parts.append(open_.join(sizes.filter(F.col("words").between(2, most)).select("start"),
                                "start", "left_semi").select(F.concat(F.lit("p"), "start").alias("start"),
                                                             "word", "n"))
        if full.isEmpty():
            break
        split = shared_table(open_.join(full, "start", "left_semi"), "full-prefixes")
        # the edit is the character after the prefix: all the rest is shared
        word = F.col("word")
        rest, tail = F.substring(word, size + 1, 1 << 30), F.substring(word, size + 2, 1 << 30)
        cells = split.select(
            F.explode(F.array(F.concat(F.lit("r"), F.col("start"), F.lit("/"), tail),
                              F.concat(F.lit("r"), F.col("start"), F.lit("/"), rest))).alias("start"),
            "word", "n")
        shared = cells.groupBy("start").agg(F.count(F.lit(1)).alias("words")).filter("words > 1")
        parts.append(cells.join(shared.select("start"), "start", "left_semi").distinct())
        size += 1
        open_ = split.filter(F.char_length(word) >= size).select(
            "word", "n", F.substring(word, 1, size).alias("start"))
    cells = parts[0]
    for p in parts[1:]:
        cells = cells.unionByName(p)
    cells = shared_table(cells.select("start", "word", "n"), "initial-states")
    n = partitions_for(cells.count(), 2 * most)
    found = (cells.repartition(n, "start").sortWithinPartitions("start")
             .mapInPandas(_compose, "word string, near string, near_n long"))
    return shared_table(found.distinct(), "near-words")


def spelled_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  slips: int | None = None) -> DataFrame:
    """Distinct words of at least ``LEAST_LENGTH`` characters with their counts n.

    ``slips``: a word's run loses one character where this number divides the CRC-32 of
    ``<id>:<run>`` (the character at that CRC modulo the run's length); a null id counts as empty.
    """
    run = F.explode(F.regexp_extract_all(ascii_lower(F.col(text_col)), F.lit(RUN), F.lit(0)))
    runs = docs.select(F.col(id_col).cast("string").alias("id"), run.alias("run"))
    runs = runs.filter(F.char_length("run") >= LEAST_LENGTH)
    word: Column = F.col("run")
    if slips:
        code = F.crc32(F.concat(F.coalesce("id", F.lit("")), F.lit(":"), "run").cast("binary"))
        at = F.pmod(F.col("code"), F.char_length("run")).cast("int")
        runs = runs.withColumn("code", code)
        word = F.when(F.col("code") % slips == 0, F.concat(
            F.substring("run", F.lit(1), at),
            F.substring("run", at + 2, F.char_length("run")))).otherwise(F.col("run"))
    return (runs.select(word.alias("word")).filter(F.char_length("word") >= LEAST_LENGTH)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")))


def spelling_variants(vocabulary: DataFrame, ratio: int = RATIO, most: int = MOST) -> DataFrame:
    """One row per word: word, n, n_near, form, form_n, root.

    ``vocabulary``: distinct words with their counts n. A word's form is the near word of largest n
    (ties: smallest in code-point order) if that is at least ``ratio`` times its own, else null; root
    follows the forms to the last one, the word itself if it has none. Counts grow by ``ratio``
    along the way, so it ends, after few steps, each of which doubles the distance. Words without near words
    keep their row; an empty vocabulary gives no rows.
    """
    words = shared_table(vocabulary.select("word", "n"), "vocabulary")
    best = near_pairs(words, most).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form"))).alias("best"))
    rows = words.join(best, "word", "left").withColumn(
        "is_form", F.coalesce(-F.col("best.less") >= ratio * F.col("n"), F.lit(False)))
    rows = shared_table(rows.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(F.col("is_form"), F.col("best.form")).alias("form"),
        F.when(F.col("is_form"), -F.col("best.less")).alias("form_n")), "forms")
    hops = rows.filter("form is not null").select("word", F.col("form").alias("root"))
    while True:
        on = hops.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = shared_table(hops.join(on, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("went")),
            "roots")
        hops = further.select("word", "root")
        if further.filter("went").isEmpty():
            break
    return rows.join(hops, "word", "left").withColumn("root", F.coalesce("root", "word"))
