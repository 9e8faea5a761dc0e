"""SentencePiece encoding and decoding by an Aho-Corasick automaton and a single-pass Viterbi.

One pass over a segment: at each position the automaton gives every piece that ends there (it
follows the output links), and each piece may relax the best path to that position.

* Unigram models: the path with the largest sum of piece scores.
* BPE models: a sum of scores would not give the merges' result. There the last piece of a
  prefix's encoding is unique: it is the piece whose pair with the last piece before it is what
  merging both strings gives. So a piece relaxes a position only if its pair is stable.

Pieces never hold a space mark after another character (checked when a model is loaded), so
segments between spaces are independent, and repeated segments are encoded once per task.
"""

from __future__ import annotations

import re
import struct
from array import array
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
CACHE = 300_000         # segments in each of two generations
SLICE = 2000             # rows handed on at once
PAIRS = 400_000         # pairs of pieces whose stability is kept


def _fields(raw: bytes):
    """(number, value) of a protocol-buffer message: int, bytes or four raw bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = raw[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(raw):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or varint()
            yield tag >> 3, raw[at:at + size]
            at += size


@dataclass
class Model:
    pieces: list[str]
    scores: list[float]
    kinds: list[int]
    model_type: int = UNIGRAM
    byte_fallback: bool = False
    dummy_prefix: bool = True
    trim_spaces: bool = True
    index: dict[str, int] = field(default_factory=dict)


def load_model(path: str) -> Model:
    """Read a SentencePiece model file. Models with a character map are refused."""
    with open(path, "rb") as f:
        raw = f.read()
    m = Model([], [], [])
    for number, value in _fields(raw):
        if number == 1:
            piece = dict(_fields(value))
            m.pieces.append(piece.get(1, b"").decode())
            m.scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
            m.kinds.append(piece.get(3, NORMAL))
        elif number == 2:
            trainer = dict(_fields(value))
            m.model_type = trainer.get(3, UNIGRAM)
            m.byte_fallback = bool(trainer.get(35, 0))
            if trainer.get(24, 0):
                raise ValueError("models with space marks as suffixes are not supported")
        elif number == 3:
            normalizer = dict(_fields(value))
            if normalizer.get(2):
                raise ValueError("models with a character map are not supported")
            m.dummy_prefix = bool(normalizer.get(3, 1))
            m.trim_spaces = bool(normalizer.get(4, 1))
    if m.model_type not in (UNIGRAM, BPE):
        raise ValueError("only unigram and BPE models are supported")
    m.index = {p: i for i, (p, k) in enumerate(zip(m.pieces, m.kinds)) if k in (NORMAL, USER)}
    if USER in m.kinds:
        raise ValueError("models with user-defined pieces are not supported")
    if any(SPACE in p.lstrip(SPACE) for p in m.index):
        raise ValueError("models with spaces inside pieces are not supported")
    return m


class Codec:
    """Encoder and decoder of one model; made once per Python worker."""

    def __init__(self, model: Model):
        self.m = model
        self.index, self.scores = model.index, model.scores
        self.rank: dict[str, float] = {}
        self.halves: dict[str, tuple[str, str]] = {}
        if model.model_type == BPE:
            # order of the merges, and the two parts of the merge that made each piece
            self.rank = {p: -self.scores[i] for p, i in self.index.items() if len(p) > 1}
            for p in self.rank:
                parts, last = self.merged(p)
                if len(parts) == 1:
                    self.halves[p] = last
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.index.items():
            if model.model_type == UNIGRAM or len(piece) == 1 or piece in self.halves:
                self.automaton.add_word(piece, (len(piece), i))
        self.automaton.make_automaton()
        self.unknown = next(i for i, k in enumerate(model.kinds) if k == UNKNOWN)
        self.bytes = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(model.pieces, model.kinds))
                      if k == BYTE}
        self.no_score = min(self.scores[i] for i in self.index.values()) - 10.0
        used = set("".join(self.index))
        breaks = "".join(c for c in "\t\n\r\x0b\x0c" if c not in used)
        cls = re.escape(breaks)
        self.cut = re.compile(
            f"{SPACE}*[^{SPACE}{cls}]+|{SPACE}+" + (f"|[{cls}]" if breaks else "")).findall
        self.segments: dict[str, bytes] = {}   # ids as 32-bit numbers
        self.older: dict[str, bytes] = {}
        self.odd: set[str] = set()              # segments that do not come back when decoded
        self.size = [len(p) for p in model.pieces]
        self.chars = {p for p in self.index if len(p) == 1}
        self.pairs: dict[int, bool] = {}
        out = []
        for p, k in zip(model.pieces, model.kinds):
            out.append(bytes([int(p[3:5], 16)]) if k == BYTE
                       else b"" if k == CONTROL else " ⁇ ".encode() if k == UNKNOWN
                       else p.replace(SPACE, " ").encode())
        self.plain = out

    def merged(self, text: str) -> tuple[list[str], tuple[str, str]]:
        """Parts that merging leaves, best score and then leftmost first, and the last merge."""
        parts, last = list(text), ("", "")
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = self.rank.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            last = parts[at], parts[at + 1]
            parts[at:at + 2] = ["".join(last)]
        return parts, last

    def stable(self, a: str, b: str) -> bool:
        """Whether merging the two pieces' characters together leaves just these two pieces.

        Goes back through the merges that made the right edge of ``a`` and the left edge of ``b``,
        latest first: the border is crossed if two edges that exist at one time merge before
        the next merge of either (on equal terms the one further left comes first).
        """
        rank, halves = self.rank, self.halves
        limit = np.inf
        while True:
            r = rank.get(a + b)
            if r is not None and r < limit:
                return False
            made_a = rank[a] if len(a) > 1 else -1.0
            made_b = rank[b] if len(b) > 1 else -1.0
            if made_a > made_b:
                limit, a = made_a, halves[a][1]
            elif made_b < 0:
                return True
            else:
                limit, b = made_b + 0.5, halves[b][0]

    def spelled(self, char: str) -> list[int]:
        if self.m.byte_fallback:
            return [self.bytes[b] for b in char.encode()]
        return [self.unknown]

    def _stable_ids(self, a: int, b: int) -> bool:
        key = a * len(self.plain) + b
        got = self.pairs.get(key)
        if got is None:
            got = self.stable(self.m.pieces[a], self.m.pieces[b])
            if len(self.pairs) < PAIRS:
                self.pairs[key] = got
        return got

    def _bpe_path(self, text: str) -> list[int]:
        """Piece that ends at each position (-1: none, -2: an unknown character).

        Matches come in order of their ends; the longest stable one at each position is kept.
        """
        n = len(text)
        last = [-1] * (n + 1)
        if not self.chars.issuperset(text):
            for i, c in enumerate(text):
                if c not in self.chars:
                    last[i + 1] = -2
        total, pair = len(self.plain), self.pairs.get
        for end, (size, piece) in self.automaton.iter(text):
            i = end + 1
            if last[i] != -1:
                continue
            if i > size:
                before = last[i - size]
                if before >= 0:
                    fits = pair(before * total + piece)
                    if not (self._stable_ids(before, piece) if fits is None else fits):
                        continue
                elif before == -1:
                    continue
            last[i] = piece
        return last

    def _unigram_path(self, text: str) -> list[int]:
        """Last piece of the best path to each position (-2: an unknown character)."""
        n = len(text)
        last = [-1] * (n + 1)
        score = [0.0] + [-np.inf] * n
        ends: list[list[tuple[int, int]]] = [[] for _ in range(n + 1)]
        for end, found in self.automaton.iter(text):
            ends[end + 1].append(found)
        for i in range(1, n + 1):
            single = False
            for size, piece in ends[i]:
                single |= size == 1
                s = score[i - size] + self.scores[piece]
                if s > score[i]:
                    score[i], last[i] = s, piece
            if not single and score[i - 1] + self.no_score > score[i]:
                score[i], last[i] = score[i - 1] + self.no_score, -2
        return last

    def _path(self, text: str) -> list[int]:
        """Pieces of the best path, from the end back."""
        last = self._bpe_path(text) if self.m.model_type == BPE else self._unigram_path(text)
        out: list[int] = []
        i = len(text)
        while i:
            piece = last[i]
            if piece >= 0:
                out.append(piece)
                i -= self.size[piece]
            else:
                out += self.spelled(text[i - 1])[::-1]
                i -= 1
        out.reverse()
        return out

    def segment(self, text: str) -> bytes:
        got = self.segments.get(text) or self.older.get(text)
        if got is None:
            if self.m.model_type == BPE and SPACE * 2 in text:
                # pieces of spaces may have equal scores, which only merging settles
                ids = [i for p in self.merged(text)[0] for i in (
                    [self.index[p]] if p in self.index else self.spelled(p))]
            else:
                ids = self._path(text)
            plain = self.plain
            if b"".join([plain[i] for i in ids]) != text.replace(SPACE, " ").encode():
                self.odd.add(text)
            got = array("i", ids).tobytes()
        if len(self.segments) >= CACHE:
            self.older, self.segments = self.segments, {}
            self.odd &= self.older.keys()
        self.segments[text] = got
        return got

    def encode_text(self, text: str | None) -> tuple[bytes, bool]:
        """Ids of a text as 32-bit numbers, and whether decoding them gives the text back.

        Segments decode one by one, so the text comes back if each of its segments does.
        """
        given = text = text or ""
        if self.m.trim_spaces:
            text = re.sub(" +", " ", text.strip(" "))
        if not text:
            return b"", not given
        same = text == given and SPACE not in text and (self.m.dummy_prefix or text[0] != " ")
        text = text.replace(" ", SPACE)
        if self.m.dummy_prefix:
            text = SPACE + text
        cut = self.cut(text)
        known = self.segments.get
        parts = [known(s) or self.segment(s) for s in cut]
        ids = b"".join(parts)
        if not self.m.byte_fallback:  # neighbouring unknown characters are one piece
            x = np.frombuffer(ids, np.int32)
            again = (x[1:] == self.unknown) & (x[:-1] == self.unknown)
            ids = np.delete(x, np.flatnonzero(again) + 1).tobytes()
        if not same or self.odd and not self.odd.isdisjoint(cut):
            same = self.decode(np.frombuffer(ids, np.int32)) == given
        return ids, same

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(self.encode_text(text)[0], np.int32).tolist()

    def decode(self, ids) -> str:
        plain = self.plain
        text = b"".join([plain[i] for i in ids]).decode("utf-8", "replace")
        return text[1:] if self.m.dummy_prefix and text.startswith(" ") else text


_CODECS: dict[str, Codec] = {}


def _codec(name: str, shared) -> Codec:
    """The worker's codec of a broadcast model."""
    if name not in _CODECS:
        _CODECS.clear()
        _CODECS[name] = Codec(shared.value)
    return _CODECS[name]


def encode_documents(docs: DataFrame, model_path: str = DEFAULT_MODEL, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_tokens, token_ids, round_trip.

    Null and empty texts have no tokens. ``round_trip`` tells whether decoding the ids gives
    the text back (null: the empty text). Repeated rows are encoded each; other columns are
    ignored. An empty table gives no rows. The model, of a size fixed by its file, is read on the
    driver and broadcast.
    """
    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(load_model(model_path))

    def run(batches):
        codec = _codec(model_path, shared)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                rows = batch.slice(at, SLICE)
                found = [codec.encode_text(t) for t in rows.column("text").to_pylist()]
                n = np.array([len(ids) // 4 for ids, _ in found], dtype=np.int64)
                ends = np.concatenate(([0], np.cumsum(n))).astype(np.int32)
                values = np.frombuffer(b"".join([ids for ids, _ in found]), np.int32)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("id"), pa.array(n),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(values)),
                     pa.array([same for _, same in found], pa.bool_())],
                    names=["id", "n_tokens", "token_ids", "round_trip"])
    return rows.mapInArrow(run, f"id {kind}, n_tokens long, token_ids array<int>, round_trip boolean"
                           ).withColumnRenamed("id", id_col)


def decode_documents(encoded: DataFrame, model_path: str = DEFAULT_MODEL, id_col: str = "doc_id",
                     ids_col: str = "token_ids") -> DataFrame:
    """One row per input row: id, text. Null ids give the empty text."""
    kind = dict(encoded.dtypes)[id_col]
    shared = encoded.sparkSession.sparkContext.broadcast(load_model(model_path))

    def run(frames):
        codec = _codec(model_path, shared)
        for f in frames:
            yield pd.DataFrame({"id": f["id"], "text": [
                codec.decode(x if x is not None else []) for x in f["ids"]]})
    return encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids")).mapInPandas(
        run, f"id {kind}, text string").withColumnRenamed("id", id_col)
