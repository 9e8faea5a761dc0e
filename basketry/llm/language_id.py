"""Language identification by multilingual mixture inference.

Per language one distribution over hashed character trigrams, counted on all training rows. A
document is a mixture: each of its trigrams comes from one of its languages. Expectation-
maximisation finds the proportions; languages leave the set, least share first, as long as the
penalised likelihood (a Bayesian information criterion) improves.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 16
SMOOTH = 0.05
UNKNOWN = "und"


class _Characters:
    """Lower-case letters of all of Unicode, as tables; made once per Python worker."""

    letter = lower = None

    @classmethod
    def load(cls) -> None:
        if cls.letter is None:
            every = [chr(i) for i in range(0x110000)]
            cls.lower = np.array([ord(c.lower()) if len(c.lower()) == 1 else i
                                  for i, c in enumerate(every)], dtype=np.uint32)
            cls.letter = np.array([c.isalpha() for c in every])


def trigrams(text: str | None) -> np.ndarray | None:
    """Hashed trigrams of the lower-case letters, other characters as one space; None if the
    text has no letter."""
    _Characters.load()
    code = np.frombuffer((text or "").encode("utf-32-le"), dtype=np.uint32)
    is_letter = _Characters.letter[code]
    if not is_letter.any():
        return None
    code = np.where(is_letter, _Characters.lower[code], np.uint32(32))
    code = np.concatenate(([np.uint32(32)], code, [np.uint32(32)])).astype(np.uint64)
    code = code[np.concatenate(([True], (code[1:] != 32) | (code[:-1] != 32)))]
    h = (code[:-2] * np.uint64(0x9E3779B1) + code[1:-1]) * np.uint64(0x85EBCA77) + code[2:]
    h *= np.uint64(0xC2B2AE3D27D4EB4F)
    return (h >> np.uint64(48)).astype(np.int64)


def _count(frames):
    held: dict[str, np.ndarray] = {}
    for frame in frames:
        for lang, text in zip(frame["lang"], frame["text"]):
            found = trigrams(text)
            if found is not None:
                if lang not in held:
                    held[lang] = np.zeros(BUCKETS, dtype=np.int64)
                held[lang] += np.bincount(found, minlength=BUCKETS)
    for lang, n in held.items():
        at = np.flatnonzero(n)
        yield pd.DataFrame({"lang": lang, "bucket": at, "n": n[at]})


def language_model(rows: DataFrame, most_languages: int) -> tuple[list[str], np.ndarray]:
    """Sorted languages and the log-probability of each bucket (row) under each of them.

    The model has BUCKETS rows for each language, whatever the size of the corpus; more than
    ``most_languages`` languages are an error.
    """
    counted = (rows.mapInPandas(_count, "lang string, bucket int, n long")
               .groupBy("lang", "bucket").agg(F.sum("n").alias("n")))
    langs = rows.select("lang").distinct().limit(most_languages + 1).collect()
    if len(langs) > most_languages:
        raise ValueError(f"more than {most_languages} languages; raise most_languages")
    found = counted.toPandas()
    names = sorted(found["lang"].unique())
    n = np.full((BUCKETS, len(names)), SMOOTH)
    for i, (_, part) in enumerate(found.groupby("lang", sort=True)):
        n[part["bucket"], i] += part["n"]
    return names, np.log(n / n.sum(axis=0)) if names else n


def mixture(like: np.ndarray, count: np.ndarray, steps: int = 30) -> tuple[np.ndarray, float]:
    """Proportions of the columns of ``like`` for weighted rows, and the log-likelihood."""
    total = count.sum()
    share = np.full(like.shape[1], 1.0 / like.shape[1])
    for _ in range(steps):
        each = like @ share
        new = share * ((count / each) @ like) / total
        moved = np.abs(new - share).max()
        share = new
        if moved < 1e-4:
            break
    return share, float(count @ np.log(like @ share))


def choose(log_p: np.ndarray, found: np.ndarray, penalty: float) -> tuple[list[int], np.ndarray]:
    """The set of languages of least penalised likelihood, and their shares."""
    bucket, count = np.unique(found, return_counts=True)
    rows = log_p[bucket]
    top = rows.max(axis=1)
    like = np.exp(rows - top[:, None])
    names = list(range(log_p.shape[1]))
    price = penalty * np.log(count.sum() + 1.0)
    share, fit = mixture(like, count)
    while len(names) > 1:
        # nearly absent languages leave together, others one at a time
        keep = share > max(1e-3, float(share.min()))
        if not keep.any():
            keep = np.arange(len(names)) < len(names) - 1
        fewer, fit_fewer = mixture(like[:, keep], count)
        if 2 * (fit - fit_fewer) >= price * (len(names) - keep.sum()):
            break
        names, like = [n for n, k in zip(names, keep) if k], like[:, keep]
        share, fit = fewer, fit_fewer
    return names, share


def identify_languages(docs: DataFrame, held_out: Column, id_col: str = "doc_id",
                       text_col: str = "text", lang_col: str = "lang", penalty: float = 3.0,
                       most_languages: int = 200) -> DataFrame:
    """One row per input row: id, held_out, lang_pred, score, languages.

    Rows with a language for which ``held_out`` does not hold teach the model; a null condition
    counts as not held out. ``languages`` lists the chosen set with its shares, largest first (ties
    by name); lang_pred is its first member and score that share. Null texts, texts without
    a letter, and all texts if nothing was learnt, get ``und`` with score 0 and an empty list.
    Other columns are ignored. An empty table gives no rows.
    """
    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("text"),
                       F.col(lang_col).cast("string").alias("lang"),
                       F.coalesce(held_out, F.lit(False)).alias("held_out"))
    names, log_p = language_model(
        rows.filter("not held_out and lang is not null").select("lang", "text"), most_languages)
    model = docs.sparkSession.sparkContext.broadcast(log_p)

    def judge(text: str | None) -> list[tuple[str, float]]:
        found = trigrams(text) if names else None
        if found is None:
            return []
        chosen, share = choose(model.value, found, penalty)
        return sorted(((names[i], float(s)) for i, s in zip(chosen, share)), key=lambda x: (-x[1], x[0]))

    def run(frames):
        for f in frames:
            got = [judge(t) for t in f["text"]]
            yield pd.DataFrame({
                "key": f["key"], "held_out": f["held_out"],
                "lang_pred": [g[0][0] if g else UNKNOWN for g in got],
                "score": [min(1.0, g[0][1]) if g else 0.0 for g in got],
                "languages": [[{"lang": a, "share": s} for a, s in g] for g in got]})
    return rows.select("key", "held_out", "text").mapInPandas(
        run, f"key {kind}, held_out boolean, lang_pred string, score double, "
        "languages array<struct<lang:string,share:double>>").withColumnRenamed("key", id_col)
