"""Corpus pipeline: quality rules, exact dedup, near-dedup, repeated strings, packing.

Each stage takes (spark, docs, sf_dir), works on all rows that the stage before it kept, and
returns a DataFrame that is written as Parquet and read again as the next stage's ``docs``. All but
the last return the columns of ``documents``; the last returns the packed pieces. Null texts count as
empty; an empty table passes through every stage; other columns pass through whatever their names.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from basketry.llm.common import ascii_lower, documents, free_name, shared_table  # noqa: E402
from basketry.llm.exact_dedup import exact_dedup  # noqa: E402
from basketry.llm.packing import best_fit_pack, word_tokens  # noqa: E402
from basketry.llm.quality import quality_rules  # noqa: E402
from basketry.llm.simhash import simhash_components  # noqa: E402
from basketry.llm.suffix_dedup import strip_repeats  # noqa: E402


def _rows_of(docs: DataFrame, verdict: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose doc_id ``verdict`` keeps; rows that share an id stay or go together."""
    ids = verdict.filter("kept").select("doc_id").toDF(free_name(docs, "kept_id"))
    return docs.join(ids, docs["doc_id"].eqNullSafe(ids[0]), "left_semi")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are no outliers of their language and source.

    Null and empty texts fail the base rules. Null languages and sources are groups of their own.
    """
    return _rows_of(docs, quality_rules(docs))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id; of repeated rows with that id, one."""
    verdict = shared_table(exact_dedup(docs).groupBy("doc_id", "text_sha256").agg(
        F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n")).filter("kept"), "exact")
    key, sha, n = (free_name(docs, x) for x in ("id_", "sha_", "n_"))
    found = verdict.select("doc_id", "text_sha256", "n").toDF(key, sha, n)
    own = F.sha2(ascii_lower(F.coalesce("text", F.lit(""))), 256)
    columns = docs.columns
    kept = docs.join(found, docs["doc_id"].eqNullSafe(found[key]) & (own == found[sha]))
    if verdict.filter("n > 1").isEmpty():
        return kept.select(*columns)
    once = kept.filter(F.col(n) > 1).dropDuplicates([key, sha])
    return kept.filter(F.col(n) == 1).unionByName(once).select(*columns)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near-duplicates the row with the least doc_id (repeated rows: all).

    Texts without words have the fingerprint zero and are linked like any others.
    """
    return _rows_of(docs, simhash_components(docs, shingle=4, radius=4))


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of over 50 words that also stand elsewhere; n_chars follows.

    A passage is a run of bytes covered by strings of 200 bytes that start in two places or more (same
    text included), so 51 words of four letters or more on average; all its copies go. No row
    goes: a text that repeats as a whole becomes empty, and a null text stays null.
    """
    columns = docs.columns
    return (strip_repeats(docs, length=200, gram=64, words=51)
            .withColumn("n_chars", F.char_length("text").cast("long"))
            .select(*columns))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in bins of the permitted sequence lengths.

    A text without words is one piece, its end mark; repeated rows are packed each.
    """
    return best_fit_pack(docs, word_tokens(F.col("text")))


STAGES = [("quality_rules", quality), ("exact_dedup", exact), ("simhash_near_dedup", near),
          ("suffix_array_dedup", repeats), ("best_fit_packing", pack)]

#: The stages are not expressible in SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = shared_table(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
