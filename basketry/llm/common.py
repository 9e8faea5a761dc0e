"""Helpers shared by the corpus operators."""

from __future__ import annotations

import string
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.session import ensure_checkpoint_dir

# A word is a maximal run of characters other than the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
WHITE_SPACE = " \t\n\x0b\f\r"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only, whatever the locale."""
    return F.translate(col, string.ascii_uppercase, string.ascii_lowercase)


def shared_path(spark: SparkSession, tag: str) -> str:
    """A new folder under ``spark.checkpoint.dir``, the folder that all executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{tag}-{uuid.uuid4().hex}"


def shared_table(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts the lineage: after a lost executor, later steps read the files again instead of
    repeating what made them.
    """
    spark = df.sparkSession
    path = shared_path(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or a longer one if ``df`` has it."""
    while name.lower() in (c.lower() for c in df.columns):
        name += "_"
    return name


def partitions_for(rows: int, per_task: int, least: int = 1) -> int:
    """Number of tasks so that each has about ``per_task`` rows."""
    return max(least, -(-rows // per_task))


def in_blocks(frames: Iterator[pd.DataFrame], key: str, most: int) -> Iterator[pd.DataFrame]:
    """Cut a stream of frames sorted by ``key`` into frames of whole keys with about ``most`` rows.

    Rows of one key are never split; the caller bounds how many rows a key can have.
    """
    held: list[pd.DataFrame] = []
    n = 0
    for frame in frames:
        while len(frame):
            if n < most:
                held.append(frame)
                n += len(frame)
                break
            last = held[-1][key].iloc[-1]
            same = int((frame[key] == last).cumprod().sum())
            if same:
                held.append(frame.iloc[:same])
                n += same
            frame = frame.iloc[same:]
            if len(frame):
                yield pd.concat(held, ignore_index=True)
                held, n = [], 0
    if held:
        yield pd.concat(held, ignore_index=True)
