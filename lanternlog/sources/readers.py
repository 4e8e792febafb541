"""Readers: JSON Lines, tables of any Spark format, and the union of sources."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from .model import SourceSpec

RAW, POSITION = "_raw", "_position"


BLANKS = " \t\r\n\f\v"


def read_jsonl(spark: SparkSession, path: str, numbered: bool = True) -> DataFrame:
    """One row per non-blank line: ``_raw``, trimmed, and if asked for its 1-based number in its file.

    Blank and bad lines count. A file may be read in several splits, so a line's number is its
    place in its split plus the lines of the file's splits before, a sum over one row per split;
    where an id is mapped, leave the numbers off and save that second look at the files.
    """
    lines = spark.read.text(path)
    raw = F.trim(F.col("value"), F.lit(BLANKS))
    if not numbered:
        return lines.select(raw.alias(RAW), F.lit(None).cast("long").alias(POSITION)).where(F.col(RAW) != "")
    # Rows of a split follow each other in their partition, so this id less the split's first is the place in the split.
    placed = lines.select(raw.alias(RAW), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("n"))
    splits = placed.groupBy("file", "at").agg(F.min("n").alias("first"), F.count("*").alias("lines"))
    before = F.sum("lines").over(Window.partitionBy("file").orderBy("at")) - F.col("lines")
    shifts = splits.select("file", "at", (before + 1 - F.col("first")).alias("shift"))
    return placed.join(shifts, ["file", "at"]).where(F.col(RAW) != "").select(RAW, (F.col("n") + F.col("shift")).alias(POSITION))


def read_table(spark: SparkSession, spec: SourceSpec, path: str | None = None) -> DataFrame:
    """A table by any format Spark knows: parquet, jdbc (``dbtable`` may be ``schema.table``), orc, a Python data source."""
    reader = spark.read.format(spec.format).options(**spec.options)
    return reader.load(path) if path else reader.load()


def union_sources(frames: list[DataFrame]) -> DataFrame:
    """All rows of all sources, also where ids collide."""
    return reduce(DataFrame.unionByName, frames)
