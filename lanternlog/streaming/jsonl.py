"""JSON Lines on a stream: good rows and quarantine of each batch, once each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..operators.normalize import shape_jsonl, split
from ..sources.model import SourceSpec
from ..sources.readers import BLANKS, POSITION, RAW


def ingest(lines: DataFrame, spec: SourceSpec, path: str, checkpoint: str) -> DataStreamWriter:
    """A writer, to be started, that brings the lines of a text stream (column value) to ``path``, good and bad rows in one reading.

    A batch is one folder, named by its number and written anew where the batch runs again after a
    failure, so each line is there once. Lines have no number on a stream: an id must be mapped.
    """

    def write(batch: DataFrame, number: int) -> None:
        raw = batch.select(F.trim(F.col("value"), F.lit(BLANKS)).alias(RAW), F.lit(None).cast("long").alias(POSITION)).where(F.col(RAW) != "")
        shaped = shape_jsonl(raw, spec).withColumn("bad", F.col("_reason").isNotNull())
        shaped.write.mode("overwrite").partitionBy("bad").parquet(f"{path}/batch={number}")

    return lines.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def ingested(spark: SparkSession, spec: SourceSpec, path: str) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantine) of the batches so far; each side reads its own folders."""
    shape = shape_jsonl(spark.createDataFrame([], f"{RAW} string, {POSITION} long"), spec)
    rows = spark.read.schema(shape.withColumns({"batch": F.lit(0), "bad": F.lit(True)}).schema).parquet(path)
    good, bad = (rows.where(F.col("bad") == flag).drop("batch", "bad") for flag in (False, True))
    return split(good)[0], split(bad)[1]
