"""Shared pieces of the training-data operators: scratch tables, checked broadcasts, splits."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side with at most this many rows and characters may be broadcast; larger ones are shuffled.
BROADCAST_ROWS, BROADCAST_CHARS = 500_000, 32_000_000


#: Folder of the innermost ``scratch`` block; empty outside.
_folder: ContextVar[str] = ContextVar("scratch_folder", default="")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names; a temporary one only in local mode with none named (tests)."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = "file://" + tempfile.mkdtemp(prefix="lanternlog-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder of the shared store, whatever store that is."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def materialize(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage is cut, lost executors don't matter."""
    path = f"{_folder.get() or scratch_root(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """What ``materialize`` writes inside is deleted at the end; the yielded function writes a table that stays."""
    outer = _folder.get()
    folder = f"{outer or scratch_root(spark)}/scratch-{uuid.uuid4().hex}"
    mark = _folder.set(folder)

    def keep(df: DataFrame, name: str) -> DataFrame:
        inner = _folder.set(outer)
        try:
            return materialize(df, name)
        finally:
            _folder.reset(inner)

    try:
        yield keep
    finally:
        _folder.reset(mark)
        delete(spark, folder)


def checked_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS, chars: int = BROADCAST_CHARS) -> DataFrame:
    """``df`` (already materialized) with a broadcast hint only when it has at most ``rows`` rows of ``chars`` characters of JSON in all."""
    if df.limit(rows + 1).count() > rows:
        return df
    size = df.agg(F.sum(F.length(F.to_json(F.struct(*df.columns))))).first()[0] or 0
    return F.broadcast(df) if size <= chars else df


def drop_ids(docs: DataFrame, ids: DataFrame, name: str) -> DataFrame:
    """``docs`` without the rows whose doc_id is in ``ids`` (one column doc_id); a null doc_id is kept."""
    ids = materialize(ids.where("doc_id is not null").distinct(), name)
    return docs.join(checked_broadcast(ids), "doc_id", "left_anti").select(docs.columns)


def text_hash() -> Column:
    return F.sha2(whole_text(), 256)


def drop_texts(docs: DataFrame, texts: DataFrame, name: str) -> DataFrame:
    """As ``drop_ids``, but only the rows whose doc_id and ``text_hash`` are in ``texts`` (doc_id, text_sha256)."""
    texts = materialize(texts.where("doc_id is not null").select("doc_id", F.col("text_sha256").alias("_sha")).distinct(), name)
    return docs.withColumn("_sha", text_hash()).join(checked_broadcast(texts), ["doc_id", "_sha"], "left_anti").select(docs.columns)


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id's decimal text, modulo n; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def whole_text(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once a row, even where ``body`` uses it inside a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
