"""Counts by level, service, logger and time bucket in one pass."""

from __future__ import annotations

import math
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..functions.redaction import RedactionSpec, redact_text
from ..functions.timing import bucket_of
from .filters import Filters, build_predicate, in_window, with_text

DIMENSIONS = ("level", "service", "logger", "time")


def count_dimensions(df: DataFrame, time_bucket: str = "hour", by_source: bool = False) -> DataFrame:
    """(dimension, bucket, n[, source]) from one scan and one shuffle; ``total`` has a null bucket."""
    known = lambda c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit("unknown"))
    keyed = df.select(F.col("level"), known("service").alias("service"), known("logger").alias("logger"), bucket_of(F.col("timestamp"), time_bucket).alias("time"), *(["source"] if by_source else []))
    extra = ["source"] if by_source else []
    sets = [[F.col(c) for c in (d, *extra)] for d in DIMENSIONS] + [[F.col(c) for c in extra]]
    grouped = keyed.groupingSets(sets, *[F.col(c) for c in (*DIMENSIONS, *extra)]).agg(F.count("*").alias("n"), *[F.grouping(d).alias(f"_{d}") for d in DIMENSIONS])
    name, bucket = F.lit("total"), F.lit(None).cast("string")
    for d in DIMENSIONS:
        name, bucket = F.when(F.col(f"_{d}") == 0, d).otherwise(name), F.when(F.col(f"_{d}") == 0, F.col(d)).otherwise(bucket)
    return grouped.select(name.alias("dimension"), bucket.alias("bucket"), "n", *extra)


def cap_groups(counts: DataFrame, cap: int = 100, dimensions: tuple[str, ...] = ("service", "logger")) -> DataFrame:
    """The ``cap`` largest buckets per source of the given dimensions, ties by bucket, with ``truncated``."""
    keys = ["source", "dimension"] if "source" in counts.columns else ["dimension"]
    # Buckets of the other dimensions are partitions of their own, so only capped ones are sorted, and cut before the shuffle.
    capped = F.col("dimension").isin(*dimensions)
    own = Window.partitionBy(*keys, F.when(~capped, F.coalesce("bucket", F.lit(""))))
    ranked = counts.withColumn("_rank", F.row_number().over(own.orderBy(F.desc("n"), "bucket"))).where(F.col("_rank") <= cap + 1)
    ranked = ranked.withColumn("truncated", F.max("_rank").over(own) > cap)
    return ranked.where(F.col("_rank") <= cap).drop("_rank")


def heavy_groups(df: DataFrame, dimension: str, cap: int = 100, tracked: int = 10_000) -> DataFrame:
    """(source, bucket, n, truncated): the ``cap`` largest labels of each source, exact, as ``cap_groups`` has them, without a row a label in the shuffle.

    A frequent-items sketch of ``tracked`` labels a source gives candidates, which are then counted exactly.
    The sketch is wrong by 3.5 rows in its map's size at most, so no other label has more rows than
    that share, or than the last candidate's estimate. Where the ``cap``-th candidate has more, the result is proven;
    the labels of the other sources are counted in full.
    """
    label = F.coalesce(F.nullif(F.col(dimension), F.lit("")), F.lit("unknown"))
    rows, k = df.select("source", label.alias("bucket")), min(4 * cap, tracked)
    sketch = F.expr(f"approx_top_k(bucket, {k}, {tracked})")
    sketched = rows.groupBy("source").agg(F.count("*").alias("rows"), sketch.alias("top")).collect()  # k items a source
    share = 3.5 / (1 << math.ceil(math.log2(tracked / 0.75)))
    over = {r["source"]: max(r["rows"] * share, r["top"][-1]["count"] if len(r["top"]) == k else 0) for r in sketched}
    candidates = df.sparkSession.createDataFrame([(r["source"], t["item"]) for r in sketched for t in r["top"]], "source string, bucket string")
    # At most k labels a source.
    counts = rows.join(F.broadcast(candidates), ["source", "bucket"]).groupBy("source", "bucket").agg(F.count("*").alias("n"))
    order = Window.partitionBy("source").orderBy(F.desc("n"), "bucket")
    ranked = counts.withColumn("r", F.row_number().over(order)).where(F.col("r") <= cap + 1).collect()  # cap + 1 rows a source
    proven = [r["source"] for r in ranked if r["r"] == cap and r["n"] > over[r["source"]] and any(x["source"] == r["source"] and x["r"] == cap + 1 for x in ranked)]
    kept = [(r["source"], r["bucket"], r["n"], True) for r in ranked if r["source"] in proven and r["r"] <= cap]
    sure = df.sparkSession.createDataFrame(kept, "source string, bucket string, n long, truncated boolean")
    rest = rows.where(~F.col("source").isin(proven)) if proven else rows
    if len(proven) == len(sketched):
        return sure
    full = rest.groupBy("source", "bucket").agg(F.count("*").alias("n")).withColumn("dimension", F.lit(dimension))
    return sure.unionByName(cap_groups(full, cap, (dimension,)).select("source", "bucket", "n", "truncated"))


def redact_labels(counts: DataFrame, spec: RedactionSpec | None = None) -> DataFrame:
    """Labels masked after counting; those that become equal are summed. Time buckets stay as they are."""
    spec = spec or RedactionSpec()
    masked = F.when(F.col("dimension") == "time", F.col("bucket")).otherwise(redact_text(F.col("bucket"), spec))
    keys = [c for c in counts.columns if c not in ("bucket", "n", "truncated")]
    flags = [F.max("truncated").alias("truncated")] if "truncated" in counts.columns else []
    return counts.withColumn("bucket", masked).groupBy(*keys, "bucket").agg(F.sum("n").alias("n"), *flags)


def log_stats(df: DataFrame, f: Filters, time_bucket: str = "hour", spec: RedactionSpec | None = None) -> DataFrame:
    rows = df.where(build_predicate(f))
    rows = with_text(rows, f.text, spec) if f.text else rows
    return redact_labels(count_dimensions(rows, time_bucket), spec)


def recent_stats(df: DataFrame, f: Filters, now: datetime | None = None, time_bucket: str = "hour", spec: RedactionSpec | None = None) -> DataFrame:
    """``log_stats`` in the last 24 hours before ``now``, or before the end asked for, unless a start is given."""
    return log_stats(df, in_window(f, now), time_bucket, spec)


def merged_stats(df: DataFrame, f: Filters, time_bucket: str = "hour", cap: int = 100, spec: RedactionSpec | None = None) -> DataFrame:
    """Counts over several sources: services and loggers are cut to ``cap`` in each source, then masked and summed."""
    counts = cap_groups(count_dimensions(df.where(build_predicate(f)), time_bucket, by_source=True), cap)
    return redact_labels(counts.drop("source"), spec)
