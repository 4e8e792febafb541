"""Numbered pages of a whole table: rows in the total order in ranges, and where each range begins."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .filters import KEY


@dataclass
class PageIndex:
    """``rows`` are stored in folders by ``part`` with their ``place`` in it; ``parts`` (part, first, n) has a row per part."""

    rows: DataFrame
    parts: DataFrame
    size: int

    def pages(self) -> DataFrame:
        """The manifest: each page with the part and place of its first row, and its number of rows."""
        total = self.parts.agg(F.coalesce(F.max(F.col("first") + F.col("n")), F.lit(0)).alias("total"))
        begins = F.explode(F.sequence(F.ceil(F.col("first") / self.size), F.floor((F.col("first") + F.col("n") - 1) / self.size)))
        starts = self.parts.where(F.ceil(F.col("first") / self.size) * self.size < F.col("first") + F.col("n")).select("part", "first", begins.alias("page"))
        n = F.least(F.lit(self.size), F.col("total") - F.col("page") * self.size)
        # One number beside the parts' rows; the join is on a constant of both.
        joined = starts.withColumn("_one", F.lit(1)).join(F.broadcast(total.withColumn("_one", F.lit(1))), "_one")
        return joined.select("page", "part", (F.col("page") * self.size - F.col("first")).alias("place"), n.cast("int").alias("n"))

    def page(self, number: int) -> DataFrame:
        """Rows of page ``number`` (from 0) in order; only the parts that it touches are read, and of these the rows around it."""
        start, end = number * self.size, (number + 1) * self.size
        touched = self.parts.where((F.col("first") < end) & (F.col("first") + F.col("n") > start)).collect()  # the parts of one page
        if not touched:
            return self.rows.limit(0).drop("part", "place")
        inside = F.lit(False)
        for r in touched:
            inside = inside | ((F.col("part") == r["part"]) & F.col("place").between(start - r["first"], end - 1 - r["first"]))
        low, high = min(start - r["first"] for r in touched), max(end - 1 - r["first"] for r in touched)
        bounds = F.col("part").isin([r["part"] for r in touched]) & F.col("place").between(max(low, 0), high)
        return self.rows.where(bounds & inside).orderBy("part", "place").drop("part", "place")


def write_pages(df: DataFrame, path: str, size: int = 100, parts: int | None = None) -> PageIndex:
    """Store ``df`` in the total order and number its pages of ``size`` rows.

    Rows go to ranges of the order; a row's place is its number in its range, so each task counts its own
    rows only. The ranges' counts are added up over one row per range.
    """
    ranged = df.repartitionByRange(parts, *KEY) if parts else df.repartitionByRange(*KEY)
    ordered = ranged.withColumn("part", F.spark_partition_id()).sortWithinPartitions("part", *KEY)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))  # the number of a row in its partition
    ordered.withColumn("place", place).write.partitionBy("part").parquet(path)
    schema = ordered.drop("part").withColumn("place", place).withColumn("part", F.lit(0)).schema
    rows = df.sparkSession.read.schema(schema).parquet(path)
    counts = rows.groupBy("part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("part")) - F.col("n")  # over one row per range
    return PageIndex(rows, counts.select("part", before.alias("first"), "n"), size)
