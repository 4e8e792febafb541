"""A bounded, redacted list of warnings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.redaction import RedactionSpec, redact_text

MOST, MOST_CHARS = 20, 200


def summarize_warnings(df: DataFrame, spec: RedactionSpec | None = None, most: int = MOST, chars: int = MOST_CHARS) -> DataFrame:
    """(place, text) of ``df`` (place, text): masked, cut, the first of equal ones, then how many more there are."""
    masked = redact_text(F.col("text"), spec or RedactionSpec())
    cut = F.when(F.length(masked) > chars, F.concat(F.substring(masked, 1, chars), F.lit("… [truncated]"))).otherwise(masked)
    distinct = df.select("place", cut.alias("text")).groupBy("text").agg(F.min("place").alias("place"))
    kept = distinct.orderBy("place", "text").limit(most).select("place", "text")
    more = distinct.agg((F.count("*") - most).alias("k")).where("k > 0")
    return kept.unionByName(more.select(F.lit(None).cast("long").alias("place"), F.concat(F.lit("["), F.col("k"), F.lit(" more warnings suppressed]")).alias("text")))
