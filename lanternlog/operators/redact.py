"""Redaction of normalized rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.redaction import MASK, RedactionSpec, is_sensitive, redact_attributes, redact_text


def redacted_column(df: DataFrame, name: str, spec: RedactionSpec) -> Column:
    if is_sensitive(name, spec):
        return F.when(F.col(name).isNotNull(), F.lit(MASK)).alias(name)
    if name == "attributes":
        return redact_attributes(F.col(name), spec).alias(name)
    return redact_text(F.col(name), spec).alias(name) if dict(df.dtypes)[name] == "string" else F.col(name)


def redact_entries(df: DataFrame, spec: RedactionSpec | None = None, full: bool = False) -> DataFrame:
    """Masked rows; without ``full`` the traceback and attributes are dropped first, at no cost."""
    spec = spec or RedactionSpec()
    df = df if full else df.drop("traceback", "attributes")
    return df.select(*[redacted_column(df, c, spec) for c in df.columns])
