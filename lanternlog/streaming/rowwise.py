"""Normalizing, filtering and redacting keep no state, so they run unchanged on a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.redaction import RedactionSpec
from ..operators.filters import Filters, build_predicate
from ..operators.normalize import normalize_table
from ..operators.redact import redact_entries
from ..sources.model import SourceSpec


def redacted_stream(raw: DataFrame, source: SourceSpec, f: Filters, spec: RedactionSpec | None = None) -> DataFrame:
    """Good rows of a streaming table, filtered and masked, ready for ``writeStream``."""
    good, _ = normalize_table(raw, source)
    return redact_entries(good.where(build_predicate(f)), spec)
