"""The normalized schema and what describes a source."""

from __future__ import annotations

from dataclasses import dataclass, field

# Fields of a normalized row, by how they are read.
REQUIRED = ("id", "timestamp", "level", "message")
STRICT_TEXT = ("logger", "service", "environment", "exception_type", "traceback")
CORRELATION = ("request_id", "trace_id", "job_id", "user_id")
FIELDS = (*REQUIRED, *STRICT_TEXT, *CORRELATION, "attributes")
FILTERABLE = ("service", "logger", "request_id", "trace_id", "job_id")

LOG_SCHEMA = (
    "id string, timestamp timestamp_ntz, level string, message string, logger string, service string, environment string, "
    "exception_type string, traceback string, request_id string, trace_id string, job_id string, user_id string, attributes string, source string"
)


@dataclass(frozen=True)
class SourceSpec:
    """A named source: which of its columns feed which field, and which column numbers its rows."""

    name: str
    field_map: dict[str, str] = field(default_factory=dict)
    position: str | None = None
    priority: int = 0
    format: str = "parquet"
    options: dict[str, str] = field(default_factory=dict)
    odd_timestamps: bool = True

    def column(self, name: str) -> str:
        return self.field_map.get(name, name)
