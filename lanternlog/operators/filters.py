"""Predicates on normalized rows."""

from __future__ import annotations

import base64
import json
from dataclasses import dataclass, replace
from datetime import UTC, datetime, timedelta
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.redaction import RedactionSpec, is_sensitive, raw_holds
from ..functions.timing import iso_z
from ..sources.model import FILTERABLE
from .redact import redact_entries

KEY = ("timestamp", "id", "source")


@dataclass(frozen=True)
class Filters:
    """All terms must hold. Empty or missing ones don't filter; times are UTC and inclusive."""

    levels: str | tuple[str, ...] | None = None
    start: datetime | None = None
    end: datetime | None = None
    service: str | None = None
    logger: str | None = None
    request_id: str | None = None
    trace_id: str | None = None
    job_id: str | None = None
    text: str | None = None

    def level_set(self) -> list[str]:
        given = self.levels.split(",") if isinstance(self.levels, str) else self.levels or ()
        return sorted({x.strip().upper() for x in given} - {""})


def level_list(text: Column) -> Column:
    """Column form of the level list: trimmed, upper case, without blanks."""
    return F.array_distinct(F.filter(F.transform(F.split(text, ","), lambda x: F.upper(F.trim(x))), lambda x: x != ""))


def window_of(start: datetime | None, end: datetime | None, now: datetime, width: timedelta = timedelta(hours=24)) -> tuple[datetime, datetime]:
    """The time range asked for, with the default width before ``end`` or ``now``."""
    end = end or now
    start = start or end - width
    if start > end:
        raise ValueError("start must not be after end")
    return start, end


def in_window(f: Filters, now: datetime | None = None, width: timedelta = timedelta(hours=24)) -> Filters:
    """``f`` with the default window before its end, or before ``now``, where it has no start."""
    start, end = window_of(f.start, f.end, now or datetime.now(UTC).replace(tzinfo=None), width)
    return replace(f, start=start, end=end)


def build_predicate(f: Filters) -> Column:
    """Terms on bare columns, so that the scan can take them over."""
    out = F.lit(True)
    if levels := f.level_set():
        out = out & F.col("level").isin(*levels)
    for value, op in ((f.start, "__ge__"), (f.end, "__le__")):
        if value is not None:
            out = out & getattr(F.col("timestamp"), op)(F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz"))
    for name in FILTERABLE:
        if value := getattr(f, name):
            out = out & (F.col(name) == value)
    return out


def where_levels(df: DataFrame, column: str, levels: str | tuple[str, ...], most: int = 64) -> DataFrame:
    """Rows of a raw source whose ``column`` is one of ``levels`` in any spelling, as a term that the scan can take over.

    One distinct over that column finds the spellings; with more than ``most`` of them the term is on the
    upper-case form, which no scan takes. Without levels all rows are kept.
    """
    wanted = Filters(levels=levels).level_set()
    if not wanted:
        return df
    form = F.upper(F.col(column)).isin(*wanted)
    found = [r[0] for r in df.select(column).where(form).distinct().limit(most + 1).collect()]  # most + 1 rows at most
    return df.where(F.col(column).isin(*found) if len(found) <= most else form)


@dataclass(frozen=True)
class Cursor:
    """Place of the last row of a page in the total order."""

    timestamp: datetime
    id: str
    source: str = ""

    def encode(self) -> str:
        data = json.dumps({"ts": self.timestamp.isoformat(), "id": self.id, "src": self.source}, separators=(",", ":"))
        return base64.urlsafe_b64encode(data.encode()).decode()

    @staticmethod
    def encoded(place: Column) -> Column:
        """``encode`` for a struct column with the fields of ``KEY``."""
        at = place["timestamp"]
        whole = F.date_trunc("second", at) == at
        stamp = F.when(whole, F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss")).otherwise(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
        data = F.to_json(F.struct(stamp.alias("ts"), place["id"].alias("id"), place["source"].alias("src")))
        return F.when(place.isNotNull(), F.translate(F.base64(data.cast("binary")), "+/\r\n", "-_"))

    @classmethod
    def decode(cls, text: str) -> Cursor:
        try:
            data = json.loads(base64.urlsafe_b64decode(text.encode()))
            return cls(datetime.fromisoformat(data["ts"]), str(data["id"]), data.get("src", ""))
        except (ValueError, KeyError, TypeError) as e:
            raise ValueError("malformed cursor") from e


def after_cursor(c: Cursor, descending: bool) -> Column:
    """Strictly after ``c``; the bound on the bare timestamp is what the scan takes over."""
    stamp, op = F.lit(c.timestamp.isoformat(sep=" ")).cast("timestamp_ntz"), "__lt__" if descending else "__gt__"
    past = lambda name, value: getattr(F.col(name), op)(value)
    bound = F.col("timestamp") <= stamp if descending else F.col("timestamp") >= stamp
    return bound & (past("timestamp", stamp) | ((F.col("timestamp") == stamp) & (past("id", F.lit(c.id)) | ((F.col("id") == c.id) & past("source", F.lit(c.source))))))


def id_is(value: str) -> Column:
    """An id, or a source and its id. Both terms are on bare columns, so the scan can take them over."""
    out = F.col("id") == value
    for at in (i for i, c in enumerate(value) if c == ":"):
        out = out | ((F.col("source") == value[:at]) & (F.col("id") == value[at + 1 :]))
    return out


def json_blob(df: DataFrame) -> Column:
    """The row as spaced ASCII JSON in lower case, nulls left out."""
    columns = [c for c in df.columns if c != "timestamp"]

    @F.pandas_udf("string")
    def run(rows: pd.DataFrame) -> pd.Series:
        def one(row: dict) -> str:
            out = {k: v for k, v in row.items() if isinstance(v, str)}
            if "attributes" in out:
                out["attributes"] = json.loads(out["attributes"])
            return json.dumps(out, default=str).lower()

        return pd.Series([one(r) for r in rows.to_dict("records")], dtype=object)

    return run(F.struct(iso_z(F.col("timestamp")).alias("timestamp"), *columns))


#: Attributes that masking may write anew: escapes, nested values, numbers with more than one spelling.
REWRITTEN = r"(?s)\\|.[\[{]|\d[eE]|[0-9.]{16}|\.0000"


def may_hold(df: DataFrame, text: str, spec: RedactionSpec) -> Column | None:
    """A test of the raw columns that no row fails whose masked columns hold ``text``; None where there is no such test.

    It says nothing about a row that passes: a secret may hold the text. Attributes are written
    anew from their parts, so a text with JSON marks may be found across parts, and rows with parts of
    another spelling pass unseen.
    """
    if not raw_holds(text, spec):
        return None
    needle = F.lit(text.lower())
    strings = [name for name, kind in df.dtypes if kind == "string" and not is_sensitive(name, spec)]
    tests = [F.coalesce(F.contains(F.lower(F.col(c)), needle), F.lit(False)) for c in strings if c != "attributes"]
    if "attributes" in strings:
        given = F.col("attributes")
        test = given.isNotNull() if set(text) & set('"\\{}[],:') else F.contains(F.lower(given), needle) | given.rlike(REWRITTEN)
        tests.append(F.coalesce(test, F.lit(False)))
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def with_text(df: DataFrame, text: str, spec: RedactionSpec | None = None, match: str = "values") -> DataFrame:
    """Fully redacted rows that contain ``text``, whatever its case. A secret can't be searched.

    ``match='json'`` looks in the row's JSON text, field names included. Otherwise rows that can't hold the
    text are left out before any rule runs, where the raw columns tell so; what is found is found in masked columns only.
    """
    spec = spec or RedactionSpec()
    sure = may_hold(df, text, spec) if match == "values" else None
    full = redact_entries(df if sure is None else df.where(sure), spec, full=True)
    if match == "json":
        return full.where(F.contains(json_blob(full), F.lit(text.lower())))
    # One pass: the masked row is built once, looked at, and kept or not; a filter would build it again.
    return full.select(F.inline(F.filter(F.array(F.struct(*full.columns)), lambda row: holds(row, full, text))))


def holds(row: Column, df: DataFrame, text: str) -> Column:
    """Whether a string of ``row``, a struct with the columns of ``df``, has ``text`` in it, whatever its case."""
    strings = [name for name, kind in df.dtypes if kind == "string"]
    return reduce(lambda a, b: a | b, [F.coalesce(F.contains(F.lower(row[c]), F.lit(text.lower())), F.lit(False)) for c in strings], F.lit(False))
