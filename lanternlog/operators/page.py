"""Ordered pages of rows: newest first, one id's timeline, whole exports."""

from __future__ import annotations

import json
from dataclasses import dataclass, replace
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..functions.redaction import RedactionSpec
from .filters import KEY, Cursor, Filters, after_cursor, build_predicate, holds, in_window, with_text
from .redact import redact_entries

DEFAULT_LIMIT, HARD_LIMIT = 100, 500
CORRELATIONS = ("request_id", "trace_id", "job_id")


def effective_limit(asked: int | None, most: int = DEFAULT_LIMIT) -> int:
    limit = min(asked if asked is not None else most, most, HARD_LIMIT)
    if limit < 1:
        raise ValueError("limit must be at least 1")
    return limit


def ordering(descending: bool) -> list[Column]:
    return [F.col(c).desc() if descending else F.col(c).asc() for c in KEY]


@dataclass
class Page:
    """``rows`` holds one row more than ``limit`` where there is more."""

    rows: DataFrame
    limit: int
    descending: bool

    def kept(self) -> DataFrame:
        return self.rows.orderBy(*ordering(self.descending)).limit(self.limit)

    def next_cursor(self) -> str | None:
        """Cursor of the last kept row, None where the page is the last; at most ``limit`` + 1 keys are fetched."""
        keys = self.rows.orderBy(*ordering(self.descending)).select(*KEY).take(self.limit + 1)
        return Cursor(*keys[self.limit - 1]).encode() if len(keys) > self.limit else None

    def record(self, f: Filters | None = None, warnings: DataFrame | None = None) -> DataFrame:
        """One row: entries (a list of rows in order), count, has_more, next_place (the last kept key where there is more), next_cursor.

        With ``f`` also filters, its terms as a map of texts; with ``warnings`` (place, text; bounded by
        ``summarize_warnings``) also these texts in order.
        """
        keys = F.struct(*KEY)
        order = F.array_sort("all", lambda a, b: F.when(a["_key"] == b["_key"], 0).when((a["_key"] > b["_key"]) == F.lit(self.descending), -1).otherwise(1))
        # Only a page's rows, ``limit`` + 1 at most, are gathered.
        got = self.rows.select(F.struct(keys.alias("_key"), *self.rows.columns).alias("row")).agg(F.collect_list("row").alias("all")).select(order.alias("all"))
        kept, more = F.slice("all", 1, self.limit), F.size("all") > self.limit
        out = got.select(
            F.transform(kept, lambda r: F.struct(*[r[c].alias(c) for c in self.rows.columns])).alias("entries"), F.size(kept).alias("count"), more.alias("has_more"),
            F.when(more, F.get("all", F.lit(self.limit - 1))["_key"]).alias("next_place"),
        )
        out = out.withColumn("next_cursor", Cursor.encoded(F.col("next_place")))
        if f:
            terms = {**{k: str(v) for k, v in vars(f).items() if v and k != "levels"}, **({"levels": ",".join(f.level_set())} if f.level_set() else {})}
            out = out.withColumn("filters", F.from_json(F.lit(json.dumps(terms)), "map<string,string>"))
        if warnings is not None:
            # A bounded list; the note on how many more there are has no place and comes last.
            texts = warnings.agg(F.array_sort(F.collect_list(F.struct(F.col("place").isNull().alias("note"), "place", "text"))).alias("w")).select(F.transform("w", lambda w: w["text"]).alias("warnings"))
            out = out.withColumn("_one", F.lit(1)).join(texts.withColumn("_one", F.lit(1)), "_one").drop("_one")
        return out


def page(df: DataFrame, f: Filters, limit: int | None = None, cursor: str | None = None, spec: RedactionSpec | None = None, descending: bool = True, most: int = DEFAULT_LIMIT) -> Page:
    """One page. Without text only the page's own rows are redacted; with text redaction comes first."""
    n = effective_limit(limit, most)
    rows = df.where(build_predicate(f))
    if cursor:
        rows = rows.where(after_cursor(Cursor.decode(cursor), descending))
    if f.text:
        rows = with_text(rows, f.text, spec).drop("traceback", "attributes")
        return Page(rows.orderBy(*ordering(descending)).limit(n + 1), n, descending)
    return Page(redact_entries(rows.orderBy(*ordering(descending)).limit(n + 1), spec), n, descending)


def recent(df: DataFrame, f: Filters, now: datetime | None = None, limit: int | None = None, cursor: str | None = None, spec: RedactionSpec | None = None, most: int = DEFAULT_LIMIT) -> Page:
    """``search`` in the last 24 hours before ``now``, or before the end asked for, unless a start is given."""
    return search(df, in_window(f, now), limit, cursor, spec, most)


def search(df: DataFrame, f: Filters, limit: int | None = None, cursor: str | None = None, spec: RedactionSpec | None = None, most: int = DEFAULT_LIMIT) -> Page:
    return page(df, f, limit, cursor, spec, True, most)


def timeline(df: DataFrame, f: Filters, limit: int | None = None, cursor: str | None = None, spec: RedactionSpec | None = None, most: int = DEFAULT_LIMIT) -> Page:
    if not any(getattr(f, c) for c in CORRELATIONS):
        raise ValueError("a request, trace or job id is needed")
    return page(df, f, limit, cursor, spec, False, most)


def export_ordered(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """All rows in the total order, range-partitioned, ready to be written; no paging loop."""
    ranged = df.repartitionByRange(partitions, *KEY) if partitions else df.repartitionByRange(*KEY)
    return ranged.sortWithinPartitions(*KEY)


def scan_window(df: DataFrame, per_source: int, newest: bool = True) -> DataFrame:
    """The newest (or earliest) rows of each source, with ``incomplete`` where some were left out."""
    order = Window.partitionBy("source").orderBy(*[F.col(c).desc() if newest else F.col(c).asc() for c in ("timestamp", "id")])
    # One row more than kept tells whether the source has more; the limit prunes before the shuffle.
    first = df.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= per_source + 1)
    over = first.groupBy("source").agg((F.max("_rank") > per_source).alias("incomplete"))
    return first.where(F.col("_rank") <= per_source).join(F.broadcast(over), "source").drop("_rank")


def bounded_scan(
    df: DataFrame, f: Filters, max_scan: int, limit: int | None = None, cursor: str | None = None, spec: RedactionSpec | None = None, descending: bool = True, most: int = DEFAULT_LIMIT
) -> DataFrame:
    """One row about the first ``max_scan`` rows of the other terms, after ``cursor``: entries that hold the text and where the scan got to.

    entries, count and has_more are a page's. ``scanned`` rows were looked at, ``incomplete`` tells that rows
    lie beyond them, whether or not any was found. ``next_place`` is where to go on, also encoded as
    ``next_cursor``: the last entry where there are more, else the last row scanned where rows lie
    beyond, else null. The bound is the feature: a text search whose cost doesn't follow the history.
    """
    n, spec, order = effective_limit(limit, most), spec or RedactionSpec(), ordering(descending)
    rows = df.where(build_predicate(replace(f, text=None)))
    if cursor:
        rows = rows.where(after_cursor(Cursor.decode(cursor), descending))
    # The window and the sums are over max_scan + 1 rows at most.
    ranked = rows.orderBy(*order).limit(max_scan + 1).withColumn("_n", F.row_number().over(Window.orderBy(*order)))
    key = F.struct(*KEY)
    full = redact_entries(ranked.withColumn("_place", key), spec, full=True)
    shown = [c for c in full.columns if c not in ("_n", "_place", "traceback", "attributes")]
    row = F.struct(*full.columns)
    found = F.col("_n") <= max_scan
    if f.text:
        found = found & F.get(F.transform(F.array(row), lambda r: holds(r, full.drop("_n", "_place"), f.text)), F.lit(0))
    marked = full.select("_n", "_place", F.struct(*shown).alias("entry"), found.alias("found"))
    nth = F.count(F.when(F.col("found"), 1)).over(Window.orderBy("_n"))
    kept = F.when(F.col("found") & (F.col("nth") <= n + 1), F.struct("_n", "_place", "entry"))
    got = marked.withColumn("nth", nth).agg(
        F.array_sort(F.collect_list(kept)).alias("hits"), F.coalesce(F.max("_n"), F.lit(0)).alias("seen"),
        F.max_by("_place", F.when(F.col("_n") <= max_scan, F.col("_n"))).alias("last_place"),
    )
    more, incomplete = F.size("hits") > n, F.col("seen") > max_scan
    at = F.when(more, F.get("hits", F.lit(n - 1))["_place"]).when(incomplete, F.col("last_place"))
    entries = F.slice(F.transform("hits", lambda h: h["entry"]), 1, n)
    out = got.select(
        entries.alias("entries"), F.least(F.size("hits"), F.lit(n)).alias("count"), more.alias("has_more"), F.least("seen", F.lit(max_scan)).alias("scanned"), incomplete.alias("incomplete"),
        at.alias("next_place"),
    )
    return out.withColumn("next_cursor", Cursor.encoded(F.col("next_place")))


def bounded_search(df: DataFrame, f: Filters, max_scan: int, limit: int | None = None, spec: RedactionSpec | None = None, most: int = DEFAULT_LIMIT) -> DataFrame:
    """The entries of ``bounded_scan`` as rows, each with ``incomplete``; where none is found only the scan's row tells."""
    return bounded_scan(df, f, max_scan, limit, spec=spec, most=most).select(F.explode("entries").alias("e"), "incomplete").select("e.*", "incomplete")


def write_evidence(df: DataFrame, path: str, spec: RedactionSpec | None = None, format: str = "parquet") -> None:
    """Masked rows in folders by date, each sorted by time; the shuffle is by date and a part of the day, so a busy day is many tasks."""
    shown = redact_entries(df, spec, full=True).withColumn("date", F.col("timestamp").cast("date"))
    dealt = shown.repartition("date", F.hour("timestamp")).sortWithinPartitions("date", *KEY)
    dealt.write.format(format).partitionBy("date").mode("append").save(path)
