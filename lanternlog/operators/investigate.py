"""Investigations as joins: from errors to whole sequences, for one id or a table of ids."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..functions.redaction import RedactionSpec
from ..sources.shared import written
from .filters import id_is
from .page import CORRELATIONS
from .redact import redact_entries

ORDER = ("timestamp", "id", "source")
TROUBLE = ("ERROR", "WARNING")


def expand_errors(df: DataFrame, levels: tuple[str, ...] = TROUBLE, on: tuple[str, ...] = CORRELATIONS) -> DataFrame:
    """Every row that shares a request, trace or job id with a row of the given levels; rows that repeat a (source, id) all stay.

    Null and empty ids never match. Each id kind adds one flag, by a join on its distinct ids, so
    a row found by several kinds is still one row.
    """
    out, flags = df, []
    for name in on:
        given = F.nullif(F.col(name), F.lit(""))
        ids = df.where(F.col("level").isin(*levels)).select(given.alias(f"_{name}")).where(f"`_{name}` is not null").distinct().withColumn(f"_in_{name}", F.lit(True))
        out = out.join(ids, given == ids[f"_{name}"], "left").drop(f"_{name}")
        flags.append(F.coalesce(F.col(f"_in_{name}"), F.lit(False)))
    return out.where(reduce(lambda a, b: a | b, flags)).select(df.columns)


def bulk_timelines(df: DataFrame, ids: DataFrame, on: str, n: int) -> DataFrame:
    """The first ``n`` rows of each id of ``ids`` (one column ``on``), oldest first, with ``rank``."""
    wanted = ids.where(f"`{on}` is not null").distinct()
    order = Window.partitionBy(on).orderBy(*ORDER)
    return df.join(wanted, on, "left_semi").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def timeline_gaps(df: DataFrame, on: str) -> DataFrame:
    """Narrow reading of each timeline: the level before, seconds since the event before, errors so far.

    Only keys and levels go through the window; join the payload back where it is needed.
    """
    order = Window.partitionBy(on).orderBy(*ORDER)
    micros = F.timestamp_diff("MICROSECOND", F.lag("timestamp").over(order), F.col("timestamp"))
    return df.where(f"`{on}` is not null and `{on}` <> ''").select(
        on, *ORDER, "level", F.lag("level").over(order).alias("level_before"), (micros / 1_000_000).alias("gap_seconds"),
        F.count_if(F.col("level") == "ERROR").over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("errors_so_far"),
    )


def timeline_gaps_in_ranges(df: DataFrame, on: str, path: str, ranges: int | None = None) -> DataFrame:
    """``timeline_gaps`` for ids that hold a large share of all rows: no task has more than one range of (id, time).

    Rows are dealt to ranges of (id, order) and written to ``path`` with their range, so that both readings
    below see the same ranges. Each range counts for itself; what lies before an id's rows in a range,
    its last row and its errors, comes from a sum over one row per id and range, and only where an id
    goes on from an earlier range, which happens once a range at most.
    """
    named = df.where(f"`{on}` is not null and `{on}` <> ''").select(on, *ORDER, "level")
    ranged = named.repartitionByRange(ranges, on, *ORDER) if ranges else named.repartitionByRange(on, *ORDER)
    rows = written(ranged.withColumn("_range", F.spark_partition_id()), path)
    error, row = F.col("level") == "ERROR", F.struct(*ORDER, "level")
    per_range = rows.groupBy(on, "_range").agg(F.max(row).alias("last"), F.count_if(error).alias("errors"))
    ends = per_range.join(per_range.groupBy(on).agg(F.count("*").alias("n")).where("n > 1").select(on), on, "left_semi")
    earlier = Window.partitionBy(on).orderBy("_range")
    carried = ends.select(
        on, "_range", F.lag("last").over(earlier).alias("last"), (F.sum("errors").over(earlier) - F.col("errors")).alias("errors"),
    ).where("last is not null")
    within = Window.partitionBy("_range", on).orderBy(*ORDER)
    local = rows.select(
        "_range", on, *ORDER, "level", F.lag(F.struct("timestamp", "level")).over(within).alias("before"),
        F.count_if(error).over(within.rowsBetween(Window.unboundedPreceding, 0)).alias("errors_here"),
    )
    # At most one row a range: the id that its first row goes on with.
    out = local.join(F.broadcast(carried), ["_range", on], "left")
    before = F.coalesce("before", F.when(F.col("last").isNotNull(), F.struct("last.timestamp", "last.level")))
    micros = F.timestamp_diff("MICROSECOND", before["timestamp"], F.col("timestamp"))
    return out.select(on, *ORDER, "level", before["level"].alias("level_before"), (micros / 1_000_000).alias("gap_seconds"), (F.col("errors_here") + F.coalesce("errors", F.lit(0))).alias("errors_so_far"))


def timeline_summary(df: DataFrame, on: str) -> DataFrame:
    """Per id: first and last time, rows, errors, id of the first error. Partial sums before the shuffle."""
    error = F.col("level") == "ERROR"
    return df.where(f"`{on}` is not null and `{on}` <> ''").groupBy(on).agg(
        F.min("timestamp").alias("first_ts"), F.max("timestamp").alias("last_ts"), F.count("*").alias("n"), F.count_if(error).alias("n_errors"),
        F.min(F.when(error, F.struct(*ORDER)))["id"].alias("first_error_id"),
    )


def bulk_detail(df: DataFrame, ids: DataFrame, spec: RedactionSpec | None = None, priority: dict[str, int] | None = None) -> DataFrame:
    """The redacted row of each ``lookup`` of ``ids``: by id or ``source:id``, first source by priority; ``found`` tells the rest.

    Of rows that share an id in one source the first by ``position`` (of ``normalize``, as a number where it is one) counts where ``df`` has that column, else by time.
    """
    ranks = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for p in (priority or {"": 0}).items() for x in p]), F.col("source")), F.lit(1 << 30))
    by_position = [F.col("position").try_cast("long"), F.col("position")] if "position" in df.columns else []
    # The ids are split at every colon into (source, id); the log is joined once, on its id.
    colons = F.filter(F.sequence(F.lit(1), F.length("lookup")), lambda i: F.substring(F.col("lookup"), i, F.lit(1)) == ":")
    own = F.array(F.struct(F.lit(None).cast("string").alias("_of"), F.col("lookup").alias("id")))
    split = F.transform(colons, lambda i: F.struct(F.substring(F.col("lookup"), F.lit(1), i - 1).alias("_of"), F.substring(F.col("lookup"), i + 1, F.length("lookup")).alias("id")))
    asked = ids.select("lookup").where("lookup <> ''").distinct().select("lookup", F.inline(F.concat(own, split)))
    hits = df.join(asked, "id").where(F.col("_of").isNull() | (F.col("_of") == F.col("source"))).select("*", ranks.alias("_rank"))
    order = Window.partitionBy("lookup").orderBy("_rank", "source", *by_position, "timestamp")
    first = hits.withColumn("_n", F.row_number().over(order)).where("_n = 1").select("lookup", *df.columns)
    # The lookup key rides along in a struct, which redaction leaves as it is.
    shown = redact_entries(first.withColumn("_key", F.struct("lookup")).drop("lookup"), spec, full=True)
    shown = shown.withColumn("lookup", F.col("_key.lookup")).drop("_key")
    return ids.select("lookup").distinct().join(shown, "lookup", "left").withColumn("found", F.col("id").isNotNull())


def detail(df: DataFrame, lookup: str, spec: RedactionSpec | None = None, priority: dict[str, int] | None = None) -> DataFrame:
    """The redacted row of one id or ``source:id``; the id goes down to the scan. One row, with ``found`` false if there is none."""
    ids = df.sparkSession.createDataFrame([(lookup,)], "lookup string")
    return bulk_detail(df.where(id_is(lookup)), ids, spec, priority)


def deploy_compare(df: DataFrame, deploys: DataFrame, seconds: int, by: tuple[str, ...] = ("level",)) -> DataFrame:
    """Counts before and after each deploy (deploy_id, at) in windows of ``seconds``; the instant itself is after.

    Rows and deploys meet on bins as long as the window, so any number of deploys joins by key.
    """
    def bin_of(t):
        return F.floor(F.timestamp_diff("SECOND", F.expr("timestamp_ntz'1970-01-01 00:00:00'"), t) / seconds)

    near = deploys.select("deploy_id", "at", F.explode(F.array(*[bin_of(F.col("at")) + d for d in (-1, 0, 1)])).alias("_bin"))
    gap = F.timestamp_diff("MICROSECOND", F.col("at"), F.col("timestamp"))
    joined = df.select("timestamp", *by, bin_of(F.col("timestamp")).alias("_bin")).join(near, "_bin").withColumn("_gap", gap)
    inside = joined.where(F.col("_gap").between(-seconds * 1_000_000, seconds * 1_000_000))
    return inside.groupBy("deploy_id", *by).agg(F.count_if(F.col("_gap") < 0).alias("n_before"), F.count_if(F.col("_gap") >= 0).alias("n_after"))


def new_families(counts: DataFrame) -> DataFrame:
    """``change`` of each family of ``deploy_compare``: new, gone, increased, decreased or same."""
    b, a = F.col("n_before"), F.col("n_after")
    return counts.withColumn("change", F.when(b == 0, "new").when(a == 0, "gone").when(a > b, "increased").when(a < b, "decreased").otherwise("same"))


def widespread(df: DataFrame, on: str = "job_id") -> DataFrame:
    """For each (service, logger) family of errors of each id: its count, all errors of the family, and the share."""
    errors = df.where("level = 'ERROR'").select(F.coalesce("service", F.lit("unknown")).alias("service"), F.coalesce("logger", F.lit("unknown")).alias("logger"), on)
    own = errors.where(f"`{on}` is not null and `{on}` <> ''").groupBy(on, "service", "logger").agg(F.count("*").alias("n_id"))
    everywhere = errors.groupBy("service", "logger").agg(F.count("*").alias("n_all"))
    return own.join(everywhere, ["service", "logger"]).select(on, "service", "logger", "n_id", "n_all", (F.col("n_id") / F.col("n_all")).alias("share"))
