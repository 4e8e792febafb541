"""Log views of the test tables, which hold no log table of their own."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.normalize import normalize_table
from ..sources.model import SourceSpec
from ..sources.shared import folder

EVENTS = SourceSpec(
    "events",
    {"id": "event_id", "timestamp": "ts", "level": "event_type", "logger": "event_type", "user_id": "user_id", "request_id": "user_id", "attributes": "props"},
)
ORDERS = SourceSpec(
    "orders", {"id": "o_orderkey", "timestamp": "o_orderdate", "level": "o_orderstatus", "message": "o_orderpriority", "job_id": "o_custkey"}, priority=1
)
DOCUMENTS = SourceSpec("documents", {"id": "doc_id", "message": "text", "service": "source", "logger": "lang"}, priority=2)
CONVERSATIONS = SourceSpec("conversations", {"message": "text", "logger": "role", "trace_id": "conv_id"}, position="turn", priority=3)

LINES = SourceSpec("app", {"timestamp": "ts", "level": "severity", "message": "msg", "user_id": "user"})


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    message = F.concat(F.lit("user "), F.col("user_id"), F.lit(" token="), F.md5(F.col("event_id").cast("string")), F.lit(" done"))
    return raw(spark, sf_dir, "events").withColumn("message", message)


def raw_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamp = F.expr("timestamp_ntz'2024-01-01 00:00:00'") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("doc_id"))
    level = F.when(F.col("doc_id") % 7 == 0, "error").otherwise("info")
    return raw(spark, sf_dir, "documents").withColumns({"timestamp": stamp, "level": level}).drop("n_chars")


def raw_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamp = F.expr("timestamp_ntz'2024-01-01 00:00:00'") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("turn"))
    return raw(spark, sf_dir, "conversations").withColumns({"timestamp": stamp, "level": F.lit("info"), "id": F.concat_ws("-", "conv_id", "turn")})


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize_table(raw_events(spark, sf_dir), EVENTS)[0]


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize_table(raw(spark, sf_dir, "orders"), ORDERS)[0]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize_table(raw_documents(spark, sf_dir), DOCUMENTS)[0]


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize_table(raw_conversations(spark, sf_dir), CONVERSATIONS)[0]


def jsonl_folder(spark: SparkSession, sf_dir: str) -> str:
    """The events as JSON Lines in four files by event id, with the oddities that real logs have, by event_id % 10.

    3: a tab before the object, 4: a key that repeats, 5: no JSON, 6: no object, 7: blank, 8: seconds since 1970, 9: a basic ISO time.
    """
    second, quote = F.substring(F.col("ts").cast("string"), 1, 19), lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    epoch = F.timestamp_diff("SECOND", F.expr("timestamp_ntz'1970-01-01 00:00:00'"), second.cast("timestamp_ntz"))
    form = F.col("event_id") % 10
    stamp = F.when(form == 8, epoch.cast("string")).when(form == 9, quote(F.regexp_replace(F.replace(second, F.lit(" "), F.lit("T")), "[-:]", ""))).otherwise(quote(second))
    line = F.concat(
        F.when(form == 3, F.lit("\t")).otherwise(""), F.lit('{"ts": '), stamp, F.when(form == 4, ', "severity": "old"').otherwise(""), F.lit(', "severity": '), quote("event_type"),
        F.lit(', "msg": "token=t'), "event_id", F.lit(' seen", "user": '), "user_id", F.lit(', "eid": '), "event_id", F.lit("}"),
    )
    line = F.when(form == 5, F.concat(F.lit("not json "), "event_id")).when(form == 6, F.concat(F.lit("["), "event_id", F.lit("]"))).when(form == 7, F.lit("\t ")).otherwise(line)
    path = folder(spark, "lines")
    raw(spark, sf_dir, "events").repartitionByRange(4, "event_id").sortWithinPartitions("event_id").select(line.alias("value")).write.text(path)
    return path


def logfmt_folder(spark: SparkSession, sf_dir: str) -> str:
    """The events as ``key=value`` lines in five files; messages hold blanks, quotes and backslashes, every 50th line is no such line."""
    quoted = lambda c: F.concat(F.lit('"'), F.regexp_replace(c, r'(["\\])', r"\\$1"), F.lit('"'))
    e = raw_events(spark, sf_dir)
    message = F.concat(F.lit('say "'), F.col("user_id"), F.lit('\\" '), F.col("message"))
    line = F.concat(
        F.lit("ts="), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit(" level="), F.col("event_type"), F.lit(" id="), F.col("event_id"), F.lit(" msg="), quoted(message),
        F.lit(" user="), F.col("user_id"), F.lit(' empty=""'),
    )
    line = F.when(F.col("event_id") % 50 == 7, F.concat(F.lit("no pairs here: "), "event_id")).otherwise(line)
    path = folder(spark, "logfmt")
    e.repartition(5, "event_id").select(line.alias("value")).write.text(path)
    return path


def events_in_derby(spark: SparkSession, sf_dir: str) -> SourceSpec:
    """The events as a table of Spark's own embedded database, which lives in one JVM: for local mode only."""
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("an embedded database is in one JVM; a cluster reads a database server")
    options = {"url": f"jdbc:derby:memory:logs{uuid.uuid4().hex};create=true", "driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver", "dbtable": "app.events"}
    rows = raw_events(spark, sf_dir).select("event_id", "ts", "event_type", "user_id", "message")
    rows.write.format("jdbc").options(**options, createTableColumnTypes="event_type varchar(40), message varchar(200)").save()
    return SourceSpec("events", {k: v for k, v in EVENTS.field_map.items() if k != "attributes"}, format="jdbc", options=options)
