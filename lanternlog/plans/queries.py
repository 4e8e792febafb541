"""The registered queries over whole tables, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.redaction import SECRET_KEYS, RedactionSpec, redact_attributes, redact_text, sensitive_name
from ..functions.timing import bucket_of, duration_seconds, iso_z, parse_timestamp
from ..operators import filters, investigate, normalize, notices, page, paging, stats
from ..operators.filters import Filters
from ..operators.redact import redact_entries
from ..sources.model import SourceSpec
from ..sources import logfmt
from ..sources.jdbc import read_jdbc
from ..sources.readers import POSITION, RAW, read_jsonl, read_table, union_sources
from ..sources.shared import folder
from ..streaming import jsonl
from . import views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# SQL of the log views; the events' messages hold a token.
MESSAGE = "concat('user ', user_id, ' token=', md5(cast(event_id AS varchar)), ' done')"
EVENTS = f"""l AS (SELECT cast(event_id AS varchar) AS id, ts AS "timestamp", upper(event_type) AS level, {MESSAGE} AS message,
  event_type AS logger, cast(NULL AS varchar) AS service, cast(user_id AS varchar) AS request_id, cast(user_id AS varchar) AS user_id, 'events' AS source FROM events)"""
ORDERS = """o AS (SELECT cast(o_orderkey AS varchar) AS id, o_orderdate AS "timestamp", upper(o_orderstatus) AS level, o_orderpriority AS message,
  cast(o_custkey AS varchar) AS job_id, 'orders' AS source FROM orders)"""
DOCUMENTS = """d AS (SELECT cast(doc_id AS varchar) AS id, timestamp '2024-01-01 00:00:00' + to_minutes(doc_id) AS "timestamp",
  CASE WHEN doc_id % 7 = 0 THEN 'ERROR' ELSE 'INFO' END AS level, text AS message, lang AS logger, source AS service, 'documents' AS source FROM documents)"""
TALKS = """c AS (SELECT concat(conv_id, '-', turn) AS id, timestamp '2024-01-01 00:00:00' + to_minutes(turn) AS "timestamp", 'INFO' AS level,
  role AS logger, cast(conv_id AS varchar) AS trace_id, 'conversations' AS source FROM conversations)"""


def masked(column: str, emails: bool = False, max_chars: int = 8000) -> str:
    """SQL of the text rules, on data where the regex engines agree."""
    out = f"CASE WHEN length({column}) > {max_chars} THEN concat(substr({column}, 1, {max_chars}), '... [truncated ', length({column}) - {max_chars}, ' chars]') ELSE {column} END"
    rules = [
        (r"\bbearer\s+[A-Za-z0-9._~+/=-]+", "Bearer [REDACTED]", "gi"),
        (r"\bauthorization\s*[:=]\s*\S+(?:\s+[A-Za-z0-9._~+/=-]+)?", "Authorization: [REDACTED]", "gi"),
        (rf"""\b({SECRET_KEYS})\s*[:=]\s*(?:"[^"]*"|''[^'']*''|[^''"\s,;}}]+)""", r"\1=[REDACTED]", "gi"),
        (r"\b([a-zA-Z][a-zA-Z0-9+.-]*://[^\s:/@]*):[^\s/?#@]+@", r"\1:[REDACTED]@", "g"),
        (r"\beyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]*", "[REDACTED]", "g"),
    ] + ([(r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b", "[REDACTED]", "g")] if emails else [])
    for pattern, replacement, flags in rules:
        out = f"regexp_replace({out}, '{pattern}', '{replacement}', '{flags}')"
    return out


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


SHOWN = ("id", "timestamp", "level", "message", "logger", "request_id", "source")
START, END = datetime(2024, 1, 10), datetime(2024, 1, 20)
RANGE = "\"timestamp\" BETWEEN timestamp '2024-01-10' AND timestamp '2024-01-20'"
TOP = 'ORDER BY "timestamp" DESC, id DESC, source DESC'


@query(f"""WITH {EVENTS} SELECT id, "timestamp", level, {masked("message")} AS message, logger, request_id, source FROM l
  WHERE level = 'ERROR' AND {RANGE} {TOP} LIMIT 100""")
def search_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page.search(views.events(spark, sf_dir), Filters(levels="error", start=START, end=END)).kept().select(*SHOWN)


@query(f"""WITH {EVENTS}, p AS (SELECT * FROM l WHERE level IN ('ERROR', 'CLICK') AND {RANGE}),
  k AS (SELECT "timestamp" AS t, id AS i, source AS s FROM p {TOP} LIMIT 1 OFFSET 49)
  SELECT id, "timestamp", level, {masked("message")} AS message, logger, request_id, source FROM p, k
  WHERE ("timestamp", id, source) < (t, i, s) {TOP} LIMIT 50""")
def search_levels_page2(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = Filters(levels=" error, click ,", start=START, end=END)
    logs = views.events(spark, sf_dir)
    cursor = page.search(logs, f, 50).next_cursor()
    return page.search(logs, f, 50, cursor).kept().select(*SHOWN)


@query(f"""WITH {EVENTS} SELECT id, "timestamp", level, {masked("message")} AS message, logger, request_id, source FROM l
  WHERE {RANGE} AND contains(lower(concat_ws('|', id, level, {masked("message")}, logger, request_id, source)), 'user 42 ') {TOP} LIMIT 100""")
def search_text_redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page.search(views.events(spark, sf_dir), Filters(text="User 42 ", start=START, end=END)).kept().select(*SHOWN)


@query("SELECT cast(0 AS bigint) AS n_found, count(*) AS n_holding FROM events WHERE contains(md5(cast(event_id AS varchar)), 'abc')")
def search_secret_unsearchable(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = views.events(spark, sf_dir)
    found = filters.with_text(logs.drop("attributes"), "abc").select(F.lit(1).alias("found"), F.lit(0).alias("holding"))
    holding = logs.where(F.contains("message", F.lit("abc"))).select(F.lit(0).alias("found"), F.lit(1).alias("holding"))
    return found.unionByName(holding).agg(F.count_if(F.col("found") == 1).alias("n_found"), F.count_if(F.col("holding") == 1).alias("n_holding"))


@query(f"""WITH {EVENTS} SELECT id, "timestamp", level, {masked("message")} AS message, logger, request_id, source FROM l
  WHERE request_id = '7' ORDER BY "timestamp", id, source LIMIT 100""")
def timeline_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page.timeline(views.events(spark, sf_dir), Filters(request_id="7")).kept().select(*SHOWN)


@query(f"""WITH {TALKS} SELECT trace_id, id, "timestamp", logger, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY trace_id ORDER BY "timestamp", id, source) AS rank FROM c) WHERE rank <= 3""")
def timelines_bulk_top3(spark: SparkSession, sf_dir: str) -> DataFrame:
    talks = views.conversations(spark, sf_dir)
    return investigate.bulk_timelines(talks, talks.select("trace_id"), "trace_id", 3).select("trace_id", "id", "timestamp", "logger", F.col("rank").cast("long"))


@query(f"""WITH {EVENTS} SELECT request_id, "timestamp", id, source, level, lag(level) OVER w AS level_before,
  date_diff('microsecond', lag("timestamp") OVER w, "timestamp") / 1000000 AS gap_seconds,
  count(CASE WHEN level = 'ERROR' THEN 1 END) OVER (w ROWS UNBOUNDED PRECEDING) AS errors_so_far
  FROM l WINDOW w AS (PARTITION BY request_id ORDER BY "timestamp", id, source)""")
def timeline_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return investigate.timeline_gaps(views.events(spark, sf_dir), "request_id")


@query(f"""WITH {EVENTS} SELECT request_id, min("timestamp") AS first_ts, max("timestamp") AS last_ts, count(*) AS n,
  count(CASE WHEN level = 'ERROR' THEN 1 END) AS n_errors,
  first(id ORDER BY "timestamp", id, source) FILTER (WHERE level = 'ERROR') AS first_error_id FROM l GROUP BY request_id""")
def timeline_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return investigate.timeline_summary(views.events(spark, sf_dir), "request_id")


@query(f"""WITH {EVENTS}, {ORDERS}, a AS (SELECT id, level, source, 0 AS p FROM l UNION ALL SELECT id, level, source, 1 FROM o),
  w AS (SELECT DISTINCT cast(c_custkey AS varchar) AS lookup FROM customer UNION SELECT DISTINCT concat('orders:', c_custkey) FROM customer)
  SELECT lookup, id, level, source, id IS NOT NULL AS found FROM (SELECT w.lookup, a.*, row_number() OVER (PARTITION BY w.lookup ORDER BY p) AS n
  FROM w LEFT JOIN a ON a.id = w.lookup OR concat(a.source, ':', a.id) = w.lookup) WHERE n = 1""")
def detail_bulk(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = union_sources([views.events(spark, sf_dir), views.orders(spark, sf_dir)])
    keys = views.raw(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("k"))
    ids = keys.select(F.col("k").alias("lookup")).union(keys.select(F.concat(F.lit("orders:"), "k")))
    return investigate.bulk_detail(logs, ids, priority={"events": 0, "orders": 1}).select("lookup", "id", "level", "source", "found")


def stats_sql(bucket: str, where: str = "true") -> str:
    cut = {"minute": "%Y-%m-%dT%H:%M:00+00:00", "hour": "%Y-%m-%dT%H:00:00+00:00", "day": "%Y-%m-%dT00:00:00+00:00"}[bucket]
    return f"""WITH {EVENTS}, f AS (SELECT *, strftime("timestamp", '{cut}') AS t FROM l WHERE {where})
      SELECT 'level' AS dimension, level AS bucket, count(*) AS n FROM f GROUP BY level
      UNION ALL SELECT 'service', 'unknown', count(*) FROM f HAVING count(*) > 0
      UNION ALL SELECT 'logger', logger, count(*) FROM f GROUP BY logger
      UNION ALL SELECT 'time', t, count(*) FROM f GROUP BY t
      UNION ALL SELECT 'total', NULL, count(*) FROM f"""


@query(stats_sql("hour", f"level = 'ERROR' AND {RANGE}"))
def stats_grouping_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.log_stats(views.events(spark, sf_dir), Filters(levels="error", start=START, end=END))


@query(stats_sql("minute"))
def stats_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.log_stats(views.events(spark, sf_dir), Filters(), "minute")


@query(stats_sql("hour"))
def stats_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.log_stats(views.events(spark, sf_dir), Filters(), "hour")


@query(stats_sql("day"))
def stats_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.log_stats(views.events(spark, sf_dir), Filters(), "day")


@query(stats_sql("day", f"contains(lower({masked('message')}), 'user 4')"))
def stats_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.log_stats(views.events(spark, sf_dir), Filters(text="USER 4"), "day")


@query(f"""WITH {EVENTS}, g AS (SELECT request_id AS bucket, count(*) AS n FROM l GROUP BY request_id)
  SELECT bucket, n, (SELECT count(*) FROM g) > 100 AS truncated FROM (SELECT *, row_number() OVER (ORDER BY n DESC, bucket) AS r FROM g) WHERE r <= 100""")
def stats_top_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = views.events(spark, sf_dir).withColumn("logger", F.col("request_id"))
    return stats.cap_groups(stats.count_dimensions(logs, by_source=True)).where("dimension = 'logger'").select("bucket", "n", "truncated")


@query("SELECT 'api_key=[REDACTED] ' || (user_id % 3) AS bucket, count(*) AS n FROM events GROUP BY 1")
def stats_labels_redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.concat(F.lit("api_key=K"), F.col("user_id"), F.lit(" "), F.col("user_id").cast("long") % 3)
    counts = stats.count_dimensions(views.events(spark, sf_dir).withColumn("service", label))
    return stats.redact_labels(counts).where("dimension = 'service'").select("bucket", "n")


@query(f"""WITH {EVENTS}, {ORDERS}, a AS (SELECT id, "timestamp", source FROM l UNION ALL SELECT id, "timestamp", source FROM o)
  SELECT id, "timestamp", source FROM a {TOP} LIMIT 500""")
def merge_sources_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = union_sources([views.events(spark, sf_dir), views.orders(spark, sf_dir)])
    return page.search(logs, Filters(), 500, most=500).kept().select("id", "timestamp", "source")


@query(f"""WITH {EVENTS}, {ORDERS}, a AS (SELECT id, "timestamp", source FROM l UNION ALL SELECT id, "timestamp", source FROM o)
  SELECT id, "timestamp", source, strftime("timestamp", '%Y-%m-%dT%H:%M:%S') || CASE WHEN microsecond("timestamp") % 1000000 = 0 THEN ''
  ELSE '.' || lpad(cast(microsecond("timestamp") % 1000000 AS varchar), 6, '0') END || 'Z' AS shown FROM a""")
def export_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = union_sources([views.events(spark, sf_dir), views.orders(spark, sf_dir)]).select("id", "timestamp", "source")
    return page.export_ordered(logs).withColumn("shown", iso_z(F.col("timestamp")))


@query(f'WITH {EVENTS} SELECT id, "timestamp", level, message, logger, service, request_id, user_id, source FROM l')
def normalize_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.events(spark, sf_dir).select("id", "timestamp", "level", "message", "logger", "service", "request_id", "user_id", "source")


@query("SELECT cast(event_id AS varchar) AS id, cast(json_extract_string(props, '$.k') AS bigint) AS k, value FROM events")
def attributes_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = F.try_parse_json("attributes")
    return views.events(spark, sf_dir).select("id", F.variant_get(merged, "$.k", "bigint").alias("k"), F.variant_get(merged, "$.value", "double").alias("value"))


@query("""SELECT 'events' AS source, reason, count(*) AS n FROM (SELECT CASE WHEN event_id % 11 = 0 THEN 'bad_timestamp' WHEN event_id % 13 = 0 THEN 'missing_level'
  WHEN event_id % 17 = 0 THEN 'missing_message' END AS reason FROM events) WHERE reason IS NOT NULL GROUP BY reason""")
def quarantine_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    broken = views.raw_events(spark, sf_dir)
    for n, name in ((11, "ts"), (13, "event_type"), (17, "message")):
        broken = broken.withColumn(name, F.when(F.col("event_id") % n != 0, F.col(name)))
    return normalize.quarantine_summary(normalize.normalize_table(broken, views.EVENTS)[1])


@query(r"""WITH w AS (SELECT event_id AS place, concat('line of user ', user_id % 40, ': password=[REDACTED]') AS text FROM events),
  g AS (SELECT text, min(place) AS place FROM w GROUP BY text)
  SELECT * FROM (SELECT place, text FROM g ORDER BY place, text LIMIT 20)
  UNION ALL SELECT NULL, concat('[', count(*) - 20, ' more warnings suppressed]') FROM g HAVING count(*) > 20""")
def warnings_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.lit("line of user "), F.col("user_id") % 40, F.lit(": password=p"), F.col("event_id"))
    return notices.summarize_warnings(views.raw(spark, sf_dir, "events").select(F.col("event_id").alias("place"), text.alias("text")))


@query(f"WITH {DOCUMENTS} SELECT id, md5({masked('message')}) AS digest, {masked('message')} <> message AS changed FROM d")
def redact_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = redact_text(F.col("message"), RedactionSpec())
    return views.documents(spark, sf_dir).select("id", F.md5(text).alias("digest"), (text != F.col("message")).alias("changed"))


@query(f"WITH {DOCUMENTS} SELECT id, md5({masked('message', emails=True)}) AS digest FROM d")
def redact_emails(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.documents(spark, sf_dir).select("id", F.md5(redact_text(F.col("message"), RedactionSpec(emails=True))).alias("digest"))


@query(f"WITH {EVENTS} SELECT id, regexp_replace({masked('message')}, 'user ([0-9]+)', 'user <\\1>', 'g') AS message FROM l")
def redact_custom_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = RedactionSpec(patterns=((r"user (?P<n>[0-9]+)", r"user <\g<n>>"),))
    return views.events(spark, sf_dir).select("id", redact_text(F.col("message"), spec).alias("message"))


@query("SELECT c_custkey, concat('postgres://u', c_custkey, ':[REDACTED]@db:5432/main https://a.b:80/x?m=q@r') AS url FROM customer")
def redact_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.concat(F.lit("postgres://u"), "c_custkey", F.lit(":pw"), "c_custkey", F.lit("@db:5432/main https://a.b:80/x?m=q@r"))
    return views.raw(spark, sf_dir, "customer").select("c_custkey", redact_text(url, RedactionSpec()).alias("url"))


@query("""WITH n AS (SELECT p_partkey, concat(CASE p_partkey % 6 WHEN 0 THEN 'api_key' WHEN 1 THEN 'authToken' WHEN 2 THEN 'tokenize_strategy' WHEN 3 THEN 'X-Authorization'
  WHEN 4 THEN 'session_count' ELSE 'clientSecret' END, '_', p_partkey) AS name FROM part),
  s AS (SELECT *, string_split_regex(lower(regexp_replace(name, '([a-z0-9])([A-Z])', '\\1 \\2', 'g')), '[^a-z0-9]+') AS t FROM n)
  SELECT p_partkey, name, list_has_any(t, ['password','passwd','pwd','passphrase','secret','token','authorization','auth','credential','credentials'])
  OR regexp_matches(array_to_string(t, ''), 'apikey|apisecret|accesskey|secretkey|privatekey|accesstoken|refreshtoken|sessiontoken|bearertoken|clientsecret') AS sensitive FROM s""")
def sensitive_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    forms = F.array(*map(F.lit, ("api_key", "authToken", "tokenize_strategy", "X-Authorization", "session_count", "clientSecret")))
    name = F.concat(F.get(forms, (F.col("p_partkey") % 6).cast("int")), F.lit("_"), F.col("p_partkey"))
    return views.raw(spark, sf_dir, "part").select("p_partkey", name.alias("name"), sensitive_name(name, RedactionSpec()).alias("sensitive"))


@query("""SELECT event_id, concat('{"password":"[REDACTED]","nested":{"refresh_token":"[REDACTED]","user":', user_id, '},"list":["token=[REDACTED] x"]}') AS attributes FROM events""")
def redact_nested_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.lit('{"password":"p'), "event_id", F.lit('","nested":{"refresh_token":"r","user":'), "user_id", F.lit('},"list":["token=t'), "event_id", F.lit(' x"]}'))
    return views.raw(spark, sf_dir, "events").select("event_id", redact_attributes(text, RedactionSpec()).alias("attributes"))


@query("""SELECT event_id, concat('{"list":[{"password":"[REDACTED]"},{"k":', user_id, '}],"o":{"token":"[REDACTED]"}}') AS attributes FROM events""")
def redact_pretty_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON with line breaks and tabs between its parts, as pretty printers write it."""
    text = F.concat(F.lit('{\n\t"list": [\n {"password":\n"p'), "event_id", F.lit('"},\r\n{"k": '), "user_id", F.lit('}],\n "o"\n: {"token": ["t'), "event_id", F.lit('"]}\n}\n'))
    return views.raw(spark, sf_dir, "events").select("event_id", redact_attributes(text, RedactionSpec()).alias("attributes"))


@query(f"""WITH {EVENTS}, e AS (SELECT DISTINCT request_id FROM l WHERE level = 'ERROR' AND {RANGE})
  SELECT id, "timestamp", level, request_id FROM l WHERE request_id IN (SELECT request_id FROM e)""")
def expand_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = views.events(spark, sf_dir)
    inside = filters.build_predicate(Filters(start=START, end=END))
    marked = logs.withColumn("level", F.when((F.col("level") == "ERROR") & ~inside, "ERROR_OUTSIDE").otherwise(F.col("level")))
    found = investigate.expand_errors(marked, on=("request_id",))
    return found.select("id", "timestamp", F.regexp_replace("level", "_OUTSIDE$", "").alias("level"), "request_id")


DEPLOYS = """p AS (SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS deploy_id, date_trunc('day', ts) + to_hours(12) AS noon FROM events)"""


def deploys(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.substring(F.col("ts").cast("string"), 1, 10)
    return views.raw(spark, sf_dir, "events").select(day.alias("deploy_id")).distinct().withColumn("at", F.concat("deploy_id", F.lit(" 12:00:00")).cast("timestamp_ntz"))


COMPARED = f"""WITH {EVENTS}, {DEPLOYS} SELECT deploy_id, level, count(CASE WHEN "timestamp" < noon THEN 1 END) AS n_before,
  count(CASE WHEN "timestamp" >= noon THEN 1 END) AS n_after FROM l JOIN p ON "timestamp" BETWEEN noon - to_hours(6) AND noon + to_hours(6) GROUP BY deploy_id, level"""


@query(COMPARED)
def deploy_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    return investigate.deploy_compare(views.events(spark, sf_dir), deploys(spark, sf_dir), 6 * 3600)


@query(f"""SELECT *, CASE WHEN n_before = 0 THEN 'new' WHEN n_after = 0 THEN 'gone' WHEN n_after > n_before THEN 'increased'
  WHEN n_after < n_before THEN 'decreased' ELSE 'same' END AS change FROM ({COMPARED.replace("to_hours(6)", "to_hours(1)").replace("level", "request_id").replace("upper(event_type) AS request_id", "upper(event_type) AS level")})""")
def new_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    return investigate.new_families(investigate.deploy_compare(views.events(spark, sf_dir), deploys(spark, sf_dir), 3600, ("request_id",)))


@query(f"""WITH {EVENTS}, e AS (SELECT request_id, logger FROM l WHERE level = 'ERROR' OR logger = 'click'),
  n AS (SELECT logger, count(*) AS n_all FROM e GROUP BY logger)
  SELECT request_id, 'unknown' AS service, logger, count(*) AS n_id, any_value(n_all) AS n_all, count(*) / any_value(n_all) AS share FROM e JOIN n USING (logger) GROUP BY request_id, logger""")
def widespread_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = views.events(spark, sf_dir).withColumn("level", F.when(F.col("logger") == "click", "ERROR").otherwise(F.col("level")))
    return investigate.widespread(logs, "request_id")


@query("SELECT CASE WHEN turn % 3 = 0 THEN concat('talk:', conv_id * 1000 + turn) ELSE concat('given', conv_id, '-', turn) END AS id, role AS logger FROM conversations")
def id_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = (F.col("conv_id") * 1000 + F.col("turn")).alias("place")
    given = F.when(F.col("turn") % 3 != 0, F.concat(F.lit("given"), "conv_id", F.lit("-"), "turn"))
    rows = views.raw_conversations(spark, sf_dir).select("timestamp", "level", "text", "role", given.alias("id"), place)
    spec = SourceSpec("talk", {"message": "text", "logger": "role"}, position="place")
    return normalize.normalize_table(rows, spec)[0].select("id", "logger")


@query("""SELECT event_id, date_trunc('second', ts) AS iso, date_trunc('second', ts) - to_hours(2) AS zoned, date_trunc('day', ts) AS dated,
  date_trunc('second', ts) AS epoch, CASE WHEN event_id % 2 = 0 THEN date_trunc('second', ts) END AS odd FROM events""")
def parse_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    second = F.substring(F.col("ts").cast("string"), 1, 19)
    epoch = F.timestamp_diff("SECOND", F.expr("timestamp_ntz'1970-01-01 00:00:00'"), second.cast("timestamp_ntz"))
    basic = F.concat(F.regexp_replace(F.replace(second, F.lit(" "), F.lit("T")), "[-:]", ""), F.lit("Z"))
    basic = F.when(F.col("event_id") % 2 == 0, basic).otherwise("2026")  # a bare year is no timestamp
    return views.raw(spark, sf_dir, "events").select(
        "event_id",
        parse_timestamp(F.concat(F.replace(second, F.lit(" "), F.lit("T")), F.lit("Z")), "string").alias("iso"),
        parse_timestamp(F.concat(second, F.lit("+02:00")), "string").alias("zoned"),
        parse_timestamp(F.substring(second, 1, 10), "string").alias("dated"),
        parse_timestamp(epoch, "bigint").alias("epoch"),
        parse_timestamp(basic, "string", odd_forms=True).alias("odd"),
    )


@query("""SELECT level, n, list_sort(list_distinct(list_filter(list_transform(string_split(concat(' ', lower(level), ' ,, x'), ','), lambda x: upper(trim(x))), lambda x: x <> ''))) AS levels,
  60 * n AS seconds FROM (SELECT upper(event_type) AS level, count(*) AS n FROM events GROUP BY 1)""")
def level_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = views.events(spark, sf_dir).groupBy("level").agg(F.count("*").alias("n"))
    levels = F.sort_array(filters.level_list(F.concat(F.lit(" "), F.lower("level"), F.lit(" ,, x"))))
    return counts.select("level", "n", levels.alias("levels"), duration_seconds(F.concat(F.lit(" "), F.col("n"), F.lit("m "))).alias("seconds"))


@query(f"""WITH {EVENTS}, {ORDERS}, a AS (SELECT id, "timestamp", source FROM l UNION ALL SELECT id, "timestamp", source FROM o)
  SELECT id, "timestamp", source, true AS incomplete FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY "timestamp" DESC, id DESC) AS r FROM a) WHERE r <= 300""")
def scan_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = union_sources([views.events(spark, sf_dir), views.orders(spark, sf_dir)])
    return page.scan_window(logs.select("id", "timestamp", "source"), 300)


@query(f"""WITH {EVENTS} SELECT strftime("timestamp", '%Y-%m-%dT%H:00:00+00:00') AS bucket, count(*) AS n FROM l
  WHERE contains(lower({masked('message')}), 'user 1') GROUP BY 1""")
def json_blob_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = filters.with_text(views.events(spark, sf_dir), '"message": "User 1', match="json")
    return found.groupBy(bucket_of(F.col("timestamp"), "hour").alias("bucket")).agg(F.count("*").alias("n"))


@query(f"""WITH {EVENTS} SELECT id, "timestamp", level, {masked("message")} AS message, source FROM l WHERE level = 'ERROR'""")
def redacted_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return redact_entries(views.events(spark, sf_dir).where(filters.build_predicate(Filters(levels="ERROR")))).select("id", "timestamp", "level", "message", "source")


WITH_ID = replace(views.LINES, field_map={**views.LINES.field_map, "id": "eid"})
GOOD_LINES = "event_id % 10 NOT IN (5, 6, 7)"


@query(f"""SELECT cast(event_id AS varchar) AS eid, date_trunc('second', ts) AS "timestamp", upper(event_type) AS level, 'token=[REDACTED] seen' AS message,
  cast(user_id AS varchar) AS user_id, concat('{{"eid":', event_id, '}}') AS attributes, 'app' AS source FROM events WHERE {GOOD_LINES}""")
def jsonl_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = normalize.normalize_jsonl(read_jsonl(spark, views.jsonl_folder(spark, sf_dir)), views.LINES)
    eid = F.variant_get(F.try_parse_json("attributes"), "$.eid", "string").alias("eid")
    return redact_entries(good, full=True).select(eid, "timestamp", "level", "message", "user_id", "attributes", "source")


@query("""SELECT 'app' AS source, CASE event_id % 10 WHEN 5 THEN 'invalid_json' ELSE 'not_object' END AS reason, count(*) AS n
  FROM events WHERE event_id % 10 IN (5, 6) GROUP BY ALL""")
def jsonl_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    # An id is mapped, so lines need no numbers and the files are read once.
    _, bad = normalize.normalize_jsonl(read_jsonl(spark, views.jsonl_folder(spark, sf_dir), numbered=False), WITH_ID)
    return normalize.quarantine_summary(bad)


@query("SELECT count(*) AS n_lines, true AS numbers_right FROM events WHERE event_id % 10 <> 7")
def jsonl_line_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event ids follow each other in a file, so id less line number is one value for each file."""
    path = views.jsonl_folder(spark, sf_dir)
    files = len(spark.read.text(path).inputFiles())
    eid = F.coalesce(F.nullif(F.regexp_extract(RAW, r"\"eid\": (\d+)", 1), F.lit("")), F.regexp_extract(RAW, r"(\d+)\]?$", 1)).cast("long")
    lines = read_jsonl(spark, path).select((eid - F.col(POSITION)).alias("shift"))
    return lines.agg(F.count("*").alias("n_lines"), (F.count_distinct("shift") == files).alias("numbers_right"))


@query(f"""WITH {EVENTS} SELECT id, "timestamp", level, {masked("message")} AS message, logger, request_id, source FROM l
  WHERE "timestamp" BETWEEN timestamp '2024-01-19' AND timestamp '2024-01-20' {TOP} LIMIT 100""")
def search_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page.recent(views.events(spark, sf_dir), Filters(), END).kept().select(*SHOWN)


@query(stats_sql("hour", "\"timestamp\" BETWEEN timestamp '2024-01-19' AND timestamp '2024-01-20'"))
def stats_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.recent_stats(views.events(spark, sf_dir), Filters(), END)


@query(f"""WITH {EVENTS}, p AS (SELECT * FROM l WHERE {RANGE} {TOP} LIMIT 4000)
  SELECT id, "timestamp", {masked("message")} AS message, (SELECT count(*) > 4000 FROM l WHERE {RANGE}) AS incomplete
  FROM p WHERE contains(lower({masked("message")}), 'user 4') {TOP} LIMIT 100""")
def search_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = Filters(text="user 4", start=START, end=END)
    return page.bounded_search(views.events(spark, sf_dir), f, 4000).select("id", "timestamp", "message", "incomplete")


@query(f"""WITH {EVENTS}, p AS (SELECT *, row_number() OVER ({TOP}) AS r FROM l WHERE level = 'CLICK' AND {RANGE}),
  k AS (SELECT * FROM p WHERE r <= 40)
  SELECT cast(count(*) AS integer) AS "count", (SELECT count(*) FROM p) > 40 AS has_more, string_agg(id, ',' ORDER BY r) AS ids,
  CASE WHEN (SELECT count(*) FROM p) > 40 THEN max_by(id, r) END AS next_id FROM k""")
def evidence_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = page.search(views.events(spark, sf_dir), Filters(levels="click", start=START, end=END), 40).record()
    ids = F.array_join(F.col("entries.id"), ",")
    return found.select("count", "has_more", ids.alias("ids"), F.col("next_place.id").alias("next_id"))


@query(f"""WITH {ORDERS} SELECT concat('orders:', id) AS lookup, id, "timestamp", level, source, true AS found FROM o WHERE id = '7'""")
def detail_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = union_sources([views.events(spark, sf_dir), views.orders(spark, sf_dir)])
    return investigate.detail(logs, "orders:7").select("lookup", "id", "timestamp", "level", "source", "found")


@query(f"""WITH {EVENTS}, {ORDERS}, a AS (SELECT level, request_id AS logger, source FROM l UNION ALL SELECT level, job_id, source FROM o),
  g AS (SELECT source, logger AS bucket, count(*) AS n FROM a GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n DESC, bucket) AS r FROM g)
  SELECT 'logger' AS dimension, bucket, cast(sum(n) AS bigint) AS n, bool_or(truncated) AS truncated FROM (SELECT *, max(r) OVER (PARTITION BY source) > 100 AS truncated FROM r) WHERE r <= 100 GROUP BY bucket
  UNION ALL SELECT 'level', level, count(*), false FROM a GROUP BY level""")
def stats_two_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = union_sources([views.events(spark, sf_dir), views.orders(spark, sf_dir)]).withColumn("logger", F.coalesce("request_id", "job_id"))
    return stats.merged_stats(logs, Filters()).where("dimension in ('logger', 'level')").select("dimension", "bucket", "n", "truncated")


SCANNED = 400


@query(f"""WITH {EVENTS}, p AS (SELECT *, contains(lower({masked("message")}), 'user 42 ') AS hit, row_number() OVER ({TOP}) AS r FROM l WHERE {RANGE}),
  n AS (SELECT count(*) AS all_rows FROM p), f1 AS (SELECT *, row_number() OVER (ORDER BY r) AS k FROM p WHERE hit AND r <= {SCANNED}),
  e1 AS (SELECT CASE WHEN (SELECT count(*) FROM f1) > 3 THEN (SELECT r FROM f1 WHERE k = 3) ELSE least({SCANNED}, all_rows) END AS e FROM n),
  f2 AS (SELECT *, row_number() OVER (ORDER BY r) AS k FROM p, e1 WHERE hit AND r > e AND r <= e + {SCANNED})
  SELECT 1 AS page, CAST(least(3, (SELECT count(*) FROM f1)) AS int) AS "count", (SELECT count(*) > 3 FROM f1) AS has_more, CAST(least({SCANNED}, all_rows) AS int) AS scanned,
  all_rows > {SCANNED} AS incomplete, coalesce((SELECT string_agg(id, ',' ORDER BY r) FROM f1 WHERE k <= 3), '') AS ids, (SELECT id FROM p, e1 WHERE r = e AND e < all_rows) AS next_id FROM n
  UNION ALL SELECT 2, CAST(least(3, (SELECT count(*) FROM f2)) AS int), (SELECT count(*) > 3 FROM f2), CAST(least({SCANNED}, all_rows - e) AS int),
  all_rows - e > {SCANNED}, coalesce((SELECT string_agg(id, ',' ORDER BY r) FROM f2 WHERE k <= 3), ''),
  (SELECT id FROM p WHERE r = CASE WHEN (SELECT count(*) FROM f2) > 3 THEN (SELECT r FROM f2 WHERE k = 3) WHEN all_rows - e > {SCANNED} THEN e + {SCANNED} END) FROM n, e1""")
def scan_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two bounded scans, the second from where the first one stopped."""
    f, logs = Filters(text="user 42 ", start=START, end=END), views.events(spark, sf_dir)
    pages, cursor = [], None
    for n in (1, 2):
        got = page.bounded_scan(logs, f, SCANNED, 3, cursor)
        cursor = got.select("next_cursor").first()[0]
        ids = F.array_join(F.col("entries.id"), ",")
        pages.append(got.select(F.lit(n).alias("page"), "count", "has_more", "scanned", "incomplete", ids.alias("ids"), F.col("next_place.id").alias("next_id")))
    return pages[0].unionByName(pages[1])


@query(f"""WITH {EVENTS}, p AS (SELECT id, row_number() OVER ({TOP}) AS r, count(*) OVER () AS n FROM l)
  SELECT 0 AS "count", false AS has_more, 250 AS scanned, true AS incomplete, id AS next_id FROM p WHERE r = 250 AND n > 250""")
def scan_without_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No entry inside the bound; the scan still tells that rows lie beyond and where to go on."""
    got = page.bounded_scan(views.events(spark, sf_dir), Filters(text="no such words"), 250)
    return got.select("count", "has_more", "scanned", "incomplete", F.col("next_place.id").alias("next_id"))


BAD_EVENT = """CASE WHEN event_id % 10 = 5 THEN 'invalid_json' WHEN event_id % 10 = 6 THEN 'not_object' END"""


@query(f"""SELECT 'app' AS source, {BAD_EVENT} AS reason, count(*) AS n, sum(user_id) AS users FROM events WHERE event_id % 10 NOT IN (5, 6, 7) GROUP BY ALL
  UNION ALL SELECT 'app', {BAD_EVENT}, count(*), NULL FROM events WHERE event_id % 10 IN (5, 6) GROUP BY ALL""")
def quarantine_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good rows and the counts by reason from one reading of the lines."""
    shaped = normalize.shape_jsonl(read_jsonl(spark, views.jsonl_folder(spark, sf_dir), numbered=False), WITH_ID)
    good, bad = normalize.split_once(shaped, folder(spark, "split"))
    kept = good.groupBy("source").agg(F.count("*").alias("n"), F.sum(F.col("user_id").cast("long")).alias("users"))
    counts = normalize.quarantine_summary(bad)
    return kept.select("source", F.lit(None).cast("string").alias("reason"), "n", "users").unionByName(counts.withColumn("users", F.lit(None).cast("long")))


@query(f"""WITH {EVENTS} SELECT id, "timestamp", level, message, logger, request_id, user_id, source FROM l
  WHERE {RANGE} AND ("timestamp", id) < (timestamp '2024-01-15', '5000')""")
def jdbc_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A database table in four ranges of its time; the time terms go down with the ranges."""
    spec = views.events_in_derby(spark, sf_dir)
    good, _ = normalize.normalize_table(read_jdbc(spark, spec, "ts", 4), spec)
    after = filters.after_cursor(filters.Cursor(datetime(2024, 1, 15), "5000", ""), True)
    return good.where(filters.build_predicate(Filters(start=START, end=END)) & after).select("id", "timestamp", "level", "message", "logger", "request_id", "user_id", "source")


LOGFMT = SourceSpec("kv", {"timestamp": "ts", "message": "msg", "attributes": "rest"}, format=logfmt.FORMAT)


@query(f"""SELECT cast(event_id AS varchar) AS id, ts AS "timestamp", upper(event_type) AS level, concat('say "', user_id, '\\" ', {MESSAGE}) AS message,
  concat('{{"empty":"","user":"', user_id, '"}}') AS attributes, 'kv' AS source FROM events
  WHERE event_id % 50 <> 7 AND event_type = 'click' AND ts >= timestamp '2024-01-10' AND ts < timestamp '2024-01-20'""")
def logfmt_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``key=value`` files by a data source of this package; level and times are tested where the lines are read."""
    logfmt.register(spark)
    path = views.logfmt_folder(spark, sf_dir)
    days = [F.lit(str(d)).cast("timestamp_ntz") for d in (START, END)]
    rows = read_table(spark, replace(LOGFMT, options={"splitBytes": "60000"}), path).where((F.col("level") == "click") & (F.col("ts") >= days[0]) & (F.col("ts") < days[1]))
    good, _ = normalize.normalize_table(rows.drop("bad"), LOGFMT)
    return good.select("id", "timestamp", "level", "message", "attributes", "source")


@query(f"""WITH {EVENTS} SELECT id, regexp_replace(regexp_replace(regexp_replace({masked('message')}, 'user ([0-9]+)', 'U<\\1>', 'g'), 'do{{0,3}}ne', 'end', 'g'), 'token', 'key', 'g') AS message FROM l""")
def redact_python_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patterns of which Java takes the last only; all run in the given order."""
    spec = RedactionSpec(patterns=((r"(user )?(?(1)([0-9]+)|never)", r"U<\2>"), (r"do{,3}ne", "end"), (r"token", "key")))
    return views.events(spark, sf_dir).select("id", redact_text(F.col("message"), spec).alias("message"))


@query("""SELECT concat('talks:', conv_id) AS lookup, arg_min(role, turn) AS logger, cast(min(turn) AS varchar) AS position, true AS found FROM conversations GROUP BY conv_id
  UNION ALL SELECT 'talks:none', NULL, NULL, false""")
def detail_first_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of rows that share an id the first by position counts, though time runs the other way."""
    days = F.expr("timestamp_ntz'2024-06-01 00:00:00'") - F.make_dt_interval(F.col("turn"))
    talks = views.raw(spark, sf_dir, "conversations").withColumns({"timestamp": days, "level": F.lit("info")})
    logs, _ = normalize.normalize_table(talks, SourceSpec("talks", {"id": "conv_id", "message": "text", "logger": "role"}, position="turn"), positions=True)
    ids = talks.select(F.concat(F.lit("talks:"), "conv_id").alias("lookup")).union(talks.sparkSession.range(1).select(F.lit("talks:none")))
    return investigate.bulk_detail(logs, ids).select("lookup", "logger", "position", "found")


@query("SELECT upper(event_type) AS level, count(*) AS n FROM events WHERE event_type IN ('click', 'error') GROUP BY ALL")
def levels_pushed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Levels in any spelling, asked of the raw column so that the scan skips the rest."""
    rows = filters.where_levels(views.raw_events(spark, sf_dir), "event_type", " Click,ERROR,,none ")
    return normalize.normalize_table(rows, views.EVENTS)[0].groupBy("level").agg(F.count("*").alias("n"))


@query(f"""WITH {EVENTS}, r AS (SELECT id, "timestamp", source, row_number() OVER (ORDER BY "timestamp", id, source) - 1 AS n, count(*) OVER () AS total FROM l)
  SELECT cast(n // 130 AS bigint) AS page, id, "timestamp", cast(least(130, total - n // 130 * 130) AS int) AS rows_in_page FROM r
  WHERE n // 130 IN (0, 7, (total - 1) // 130)""")
def page_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First, eighth and last page of all events, each read by its place."""
    index = paging.write_pages(views.events(spark, sf_dir).select("id", "timestamp", "source"), folder(spark, "pages"), 130, 8)
    manifest = index.pages()
    last = manifest.agg(F.max("page")).first()[0]
    rows = [index.page(n).select(F.lit(n).cast("long").alias("page"), "id", "timestamp") for n in dict.fromkeys((0, min(7, last), last))]
    return reduce(DataFrame.unionByName, rows).join(manifest.select("page", F.col("n").alias("rows_in_page")), "page")


HOT = """WITH l AS (SELECT cast(event_id AS varchar) AS id, ts AS "timestamp", upper(event_type) AS level, CASE WHEN event_id % 2 = 0 THEN 'hot' ELSE cast(user_id AS varchar) END AS request_id, 'events' AS source FROM events)"""


@query(f"""{HOT} SELECT request_id, "timestamp", id, source, level, lag(level) OVER w AS level_before,
  date_diff('microsecond', lag("timestamp") OVER w, "timestamp") / 1000000 AS gap_seconds,
  count(CASE WHEN level = 'ERROR' THEN 1 END) OVER (w ROWS UNBOUNDED PRECEDING) AS errors_so_far
  FROM l WINDOW w AS (PARTITION BY request_id ORDER BY "timestamp", id, source)""")
def timeline_gaps_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One id has half of all rows; its timeline is dealt to ranges of time."""
    logs = views.events(spark, sf_dir).withColumn("request_id", F.when(F.col("id").cast("long") % 2 == 0, "hot").otherwise(F.col("request_id")))
    return investigate.timeline_gaps_in_ranges(logs, "request_id", folder(spark, "ranges"), 12)


@query("""WITH g AS (SELECT CASE WHEN event_id % 3 = 0 THEN concat('hot', user_id % 150) ELSE concat('own', event_id) END AS bucket, count(*) AS n FROM events GROUP BY 1)
  SELECT 'events' AS source, bucket, n, (SELECT count(*) FROM g) > 100 AS truncated FROM (SELECT *, row_number() OVER (ORDER BY n DESC, bucket) AS r FROM g) WHERE r <= 100""")
def stats_heavy_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The largest of very many labels: candidates from a sketch, counted exactly, proven by the sketch's bound."""
    number = F.col("id").cast("long")
    label = F.when(number % 3 == 0, F.concat(F.lit("hot"), F.col("user_id").cast("long") % 150)).otherwise(F.concat(F.lit("own"), "id"))
    return stats.heavy_groups(views.events(spark, sf_dir).withColumn("logger", label), "logger", tracked=3000)


@query(f"""SELECT 'app' AS source, {BAD_EVENT} AS reason, count(*) AS n FROM events WHERE event_id % 10 <> 7 GROUP BY ALL""")
def jsonl_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines as a stream: rows and quarantine of every batch, each written once."""
    path = folder(spark, "ingested")
    lines = spark.readStream.option("maxFilesPerTrigger", "2").text(views.jsonl_folder(spark, sf_dir))
    jsonl.ingest(lines, WITH_ID, path, folder(spark, "ingest-checkpoint")).trigger(availableNow=True).start().awaitTermination()
    good, bad = jsonl.ingested(spark, WITH_ID, path)
    return normalize.quarantine_summary(bad).unionByName(good.groupBy("source").agg(F.count("*").alias("n")).withColumn("reason", F.lit(None).cast("string")))
