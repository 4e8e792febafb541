"""Facts of small literal logs; the session runs in a zone other than UTC."""

import json
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lanternlog.functions import timing
from lanternlog.functions.redaction import RedactionSpec, is_sensitive, mask_tree, redact_attributes, redact_text, sensitive_name, text_cleaner
from lanternlog.operators import filters, investigate, normalize, notices, page, stats
from lanternlog.operators.filters import Cursor, Filters
from lanternlog.sources.model import SourceSpec
from lanternlog.sources.readers import read_jsonl, union_sources
from lanternlog.streaming.rowwise import redacted_stream

LINES = """{"ts": "2026-05-30T07:00:00Z", "severity": "info", "msg": "start", "req": "req-1"}
{"ts": "2026-05-30T07:01:00", "severity": "WARNING", "msg": "slow", "req": "req-1", "n": 1.5}

not-json
[1, 2]
{"ts": "2026-05-30T03:02:00-04:00", "severity": "ERROR", "msg": "boom token=abc123", "req": "req-1", "traceback": "x bearer zz.yy", "secret": "hunter2"}
{"ts": "nope", "severity": "ERROR", "msg": "bad"}
{"ts": 1780124400, "severity": "ERROR", "msg": "epoch", "logger": 5}
{"ts": 1780124400, "severity": "ERROR", "msg": "old"}
"""
SPEC = SourceSpec("app", {"timestamp": "ts", "level": "severity", "message": "msg", "request_id": "req"})
START, END = datetime(2026, 5, 29, 8), datetime(2026, 5, 30, 8)


@pytest.fixture(scope="module")
def parts(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("logs") / "a.jsonl"
    path.write_text(LINES)
    return normalize.normalize_jsonl(read_jsonl(spark, str(path)), SPEC)


def test_jsonl_ids_times_and_quarantine(parts):
    good, bad = parts
    rows = {r["id"]: r for r in good.collect()}
    assert set(rows) == {"app:1", "app:2", "app:6", "app:9"}
    assert rows["app:6"]["timestamp"] == datetime(2026, 5, 30, 7, 2) and rows["app:9"]["timestamp"] == datetime(2026, 5, 30, 7)
    assert rows["app:1"]["level"] == "INFO" and rows["app:2"]["attributes"] == '{"n":1.5}'
    assert {(r["position"], r["reason"]) for r in bad.collect()} == {("4", "invalid_json"), ("5", "not_object"), ("7", "bad_timestamp"), ("8", "bad_type:logger")}


def test_pages_join_without_overlap(parts):
    f = Filters(levels="ERROR,WARNING", start=START, end=END)
    first = page.search(parts[0], f, 1)
    assert [r["id"] for r in first.kept().collect()] == ["app:6"]
    second = page.search(parts[0], f, 2, first.next_cursor())
    assert [r["id"] for r in second.kept().collect()] == ["app:2", "app:9"] and second.next_cursor() is None


def test_secrets_can_not_be_searched(parts):
    for text, ids in (("abc123", []), ("hunter2", []), ("zz.yy", []), ("BOOM", ["app:6"])):
        assert [r["id"] for r in page.search(parts[0], Filters(text=text)).kept().collect()] == ids
        assert [r["id"] for r in filters.with_text(parts[0], text, match="json").collect()] == ids
    shown = filters.with_text(parts[0], "boom").first()
    assert shown["attributes"] == '{"secret":"[REDACTED]"}' and shown["traceback"] == "x Bearer [REDACTED]"


def test_timeline_and_stats(parts):
    line = page.timeline(parts[0], Filters(request_id="req-1"), 2)
    assert [r["id"] for r in line.kept().collect()] == ["app:1", "app:2"] and line.next_cursor()
    with pytest.raises(ValueError):
        page.timeline(parts[0], Filters())
    got = {(r["dimension"], r["bucket"]): r["n"] for r in stats.log_stats(parts[0], Filters()).collect()}
    assert got["total", None] == 4 and got["time", "2026-05-30T07:00:00+00:00"] == 4 and got["service", "unknown"] == 4


def test_every_page_together_is_the_whole_order(spark):
    rows = [(f"{i % 5}", datetime(2024, 1, 1) + timedelta(minutes=i % 3), f"s{i % 4}") for i in range(60)]
    df = spark.createDataFrame(sorted(set(rows)), "id string, timestamp timestamp_ntz, source string")
    seen, cursor = [], None
    while True:
        p = page.search(df, Filters(), 7, cursor)
        seen += [tuple(r) for r in p.kept().collect()]
        if not (cursor := p.next_cursor()):
            break
    assert seen == sorted(set(rows), key=lambda r: (r[1], r[0], r[2]), reverse=True)
    assert Cursor.decode(Cursor(datetime(2024, 1, 1), "é", "s").encode()) == Cursor(datetime(2024, 1, 1), "é", "s")
    with pytest.raises(ValueError):
        Cursor.decode("%%")


TEXTS = [
    "failed with bearer abc.def and api_key=secret-value for a@example.com",
    "access_token=AAA then Authorization: Basic dXNlcjpwYXNz",
    'api_key="SECRET WITH SPACE" tail',
    "postgres://app:S3cretPw@db:5432/main redis://:onlypass@cache:6379/0",
    "Set-Cookie: session=abc; HttpOnly credentials=x passphrase=y",
    "eyJhbGciOi.eyJzdWIi.SIG stays",
    "https://host:8080/path?mail=a@b.co http://a.b/c",
    '{"password": "x y"} tokenize_strategy=1 étoken=q ſecret=z',
]


@pytest.mark.parametrize("emails", [False, True])
def test_text_rules_equal_python(spark, emails):
    spec = RedactionSpec(emails=emails, patterns=((r"st(?P<x>a)ys", r"<\g<x>>$"),))
    got = [r[0] for r in spark.createDataFrame([(t,) for t in TEXTS], "t string").select(redact_text(F.col("t"), spec)).collect()]
    want = []
    for t in TEXTS:
        for pattern, replacement, ignore in spec.rules()[:-1]:
            t = re.sub(pattern, re.sub(r"\$(\d)", r"\\\1", replacement), t, flags=re.I if ignore else 0)
        want.append(re.sub(r"st(?P<x>a)ys", r"<\g<x>>$", t))
    assert got == want


def test_long_text_is_cut_first(spark):
    got = spark.range(1).select(redact_text(F.lit("token=abc " + "x" * 60), RedactionSpec(max_chars=50))).first()[0]
    assert "abc" not in got and "[truncated 20 chars]" in got


def test_field_names(spark):
    spec = RedactionSpec(fields=("badge",))
    names = {n: True for n in "api_key apiKey refresh_token authToken client_secret X-Authorization passphrase badge".split()}
    names |= {n: False for n in "tokenize_strategy secretariat_email authored_by keyboard_layout session_count".split()}
    assert {n: is_sensitive(n, spec) for n in names} == names
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert {r[0]: r[1] for r in df.select("n", sensitive_name(F.col("n"), spec)).collect()} == names


def test_attributes_flat_nested_and_deep(spark):
    deep = '{"a":' * 60 + "1" + "}" * 60
    texts = ['{"a":1.50,"token":5,"s":"pwd=x","n":null,"b":true}', '{"o":{"password":"p","k":"v"}}', deep, "{}", None]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(redact_attributes(F.col("t"), RedactionSpec())).collect()]
    assert "[REDACTED]" in got[0] and '"s":"pwd=[REDACTED]"' in got[0] and '"n":null' in got[0] and "5" not in got[0].split('"token":')[1][:14]
    assert got[1] == '{"o":{"password":"[REDACTED]","k":"v"}}' and "[TRUNCATED]" in got[2] and got[3:] == ["{}", None]


def test_attribute_merge_overwrites_and_keeps_types(spark):
    df = spark.createDataFrame([("i", datetime(2024, 1, 1), "info", "m", '{"k": 1, "v": "x"}', 2.5), ("j", datetime(2024, 1, 1), "info", "m", "plain", 1.0)], "id string, timestamp timestamp_ntz, level string, message string, attributes string, k double")
    rows = {r["id"]: r["attributes"] for r in normalize.normalize_table(df, SourceSpec("t"))[0].collect()}
    assert {k: json.loads(v) for k, v in rows.items()} == {"i": {"k": 2.5, "v": "x"}, "j": {"attributes": "plain", "k": 1}}


def test_tables_union_keeps_colliding_ids(spark):
    row = [("X", datetime(2024, 1, 1), "info", "m")]
    a, b = (normalize.normalize_table(spark.createDataFrame(row, "id string, timestamp timestamp_ntz, level string, message string"), SourceSpec(n))[0] for n in "ab")
    assert [r["source"] for r in page.search(union_sources([a, b]), Filters()).kept().collect()] == ["b", "a"]


def test_time_helpers(spark):
    assert timing.duration(" 3h ") == timedelta(hours=3)
    for bad in ("0h", "5x", "99999999999999w"):
        with pytest.raises(ValueError):
            timing.duration(bad)
    texts = {"2024-03-10 02:30:00": datetime(2024, 3, 10, 2, 30), "2024-11-03T06:30:00Z": datetime(2024, 11, 3, 6, 30), "2024-05-01": datetime(2024, 5, 1), "2024": None, "T07:00": None, "20240501T070000Z": datetime(2024, 5, 1, 7), "2024-W22-6": datetime(2024, 6, 1), "": None}
    more = ["20240501", "2024W22", "2024-W22", "2024W226T0730", "2020-W53-7", "2021-W53-1", "2024-W00-1", "2024-W22-8", "2024-13-01T00", "20240230", "20240501T07", "2024-05-01T07:30:15,25+05", "20240501T073015.1234567-0330", "20240501T0730.5", "2024-0501", "2024-05-01x07:00", "20240501T250000"]
    for t in more:
        try:
            at = datetime.fromisoformat(t)
            texts[t] = (at - (at.utcoffset() or timedelta())).replace(tzinfo=None)
        except ValueError:
            texts[t] = None
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert {r[0]: r[1] for r in df.select("t", timing.parse_timestamp(F.col("t"), "string", odd_forms=True)).collect()} == texts
    with pytest.raises(ValueError):
        filters.window_of(datetime(2024, 1, 2), datetime(2024, 1, 1), datetime(2024, 1, 3))
    assert filters.window_of(None, None, datetime(2024, 1, 3)) == (datetime(2024, 1, 2), datetime(2024, 1, 3))


def test_label_cap_and_redacted_labels(spark):
    rows = [(f"l{i}",) for i in range(101)] + [("token=a",), ("token=b",)]
    df = spark.createDataFrame(rows, "logger string").selectExpr("'INFO' as level", "'s' as service", "logger", "timestamp_ntz'2024-01-01 00:00:00' as timestamp", "'x' as source")
    capped = stats.cap_groups(stats.count_dimensions(df, by_source=True)).where("dimension = 'logger'")
    assert capped.count() == 100 and capped.where("truncated").count() == 100
    merged = {r["bucket"]: r["n"] for r in stats.redact_labels(stats.count_dimensions(df)).where("dimension = 'logger'").collect()}
    assert merged["token=[REDACTED]"] == 2


def test_warnings_are_bounded(spark):
    df = spark.createDataFrame([(i, f"line {i}: token=s{i}") for i in range(40)] + [(99, "line 0: token=zz")], "place long, text string")
    rows = notices.summarize_warnings(df).collect()
    assert len(rows) == 21 and rows[-1]["text"] == "[20 more warnings suppressed]" and not any("s1" in r["text"] for r in rows)


def test_deploy_instant_counts_as_after(spark):
    at = datetime(2024, 1, 1, 12)
    logs = spark.createDataFrame([(at + timedelta(seconds=s), "ERROR") for s in (-61, -60, -1, 0, 60, 61)], "timestamp timestamp_ntz, level string")
    deploys = spark.createDataFrame([("d", at)], "deploy_id string, at timestamp_ntz")
    assert [tuple(r) for r in investigate.deploy_compare(logs, deploys, 60).collect()] == [("d", "ERROR", 2, 2)]


def test_no_secret_passes_whatever_the_layout(spark):
    texts = [
        '{\n "o": {"password":"hunter2"}\n}', '{"l":[{"token":"hunter2"}],\t"k":1}', '{"a":"x",\r\n"l":\n[["pwd=hunter2"]]}', ' \n{"Password" : "hunter2", "n": 1.50}\n',
        '{"token":"hunter2","token":"hunter2"}', '["password=hunter2"]', '{"a": {}, "b": []}', '{"secret": {"x": ["hunter2"]}}', "hunter2 {",
    ]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(redact_attributes(F.col("t"), RedactionSpec())).collect()]
    assert not any("hunter2" in g for g in got)
    assert json.loads(got[0]) == {"o": {"password": "[REDACTED]"}} and json.loads(got[3]) == {"Password": "[REDACTED]", "n": 1.5} and json.loads(got[6]) == {"a": {}, "b": []}


def test_tree_is_cut_by_depth_and_number(spark):
    clean = text_cleaner(RedactionSpec())
    assert mask_tree([1] * 100, RedactionSpec(max_nodes=10), clean) == [1] * 9 + ["[TRUNCATED]"] * 91
    assert mask_tree({"a": {"b": {"c": 1}}}, RedactionSpec(max_depth=2), clean) == {"a": {"b": {"c": "[TRUNCATED]"}}}
    assert mask_tree({"a": "token=x", "pwd": {"k": 1}, "l": ["pwd=y z", 2]}, RedactionSpec(), clean) == {"a": "token=[REDACTED]", "pwd": "[REDACTED]", "l": ["pwd=[REDACTED] z", 2]}


def test_line_numbers_over_many_splits(spark, tmp_path):
    for f in range(2):
        (tmp_path / f"{f}.jsonl").write_text("".join(f'{{"f": {f}, "n": {i + 1}}}\n' + "\n" * (i % 3 == 0) for i in range(4000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        rows = read_jsonl(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(rows) == 8000
    for r in rows:
        n = json.loads(r["_raw"])["n"]
        assert r["_position"] == n + (n + 1) // 3


def test_odd_lines(spark, tmp_path):
    lines = ["\t", '\t{"ts": "2024-05-01", "severity": "info", "msg": "tab"} \t', '{"ts": 20240501, "severity": "info", "msg": "number"}', '{"ts": "20240501T070000Z", "severity": "x", "severity": "info", "msg": "twice", "a": 1, "a": {"b": "2"}, "s": "5 x"}']
    (tmp_path / "odd.jsonl").write_text("\n".join(lines))
    good, bad = normalize.normalize_jsonl(read_jsonl(spark, str(tmp_path)), SPEC)
    rows = {r["message"]: r for r in good.collect()}
    assert bad.count() == 0 and {m: r["id"] for m, r in rows.items()} == {"tab": "app:2", "number": "app:3", "twice": "app:4"}
    assert rows["number"]["timestamp"] == datetime(1970, 8, 23, 6, 21, 41) and rows["twice"]["timestamp"] == datetime(2024, 5, 1, 7)
    assert rows["twice"]["level"] == "INFO" and json.loads(rows["twice"]["attributes"]) == {"a": {"b": "2"}, "s": "5 x"}


def test_rows_that_repeat_stay_in_expanded_errors(spark):
    rows = [("X", "s", "ERROR", "r", "j"), ("X", "s", "INFO", "r", None), ("Y", "s", "INFO", None, "j"), ("Z", "s", "INFO", "", None)]
    df = spark.createDataFrame(rows, "id string, source string, level string, request_id string, job_id string").withColumns({"trace_id": F.lit(None).cast("string"), "timestamp": F.lit(datetime(2024, 1, 1)).cast("timestamp_ntz")})
    assert sorted((r["id"], r["level"]) for r in investigate.expand_errors(df).collect()) == [("X", "ERROR"), ("X", "INFO"), ("Y", "INFO")]


def test_detail_recent_record_and_bounded(spark, parts):
    good = parts[0]
    assert investigate.detail(good, "app:6").first()["found"] and not investigate.detail(good, "app:77").first()["found"]
    assert {r["id"] for r in page.recent(good, Filters(), END).kept().collect()} == {"app:1", "app:2", "app:6", "app:9"}
    assert page.recent(good, Filters(), datetime(2026, 6, 2)).kept().count() == 0
    r = page.search(good, Filters(), 2).record().first()
    assert (r["count"], r["has_more"], [e["id"] for e in r["entries"]], r["next_place"]["id"]) == (2, True, ["app:6", "app:2"], "app:2")
    assert not page.search(good.limit(0), Filters(), 2).record().first()["has_more"]
    for scan, ids, incomplete in ((1, ["app:6"], {True}), (4, ["app:6"], {False})):
        rows = page.bounded_search(good, Filters(text="boom"), scan).collect()
        assert [r["id"] for r in rows] == ids and {r["incomplete"] for r in rows} == incomplete


def test_evidence_is_written_by_date_and_masked(spark, parts, tmp_path):
    page.write_evidence(parts[0], str(tmp_path / "out"))
    rows = spark.read.parquet(str(tmp_path / "out"))
    assert rows.count() == 4 and [str(r[0]) for r in rows.select("date").distinct().collect()] == ["2026-05-30"]
    assert not any("hunter2" in str(r) or "abc123" in str(r) for r in rows.collect())


def test_stream_equals_batch(spark, tmp_path):
    source = tmp_path / "in"
    batch = spark.createDataFrame([(i, datetime(2024, 1, 1) + timedelta(hours=i), "error" if i % 2 else "info", f"token=s{i}") for i in range(6)], "id long, timestamp timestamp_ntz, level string, message string")
    batch.write.parquet(str(source))
    shown = redacted_stream(spark.readStream.schema(batch.schema).parquet(str(source)), SourceSpec("t"), Filters(levels="error"))
    shown.writeStream.format("memory").queryName("masked_rows").trigger(availableNow=True).start().awaitTermination(60)
    assert sorted((r["id"], r["message"]) for r in spark.table("masked_rows").collect()) == [(str(i), "token=[REDACTED]") for i in (1, 3, 5)]


def test_filters_on_bare_columns_reach_the_scan(spark, tmp_path):
    df = spark.createDataFrame([("a", datetime(2024, 1, 1), "INFO", "m", "s")], "id string, timestamp timestamp_ntz, level string, message string, source string")
    df.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = stored.where(filters.build_predicate(Filters(levels="info", start=START)) & filters.id_is("s:a"))._jdf.queryExecution().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = plan[plan.index("PushedFilters") :]
    assert "GreaterThanOrEqual(timestamp" in pushed and "level,INFO" in pushed and "EqualTo(id,a)" in pushed
