"""Text pre-filter, bounded scans with state, one-pass quarantine, database and key=value sources, patterns of Python's own."""

import json
import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lanternlog.functions import redaction
from lanternlog.functions.redaction import RedactionSpec, raw_holds, redact_attributes, redact_text
from lanternlog.operators import filters, investigate, normalize, notices, page
from lanternlog.operators.filters import Cursor, Filters
from lanternlog.sources import logfmt
from lanternlog.sources.jdbc import range_predicates, read_jdbc
from lanternlog.sources.model import SourceSpec
from lanternlog.sources.readers import read_jsonl, read_table

COLUMNS = "id string, timestamp timestamp_ntz, level string, message string, service string, token string, attributes string, source string"
PIECES = (
    "user", "42", " ", " ", "token=abc", "Bearer abc.def", "authorization: xyz 12", "http://u:pw@h/x", "eyJab.cd.ef", "password = 'a b'", "x" * 40, "Done", "[", "]", "=", ":", "chars", "É", "İx", "ΑΣ", "mail@a.bc",
)


def log_rows(rng, n):
    def text():
        return "".join(rng.choice(PIECES) + rng.choice(("", " ")) for _ in range(rng.randint(1, 12)))

    def attributes():
        kind = rng.randrange(6)
        flat = {rng.choice(("k", "user", "password", "v w", "é")) + str(i): rng.choice((text(), 1, 1.5, True, None, 12345678901234567890)) for i in range(rng.randint(0, 4))}
        if kind == 0:
            return None
        if kind == 1:
            return rng.choice(("no json", '{"a":1,"a":2}', '{"a": 1e5}', '{"a":1.10,"b":"\\u0041b"}', '{ "a" : "x" }', '{"a":NaN}'))
        return json.dumps(flat if kind < 4 else {"o": flat, "l": [text(), 2]}, ensure_ascii=rng.random() < 0.5)

    start = datetime(2024, 1, 1)
    return [(str(i), start + timedelta(minutes=rng.randrange(50)), rng.choice(("INFO", "ERROR")), text(), rng.choice((None, "api", text())), "abc42", attributes(), rng.choice("ab")) for i in range(n)]


def test_prefilter_changes_no_result(spark, monkeypatch):
    rng = random.Random(8)
    df = spark.createDataFrame(log_rows(rng, 500), COLUMNS).cache()
    needles = ["[", "=", "bearer", "user", "R 42", "done", "4", "42", "k1", '"k0":', "1.5", "abc", "redacted", "d]", "chars", "trunc", "é", "i̇x", "ας", "mail", "authorization", "true", "x x", " ", "pw@h", "12345678901234567890", "100000", "ab", "e", "null", "]x"]
    needles += ["".join(rng.choice(PIECES) for _ in range(2))[: rng.randint(1, 9)] for _ in range(10)]
    for spec, some in ((RedactionSpec(max_chars=60), needles), (RedactionSpec(emails=True), ["mail", "user", "]", "x x"])):
        by_needle = {}
        for text in dict.fromkeys(some):
            by_needle[text] = sorted(map(str, filters.with_text(df, text, spec).collect()))
        monkeypatch.setattr(filters, "may_hold", lambda *_: None)
        for text, rows in by_needle.items():
            assert rows == sorted(map(str, filters.with_text(df, text, spec).collect())), text
        monkeypatch.undo()
        assert sum(raw_holds(t, spec) for t in by_needle) >= 2 * len(by_needle) // 5 and sum(map(bool, by_needle.values())) > len(by_needle) // 3


def test_prefilter_comes_before_the_rules(spark, tmp_path):
    assert not any(raw_holds(t, RedactionSpec()) for t in ("[", "=", "bearer ", "7", "x=", "]y", "auth", "4 chars", "redac", ""))
    assert not raw_holds("user", RedactionSpec(patterns=(("a", "user"),)))
    path = str(tmp_path / "rows")
    spark.createDataFrame(log_rows(random.Random(1), 20), COLUMNS).write.parquet(path)
    plan = filters.with_text(spark.read.parquet(path), "user")._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.split("\n")
    scan = next(i for i, line in enumerate(lines) if "Relation" in line)
    below = next(i for i, line in enumerate(lines) if "Filter" in line)
    assert below == scan - 1 and "user" in lines[below] and "REDACTED" not in lines[below]


@pytest.fixture(scope="module")
def logs(spark):
    rng = random.Random(2)
    return spark.createDataFrame(log_rows(rng, 300), COLUMNS).cache()


def test_walk_by_resume_equals_the_whole_search(spark, logs):
    for text, scan, limit, descending in (("user 42", 40, 3, True), ("user 42", 7, 5, False), ("eyJ", 100, 4, True), (None, 60, 25, False)):
        want = filters.with_text(logs, text) if text else filters.redact_entries(logs, full=True)
        keys = [tuple(r) for r in want.orderBy(*page.ordering(descending)).select(*filters.KEY).collect()]
        got, cursor, scanned, pages = [], None, 0, 0
        while True:
            r = page.bounded_scan(logs, Filters(text=text), scan, limit, cursor, descending=descending).first()
            got += [(e["timestamp"], e["id"], e["source"]) for e in r["entries"]]
            assert r["count"] == len(r["entries"]) <= limit and r["scanned"] <= scan and (r["next_cursor"] is None) == (r["next_place"] is None)
            pages += 1
            if r["next_cursor"] is None:
                assert not r["incomplete"] and not r["has_more"]
                break
            assert Cursor.decode(r["next_cursor"]) == Cursor(*r["next_place"]) and Cursor(*r["next_place"]).encode() == r["next_cursor"]
            cursor = r["next_cursor"]
        assert got == keys and pages > 2
    empty = page.bounded_scan(logs, Filters(text="not there"), 10).first()
    assert (empty["entries"], empty["scanned"], empty["incomplete"]) == ([], 10, True) and empty["next_cursor"]
    none = page.bounded_scan(logs.limit(0), Filters(text="x"), 10).first()
    assert (none["scanned"], none["incomplete"], none["next_cursor"], none["has_more"]) == (0, False, None, False)
    whole = page.bounded_scan(logs, Filters(text="not there"), 300).first()
    assert (whole["scanned"], whole["incomplete"]) == (300, False)


def test_record_has_filters_warnings_and_cursor(spark, logs):
    found = notices.summarize_warnings(spark.createDataFrame([(i, f"line {i}: token=s") for i in range(30)], "place long, text string"), most=2)
    f = Filters(levels="error, info", service="api", start=datetime(2024, 1, 1))
    r = page.search(logs, f, 3).record(f, found).first()
    assert r["filters"] == {"levels": "ERROR,INFO", "service": "api", "start": "2024-01-01 00:00:00"}
    assert r["warnings"] == ["line 0: token=[REDACTED]", "line 1: token=[REDACTED]", "[28 more warnings suppressed]"]
    assert Cursor.decode(r["next_cursor"]) == Cursor(*r["next_place"])
    assert page.search(logs, f, 3, r["next_cursor"]).kept().count() == 3


LINES = ['{"ts": "2024-05-01", "severity": "info", "msg": "a", "id": 1}', "no json", "[1]", '{"severity": "info", "msg": "b", "id": 2}', '{"ts": "2024-05-01", "msg": "c"}', '{"ts": "2024-05-01", "severity": "x", "msg": "d", "logger": 5}', '{"ts": "2024-05-02", "severity": "warn", "msg": "e"}']
SPEC = SourceSpec("app", {"timestamp": "ts", "level": "severity", "message": "msg"})


def test_quarantine_from_one_reading(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for i in range(4):
        (tmp_path / "in" / f"{i}.jsonl").write_text("\n".join(LINES * 3))
    lines = read_jsonl(spark, str(tmp_path / "in"), numbered=False)
    spec = SourceSpec("app", {**SPEC.field_map, "id": "msg"})
    good, bad = normalize.normalize_jsonl(lines, spec)
    want_good, want_bad = sorted(map(str, good.collect())), {tuple(r) for r in normalize.quarantine_summary(bad).collect()}
    shaped = normalize.shape_jsonl(lines, spec)
    one, two = normalize.split_once(shaped, str(tmp_path / "split"))
    assert sorted(map(str, one.collect())) == want_good and {tuple(r) for r in normalize.quarantine_summary(two).collect()} == want_bad
    kept, counts = normalize.watched(shaped, spec)
    assert kept._jdf.queryExecution().executedPlan().toString().count("FileScan text") == 1
    assert sorted(map(str, kept.collect())) == want_good
    seen = counts.get
    assert seen.pop("good") == len(want_good) and {("app", k, n) for k, n in seen.items() if n} == want_bad
    assert set(seen) == set(normalize.reasons(spec))


def test_positions_reach_the_bulk_lookup(spark):
    raw = spark.createDataFrame([("x", p, datetime(2024, 1, 30 - p), "info", f"m{p}") for p in (10, 9, 11)] + [("a:b", 1, datetime(2024, 1, 1), "info", "whole"), ("b", 2, datetime(2024, 1, 2), "info", "part")], "id string, line int, timestamp timestamp_ntz, level string, message string")
    rows, _ = normalize.normalize_table(raw, SourceSpec("a", position="line"), positions=True)
    more = normalize.normalize_table(raw.where("id = 'b'"), SourceSpec("z", position="line"), positions=True)[0]
    ids = spark.createDataFrame([("x",), ("a:x",), ("a:b",), ("b",), ("z:b",), ("q:x",), ("",), (":",)], "lookup string")
    got = {r["lookup"]: (r["message"], r["source"]) for r in investigate.bulk_detail(rows.union(more), ids.union(ids), priority={"z": 0, "a": 1}).collect()}
    assert got == {"x": ("m9", "a"), "a:x": ("m9", "a"), "a:b": ("whole", "a"), "b": ("part", "z"), "z:b": ("part", "z"), "q:x": (None, None), "": (None, None), ":": (None, None)}


def test_raw_levels_reach_the_scan(spark, tmp_path):
    df = spark.createDataFrame([(x, i) for i, x in enumerate(("error", "Error", "ERROR", "info", "Warn", None))], "lvl string, n int")
    df.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    got = filters.where_levels(stored, "lvl", "error, WARN")
    plan = got._jdf.queryExecution().toString()
    assert "Error" in (pushed := plan[plan.index("PushedFilters") :]) and "Warn" in pushed
    assert sorted(r["n"] for r in got.collect()) == [0, 1, 2, 4]
    assert sorted(r["n"] for r in filters.where_levels(stored, "lvl", "error, WARN", most=2).collect()) == [0, 1, 2, 4]
    assert filters.where_levels(stored, "lvl", " , ").count() == 6 and filters.where_levels(stored, "lvl", "none").count() == 0


def test_database_is_read_in_ranges(spark, tmp_path):
    options = {"url": "jdbc:derby:memory:tests;create=true", "driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver", "dbtable": "app.logs"}
    start = datetime(2024, 1, 1)
    rows = [(str(i), start + timedelta(hours=i) if i % 9 else None, "info" if i % 2 else "ERROR", f"m{i}", i) for i in range(200)]
    df = spark.createDataFrame(rows, "id string, at timestamp_ntz, level string, message string, n int")
    df.write.format("jdbc").options(**options, createTableColumnTypes="id varchar(20), level varchar(20), message varchar(100)").save()
    for column, parts in (("at", 4), ("n", 7), ("n", 1)):
        got = read_jdbc(spark, SourceSpec("logs", options=options), column, parts)
        assert got.rdd.getNumPartitions() == parts and sorted(map(tuple, got.collect()), key=str) == sorted(rows, key=str)
    spec = SourceSpec("logs", {"timestamp": "at"}, options=options)
    good, bad = normalize.normalize_table(read_jdbc(spark, spec, "at", 4), spec)
    assert good.count() == 177 and [tuple(r) for r in normalize.quarantine_summary(bad).collect()] == [("logs", "bad_timestamp", 23)]
    after = good.where(filters.after_cursor(Cursor(start + timedelta(hours=50), "50", "logs"), True))
    plan = after._jdf.queryExecution().toString()
    assert "LessThanOrEqual(at" in plan[plan.index("PushedFilters") :]
    assert sorted(int(r["id"]) for r in after.collect()) == [i for i in range(50) if i % 9]
    spark.createDataFrame([], df.schema).write.format("jdbc").options(**{**options, "dbtable": "empty"}, createTableColumnTypes="id varchar(20), level varchar(20), message varchar(100)").save()
    assert read_jdbc(spark, SourceSpec("e", options={**options, "dbtable": "empty"}), "n").count() == 0
    with pytest.raises(ValueError):
        read_jdbc(spark, SourceSpec("e", options={**options, "dbtable": "(select 1)"}), "n")
    assert range_predicates("n", 0, 3, 10) == ["n < 1 OR n IS NULL", "n >= 1 AND n < 2", "n >= 2"] and range_predicates("n", 5, 5, 4) == ["1 = 1"]


def logfmt_lines():
    yield 'ts=2024-05-01T10:00:00 level=info id=1 msg="said \\"no\\" \\\\ end" user=3 empty="" none='
    yield "ts=2024-05-01T10:00:01.5 level=error id=2 msg=short"
    yield from ("", "  ", "free text", "ts=never level=info", "level=info id=3", 'ts=2024-05-01 msg="open', "ts=2024-05-01T10:00:00+02:00 level=x")
    yield "ts=2024-05-03 level=info id=4 msg=ünï"


def test_key_value_files(spark, tmp_path):
    logfmt.register(spark)
    text = "\n".join(logfmt_lines())
    for name, body in (("a.log", text + "\n"), ("b.log", text), ("c.log", ""), ("_hidden", text), ("d.log", "x" * 70_000 + "\n" + text)):
        (tmp_path / name).write_text(body)
    want = [logfmt.line_values(line) for line in logfmt_lines() if line.strip()] * 3 + [logfmt.line_values("x" * 70_000)]
    for split in (1, 7, 64, 100_000, 1 << 20):
        spec = SourceSpec("kv", {"timestamp": "ts", "message": "msg"}, format=logfmt.FORMAT, options={"splitBytes": str(max(split, 50))})
        rows = [tuple(r) for r in read_table(spark, spec, str(tmp_path)).collect()]
        assert sorted(map(str, rows)) == sorted(map(str, want)), split
        spans = [logfmt.Span(p, at, min(at + split, size)) for p, size in logfmt.files(str(tmp_path)) if size < 5000 for at in range(0, size, split)]
        assert sorted(str(r) for s in spans for r in logfmt.read_span(str(tmp_path), s, logfmt.Terms())) == sorted(map(str, want[: 2 * len(want) // 3]))
    source = spark.read.format("logfmt").load(str(tmp_path))
    low = F.lit("2024-05-01 10:00:01").cast("timestamp_ntz")
    found = source.where((F.col("level") == "info") & (F.col("ts") > low) & (F.length("msg") == 3))
    assert [r["id"] for r in found.collect()] == ["4"] * 3
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "length(msg" in plan and not re.search(r"level#\d+ = info|ts#\d+ >", plan)
    assert source.where("level is null").count() == 3 * 5 + 1 and source.where(F.col("level").isin("info", "error")).count() == 9


def test_key_value_stream(spark, tmp_path):
    logfmt.register(spark)
    (tmp_path / "in").mkdir()
    line = "ts=2024-05-0{0} level=info id={0} msg=m\n"

    def run():
        rows = spark.readStream.format("logfmt").load(str(tmp_path / "in")).select("id", "ts")
        rows.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "ck")).option("path", str(tmp_path / "out")).trigger(availableNow=True).start().awaitTermination(90)
        return sorted(r["id"] for r in spark.read.parquet(str(tmp_path / "out")).collect())

    (tmp_path / "in" / "1.log").write_text(line.format(1) + line.format(2))
    assert run() == ["1", "2"]
    (tmp_path / "in" / "2.log").write_text(line.format(3))
    assert run() == ["1", "2", "3"]


def test_patterns_of_python_keep_meaning_and_order(spark):
    texts = ["<a> b> c", "xxxx do ddoneee", "id 5\n", "id 5", "a[b&&c]d", "line\r\nend", None, "", "ééé 42"]
    df = spark.createDataFrame([(t, json.dumps({"k": t})) for t in texts], "t string, attributes string")
    for patterns in (
        ((r"(<)?\w+(?(1)>|$)", "T"),), ((r"d{,3}o", "D"),), ((r"5\Z", "E"),), ((r"[b&&c]", "S"),), ((r"[[]b", "B"),), ((r"(?P<two_words>\w+) (\w+)", r"\2 \g<two_words>"),),
        ((r"x", "yy"), (r"(y)?y(?(1)y|z)", "Q"), (r"Q", "$1\\\\")), ((r".+$", "L"),), ((r"(a)|b", r"[\1]"),),
    ):
        spec = RedactionSpec(patterns=patterns)
        want = []
        for t in texts:
            for p, r in patterns:
                t = re.sub(p, r, t) if t is not None else None
            want.append(t)
        rows = df.select(redact_text(F.col("t"), spec), redact_attributes(F.col("attributes"), spec)).collect()
        assert [r[0] for r in rows] == want, patterns
        assert [json.loads(r[1])["k"] for r in rows] == want, patterns
    assert redaction.java_takes(r"a(b)\1") and not redaction.java_takes(r"(?(1)a|b)") and not redaction.java_takes(r"x{,3}")
    with pytest.raises(re.error):
        RedactionSpec(patterns=(("(", "x"),))
