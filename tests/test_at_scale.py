"""Numbered pages, hot timelines, very many labels, streamed lines: against the plain forms."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lanternlog.operators import investigate, paging, stats
from lanternlog.operators.filters import KEY
from lanternlog.sources.model import SourceSpec
from lanternlog.streaming import jsonl


def rows_of(rng, n, hot=0.5):
    start = datetime(2024, 1, 1)
    return [(str(i), start + timedelta(seconds=rng.randrange(n)), rng.choice(("INFO", "ERROR", "INFO")), "hot" if rng.random() < hot else rng.choice((None, "", "a", "b", f"r{rng.randrange(40)}")), rng.choice("xy")) for i in range(n)]


FIELDS = "id string, timestamp timestamp_ntz, level string, request_id string, source string"


@pytest.mark.parametrize("n, size, parts", [(1000, 70, 8), (1000, 1000, 3), (21, 1, 5), (10, 50, 4), (100, 10, 1)])
def test_pages_are_those_of_the_order(spark, tmp_path, n, size, parts):
    df = spark.createDataFrame(rows_of(random.Random(n), n), FIELDS)
    index = paging.write_pages(df.repartition(5), str(tmp_path / "pages"), size, parts)
    want = [r["id"] for r in df.orderBy(*KEY).collect()]
    manifest = {r["page"]: r for r in index.pages().collect()}
    assert sorted(manifest) == list(range(-(-n // size))) and sum(r["n"] for r in manifest.values()) == n
    for number in {0, 1, 3, -(-n // size) - 1, -(-n // size)}:
        got = index.page(number)
        assert [r["id"] for r in got.collect()] == want[number * size : (number + 1) * size]
        assert got.columns == df.columns
    firsts = {(r["part"], r["place"]): r["id"] for r in index.rows.collect()}
    assert all(firsts[r["part"], r["place"]] == want[p * size] for p, r in manifest.items())


def test_a_page_reads_its_parts_only(spark, tmp_path):
    df = spark.createDataFrame(rows_of(random.Random(3), 2000), FIELDS)
    index = paging.write_pages(df, str(tmp_path / "pages"), 100, 10)
    plan = index.page(7)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "part" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "place" in plan.split("PushedFilters: [")[1].split("]")[0]
    assert len(index.page(7).inputFiles()) <= 10 and "SinglePartition" not in index.rows._jdf.queryExecution().executedPlan().toString()
    empty = paging.write_pages(df.limit(0), str(tmp_path / "none"), 100, 4)
    assert empty.page(0).count() == 0 and empty.pages().count() == 0


def test_ranges_equal_the_window(spark, tmp_path):
    rng = random.Random(6)
    df = spark.createDataFrame(rows_of(rng, 3000) + [("t", datetime(2024, 1, 1), "ERROR", "tie", "x")] * 4, FIELDS).repartition(7)
    want = sorted(map(str, investigate.timeline_gaps(df, "request_id").collect()))
    for ranges in (1, 5, 23):
        got = investigate.timeline_gaps_in_ranges(df, "request_id", str(tmp_path / f"r{ranges}"), ranges)
        assert sorted(map(str, got.collect())) == want
    sizes = [r["count"] for r in spark.read.parquet(str(tmp_path / "r23")).groupBy("_range", "request_id").count().collect()]
    assert max(sizes) < 3 * 3000 / 23 and sum(sizes) == len(want)
    assert investigate.timeline_gaps_in_ranges(df.limit(0), "request_id", str(tmp_path / "none"), 3).count() == 0


def test_heavy_labels_are_exact_and_proven_or_counted(spark):
    rng = random.Random(9)
    rows = [("x", f"h{rng.randrange(60)}") for _ in range(6000)] + [("x", f"s{i}") for i in range(6000)]
    rows += [("y", f"s{i}") for i in range(3000)] + [("z", rng.choice(("a", "b", None, ""))) for _ in range(50)]
    df = spark.createDataFrame(rows, "source string, logger string").selectExpr("source", "logger", "'INFO' as level", "'s' as service", "timestamp_ntz'2024-01-01 00:00:00' as timestamp")
    want = sorted(map(tuple, stats.cap_groups(stats.count_dimensions(df, by_source=True), 40).where("dimension = 'logger'").select("source", "bucket", "n", "truncated").collect()))
    for tracked in (64, 1000, 100_000):
        assert sorted(map(tuple, stats.heavy_groups(df, "logger", 40, tracked).collect())) == want, tracked
    assert stats.heavy_groups(df.limit(0), "logger").count() == 0
    # Proven for x: no full count of its labels is in the plan.
    plan = stats.heavy_groups(df.where("source = 'x'"), "logger", 40, 4000)._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan


LINE = '{{"ts": "2024-05-01", "severity": "info", "msg": "m", "id": "{}"}}\n'
SPEC = SourceSpec("app", {"timestamp": "ts", "level": "severity", "message": "msg"})


def test_a_failed_batch_leaves_each_line_once(spark, tmp_path, monkeypatch):
    source, out, checkpoint = (tmp_path / x for x in ("in", "out", "ck"))
    source.mkdir()

    def run():
        query = jsonl.ingest(spark.readStream.text(str(source)), SPEC, str(out), str(checkpoint)).trigger(availableNow=True).start()
        query.awaitTermination(90)

    (source / "1.jsonl").write_text(LINE.format(1) + "no json\n\n" + LINE.format(2))
    run()
    (source / "2.jsonl").write_text(LINE.format(3) + "[]\n")
    shape, calls = jsonl.shape_jsonl, []

    def failing(raw, spec):
        calls.append(1)
        shaped = shape(raw, spec)
        if len(calls) == 1:
            # The batch is written, then its run fails before Spark notes it as done.
            shaped.withColumn("bad", F.col("_reason").isNotNull()).write.mode("overwrite").partitionBy("bad").parquet(f"{out}/batch=1")
            raise RuntimeError("lost")
        return shaped

    monkeypatch.setattr(jsonl, "shape_jsonl", failing)
    with pytest.raises(Exception, match="lost"):
        run()
    run()
    monkeypatch.undo()
    good, bad = jsonl.ingested(spark, SPEC, str(out))
    assert sorted(r["id"] for r in good.collect()) == ["1", "2", "3"]
    assert sorted(r["reason"] for r in bad.collect()) == ["invalid_json", "not_object"]
