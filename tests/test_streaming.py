"""Streaming jobs, one file per micro-batch."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from tillstream import schemas
from tillstream.operators.normalize import read_unified, with_event_time
from tillstream.operators.serve import latest_by_key
from tillstream.plans.batch import top_cities
from tillstream.sinks.rankings import read_rankings, replace_rankings
from tillstream.sinks.topic import unified_records
from tillstream.sources.topic import read_topic
from tillstream.streaming.jobs import (
    normalization_job, quarantine_job, ranking_job, ranking_quarantine_job, run_available,
    start_continuous,
)
from tillstream.streaming.progress import ProgressLog, progress_samples


def ms(clock):
    hours, minutes, seconds = map(int, clock.split(":"))
    return 1771459200000 + (hours * 3600 + minutes * 60 + seconds) * 1000


class Feed:
    """A unified topic of text files, each read as a micro-batch of its own."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.files = spark, folder, 0
        (folder / "topic").mkdir()

    def add(self, *sales):
        path = self.folder / "topic" / f"f{self.files}.txt"
        path.write_text("".join(json.dumps({
            "saleId": "s", "salesmanName": name, "city": name, "country": country,
            "amount": amount, "product": "p", "eventTime": ms(clock), "source": "files",
            "ingestionTime": 0}) + "\n" for name, country, amount, clock in sales))
        os.utime(path, (1_700_000_000 + self.files, 1_700_000_000 + self.files))
        self.files += 1

    def run(self, key="city", country=None, table="table", **options):
        records = read_topic(self.spark, str(self.folder / "topic"), fmt="text",
                             options={"maxFilesPerTrigger": "1"})
        return run_available(ranking_job(
            with_event_time(read_unified(records)), key, str(self.folder / table),
            str(self.folder / f"{table}-checkpoint"), country=country, **options))

    def rows(self, schema=schemas.CITY_RANKING, key="city", table="table"):
        table = read_rankings(self.spark, str(self.folder / table), schema)
        found = latest_by_key(table).collect()
        return sorted((str(r.window_start)[11:16], r.rank, r[key], float(r.total_sales),
                       r.transaction_count) for r in found)


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


def test_row_in_the_batch_after_the_watermark_passed_still_counts(feed):
    feed.add(("A", "BR", 10, "08:01:00"), ("B", "BR", 20, "08:02:00"), ("A", "BR", 15, "08:59:59"))
    feed.add(("C", "BR", 1, "09:00:04"))
    feed.add(("A", "BR", 100, "08:30:00"))
    feed.add(("C", "BR", 1, "09:00:05"))
    feed.add(("B", "BR", 999, "08:30:00"))
    feed.add(("C", "BR", 5, "10:30:00"))
    feed.run()
    assert feed.rows() == [
        ("08:00", 1, "B", 1019.0, 2), ("08:00", 2, "A", 125.0, 3), ("09:00", 1, "C", 2.0, 2)]


def test_later_rows_are_dropped_and_counted(feed):
    feed.add(("A", "BR", 10, "08:01:00"))
    feed.add(("C", "BR", 1, "09:00:05"))
    feed.add(("D", "BR", 2, "09:00:06"))
    feed.add(("B", "BR", 999, "08:30:00"))
    feed.add(("C", "BR", 5, "10:30:00"))
    query = feed.run()
    assert feed.rows() == [
        ("08:00", 1, "A", 10.0, 1), ("09:00", 1, "D", 2.0, 1), ("09:00", 2, "C", 1.0, 1)]
    samples = progress_samples(feed.spark, query)
    dropped = samples.where("series = 'rows_dropped_late'").agg(F.sum("value")).first()[0]
    assert dropped == 1
    assert samples.where("series = 'input_rows'").agg(F.sum("value")).first()[0] == 5


def test_window_closes_exactly_five_seconds_after_its_end(feed):
    feed.add(("A", "BR", 10, "08:01:00"), ("C", "BR", 1, "09:00:04"))
    feed.run()
    assert not list(feed.folder.glob("table/window_date=*"))
    feed.add(("C", "BR", 1, "09:00:05"))
    feed.run()
    assert feed.rows() == [("08:00", 1, "A", 10.0, 1)]


def test_rows_of_other_countries_advance_the_watermark(feed):
    feed.add(("Ann", "bR", 10, "08:01:00"), ("Bob", "AR", 99, "08:02:00"))
    feed.add(("Bob", "AR", 1, "09:00:05"))
    query = feed.run("salesman_name", "BR", "men")
    rows = feed.rows(schemas.SALESMAN_RANKING, "salesman_name", "men")
    assert rows == [("08:00", 1, "Ann", 10.0, 1)]
    observed = [p["observedMetrics"]["arrived"]["rows"] for p in query.recentProgress
                if "arrived" in p.get("observedMetrics", {})]
    assert sum(observed) == 3


@pytest.mark.parametrize("options", [{}, {"write": replace_rankings}])
def test_restart_goes_on_and_replay_changes_nothing(feed, options):
    feed.add(("A", "BR", 10, "08:01:00"))
    feed.add(("A", "BR", 1, "09:30:00"))
    feed.run(**options)
    feed.add(("A", "BR", 2, "09:40:00"), ("B", "BR", 1, "10:30:00"))
    feed.run(**options)
    once = feed.rows()
    assert once == [("08:00", 1, "A", 10.0, 1), ("09:00", 1, "A", 3.0, 2)]
    # As after losing the checkpoint: everything is read and ranked again into the same table.
    records = read_topic(feed.spark, str(feed.folder / "topic"), fmt="text")
    run_available(ranking_job(with_event_time(read_unified(records)), "city",
                              str(feed.folder / "table"), str(feed.folder / "again"), **options))
    assert feed.rows() == once
    table = read_rankings(feed.spark, str(feed.folder / "table"), schemas.CITY_RANKING)
    assert table.count() == 2 * len(once)


def test_stream_equals_batch_on_closed_windows(feed):
    names = ["A", "B", "C", "D"]
    sales = [(names[i * 7 % 4], "BR", i % 13, f"{8 + i // 40:02}:{i % 40:02}:00")
             for i in range(160)]
    feed.add(*sales)
    feed.add(("Z", "BR", 1, "23:00:00"))
    feed.run()
    records = read_topic(feed.spark, str(feed.folder / "topic"), fmt="text", streaming=False)
    batch = top_cities(with_event_time(read_unified(records))).where("hour(window_start) < 23")
    expected = sorted((str(r.window_start)[11:16], r.rank, r.city, float(r.total_sales),
                       r.transaction_count) for r in batch.collect())
    assert feed.rows() == expected and expected


def test_normalization_stream_unifies_and_skips_malformed(spark, tmp_path):
    texts = {
        "postgres": ['{"id":1,"salesman":"Ann","sale_date":"2026-02-19T08:00:00Z","amount":1.5}',
                     '{"id":'],
        "files": ['{"sale_id":"F1","salesman_name":"Bob","amount":"2","sale_date":"2026-02-19T08:00"}'],
        "legacy": ['{"saleId":"L1","salesmanName":"Cy","amount":3,"saleDate":1771488000000}'],
    }
    for source, lines in texts.items():
        (tmp_path / source).mkdir()
        (tmp_path / source / "a.txt").write_text("\n".join(lines) + "\n")
    topics = {s: read_topic(spark, str(tmp_path / s), fmt="text") for s in texts}
    out = str(tmp_path / "unified")
    query = run_available(normalization_job(
        topics, out, str(tmp_path / "cp"), fmt="text", now_ms=F.lit(5).cast("bigint")))
    counted = [p["observedMetrics"] for p in query.recentProgress]
    assert sum(metrics["quality_postgres"]["records"] for metrics in counted) == 1
    assert sum(metrics["quality_postgres_read"]["malformed"] for metrics in counted) == 1
    run_available(quarantine_job(topics, str(tmp_path / "aside"), str(tmp_path / "aside-cp")))
    aside = spark.read.schema("source string, value string").parquet(str(tmp_path / "aside"))
    assert [tuple(r) for r in aside.collect()] == [("postgres", '{"id":')]
    assert sum(metrics["quality_files"]["zero_amount"] for metrics in counted) == 0
    lines = sorted(r.value for r in spark.read.text(out).collect())
    assert [json.loads(line)["source"] for line in lines] == ["postgres", "files", "legacy"]
    assert json.loads(lines[0]) == {
        "saleId": "1", "salesmanName": "Ann", "city": "", "country": "", "amount": 1.5,
        "product": "", "eventTime": 1771488000000, "source": "postgres", "ingestionTime": 5}
    events = read_unified(read_topic(spark, out, fmt="text", streaming=False))
    assert events.schema.names == schemas.SALES_EVENT.names
    assert sorted(r.value for r in unified_records(events).collect()) == lines


def test_unusable_unified_records_are_set_aside(spark, tmp_path):
    good = {"saleId": "a", "salesmanName": "n", "city": "X", "country": "BR", "amount": 1.0,
            "product": "p", "eventTime": ms("08:00:00"), "source": "files", "ingestionTime": 0}
    lines = [json.dumps(good), json.dumps(good | {"saleId": "b"}), "{broken",
             json.dumps(good | {"eventTime": 2**62, "saleId": "far"}),
             json.dumps(good | {"eventTime": None}), json.dumps(good | {"amount": "x"}), ""]
    (tmp_path / "topic").mkdir()
    (tmp_path / "topic" / "a.txt").write_text("\n".join(lines) + "\n")
    batch = read_topic(spark, str(tmp_path / "topic"), fmt="text", streaming=False)
    assert with_event_time(read_unified(batch)).count() == 2
    stream = read_topic(spark, str(tmp_path / "topic"), fmt="text", max_per_trigger=1)
    run_available(ranking_quarantine_job(stream, str(tmp_path / "aside"), str(tmp_path / "cp")))
    aside = spark.read.schema("reason string, value string").parquet(str(tmp_path / "aside"))
    got = sorted((r.reason, r.value) for r in aside.collect())
    assert [reason for reason, _ in got] == ["unplaceable"] + ["unreadable"] * 4
    assert json.loads(got[0][1])["saleId"] == "far"
    assert {value for _, value in got[1:]} == {lines[2], lines[4], lines[5], ""}


def test_continuous_job_commits_and_stops(feed, spark, tmp_path):
    feed.add(("A", "BR", 10, "08:01:00"), ("C", "BR", 1, "10:00:00"))
    records = read_topic(spark, str(feed.folder / "topic"), fmt="text")
    log = ProgressLog(spark, str(tmp_path / "progress"))
    spark.streams.addListener(log)
    try:
        query = start_continuous(ranking_job(
            with_event_time(read_unified(records)), "city", str(feed.folder / "table"),
            str(feed.folder / "continuous")), "1 second")
        deadline = time.time() + 60
        while not list(feed.folder.glob("table/window_date=*")) and time.time() < deadline:
            time.sleep(0.5)
        query.processAllAvailable()
        query.stop()
        while not list((tmp_path / "progress").glob("*.parquet")) and time.time() < deadline:
            time.sleep(0.5)
    finally:
        spark.streams.removeListener(log)
    assert feed.rows() == [("08:00", 1, "A", 10.0, 1)]
    samples = spark.read.schema(schemas.METRIC_SAMPLE).parquet(str(tmp_path / "progress"))
    assert samples.where("series = 'input_rows'").count() >= 1
