"""Streams with state per series, running rankings, source watermarks and repeated micro-batches."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from test_metrics import SCHEMA, random_samples
from tillstream import schemas
from tillstream.operators import metrics
from tillstream.operators.aggregate import sales_by_window
from tillstream.operators.rank import top_n_per_window
from tillstream.sinks.rankings import append_once, read_rankings
from tillstream.streaming import open_windows, running, series, watermarks
from tillstream.streaming.jobs import ranking_job, run_available

SALES = "event_time timestamp, amount decimal(18,2), city string"
DAY = datetime(2024, 3, 1)


def in_portions(rows, at, seed):
    """Rows in order of time, shuffled within four seconds, cut into three portions."""
    draw = random.Random(seed)
    ordered = sorted(rows, key=lambda r: at(r) + timedelta(seconds=draw.random() * 4))
    cuts = sorted(draw.sample(range(1, len(rows)), 2))
    return [ordered[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)], strict=True)]


def appended(spark, folder, portions, job):
    """What a job appends, run anew after each portion."""
    for k, rows in enumerate(portions):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{folder}/in/portion={k}")
        stream = spark.readStream.schema(SCHEMA).parquet(f"{folder}/in/*")
        run_available(job(stream).writeStream.format("parquet").option(
            "checkpointLocation", f"{folder}/checkpoint").option("path", f"{folder}/out"))
    return spark.read.parquet(f"{folder}/out")


def closed(rows):
    newest = max(r[2] for r in rows)
    return [r for r in rows if r[2] <= newest - timedelta(seconds=5)]


@pytest.mark.parametrize("seed", [1, 3])
def test_streamed_rates_equal_batch(spark, tmp_path, seed):
    rows = random_samples(seed, n=300, spread=2000)
    found = appended(spark, tmp_path, in_portions(rows, lambda r: r[2], seed),
                     lambda s: series.stream_counter_rate(s, "series", 300, seq="seq"))
    batch = metrics.counter_rate(spark.createDataFrame(closed(rows), SCHEMA), "series", 300, seq="seq")
    assert sorted((r.series, r.seq, r.increase, r.rate) for r in found.collect()) == sorted(
        (r.series, r.seq, r.increase, r.rate) for r in batch.collect())


@pytest.mark.parametrize("seed", [1, 5])
def test_streamed_alerts_equal_batch(spark, tmp_path, seed):
    rows = random_samples(seed, n=300, spread=2000)
    log = appended(spark, tmp_path, in_portions(rows, lambda r: r[2], seed),
                   lambda s: series.stream_alert(s, "series", (10, 20), seq="seq"))
    batch = metrics.sustained_breaches(
        spark.createDataFrame(closed(rows), SCHEMA), "series", 10, 20, seq="seq")
    columns = batch.columns
    found = series.alert_stretches(log.unionByName(log), "series")
    assert sorted(map(tuple, found.select(columns).collect())) == sorted(map(tuple, batch.collect()))
    # Only the last stretch of a series may go on.
    last = {r.series: max(x.breach_start for x in found.collect() if x.series == r.series)
            for r in found.collect()}
    assert all(r.breach_start == last[r.series] for r in found.where("firing").collect())


def sales_rows(seed, n=200, hours=3):
    draw = random.Random(seed)
    return [(DAY + timedelta(seconds=draw.randrange(hours * 3600)), None, f"c{draw.randrange(15)}")
            for _ in range(n)]


def with_amounts(spark, rows):
    return spark.createDataFrame(rows, SALES).withColumn(
        "amount", F.pmod(F.xxhash64("event_time", "city"), F.lit(500)).cast("decimal(18,2)"))


def ranking(sales, n):
    return sorted(map(tuple, top_n_per_window(sales_by_window(sales, "city"), "city", n).select(
        "window_start", "city", "total_sales", "transaction_count", "rank").collect()))


def test_running_ranking_follows_every_portion_and_a_repeated_batch(spark, tmp_path):
    sales = with_amounts(spark, sales_rows(2))
    for k in range(3):
        sales.where(F.pmod(F.hash("event_time"), F.lit(3)) == k).write.parquet(f"{tmp_path}/in/p={k}")
        stream = spark.readStream.schema(SALES).parquet(f"{tmp_path}/in/*")
        writer = running.running_ranking_job(stream, "city", str(tmp_path / "out"),
                                             str(tmp_path / "checkpoint"), n=4, out_of_order="2 days")
        run_available(writer)
        changes = running.ranking_changes(spark, str(tmp_path / "out"), "city")
        found = running.folded(changes)
        come = sales.where(F.pmod(F.hash("event_time"), F.lit(3)) <= k)
        assert sorted(map(tuple, found.select(
            "window_start", "city", "total_sales", "transaction_count", "rank").collect())) == ranking(come, 4)
    # The last micro-batch once more: its rows are replaced, not doubled.
    before = sorted(map(tuple, changes.collect()), key=str)
    last = changes.agg(F.max("batch")).first()[0]
    totals = spark.createDataFrame(
        spark.read.parquet(f"{tmp_path}/out/totals/batch={last}").collect(), running._totals_schema("city"))
    running._rank_changes("city", str(tmp_path / "out"), 4)(totals, last)
    again = running.ranking_changes(spark, str(tmp_path / "out"), "city")
    assert sorted(map(tuple, again.collect()), key=str) == before


def test_running_ranking_is_written_by_window_not_by_one_task(spark, tmp_path):
    start = 1_771_459_200
    spark.createDataFrame([(start + 3600 * hour, float(hour % 7 + k), f"city{k}")
                           for hour in range(48) for k in range(3)], "s bigint, a double, city string").select(
        F.timestamp_seconds("s").alias("event_time"), F.col("a").cast("decimal(18,2)").alias("amount"),
        "city").write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("event_time TIMESTAMP, amount DECIMAL(18,2), city STRING").parquet(
        f"{tmp_path}/in")
    run_available(running.running_ranking_job(stream, "city", str(tmp_path / "out"),
                                              str(tmp_path / "checkpoint"), n=2, out_of_order="9 days"))
    changes = running.ranking_changes(spark, str(tmp_path / "out"), "city")
    rows = changes.select("window_start", F.input_file_name().alias("file")).collect()
    assert len(rows) == 96 and len({r.window_start for r in rows}) == 48
    assert len({(r.window_start, r.file) for r in rows}) == 48
    assert len({r.file for r in rows}) > 1


def test_open_and_closed_windows_make_up_all(spark, tmp_path):
    sales = with_amounts(spark, sales_rows(4))
    sales.write.parquet(f"{tmp_path}/in/p=0")
    stream = spark.readStream.schema(SALES).parquet(f"{tmp_path}/in/*")
    run_available(ranking_job(stream, "city", f"{tmp_path}/table", f"{tmp_path}/checkpoint", n=100))
    columns = ["window_start", "city", "total_sales", "transaction_count"]
    table = read_rankings(spark, f"{tmp_path}/table", schemas.CITY_RANKING).select(columns)
    still = open_windows.open_totals(spark, f"{tmp_path}/checkpoint", "city").select(columns)
    assert table.count() and still.count()
    assert sorted(map(tuple, table.unionByName(still).collect())) == sorted(
        map(tuple, sales_by_window(sales, "city").select(columns).collect()))


def test_a_batch_that_failed_after_its_write_is_recognised(spark, tmp_path):
    with_amounts(spark, sales_rows(6)).write.parquet(f"{tmp_path}/in/p=0")
    stream = spark.readStream.schema(SALES).parquet(f"{tmp_path}/in/*")

    def job(write):
        return ranking_job(stream, "city", f"{tmp_path}/table", f"{tmp_path}/checkpoint", write=write)

    def fail_after(rows, path):
        append_once(rows, path)
        if rows.count():
            raise ConnectionError

    with pytest.raises(StreamingQueryException):
        run_available(job(fail_after))
    written = read_rankings(spark, f"{tmp_path}/table", schemas.CITY_RANKING).count()
    run_available(job(append_once))
    table = read_rankings(spark, f"{tmp_path}/table", schemas.CITY_RANKING)
    assert written and table.count() == written
    assert table.groupBy("window_start").agg(F.count_distinct("updated_at", "batch_id").alias("n")).where(
        "n > 1").count() == 0


def test_a_lagging_source_holds_windows_and_a_heartbeat_lets_them_go(spark, tmp_path):
    beats = f"{tmp_path}/beats"
    watermarks.prepare_heartbeats(spark, beats, ["a", "b"])
    for source, hours in (("a", 5), ("b", 1)):
        rows = [(DAY + timedelta(hours=h, minutes=30), None, source) for h in range(hours)]
        with_amounts(spark, rows).write.parquet(f"{tmp_path}/{source}/p=0")
    streams = {s: spark.readStream.schema(SALES).parquet(f"{tmp_path}/{s}/*") for s in "ab"}
    now = [0]
    idle = watermarks.IdleSources(spark, beats, ["a", "b"], 60, clock=lambda: now[0])
    query = ranking_job(watermarks.with_source_watermarks(streams, heartbeats=beats), "city",
                        f"{tmp_path}/table", f"{tmp_path}/checkpoint", one_watermark=False).trigger(
        processingTime="0 seconds").start()
    try:
        query.processAllAvailable()
        table = read_rankings(spark, f"{tmp_path}/table", schemas.CITY_RANKING)
        assert table.count() == 0
        assert idle.look(query) == []
        now[0] = 60
        assert idle.look(query) == ["b"]
        query.processAllAvailable()
    finally:
        query.stop()
    closed_hours = {r.window_start.hour for r in read_rankings(
        spark, f"{tmp_path}/table", schemas.CITY_RANKING).collect()}
    assert closed_hours == {0, 1, 2, 3}


def test_only_the_smallest_watermark_is_accepted(spark):
    stream = spark.readStream.format("rate").load().withColumnRenamed("timestamp", "event_time")
    spark.conf.set("spark.sql.streaming.multipleWatermarkPolicy", "max")
    try:
        with pytest.raises(ValueError):
            watermarks.with_source_watermarks({"a": stream})
    finally:
        spark.conf.unset("spark.sql.streaming.multipleWatermarkPolicy")
