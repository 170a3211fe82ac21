"""CSV, XML, relational and topic sources; ranking tables."""

import pytest
from pyspark.sql import functions as F

from tillstream import schemas
from tillstream.operators.normalize import normalize_sales
from tillstream.operators.serve import latest_by_key, latest_windows
from tillstream.sinks.rankings import (
    append_rankings, compact_rankings, ranking_rows, read_rankings, replace_rankings,
)
from tillstream.sinks.topic import to_topic_records, write_topic
from tillstream.sources import csv_sales
from tillstream.sources.csv_sales import read_csv_sales, read_csv_sales_by_name
from tillstream.sources.legacy import poll_legacy, read_legacy_sales
from tillstream.sources.relational import load_mark, poll, save_mark, scan_since
from tillstream.sources.topic import read_topic
from tillstream.streaming.jobs import run_available

HEADER = "sale_id,salesman_name,city,country,amount,product,sale_date"


def test_csv_edge_cases(spark, tmp_path):
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "a.csv").write_text(
        HEADER + "\n"
        "F1, Ann ,X,BR,1.0,P,2026-02-19T08:00:00\n"
        "\n"
        'F2,"Y,Z",BR,2.0,P,D,extra\n'
        "F3,W\n")
    (tmp_path / "ignored.txt").write_text("x\n")
    expected = [
        ("F1", "Ann", "X", "BR", "1.0", "P", "2026-02-19T08:00:00"),
        ("F2", '"Y', 'Z"', "BR", "2.0", "P", "D"),
        ("F3", "W", None, None, None, None, None),
    ]
    for read in (read_csv_sales, read_csv_sales_by_name):
        assert sorted(map(tuple, read(spark, str(tmp_path)).collect()), key=str) == expected


def test_csv_with_other_column_order(spark, tmp_path):
    (tmp_path / "usual.csv").write_text(HEADER + "\nF1,Ann,X,BR,1.0,P,D\n")
    (tmp_path / "other.csv").write_text(" city , sale_id,note,amount\nY,F2,hello, 2.0 \nZ,F3,,\n")
    rows = read_csv_sales_by_name(spark, str(tmp_path)).orderBy("sale_id").collect()
    assert [(r.sale_id, r.city, r.amount, r.product) for r in rows] == [
        ("F1", "X", "1.0", "P"), ("F2", "Y", "2.0", None), ("F3", "Z", "", None)]
    with pytest.raises(Exception, match="header"):
        read_csv_sales(spark, str(tmp_path)).collect()


def test_csv_by_name_finds_headers_of_split_files(spark, tmp_path):
    lines = [f"F{i},Ann,city_{i % 7},BR,{i}.5,P,D" for i in range(3000)]
    (tmp_path / "big.csv").write_text("\n".join([HEADER, *lines]) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        rows = read_csv_sales_by_name(spark, str(tmp_path))
        assert rows.select("sale_id").distinct().count() == rows.count() == 3000
        assert rows.rdd.getNumPartitions() > 5
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_csv_by_name_in_both_ways(spark, tmp_path, monkeypatch):
    """By position for each header, and file by file: repeated names, odd file names, empty files."""
    (tmp_path / "a b%20c.csv").write_text("sale_id,city,city\nF1,X\nF2,X,Y\n\nF3,X,\nF4\n")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "header only.csv").write_text(HEADER + "\n")
    (tmp_path / "twice.csv").write_text(f"{HEADER}\n{HEADER}\nF5,Ann,X,BR,1.0,P,D\n")
    found = []
    for layouts in (32, 1):
        monkeypatch.setattr(csv_sales, "LAYOUTS", layouts)
        found.append(sorted(map(tuple, read_csv_sales_by_name(spark, str(tmp_path)).collect()), key=str))
    assert found[0] == found[1]
    assert {(r[0], r[2]) for r in found[0]} == {
        ("F1", "X"), ("F2", "Y"), ("F3", ""), ("F4", None), ("F5", "X"), ("sale_id", "city")}


def test_csv_stream_takes_each_file_once(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    (tmp_path / "in").mkdir()

    def run():
        writer = read_csv_sales(spark, source, streaming=True).writeStream.format(
            "parquet").option("path", out).option("checkpointLocation", checkpoint)
        run_available(writer)
        return spark.read.parquet(out).count()

    (tmp_path / "in" / "a.csv").write_text(HEADER + "\nF1,Ann,X,BR,1.0,P,D\n")
    assert run() == 1
    assert run() == 1
    (tmp_path / "in" / "b.csv").write_text(HEADER + "\nF2,Ann,X,BR,1.0,P,D\n")
    assert run() == 2


def test_legacy_responses(spark, tmp_path):
    sale = ("<sales><saleId>{0}</saleId><salesmanName>Ann</salesmanName><city>X</city>"
            "<country>BR</country><amount>1.5</amount><product>P</product>"
            "<saleDate>{1}</saleDate></sales>")
    (tmp_path / "r.xml").write_text(
        "<response>" + sale.format("L1", 1000) + sale.format("L2", 2000) + "</response>")
    assert read_legacy_sales(spark, str(tmp_path)).count() == 2
    rows = read_legacy_sales(spark, str(tmp_path), since_ms=1000).collect()
    assert [(r.saleId, r.amount, r.saleDate) for r in rows] == [("L2", 1.5, 2000)]


def test_pages_and_marks(spark, tmp_path, plan_of):
    spark.range(1, 26).write.parquet(str(tmp_path / "table"))
    table = spark.read.parquet(str(tmp_path / "table"))
    marks, topic = str(tmp_path / "marks"), str(tmp_path / "topic")

    sent = []

    def send(rows):
        sent.append(rows.count())
        write_topic(to_topic_records(rows), topic, fmt="parquet")

    assert load_mark(spark, marks) == 0
    assert load_mark(spark, marks, default=-1) == -1
    assert [poll(spark, table, marks, send, page=10) for _ in range(2)] == [25, 25]
    assert sent == [10, 10, 5]
    keys = [row.key for row in spark.read.parquet(topic).collect()]
    assert sorted(map(int, keys)) == list(range(1, 26))
    save_mark(spark, marks, 7, "other")
    assert (load_mark(spark, marks), load_mark(spark, marks, "other")) == (25, 7)
    save_mark(spark, marks, 3, "other")
    assert load_mark(spark, marks, "other") == 3
    assert len(list((tmp_path / "marks" / "producer_id=relational").iterdir())) == 2
    assert scan_since(table, 5).count() == 20
    plan = plan_of(scan_since(table, 5, page=10))
    assert "GreaterThan(id,5)" in plan and "TakeOrderedAndProject" in plan


def test_failed_send_keeps_the_mark(spark, tmp_path):
    marks = str(tmp_path / "marks")
    table = spark.range(1, 11)
    save_mark(spark, marks, 3)

    def send(rows):
        raise RuntimeError("broker down")

    with pytest.raises(RuntimeError):
        poll(spark, table, marks, send)
    assert load_mark(spark, marks) == 3


def test_record_keys_and_null_fields(spark):
    rows = spark.createDataFrame([(1, None), (None, "x")], "id long, city string")
    assert sorted(map(tuple, to_topic_records(rows).collect())) == [
        ("1", '{"id":1,"city":null}'), ("unknown", '{"id":null,"city":"x"}')]


def test_topic_formats(spark, tmp_path):
    records = spark.createDataFrame([("k", '{"id":1}')], "key string, value string")
    for fmt, frame in (("parquet", records), ("text", records.select("value"))):
        path = str(tmp_path / fmt)
        write_topic(frame, path, fmt=fmt)
        read = read_topic(spark, path, fmt=fmt, streaming=False)
        assert [tuple(r) for r in read.collect()] == [('{"id":1}',)]
    with pytest.raises(ValueError):
        read_topic(spark, "x", fmt="carrier pigeon")


def ranked(spark, rows):
    frame = spark.createDataFrame(rows, "start string, city string, total int, rank int")
    start = F.to_timestamp("start")
    return frame.select(
        start.alias("window_start"), (start + F.expr("interval 1 hour")).alias("window_end"),
        "city", F.col("total").alias("total_sales"), F.lit(1).alias("transaction_count"), "rank")


def contents(spark, path):
    table = latest_windows(read_rankings(spark, path, schemas.CITY_RANKING))
    return sorted((str(r.window_start)[11:16], r.city, r.rank) for r in table.collect())


def test_windows_are_replaced_as_a_whole(spark, tmp_path):
    path = str(tmp_path / "t")
    first = ranked(spark, [
        ("2026-02-19 08:00:00", "A", 5, 1), ("2026-02-19 08:00:00", "B", 4, 2),
        ("2026-02-19 09:00:00", "A", 3, 1), ("2026-02-20 10:00:00", "C", 3, 1)])
    second = ranked(spark, [("2026-02-19 08:00:00", "B", 9, 1)])
    replace_rankings(ranking_rows(first), path)
    before = contents(spark, path)
    replace_rankings(ranking_rows(first), path)
    assert contents(spark, path) == before
    replace_rankings(ranking_rows(second), path)
    assert contents(spark, path) == [("08:00", "B", 1), ("09:00", "A", 1), ("10:00", "C", 1)]
    replace_rankings(ranking_rows(second.limit(0)), path)
    assert len(contents(spark, path)) == 3


def test_appended_versions_all_stay(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = ranking_rows(ranked(spark, [("2026-02-19 08:00:00", "A", 5, 1)]))
    append_rankings(rows, path)
    append_rankings(rows, path)
    assert read_rankings(spark, path, schemas.CITY_RANKING).count() == 2


def test_appended_versions_fold_into_one_file(spark, tmp_path):
    path = tmp_path / "t"
    rows = ranking_rows(ranked(spark, [("2026-02-19 08:00:00", "A", 5, 1)]))
    for _ in range(3):
        append_rankings(rows, str(path))
    table = read_rankings(spark, str(path), schemas.CITY_RANKING)
    compact_rankings(latest_by_key(table), str(tmp_path / "folded"))
    assert contents(spark, str(tmp_path / "folded")) == [("08:00", "A", 1)]
    assert len(list((tmp_path / "folded").glob("window_date=*/*.parquet"))) == 1


def test_a_restated_window_with_fewer_rows_leaves_no_old_rank(spark, tmp_path):
    path = str(tmp_path / "t")
    append_rankings(ranking_rows(ranked(spark, [
        ("2026-02-19 08:00:00", "A", 5, 1), ("2026-02-19 08:00:00", "B", 4, 2)]), batch_id=9), path)
    replace_rankings(ranking_rows(ranked(spark, [("2026-02-19 08:00:00", "B", 9, 1)])), path)
    assert contents(spark, path) == [("08:00", "B", 1)]
    by_key = latest_by_key(read_rankings(spark, path, schemas.CITY_RANKING))
    assert sorted((r.city, r.rank) for r in by_key.collect()) == [("B", 1), ("B", 2)]


def test_legacy_poll(spark, tmp_path):
    sale = ("<sales><saleId>{0}</saleId><salesmanName>Ann</salesmanName><city>X</city>"
            "<country>BR</country><amount>1.5</amount><product>P</product>"
            "<saleDate>{1}</saleDate></sales>")
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "r.xml").write_text("<response>" + "".join(
        sale.format(f"L{i}", 1_000_000 * i) for i in range(1, 4)) + "</response>")
    folder, marks, sent = str(tmp_path / "in"), str(tmp_path / "marks"), []

    def send(rows):
        sent.append(sorted(r.saleId for r in rows.collect()))

    def fail(rows):
        raise RuntimeError("broker down")

    with pytest.raises(RuntimeError):
        poll_legacy(spark, folder, marks, fail, 2_200_000)
    assert load_mark(spark, marks, "legacy", -1) == -1
    assert poll_legacy(spark, folder, marks, send, 2_200_000) == 2_200_000
    assert poll_legacy(spark, folder, marks, send, 3_000_001) == 3_000_001
    assert poll_legacy(spark, folder, marks, send, 9_000_000) == 3_000_001
    assert sent == [["L2", "L3"], ["L3"]]


def test_three_shapes_of_a_sale_give_one_event(spark):
    texts = [
        '{"id":7,"salesman":"Ann","city":"X","country":"BR","amount":1.50,"product":"P",'
        '"sale_date":"2026-02-19T08:00:00Z","created_at":"2026-02-19T09:00:00Z"}',
        '{"sale_id":"7","salesman_name":"Ann","city":"X","country":"BR","amount":"1.50",'
        '"product":"P","sale_date":"2026-02-19T08:00:00"}',
        '{"saleId":"7","salesmanName":"Ann","city":"X","country":"BR","amount":1.5,'
        '"product":"P","saleDate":1771488000000,"source":"legacy"}',
    ]
    frame = spark.createDataFrame([(t,) for t in texts], "value string")
    events = normalize_sales(frame, "any", now_ms=F.lit(0).cast("bigint"))
    assert events.distinct().count() == 1
