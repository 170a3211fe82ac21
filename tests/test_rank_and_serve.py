"""Windowed totals, top-N, and the reads of a ranking table."""

import random

import pytest
from pyspark.sql import functions as F

from tillstream.operators import serve
from tillstream.operators.aggregate import merge_partials, sales_by_window
from tillstream.operators.normalize import filter_country
from tillstream.operators.rank import by_rank, clamp_limit
from tillstream.plans.batch import top_cities, top_salesmen


def sales(spark, rows):
    frame = spark.createDataFrame(
        rows, "salesman_name string, city string, country string, amount double, at string")
    return frame.select(
        "salesman_name", "city", "country", F.col("amount").cast("decimal(18,2)").alias("amount"),
        F.to_timestamp("at").alias("event_time"))


def random_sales(seed, n=2000):
    rng = random.Random(seed)
    return [(f"m{rng.randrange(40)}", "hot" if rng.random() < 0.4 else f"c{rng.randrange(60)}",
             rng.choice(["BR", "br", "Br", " BR", "AR"]), rng.randrange(0, 5000) / 100,
             f"2026-02-19 {rng.randrange(24):02}:{rng.randrange(60):02}:00") for _ in range(n)]


def brute_top(rows, key, n):
    totals = {}
    for row in rows:
        window = row[4][11:13]
        cents, count = totals.get((window, row[key]), (0, 0))
        totals[window, row[key]] = (cents + round(row[3] * 100), count + 1)
    out = []
    for window in {w for w, _ in totals}:
        best = sorted(((-t[0], name, t[1]) for (w, name), t in totals.items() if w == window))
        out += [(window, name, -cents, count, i + 1)
                for i, (cents, name, count) in enumerate(best[:n])]
    return sorted(out)


def got_top(df, key):
    return sorted((r.window_start.strftime("%H"), r[key], int(r.total_sales * 100),
                   r.transaction_count, r.rank) for r in df.collect())


@pytest.mark.parametrize("seed, n", [(1, 10), (2, 3), (3, 1000)])
def test_top_cities(spark, seed, n):
    rows = random_sales(seed)
    assert got_top(top_cities(sales(spark, rows), n), "city") == brute_top(rows, 1, n)


def test_top_salesmen_of_one_country_in_any_case(spark):
    rows = random_sales(4)
    ranked = top_salesmen(sales(spark, rows))
    brazil = [row for row in rows if row[2].upper() == "BR"]
    assert got_top(ranked, "salesman_name") == brute_top(brazil, 0, 10)
    assert {r.country for r in ranked.select("country").distinct().collect()} == {"BR"}


def test_salted_top_is_the_same(spark):
    rows = random_sales(5)
    ranked = top_cities(sales(spark, rows), 7, salts=16)
    assert got_top(ranked, "city") == brute_top(rows, 1, 7)
    assert "salted_rank" not in ranked.columns


def test_ties_go_to_the_smaller_key(spark):
    rows = [("m", c, "BR", 5.0, "2026-02-19 08:00:00") for c in ("B", "A", "C")]
    ranked = top_cities(sales(spark, rows), 2).orderBy("rank").collect()
    assert [(r.city, r.rank) for r in ranked] == [("A", 1), ("B", 2)]


def test_plan_cuts_before_each_shuffle(spark, plan_of, tmp_path):
    sales(spark, random_sales(6)).write.parquet(str(tmp_path / "s"))
    plan = plan_of(top_cities(spark.read.parquet(str(tmp_path / "s"))))
    assert plan.count("Exchange hashpartitioning") == 2
    assert plan.count("WindowGroupLimit") == 2
    assert "partial_sum" in plan
    assert "salesman_name" not in plan


def test_partials_merge_to_the_whole(spark):
    frame = sales(spark, random_sales(7))
    parts = [sales_by_window(frame.where(F.col("country") == c), "city")
             for c in ("BR", "br", "Br", " BR", "AR")]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    merged = merge_partials(union, "city")
    whole = sales_by_window(frame, "city")
    assert merged.dtypes == whole.dtypes
    assert merged.exceptAll(whole).count() == whole.exceptAll(merged).count() == 0


def test_country_filter_does_not_trim(spark):
    frame = spark.createDataFrame([("BR",), ("bR",), (" BR",), ("",), ("BRA",)], "country string")
    assert filter_country(frame).count() == 2


def log(spark, rows, with_country=False):
    frame = spark.createDataFrame(
        rows, "start string, name string, country string, total int, rank int, version string,"
              " batch_id long")
    start = F.to_timestamp("start")
    return frame.select(
        start.alias("window_start"), (start + F.expr("interval 1 hour")).alias("window_end"),
        F.col("name").alias("salesman_name" if with_country else "city"), "country",
        F.col("total").cast("decimal(18,2)").alias("total_sales"),
        F.lit(1).cast("bigint").alias("transaction_count"), "rank",
        F.to_timestamp("version").alias("updated_at"), "batch_id")


LOG = [
    ("2026-02-19 08:00:00", "A", "BR", 5, 1, "2026-02-19 09:00:05", 1),
    ("2026-02-19 08:00:00", "B", "BR", 4, 2, "2026-02-19 09:00:05", 1),
    ("2026-02-19 08:00:00", "C", "BR", 9, 1, "2026-02-19 09:00:35", 2),
    ("2026-02-19 08:00:00", "D", "BR", 8, 1, "2026-02-19 09:00:35", 3),
    ("2026-02-19 09:00:00", "E", "BR", 1, 1, "2026-02-19 10:00:05", 1),
    ("2026-02-19 09:00:00", "F", "AR", 1, 1, "2026-02-19 10:00:06", 2),
]


def test_newest_version_wins_then_the_later_insert(spark):
    rows = serve.latest_by_key(log(spark, LOG)).collect()
    assert sorted((str(r.window_start)[11:13], r.rank, r.city) for r in rows) == [
        ("08", 1, "D"), ("08", 2, "B"), ("09", 1, "F")]


def test_country_is_looked_at_after_replacement(spark):
    table = log(spark, LOG, with_country=True)
    assert [r.salesman_name for r in serve.latest_rankings(table, "BR").collect()] == ["D", "B"]
    assert [r.salesman_name for r in serve.latest_rankings(table, "AR").collect()] == ["F"]
    assert serve.latest_rankings(table, "br").count() == 0


@pytest.mark.parametrize("text", [
    "2026-02-19T08:00:00Z", "2026-02-19T08:00:00", "2026-02-19 08:00:00", "2026-02-19 08:00",
    "2026-02-19T05:00:00-03:00", "1771488000", "20260219080000"])
def test_window_texts(spark, text):
    rows = serve.rankings_for_window(log(spark, LOG), text).collect()
    assert [r.city for r in rows] == ["D", "B"]


def test_bad_window_text_fails(spark):
    with pytest.raises(Exception):
        serve.rankings_for_window(log(spark, LOG), "soon").collect()


@pytest.mark.parametrize("limit, expected", [(0, 1), (-5, 1), (1, 1), (10, 10), (101, 100)])
def test_limit_is_clamped(limit, expected):
    assert clamp_limit(limit) == expected


def test_limit_cuts_by_rank(spark):
    rows = serve.rankings(log(spark, LOG), "2026-02-19T08:00:00Z", limit=0).collect()
    assert [r.city for r in rows] == ["D"]
    assert by_rank(spark.range(300).withColumnRenamed("id", "rank"), 250).count() == 250


def test_large_totals_stop_nothing(spark):
    rows = [("m", "A", "BR", 9e15, "2026-02-19 08:00:00")] * 2
    ranked = top_cities(sales(spark, rows)).collect()
    assert [(str(r.total_sales), r.rank) for r in ranked] == [("18000000000000000.00", 1)]


@pytest.mark.parametrize("country", [None, "BR", "AR", "XX"])
def test_latest_window_reads_one_date(spark, tmp_path, plan_of, country):
    from tillstream import schemas
    from tillstream.sinks.rankings import append_rankings, ranking_rows, read_rankings
    rows = log(spark, [
        (f"2026-02-{day:02} 08:00:00", f"{c}{day}", c, day, rank, "2026-03-01 00:00:00", 1)
        for day in range(1, 20) for rank, c in enumerate(["BR", "AR"] if day < 15 else ["BR"], 1)],
        with_country=True)
    append_rankings(ranking_rows(rows), str(tmp_path / "t"))
    table = read_rankings(spark, str(tmp_path / "t"), schemas.SALESMAN_RANKING)
    found = serve.latest_rankings(table, country)
    assert "PartitionFilters: [isnotnull(window_date" in plan_of(found) or country == "XX"
    want = {None: ["BR19"], "BR": ["BR19"], "AR": ["AR14"], "XX": []}
    assert [r.salesman_name for r in found.collect()] == want[country]
    plain = serve.latest_rankings(table.drop("window_date"), country)
    assert [r.salesman_name for r in plain.collect()] == want[country]


def test_responses(spark):
    table = log(spark, LOG)
    latest = serve.top_sales_by_city(table, None).first()
    assert (latest.window.start, latest.window.end) == (
        "2026-02-19T09:00:00Z", "2026-02-19T10:00:00Z")
    given = serve.top_sales_by_city(table, "2026-02-19T08:00:00Z", 1).first()
    assert [r.city for r in given.rankings] == ["D"]
    men = serve.top_salesmen(log(spark, LOG, with_country=True)).first()
    assert [(r.rank, r.salesmanName, r.country, str(r.totalSales), r.transactionCount)
            for r in men.rankings] == [(1, "D", "BR", "8.00", 1), (2, "B", "BR", "4.00", 1)]
    none = serve.top_sales_by_city(table.limit(0)).first()
    assert (none.window.start, none.window.end, none.rankings) == ("N/A", "N/A", [])


def test_window_filter_reaches_the_scan(spark, tmp_path, plan_of):
    from tillstream import schemas
    from tillstream.sinks.rankings import append_rankings, ranking_rows, read_rankings
    rows = log(spark, LOG).drop("updated_at", "batch_id", "country")
    append_rankings(ranking_rows(rows), str(tmp_path / "t"))
    table = read_rankings(spark, str(tmp_path / "t"), schemas.CITY_RANKING)
    plan = plan_of(serve.rankings_for_window(table, "2026-02-19T08:00:00Z"))
    assert "PartitionFilters: [isnotnull(window_date" in plan
    assert "PushedFilters: [IsNotNull(window_start), EqualTo(window_start" in plan
