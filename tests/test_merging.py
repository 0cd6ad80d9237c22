"""Merges: any split of the days into batches, in any order, with replays, equals the one-shot build."""

import random

import pytest
from pyspark.sql import functions as F

from sparkdesk.operators import demand as D
from sparkdesk.operators import merging as M
from sparkdesk.operators.cube import LEVEL, load, save, smallest_row

KEYS = ["line", "station"]


@pytest.fixture(scope="module")
def daily(spark):
    rng = random.Random(7)
    rows = [
        (f"2024-01-{d:02d}", line, st, None if rng.random() < 0.2 else rng.randint(0, 50), rng.randint(0, 50))
        for d in range(1, 13) for line in "AB" for st in ("x", "y", "hot") if rng.random() < 0.8
    ]
    df = spark.createDataFrame(rows, "d string, line string, station string, ride_num bigint, alight_num bigint")
    return df.select(F.to_date("d").alias("use_ymd"), "line", "station", "ride_num", "alight_num").cache()


def rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


def gold(cube):
    return rows(D.station_load(cube)), rows(D.monthly_load(cube)), rows(D.weekday_load(cube)), rows(D.network_by_day(cube)), rows(D.table_meta(cube))


@pytest.mark.parametrize("seed", range(2))
def test_batches_in_any_order_with_replays_and_half_days(spark, daily, seed):
    rng = random.Random(seed)
    days = [r[0] for r in daily.select("use_ymd").distinct().collect()]
    rng.shuffle(days)
    half = F.col("station") == "hot"
    batches = [daily.where(F.col("use_ymd").isin(days[:5])), daily.where(F.col("use_ymd").isin(days[3:9]) & half), daily.where(F.col("use_ymd").isin(days[4:])), daily]
    cube, silver = D.daily_cube(daily.limit(0)), daily.limit(0)
    for b in batches:
        cube, fresh = M.merged_daily(cube, silver, b)
        cube, silver = spark.createDataFrame(cube.collect(), cube.schema), spark.createDataFrame([*silver.collect(), *fresh.collect()], daily.schema)
    assert rows(silver) == rows(daily)
    assert gold(cube) == gold(D.daily_cube(daily))


def test_one_scan_fills_all_tables(spark, daily, tmp_path):
    daily.write.parquet(f"{tmp_path}/silver")
    cube = D.daily_cube(spark.read.parquet(f"{tmp_path}/silver"))
    plan = cube._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Expand") == 1
    save(cube, f"{tmp_path}/gold")
    again = load(spark, f"{tmp_path}/gold", cube)
    assert gold(again) == gold(D.daily_cube(daily))
    months = D.monthly_load(again)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(level" in months and "= month" in months


def test_cube_levels_and_nulls(spark, daily):
    cube = D.daily_cube(daily)
    one = lambda level: rows(D.daily_cube(daily, level).where(F.col(LEVEL) == level))
    for level in D.DAILY.levels:
        assert rows(cube.where(F.col(LEVEL) == level)) == one(level)
    want = {(k.line, k.station): k for k in daily.groupBy(*KEYS).agg(F.avg("ride_num").alias("a"), F.max("ride_num").alias("m"), F.count("*").alias("n")).collect()}
    for r in D.station_load(cube).collect():
        w = want[r.line, r.station]
        assert r.avg_ride == pytest.approx(w.a) and r.max_ride == w.m and r.data_days == w.n


def test_a_second_line_on_day_two_shows_both_days(spark):
    make = lambda *r: spark.createDataFrame(list(r), "d string, line string, station string, ride_num bigint, alight_num bigint").select(F.to_date("d").alias("use_ymd"), "line", "station", "ride_num", "alight_num")
    first = make(("2024-01-01", "1", "late", 10, 1), ("2024-01-01", "1", "plain", 7, 1))
    second = make(("2024-01-02", "2", "late", 5, 2), ("2024-01-02", "1", "plain", 7, 1))
    cube = D.daily_cube(first)
    assert D.transfer_pattern(cube).count() == 0
    cube, _ = M.merged_daily(cube, first, second)
    whole = D.daily_cube(first.unionByName(second))
    assert rows(D.transfer_pattern(cube)) == rows(D.transfer_pattern(whole))
    assert {(r.station, r.line): r.total_ride for r in D.transfer_pattern(cube).collect()} == {("late", "1"): 10, ("late", "2"): 5}
    assert [(r.year_month, r.total_ride) for r in D.transfer_monthly(cube).collect()] == [("2024-01", 15)]


def test_corrections_lower_a_maximum(spark, daily):
    top = daily.orderBy(F.desc_nulls_last("ride_num")).first()
    mine = (F.col("use_ymd") == top.use_ymd) & (F.col("line") == top.line) & (F.col("station") == top.station)
    right = daily.withColumn("ride_num", F.when(mine, F.lit(0)).otherwise(F.col("ride_num")))
    assert gold(M.corrected_daily(D.daily_cube(daily), right, daily.where(mine))) == gold(D.daily_cube(right))


def test_repeats_of_a_key_give_one_row_in_any_order(spark):
    df = spark.createDataFrame([(1, "b", 5), (1, "a", 9), (2, None, 1), (2, "z", 0)], "k int, v string, n int")
    assert rows(smallest_row(df, ["k"])) == rows(smallest_row(df.orderBy(F.desc("v")), ["k"])) == [(1, 9, "a"), (2, 1, None)]
    assert rows(smallest_row(df, ["k"], ["n"])) == [(1, 5, "b"), (2, 0, "z")]


def test_insert_only_keeps_stored_and_upsert_replaces(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "B"), (3, "c"), (3, "d")], "k int, v string")
    assert rows(M.insert_only(old, new, ["k"])) == [(1, "a"), (2, "b"), (3, "c")]
    assert rows(M.upsert(old, new, ["k"], "v")) == [(1, "a"), (2, "B"), (3, "d")]


def test_stream_of_one_file_per_trigger_with_late_and_repeated_days(spark, tmp_path, daily):
    from sparkdesk.streaming.jobs import settled_gold, settled_rows, stream_to_gold

    day = F.dayofmonth("use_ymd")
    deliveries = [daily.where(day == 1), daily.where(day.isin(1, 2, 3)), daily.where(day >= 10), daily.where(day.isin(4, 5)), daily.where(day == 2), daily]

    def deliver(i, df):
        df.coalesce(1).write.parquet(f"{tmp_path}/in/d={i}")

    def run():
        src = spark.readStream.schema(daily.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
        stream_to_gold(src, f"{tmp_path}/gold", f"{tmp_path}/cp", horizon_days=3).awaitTermination()

    for i, df in enumerate(deliveries[:4]):
        deliver(i, df)
    run()
    for i, df in enumerate(deliveries[4:], 4):
        deliver(i, df)
    run()  # goes on with the state of the first run
    assert spark.read.parquet(f"{tmp_path}/gold/late").count() > 0
    assert rows(settled_rows(spark, f"{tmp_path}/gold")) == rows(daily)
    assert rows(D.station_load(settled_gold(spark, f"{tmp_path}/gold"))) == rows(D.station_load(D.daily_cube(daily)))
    sizes = {f.name: spark.read.parquet(str(f)).count() for f in (tmp_path / "gold" / "total").iterdir()}
    assert sizes["batch=4"] == 0  # a batch of repeats writes no state


def test_partitioned_merge_touches_only_its_partitions(spark, tmp_path):
    from sparkdesk.sources.writers import merge_partitions, write_partitioned

    old = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (3, "c", 2)], "k int, v string, p int")
    write_partitioned(old, f"{tmp_path}/t", "p")
    keep = {f.name for f in (tmp_path / "t" / "p=2").iterdir()}
    merge_partitions(spark, f"{tmp_path}/t", spark.createDataFrame([(2, "B", 1), (9, "z", 1)], old.schema), ["k"], "p", "v")
    got = spark.read.schema(old.schema).parquet(f"{tmp_path}/t")
    assert rows(got.select("k", "v", "p")) == rows(spark.createDataFrame([(1, "a", 1), (2, "B", 1), (9, "z", 1), (3, "c", 2)], old.schema))
    assert {f.name for f in (tmp_path / "t" / "p=2").iterdir()} == keep


def test_upsert_takes_the_latest_of_repeats(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "k int, v string, at int")
    new = spark.createDataFrame([(2, "x", 5), (2, "y", 7), (2, "w", 6)], old.schema)
    assert sorted(map(tuple, M.upsert(old, new, ["k"], "at").collect())) == [(1, "a", 1), (2, "y", 7)]


def test_merge_reads_arriving_partitions_only(spark, tmp_path):
    from sparkdesk.sources.writers import touched, write_partitioned

    old = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (3, "c", 3)], "k int, v string, p int")
    write_partitioned(old, f"{tmp_path}/t", "p")
    got = touched(spark, f"{tmp_path}/t", old.where("p = 2"), "p")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(p" in plan and "= 2" in plan and [tuple(r) for r in got.collect()] == [(2, "b", 2)]
