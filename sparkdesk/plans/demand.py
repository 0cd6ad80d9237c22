"""Demand queries: silver, gold, merges and dashboard reads."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkdesk.functions.calendar import days_in_month, is_weekend, weekday, year_month
from sparkdesk.operators import demand as D
from sparkdesk.operators import merging as M
from sparkdesk.operators.cube import load, save, smallest_row
from sparkdesk.plans.registry import query
from sparkdesk.plans.tables import DAILY, HOURLY, VISITS
from sparkdesk.session import materialize, shared_dir

CUT = "1999-01-01"  # days before are the stored table, days from here on arrive later
MIN_LINES = 5


def r(df, digits=6, *cols):
    """Round the named (or all double) columns for comparison."""
    names = cols or [n for n, t in df.dtypes if t == "double"]
    return df.select(*[F.round(c, digits).alias(c) if c in names else F.col(c) for c in df.columns])


def raw_daily(t):
    """Raw text rows as a day's file holds them, with a broken twin of every tenth day of month."""
    good = t.daily.select(
        F.date_format("use_ymd", "yyyyMMdd").alias("USE_YMD"), F.col("line").alias("SBWY_ROUT_LN_NM"),
        F.col("station").alias("SBWY_STNS_NM"), F.col("ride_num").cast("string").alias("GTON_TNOPE"),
        F.col("alight_num").cast("string").alias("GTOFF_TNOPE"),
    )
    twins = F.when(F.col("USE_YMD").endswith("10"), F.array(F.col("GTON_TNOPE"), F.lit("n/a"))).when(
        F.col("USE_YMD").endswith("20"), F.array("GTON_TNOPE", "GTON_TNOPE")).otherwise(F.array("GTON_TNOPE"))
    return good.withColumn("GTON_TNOPE", F.explode(twins)).select(good.columns)


def hourly_wide(t, hours=D.HOURS):
    """Hourly table as the wide month file: two text columns per hour, '775.0' style numbers."""
    cell = lambda v, h, name: F.sum(F.when(F.col("hour") == h, F.col(v))).alias(f"{h}_{name}")
    wide = t.hourly.groupBy("use_mm", "line", "station").agg(*[
        cell(v, h, name) for h in hours for v, name in (("ride_num", "GET_ON_NOPE"), ("alight_num", "GET_OFF_NOPE"))])
    text = lambda c: F.when(F.col(c).isNotNull(), F.concat(F.col(c).cast("string"), F.lit(".0")))
    return wide.select(
        F.col("use_mm").alias("USE_MM"), F.col("line").alias("SBWY_ROUT_LN_NM"), F.col("station").alias("STTN"),
        *[text(f"{h}_{k}").alias(f"HR_{h}_{k}") for h in hours for k in ("GET_ON_NOPE", "GET_OFF_NOPE")],
    )


def day_text(df):
    return df.withColumn("use_ymd", F.date_format("use_ymd", "yyyy-MM-dd"))


DAILY_OUT = "strftime(use_ymd, '%Y-%m-%d') AS use_ymd, line, station, ride_num, alight_num"
GOLD_HOURLY = f"""{HOURLY}, gold_hourly AS (
  SELECT line, station, hour, avg(ride_num / CAST(dim AS DOUBLE)) AS avg_ride, avg(alight_num / CAST(dim AS DOUBLE)) AS avg_alight,
         max(ride_num / CAST(dim AS DOUBLE)) AS max_ride, count(*) AS data_months
  FROM (SELECT *, day(last_day(strptime(use_mm || '01', '%Y%m%d'))) AS dim FROM hourly) GROUP BY 1, 2, 3)"""
GOLD = f"""{DAILY}, gold AS (
  SELECT line, station, avg(ride_num) AS avg_ride, avg(alight_num) AS avg_alight, max(ride_num) AS max_ride,
         max(alight_num) AS max_alight, count(*) AS data_days FROM daily GROUP BY 1, 2)"""
TRANSFER = f"""{VISITS}, transfer AS (
  SELECT station, count(DISTINCT line) AS line_count FROM visits GROUP BY 1 HAVING count(DISTINCT line) >= {MIN_LINES})"""


# --- silver -------------------------------------------------------------------------------------
@query("p01_typed_silver", f"WITH {DAILY} SELECT {DAILY_OUT} FROM daily")
def _(t):
    return day_text(D.daily_silver(raw_daily(t)))


@query("p02_drop_incomplete", f"WITH {DAILY} SELECT count(*) AS kept, count(DISTINCT station) AS stations FROM daily")
def _(t):
    return D.daily_silver(raw_daily(t)).agg(F.count("*").alias("kept"), F.countDistinct("station").alias("stations"))


FILLED = f"""{HOURLY}, h AS (SELECT unnest(range(4, 24)) AS hour), filled AS (
  SELECT k.use_mm, k.line, k.station, h.hour, coalesce(x.ride_num, 0) AS ride_num, coalesce(x.alight_num, 0) AS alight_num
  FROM (SELECT DISTINCT use_mm, line, station FROM hourly) k CROSS JOIN h
  LEFT JOIN hourly x ON x.use_mm = k.use_mm AND x.line = k.line AND x.station = k.station AND x.hour = h.hour)"""


@query("p03_gaps_to_zero", f"WITH {FILLED} SELECT use_mm, line, station, hour, ride_num FROM filled")
def _(t):
    long = D.hourly_silver(hourly_wide(t))
    return long.select("use_mm", "line", "station", F.col("hour").cast("bigint").alias("hour"), "ride_num")


@query("p04_wide_to_long", f"WITH {FILLED} SELECT use_mm, line, station, CAST(hour AS INTEGER) AS hour, ride_num, alight_num FROM filled")
def _(t):
    return D.hourly_silver(hourly_wide(t))


@query("p16_weekday_flag", f"""WITH {DAILY} SELECT strftime(use_ymd, '%Y-%m-%d') AS use_ymd,
  CAST(dayofweek(use_ymd) + 1 AS INTEGER) AS day_of_week, dayofweek(use_ymd) IN (0, 6) AS is_weekend, count(*) AS n FROM daily GROUP BY 1, 2, 3""")
def _(t):
    return t.daily.groupBy(
        F.date_format("use_ymd", "yyyy-MM-dd").alias("use_ymd"), weekday("use_ymd").alias("day_of_week"),
        is_weekend("use_ymd").alias("is_weekend"),
    ).agg(F.count("*").alias("n"))


@query("p17_month_key", f"WITH {DAILY} SELECT strftime(use_ymd, '%Y-%m') AS year_month, count(*) AS n FROM daily GROUP BY 1")
def _(t):
    return t.daily.groupBy(year_month("use_ymd").alias("year_month")).agg(F.count("*").alias("n"))


@query("p18_days_in_month", f"""WITH {HOURLY} SELECT use_mm, CAST(day(last_day(strptime(use_mm || '01', '%Y%m%d'))) AS INTEGER) AS days,
  count(*) AS n FROM hourly GROUP BY 1, 2""")
def _(t):
    return t.hourly.groupBy("use_mm", days_in_month("use_mm").alias("days")).agg(F.count("*").alias("n"))


@query("p19_export_safe", f"""WITH {DAILY} SELECT line, station, CAST(dayofweek(use_ymd) + 1 AS BIGINT) AS day_of_week,
  round(coalesce(avg(ride_num), 0.0), 6) AS avg_ride, round(coalesce(avg(alight_num), 0.0), 6) AS avg_alight,
  CAST(dayofweek(use_ymd) IN (0, 6) AS BIGINT) AS is_weekend FROM daily GROUP BY 1, 2, 3, 6""")
def _(t):
    safe = D.export_safe(D.weekday_load(D.daily_cube(t.daily, "weekday")), ["line", "station", "day_of_week", "avg_ride", "avg_alight", "is_weekend"])
    return r(safe)


@query("p20_optional_filters", f"""WITH {DAILY} SELECT {DAILY_OUT} FROM daily
  WHERE line = 'R' AND use_ymd BETWEEN DATE '1997-03-01' AND DATE '2000-02-29'""")
def _(t):
    rows = D.where_equal(t.daily, line="R", station=None)
    return day_text(D.between_dates(rows, "1997-03-01", "2000-02-29"))


@query("j17_dedup_key", f"WITH {DAILY} SELECT {DAILY_OUT} FROM daily")
def _(t):
    other = t.daily.withColumn("ride_num", F.col("ride_num") + 1)  # a repeat that differs: the smaller row stays
    return day_text(smallest_row(other.unionByName(t.daily), D.DAILY_KEY))


# --- gold ---------------------------------------------------------------------------------------
@query("a01_station_load", f"""WITH {GOLD} SELECT line, station, round(avg_ride, 6) AS avg_ride, round(avg_alight, 6) AS avg_alight,
  max_ride, max_alight, data_days FROM gold""")
def _(t):
    return r(D.station_load(D.daily_cube(t.daily, "station")))


@query("a02_weekday_load", f"""WITH {DAILY} SELECT line, station, CAST(dayofweek(use_ymd) + 1 AS INTEGER) AS day_of_week,
  dayofweek(use_ymd) IN (0, 6) AS is_weekend, round(avg(ride_num), 6) AS avg_ride, round(avg(alight_num), 6) AS avg_alight,
  count(*) AS week_cnt FROM daily GROUP BY 1, 2, 3, 4""")
def _(t):
    return r(D.weekday_load(D.daily_cube(t.daily, "weekday")))


MONTHLY_SQL = f"""WITH {DAILY} SELECT line, station, strftime(use_ymd, '%Y-%m') AS year_month,
  CAST(sum(ride_num) AS BIGINT) AS total_ride, CAST(sum(alight_num) AS BIGINT) AS total_alight FROM daily GROUP BY 1, 2, 3"""


@query("a03_monthly_load", MONTHLY_SQL)
def _(t):
    return D.monthly_load(D.daily_cube(t.daily, "month"))


@query("a04_transfer_stations", f"WITH {TRANSFER} SELECT * FROM transfer")
def _(t):
    return D.transfer_stations(D.daily_cube(t.visits, "station"), MIN_LINES)


PATTERN_SQL = f"""WITH {TRANSFER} SELECT station, line, round(avg(ride_num), 4) AS avg_ride, round(avg(alight_num), 6) AS avg_alight,
  CAST(sum(ride_num) AS BIGINT) AS total_ride, CAST(sum(alight_num) AS BIGINT) AS total_alight, count(*) AS tp_cnt
  FROM visits SEMI JOIN transfer USING (station) GROUP BY 1, 2"""


def pattern_out(df):
    return r(r(df, 4, "avg_ride"), 6, "avg_alight")


@query("a05_transfer_pattern", PATTERN_SQL)
def _(t):
    return pattern_out(D.transfer_pattern(D.daily_cube(t.visits, "station"), MIN_LINES))


TMONTH_SQL = f"""WITH {TRANSFER} SELECT station, strftime(use_ymd, '%Y-%m') AS year_month,
  CAST(sum(ride_num) AS BIGINT) AS total_ride, CAST(sum(alight_num) AS BIGINT) AS total_alight
  FROM visits SEMI JOIN transfer USING (station) GROUP BY 1, 2"""


@query("a06_transfer_monthly", TMONTH_SQL)
def _(t):
    return D.transfer_monthly(D.daily_cube(t.visits, "station", "month"), MIN_LINES)


@query("a07_hourly_load", f"""WITH {GOLD_HOURLY} SELECT line, station, hour, round(avg_ride, 6) AS avg_ride,
  round(avg_alight, 6) AS avg_alight, round(max_ride, 6) AS max_ride, data_months FROM gold_hourly""")
def _(t):
    return r(D.hourly_load(D.hourly_cube(t.hourly, "hour")))


_META_SQL = f"""WITH {DAILY} SELECT strftime(min(use_ymd), '%Y-%m-%d') AS min_date, strftime(max(use_ymd), '%Y-%m-%d') AS max_date,
  count(DISTINCT use_ymd) AS total_days, count(DISTINCT station) AS total_stations,
  (SELECT string_agg(m, ',' ORDER BY m) FROM (SELECT DISTINCT strftime(use_ymd, '%Y-%m') AS m FROM daily)) AS months FROM daily"""


@query("a08_table_meta", _META_SQL)
def _(t):
    return D.table_meta(D.daily_cube(t.daily, "day", "station"))


@query("a09_daily_trend", f"""WITH {DAILY} SELECT station, strftime(use_ymd, '%Y-%m-%d') AS date, CAST(sum(ride_num) AS BIGINT) AS ride_num,
  CAST(sum(alight_num) AS BIGINT) AS alight_num FROM daily WHERE use_ymd >= DATE '1996-01-01' GROUP BY 1, 2""")
def _(t):
    return D.daily_trend(t.daily, start="1996-01-01")


@query("a10_busiest_transfer", f"""WITH {TRANSFER} SELECT station, CAST(sum(ride_num) AS BIGINT) AS total_ride,
  CAST(sum(alight_num) AS BIGINT) AS total_alight FROM visits SEMI JOIN transfer USING (station)
  GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")
def _(t):
    return D.busiest_transfer(D.daily_cube(t.visits, "station"), MIN_LINES)


@query("a10_busiest_transfer_month", f"""WITH {TRANSFER} SELECT station, CAST(sum(ride_num) AS BIGINT) AS total_ride,
  CAST(sum(alight_num) AS BIGINT) AS total_alight FROM visits SEMI JOIN transfer USING (station)
  WHERE strftime(use_ymd, '%Y-%m') = '1998-05' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")
def _(t):
    return D.busiest_transfer(D.daily_cube(t.visits, "station", "month"), MIN_LINES, "1998-05")


@query("a11_hour_profile", f"""WITH {GOLD_HOURLY} SELECT station, hour, round(sum(avg_ride), 6) AS avg_ride,
  round(sum(avg_alight), 6) AS avg_alight, round(sum(max_ride), 6) AS max_ride FROM gold_hourly GROUP BY 1, 2""")
def _(t):
    return r(D.hour_profile(D.hourly_load(D.hourly_cube(t.hourly, "hour"))))


@query("a11_hour_profile_month", f"""WITH {HOURLY} SELECT station, use_mm, hour, round(sum(ride_num / CAST(dim AS DOUBLE)), 6) AS avg_ride,
  round(sum(alight_num / CAST(dim AS DOUBLE)), 6) AS avg_alight, round(max(ride_num / CAST(dim AS DOUBLE)), 6) AS max_ride
  FROM (SELECT *, day(last_day(strptime(use_mm || '01', '%Y%m%d'))) AS dim FROM hourly) GROUP BY 1, 2, 3""")
def _(t):
    return r(D.hour_profile_month(D.hourly_cube(t.hourly, "month_hour")))


@query("a12_heat_map", f"WITH {GOLD_HOURLY} SELECT station, hour, round(sum(avg_ride), 6) AS avg_ride FROM gold_hourly GROUP BY 1, 2")
def _(t):
    return r(D.heat_map(D.hourly_load(D.hourly_cube(t.hourly, "hour"))))


_CELLS = ", ".join(f"coalesce(round(sum(CASE WHEN hour = {h} THEN v END), 4), 0.0) AS h{h:02d}" for h in D.HOURS)


@query("a12_heat_map_wide", f"""WITH {GOLD_HOURLY}, cell AS (SELECT station, hour, sum(avg_ride) AS v FROM gold_hourly GROUP BY 1, 2),
  busy AS (SELECT station FROM cell GROUP BY 1 ORDER BY round(sum(v), 6) DESC, station LIMIT 30)
  SELECT station, {_CELLS} FROM cell SEMI JOIN busy USING (station) GROUP BY 1""")
def _(t):
    return D.heat_map_wide(D.hourly_load(D.hourly_cube(t.hourly, "hour")))


@query("a13_network_by_hour", f"""WITH {GOLD_HOURLY} SELECT hour, round(sum(avg_ride), 4) AS avg_ride, round(sum(avg_alight), 4) AS avg_alight
  FROM gold_hourly GROUP BY 1""")
def _(t):
    return r(D.network_by_hour(D.hourly_load(D.hourly_cube(t.hourly, "hour"))), 4)


@query("a13_line_hour_mean", f"""WITH {GOLD_HOURLY} SELECT line, hour, round(avg(avg_ride), 6) AS avg_ride FROM gold_hourly
  WHERE line IN ('A', 'N') GROUP BY 1, 2""")
def _(t):
    return r(D.line_hour_mean(D.hourly_load(D.hourly_cube(t.hourly, "hour")), ["A", "N"]))


PEAK = f"""{GOLD_HOURLY}, peak AS (SELECT station, hour, avg_ride FROM (
  SELECT *, rank() OVER (PARTITION BY station ORDER BY round(avg_ride, 9) DESC) AS rk FROM (
    SELECT station, hour, avg(avg_ride) AS avg_ride FROM gold_hourly GROUP BY 1, 2)) WHERE rk <= 3)"""


@query("w01_peak_hours", f"WITH {PEAK} SELECT station, hour, round(avg_ride, 6) AS avg_ride FROM peak")
def _(t):
    return r(D.peak_hours(D.hourly_load(D.hourly_cube(t.hourly, "hour"))))


@query("a14_peak_hour_counts", f"WITH {PEAK} SELECT hour, count(*) AS stations FROM peak GROUP BY 1")
def _(t):
    return D.peak_hour_counts(D.peak_hours(D.hourly_load(D.hourly_cube(t.hourly, "hour"))))


@query("a15_network_by_day", f"""WITH {DAILY} SELECT strftime(use_ymd, '%Y-%m-%d') AS use_ymd, CAST(sum(ride_num) AS BIGINT) AS ride_num,
  CAST(sum(alight_num) AS BIGINT) AS alight_num FROM daily GROUP BY 1""")
def _(t):
    return day_text(D.network_by_day(D.daily_cube(t.daily, "day")))


@query("a15_line_ranking", f"WITH {GOLD} SELECT line, round(avg(avg_ride), 6) AS avg_ride, count(*) AS stations FROM gold GROUP BY 1")
def _(t):
    return r(D.line_ranking(D.station_load(D.daily_cube(t.daily, "station"))))


@query("j05_transfer_rows", f"""WITH {TRANSFER} SELECT strftime(use_ymd, '%Y-%m-%d') AS use_ymd, line, station, ride_num, alight_num
  FROM visits SEMI JOIN transfer USING (station)""")
def _(t):
    return day_text(D.at_transfer(t.visits, D.transfer_stations(D.daily_cube(t.visits, "station"), MIN_LINES))).select(
        "use_ymd", "line", "station", "ride_num", "alight_num")


VGOLD = """vgold AS (SELECT line, station, avg(ride_num) AS avg_ride FROM visits GROUP BY 1, 2)"""


@query("j06_transfer_flag", f"""WITH {TRANSFER}, {VGOLD} SELECT line, station, round(avg_ride, 4) AS avg_ride,
  station IN (SELECT station FROM transfer) AS is_transfer FROM vgold""")
def _(t):
    gold = D.station_load(D.daily_cube(t.visits, "station")).select("line", "station", "avg_ride")
    return r(D.flag_member(gold, D.transfer_stations(D.daily_cube(t.visits, "station"), MIN_LINES), "station", "is_transfer"), 4)


@query("a16_transfer_compare", f"""WITH {TRANSFER}, {VGOLD} SELECT station IN (SELECT station FROM transfer) AS is_transfer,
  round(avg(avg_ride), 3) AS mean_avg_ride, count(*) AS n FROM vgold GROUP BY 1""")
def _(t):
    gold = D.station_load(D.daily_cube(t.visits, "station")).select("line", "station", "avg_ride")
    flagged = D.flag_member(gold, D.transfer_stations(D.daily_cube(t.visits, "station"), MIN_LINES), "station", "is_transfer")
    return r(D.compare_groups(flagged, "is_transfer", "avg_ride"), 3)


@query("a32_run_report", f"""WITH {GOLD}, {GOLD_HOURLY}, parts AS (
  SELECT 'silver' AS table_name, count(*) AS n_rows, count(DISTINCT station) AS stations, NULL AS first_hour, NULL AS last_hour FROM daily
  UNION ALL SELECT 'station', count(*), count(DISTINCT station), NULL, NULL FROM gold
  UNION ALL SELECT 'weekday', count(*), count(DISTINCT station), NULL, NULL FROM (SELECT DISTINCT line, station, dayofweek(use_ymd) FROM daily)
  UNION ALL SELECT 'month', count(*), count(DISTINCT station), NULL, NULL FROM (SELECT DISTINCT line, station, strftime(use_ymd, '%Y-%m') FROM daily)
  UNION ALL SELECT 'hour', count(*), count(DISTINCT station), min(hour), max(hour) FROM gold_hourly
  UNION ALL SELECT 'month_hour', count(*), count(DISTINCT station), min(hour), max(hour) FROM (SELECT DISTINCT station, use_mm, hour FROM hourly))
  SELECT table_name, n_rows, stations, CAST(first_hour AS INTEGER) AS first_hour, CAST(last_hour AS INTEGER) AS last_hour FROM parts""")
def _(t):
    return D.run_report(materialize(D.daily_cube(t.daily), "a32"), materialize(D.hourly_cube(t.hourly), "a32"))


# one job, one scan of silver, all daily tables; the tables are read from their folders
def _stored_cube(t):
    path = shared_dir(t.spark, "gold")
    cube = D.daily_cube(t.daily)
    save(cube, path)
    return load(t.spark, path, cube)


@query("a03_monthly_from_cube", MONTHLY_SQL)
def _(t):
    return D.monthly_load(_stored_cube(t))


@query("a08_meta_from_cube", _META_SQL)
def _(t):
    return D.table_meta(_stored_cube(t))


# --- rankings and ordered reads ---------------------------------------------------------------------
@query("w02_top_stations", f"""WITH {GOLD} SELECT line, station, round(avg_ride, 6) AS avg_ride, round(avg_alight, 6) AS avg_alight,
  max_ride, max_alight, data_days FROM gold ORDER BY round(avg_ride, 6) DESC, line, station LIMIT 10""")
def _(t):
    return D.top_stations(r(D.station_load(D.daily_cube(t.daily, "station"))))


@query("w03_rush_boarding", f"""WITH {GOLD_HOURLY} SELECT station, round(sum(avg_ride), 6) AS avg_ride FROM gold_hourly WHERE hour = 8
  GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")
def _(t):
    return D.rush_ranking(D.hourly_load(D.hourly_cube(t.hourly, "hour")), 8, "avg_ride")


@query("w03_rush_alighting", f"""WITH {GOLD_HOURLY} SELECT station, round(sum(avg_alight), 6) AS avg_alight FROM gold_hourly WHERE hour = 18
  GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")
def _(t):
    return D.rush_ranking(D.hourly_load(D.hourly_cube(t.hourly, "hour")), 18, "avg_alight")


@query("w04_ordered_transfer", f"WITH {TRANSFER} SELECT * FROM transfer ORDER BY line_count DESC, station")
def _(t):
    return D.transfer_stations(D.daily_cube(t.visits, "station"), MIN_LINES).orderBy(F.col("line_count").desc(), "station")


@query("w04_ordered_week", f"""WITH {DAILY} SELECT line, station, CAST(dayofweek(use_ymd) + 1 AS INTEGER) AS day_of_week, count(*) AS week_cnt
  FROM daily WHERE station = '7' GROUP BY 1, 2, 3 ORDER BY 3, 1""")
def _(t):
    week = D.where_equal(D.weekday_load(D.daily_cube(t.daily, "weekday")), station="7")
    return week.select("line", "station", "day_of_week", "week_cnt").orderBy("day_of_week", "line")


@query("w04_ordered_months", f"""WITH {DAILY} SELECT line, station, strftime(use_ymd, '%Y-%m') AS year_month, CAST(sum(ride_num) AS BIGINT) AS total_ride
  FROM daily WHERE station = '7' GROUP BY 1, 2, 3 ORDER BY 3, 1""")
def _(t):
    return D.where_equal(D.monthly_load(D.daily_cube(t.daily, "month")), station="7").drop("total_alight").orderBy("year_month", "line")


@query("w04_ordered_lines", f"""WITH {TRANSFER}, one AS (SELECT min(station) AS station FROM transfer) SELECT station, line, count(*) AS tp_cnt FROM visits SEMI JOIN one USING (station) GROUP BY 1, 2 ORDER BY 2""")
def _(t):
    pattern = D.transfer_pattern(D.daily_cube(t.visits, "station"), MIN_LINES)
    return pattern.where(F.col("station") == pattern.agg(F.min("station")).scalar()).select("station", "line", "tp_cnt").orderBy("line")


@query("w05_top_total", f"""WITH {DAILY} SELECT {DAILY_OUT}, ride_num + alight_num AS total FROM daily
  ORDER BY total DESC, use_ymd, line, station LIMIT 20""")
def _(t):
    return day_text(D.top_by(D.with_total(t.daily, "ride_num", "alight_num"), "total", D.DAILY_KEY, 20))


@query("w06_peak_hour_of", f"""WITH {GOLD_HOURLY}, cell AS (SELECT station, hour, round(sum(avg_ride), 9) AS ride, round(sum(avg_alight), 9) AS alight
  FROM gold_hourly GROUP BY 1, 2)
  SELECT a.station, a.hour AS ride_hour, b.hour AS alight_hour FROM
  (SELECT station, hour, row_number() OVER (PARTITION BY station ORDER BY ride DESC, hour) AS k FROM cell) a JOIN
  (SELECT station, hour, row_number() OVER (PARTITION BY station ORDER BY alight DESC, hour) AS k FROM cell) b
  ON a.station = b.station AND a.k = 1 AND b.k = 1""")
def _(t):
    return D.peak_hour_of(D.hourly_load(D.hourly_cube(t.hourly, "hour")))


# --- merges -------------------------------------------------------------------------------------
def stored_daily(t):
    return t.daily.where(F.col("use_ymd") < F.lit(CUT).cast("date"))


def arriving_daily(t):
    """Later days, plus a corrected copy of the last stored year: what a re-run delivers."""
    late = t.daily.where(F.col("use_ymd") >= F.lit("1998-01-01").cast("date"))
    return late.withColumn("ride_num", F.when(F.col("use_ymd") < F.lit(CUT).cast("date"), F.col("ride_num") + 1)
                           .otherwise(F.col("ride_num")))


@query("m01_insert_only_daily", f"WITH {DAILY} SELECT {DAILY_OUT} FROM daily")
def _(t):
    return day_text(M.insert_only(stored_daily(t), arriving_daily(t), D.DAILY_KEY))


@query("m02_insert_only_hourly", f"WITH {HOURLY} SELECT use_mm, line, station, hour, ride_num, alight_num FROM hourly")
def _(t):
    stored = t.hourly.where("use_mm < '199901'")
    late = t.hourly.where("use_mm >= '199801'").withColumn(
        "ride_num", F.when(F.col("use_mm") < "199901", F.col("ride_num") + 1).otherwise(F.col("ride_num")))
    return M.insert_only(stored, late, D.HOURLY_KEY)


@query("m02_upsert_daily", f"""WITH {DAILY} SELECT strftime(use_ymd, '%Y-%m-%d') AS use_ymd, line, station,
  CASE WHEN year(use_ymd) = 1998 THEN ride_num + 1 ELSE ride_num END AS ride_num, alight_num FROM daily""")
def _(t):
    first = arriving_daily(t)
    again = first.withColumn("alight_num", F.col("alight_num") + 7)  # an earlier delivery that a later one replaces
    arriving = again.withColumn("at", F.lit(1)).unionByName(first.withColumn("at", F.lit(2)))
    return day_text(M.upsert(stored_daily(t).withColumn("at", F.lit(0)), arriving, D.DAILY_KEY, "at").drop("at"))


def _cube_in_batches(t, daily):
    """The cube of a table that arrives in three batches: days before the cut, a re-delivery with more, half a day at a time."""
    cut = F.lit(CUT).cast("date")
    old, late = daily.where(F.col("use_ymd") < cut), daily.where(F.col("use_ymd") >= cut)
    half = F.crc32(F.col("station").cast("binary")) % 2 == 0
    cube, fresh = M.merged_daily(D.daily_cube(old), old, old.where(F.year("use_ymd") == 1998).unionByName(late.where(half)))
    silver = old.unionByName(fresh)
    return M.merged_daily(materialize(cube, "cube"), silver, late)[0]


@query("m03_running_mean", f"""WITH {GOLD} SELECT line, station, round(avg_ride, 6) AS avg_ride, round(avg_alight, 6) AS avg_alight,
  max_ride, max_alight, data_days FROM gold""")
def _(t):
    return r(D.station_load(_cube_in_batches(t, t.daily)))


@query("m03_corrected_mean", f"""WITH {DAILY.replace("CAST(sum(l_quantity) AS BIGINT) AS ride_num", "CAST(sum(l_quantity) AS BIGINT) // CASE WHEN CAST(l_shipdate AS DATE) = DATE '1998-03-04' THEN 2 ELSE 1 END AS ride_num")}
  SELECT line, station, round(avg(ride_num), 6) AS avg_ride, max(ride_num) AS max_ride, count(*) AS data_days FROM daily GROUP BY 1, 2""")
def _(t):
    wrong = F.col("use_ymd") == F.lit("1998-03-04").cast("date")
    right = t.daily.withColumn("ride_num", F.when(wrong, F.floor(F.col("ride_num") / 2)).otherwise(F.col("ride_num")))
    cube = M.corrected_daily(D.daily_cube(t.daily), right, t.daily.where(wrong))
    return r(D.station_load(cube).select("line", "station", "avg_ride", "max_ride", "data_days"))


@query("m04_additive_month", MONTHLY_SQL)
def _(t):
    return D.monthly_load(_cube_in_batches(t, t.daily))


@query("m05_transfer_pattern_merge", PATTERN_SQL)
def _(t):
    return pattern_out(D.transfer_pattern(_cube_in_batches(t, t.visits), MIN_LINES))


@query("m06_transfer_month_merge", TMONTH_SQL)
def _(t):
    return D.transfer_monthly(_cube_in_batches(t, t.visits), MIN_LINES)


@query("m06_late_transfer", f"""WITH {TRANSFER}, early AS (
    SELECT station FROM visits WHERE use_ymd < DATE '{CUT}' GROUP BY 1 HAVING count(DISTINCT line) < {MIN_LINES})
  SELECT station, strftime(use_ymd, '%Y-%m') AS year_month, CAST(sum(ride_num) AS BIGINT) AS total_ride, CAST(sum(alight_num) AS BIGINT) AS total_alight
  FROM visits SEMI JOIN transfer USING (station) SEMI JOIN early USING (station) GROUP BY 1, 2""")
def _(t):
    old = D.daily_cube(t.visits.where(F.col("use_ymd") < F.lit(CUT).cast("date")), "station")
    not_yet = D.DAILY.view(old, "station").select("station").distinct().join(D.transfer_stations(old, MIN_LINES), "station", "left_anti")
    return D.transfer_monthly(_cube_in_batches(t, t.visits), MIN_LINES).join(not_yet, "station", "left_semi")


@query("m07_rebuild_weekly", f"""WITH {DAILY} SELECT line, station, CAST(dayofweek(use_ymd) + 1 AS INTEGER) AS day_of_week,
  dayofweek(use_ymd) IN (0, 6) AS is_weekend, round(avg(ride_num), 6) AS avg_ride, round(avg(alight_num), 6) AS avg_alight,
  count(*) AS week_cnt FROM daily GROUP BY 1, 2, 3, 4""")
def _(t):
    return r(M.rebuild_weekly(M.insert_only(stored_daily(t), arriving_daily(t), D.DAILY_KEY)))


@query("m08_migrate_columns", PATTERN_SQL)
def _(t):
    old_shape = D.transfer_pattern(D.daily_cube(t.visits, "station"), MIN_LINES).drop("tp_cnt")
    return pattern_out(M.migrate_columns(old_shape, t.visits, "pattern", MIN_LINES))
