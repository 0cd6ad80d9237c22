"""Source and sink queries: tables are written to the shared folder in each format and read back."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from sparkdesk.operators import demand as D
from sparkdesk.operators import merging as M
from sparkdesk.operators.companies import latest_and_history
from sparkdesk.operators.reshape import drop_subtotals
from sparkdesk.plans.corpus import pages_of
from sparkdesk.plans.datasets import ANSWERED, answered
from sparkdesk.plans.demand import DAILY_OUT, FILLED, arriving_daily, day_text, hourly_wide, raw_daily, stored_daily
from sparkdesk.plans.registry import query
from sparkdesk.plans.tables import DAILY, PANEL
from sparkdesk.session import shared_dir
from sparkdesk.sources import readers as R
from sparkdesk.sources import writers as W

PLAIN = f"WITH {DAILY} SELECT {DAILY_OUT} FROM daily"


@query("s01_daily_csv", PLAIN)
def _(t):
    path = shared_dir(t.spark, "s01")
    raw_daily(t).write.csv(path, header=True)
    return day_text(D.daily_silver(R.read_daily_csv(t.spark, path)))


@query("s02_hourly_csv", f"WITH {FILLED} SELECT use_mm, line, station, CAST(hour AS INTEGER) AS hour, ride_num, alight_num FROM filled")
def _(t):
    path = shared_dir(t.spark, "s02")
    hourly_wide(t).write.csv(path, header=True)
    return D.hourly_silver(R.read_hourly_csv(t.spark, path))


@query("s03_file_tree", f"WITH {DAILY} SELECT line, count(*) AS n, CAST(sum(ride_num) AS BIGINT) AS ride_num FROM daily GROUP BY 1")
def _(t):
    path = shared_dir(t.spark, "s03")
    t.daily.withColumn("folder", F.col("line")).write.partitionBy("folder").csv(path, header=True)
    tree = R.read_tree(t.spark, path, "use_ymd string, line string, station string, ride_num bigint, alight_num bigint")
    return tree.groupBy("line").agg(F.count("*").alias("n"), F.sum("ride_num").alias("ride_num"))


def korean_rows(t):
    return t.supplier.select(F.concat(F.lit("구"), F.col("s_nationkey").cast("string")).alias("district"), F.col("s_suppkey").cast("string").alias("key"))


@query("s04_encoding_fallback", "SELECT '구' || s_nationkey AS district, CAST(s_suppkey AS VARCHAR) || k AS key FROM supplier CROSS JOIN (SELECT unnest(['', 'b', 'h']) AS k)")
def _(t):
    """One folder: files in UTF-8, files in the Korean code page, files with a header of foreign names."""
    path = shared_dir(t.spark, "s04")

    @F.pandas_udf("binary")
    def encode(lines: pd.Series) -> pd.Series:
        return lines.map(lambda x: x.encode("cp949"))

    rows = korean_rows(t)
    line = lambda end: rows.select(F.concat_ws(",", "district", F.concat("key", F.lit(end))).alias("value"))
    headed = line("h").select(F.concat(F.when(F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0, F.lit("자치구,열쇠\n")).otherwise(F.lit("")), "value").alias("value"))
    line("").write.text(f"{path}/plain")
    line("b").select(encode("value").cast("string").alias("value")).write.mode("append").text(f"{path}/plain")
    headed.write.text(f"{path}/headed")
    plain = R.read_csv_any(t.spark, f"{path}/plain", "district string, key string", header=False)
    return plain.unionByName(R.read_csv_any(t.spark, f"{path}/headed", "district string, key string"))


def block_files(t):
    """A printed table per district: three head rows (year, item, unit), a subtotal row, two columns per year the district has.

    Every other file lists its years backwards, so the place of a year differs from file to file.
    """
    path = shared_dir(t.spark, "block")
    years = F.sort_array(F.collect_list(F.struct("year", "gas_supply", "total_households")))
    wide = t.panel.groupBy("district").agg(years.alias("y"))
    wide = wide.withColumn("y", F.when(F.length("district") % 2 == 0, F.reverse("y")).otherwise(F.col("y")))
    joined = lambda *cells: F.concat_ws(",", *cells)
    each = lambda a, b: F.array_join(F.transform("y", lambda v: joined(a(v), b(v))), ",")
    text = lambda k: (lambda v: v[k].cast("string"))
    fixed = lambda x: (lambda v: F.lit(x))
    lines = F.array(
        joined(F.lit("x"), F.lit("name"), each(text("year"), text("year"))), joined(F.lit("x"), F.lit("name"), each(fixed("all"), fixed("part"))),
        joined(F.lit("x"), F.lit("name"), each(fixed("area m2"), fixed("rate"))),
        joined(F.lit("x"), F.concat(F.lit(" "), "district", F.lit(" ")), each(text("gas_supply"), text("total_households"))),
        joined(F.lit("x"), F.lit("소계"), each(text("gas_supply"), text("total_households"))))
    rows = wide.select("district", F.posexplode(lines).alias("i", "value")).repartition("district").sortWithinPartitions("district", "i")
    rows.select("district", "value").write.partitionBy("district").text(path)
    return path


@query("s05_skip_head_rows", f"WITH {PANEL} SELECT DISTINCT district FROM panel")
def _(t):
    body = R.read_headless(t.spark, block_files(t), 2, 3)
    return drop_subtotals(body.select(F.col("_c1").alias("district")), "district")


@query("s06_head_columns", f"WITH {PANEL} SELECT district, year, CAST(gas_supply AS DOUBLE) AS supply FROM panel")
def _(t):
    return drop_subtotals(R.read_block_table(t.spark, block_files(t), "all", "area", "supply"), "district")


@query("s07_tolerant_csv", f"WITH {DAILY} SELECT count(*) AS good, (SELECT 2 * count(*) FROM daily WHERE day(use_ymd) = 10) AS bad FROM daily")
def _(t):
    path = shared_dir(t.spark, "s07")
    lines = t.daily.select(F.concat_ws(",", "use_ymd", "line", "station", "ride_num", "alight_num").alias("value"), "use_ymd")
    broken = lines.where(F.dayofmonth("use_ymd") == 10).select(F.explode(F.array(F.concat("value", F.lit(",9,9,9")), F.concat("value", F.lit("x")))).alias("value"))
    lines.select("value").unionByName(broken).write.text(path)
    good, bad = R.read_tolerant_csv(t.spark, path, "use_ymd date, line string, station string, ride_num bigint, alight_num bigint", header=False)
    return good.agg(F.count("*").alias("good")).withColumn("bad", bad.agg(F.count("*")).scalar())


@query("s08_jsonl", "SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang AS section, text, lang || ',' || source AS keywords FROM documents")
def _(t):
    path = shared_dir(t.spark, "s08")
    t.documents.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("lang").alias("section"), "text", F.array("lang", "source").alias("keywords")).write.json(path)
    t.spark.createDataFrame([("",), ("  ",)], "value string").write.mode("append").text(path)
    return R.read_jsonl(t.spark, path).select("doc_id", "section", "text", F.array_join("keywords", ",").alias("keywords"))


@query("s09_read_table", PLAIN)
def _(t):
    path = shared_dir(t.spark, "s09")
    W.write_partitioned(t.daily.withColumn("y", F.year("use_ymd")), path, "y")
    return day_text(R.read_table(t.spark, path).drop("y"))


@query("s10_overwrite_partitions", f"WITH {DAILY} SELECT line, count(*) AS n, CAST(sum(ride_num) + CASE line WHEN 'R' THEN count(*) ELSE 0 END AS BIGINT) AS ride_num FROM daily GROUP BY 1")
def _(t):
    path = shared_dir(t.spark, "s10")
    W.write_partitioned(t.daily, path, "line")
    W.overwrite_partitions(t.daily.where("line = 'R'").withColumn("ride_num", F.col("ride_num") + 1), path, "line")
    return t.spark.read.parquet(path).groupBy("line").agg(F.count("*").alias("n"), F.sum("ride_num").alias("ride_num"))


@query("s11_new_version", f"WITH {DAILY} SELECT line, station, count(*) AS n, true AS has_new_column FROM daily GROUP BY 1, 2")
def _(t):
    path = shared_dir(t.spark, "s11")
    W.write_version(D.station_load(D.daily_cube(t.daily, "station")).select("line", "station"), path, 1)
    W.write_version(t.daily.groupBy("line", "station").agg(F.count("*").alias("n")), path, 2)
    df = W.read_version(t.spark, path)
    return df.withColumn("has_new_column", F.lit("n" in df.columns))


UPSERTED = f"""WITH {DAILY} SELECT strftime(use_ymd, '%Y-%m-%d') AS use_ymd, line, station, CASE WHEN year(use_ymd) = 1998 THEN ride_num + 1 ELSE ride_num END AS ride_num, alight_num FROM daily"""


@query("s12_upsert_partitions", UPSERTED)
def _(t):
    path = shared_dir(t.spark, "s12")
    W.write_partitioned(stored_daily(t).withColumn("m", F.date_format("use_ymd", "yyyyMM")), path, "m")
    late = arriving_daily(t).withColumn("m", F.date_format("use_ymd", "yyyyMM"))
    early = late.withColumn("ride_num", F.col("ride_num") * 9)  # a first delivery that the second one replaces
    W.merge_partitions(t.spark, path, early.withColumn("at", F.lit(1)).unionByName(late.withColumn("at", F.lit(2))), D.DAILY_KEY, "m", "at")
    return day_text(t.spark.read.schema(late.schema).parquet(path).drop("m"))


@query("s13_replace_document", """SELECT doc_id, CAST(generate_subscripts(string_split(text, chr(10)), 1) AS BIGINT) AS page_num, CASE WHEN lang = 'en' THEN 'new' ELSE 'old' END AS version FROM documents""")
def _(t):
    pages = pages_of(t).select("doc_id", "page_num")
    stored = pages.unionByName(pages.where("page_num = 1").withColumn("page_num", F.lit(999999).cast("bigint")).join(t.documents.where("lang = 'en'").select("doc_id"), "doc_id", "left_semi"))
    arriving = pages.join(t.documents.where("lang = 'en'").select("doc_id"), "doc_id", "left_semi")
    return M.replace_groups(stored.withColumn("version", F.lit("old")), arriving.withColumn("version", F.lit("new")), "doc_id")


@query("s14_append_missing", PLAIN)
def _(t):
    path = shared_dir(t.spark, "s14")
    W.write_partitioned(stored_daily(t).withColumn("m", F.date_format("use_ymd", "yyyyMM")), path, "m")
    late = arriving_daily(t).withColumn("m", F.date_format("use_ymd", "yyyyMM"))
    W.append_new_keys(t.spark, path, late, D.DAILY_KEY, "m")
    return day_text(t.spark.read.schema(late.schema).parquet(path).drop("m"))


@query("s15_instruction_jsonl", f"WITH {ANSWERED} SELECT * FROM ins")
def _(t):
    path = shared_dir(t.spark, "s15")
    W.write_jsonl(answered(t), path)
    return R.read_jsonl(t.spark, path, "instruction string, input string, output string, label string, _rcept_no string")


@query("s16_export_check", """SELECT count(*) AS written, count(*) AS read, 5 AS columns, true AS same,
  (SELECT count(*) FROM documents) AS less_written, (SELECT count(*) FROM documents) AS less_read, false AS less_same FROM documents""")
def _(t):
    whole = W.export_csv(t.documents, shared_dir(t.spark, "s16"))
    path = shared_dir(t.spark, "s16")
    t.documents.drop("lang").write.csv(path, header=True, escape='"')  # an export that lost a column
    less = W.compare_export(t.documents, path)
    return whole.select("*", *[less.select(c).scalar().alias(f"less_{c}") for c in ("written", "read", "same")])


@query("s17_two_track", """SELECT CAST(user_id AS BIGINT) AS user_id, max(ts) AS last_ts, arg_max(event_id, ts) AS event_id, (SELECT count(*) FROM events) AS history FROM events GROUP BY 1""")
def _(t):
    path = shared_dir(t.spark, "s17")
    runs = t.events.select("user_id", "event_id", "ts")
    cut = F.to_timestamp_ntz(F.lit("2024-01-16 00:00:00"))
    W.save_two_track(t.spark, runs.where(F.col("ts") >= cut), f"{path}/latest", f"{path}/history", "user_id", "ts")
    W.save_two_track(t.spark, runs.where(F.col("ts") < cut), f"{path}/latest", f"{path}/history", "user_id", "ts")  # older runs that come late
    total = t.spark.read.schema(runs.schema).parquet(f"{path}/history").agg(F.count("*")).scalar()
    return W.read_version(t.spark, f"{path}/latest").select("user_id", F.col("ts").alias("last_ts"), "event_id", total.alias("history"))


@query("s17_latest_record", "SELECT CAST(user_id AS BIGINT) AS user_id, arg_max(event_id, ts) AS event_id FROM events GROUP BY 1")
def _(t):
    latest, _history = latest_and_history(t.events.select("user_id", "event_id", "ts"), ["user_id"], "ts")
    return latest.select("user_id", "event_id")


@query("s18_stored_periods", "SELECT DISTINCT strftime(o_orderdate, '%Y%m') AS period FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '2001-01-01'")
def _(t):
    path = shared_dir(t.spark, "s18")
    months = t.orders.select(F.concat(F.lit("daily_"), F.date_format("o_orderdate", "yyyyMM"), F.lit(".csv")).alias("folder"), F.col("o_orderkey").cast("string").alias("k"))
    months.write.partitionBy("folder").csv(path)
    return R.stored_periods(t.spark, path, "199601", "200012", digits=6)
