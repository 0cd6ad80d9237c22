"""Stream queries: the given tables arrive as deliveries of files, the stream takes each as it comes, and its result is a table."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkdesk.operators.demand import station_load
from sparkdesk.plans.demand import GOLD, DAILY_OUT, day_text, r, raw_daily
from sparkdesk.plans.registry import query
from sparkdesk.plans.tables import DAILY
from sparkdesk.session import materialize, shared_dir
from sparkdesk.streaming import jobs as J

HORIZON = 120


@query("r01_stream_to_silver", f"WITH {DAILY} SELECT {DAILY_OUT} FROM daily")
def _(t):
    path = shared_dir(t.spark, "r01")
    for part in ("1", "2"):  # the second delivery repeats the first
        raw_daily(t).write.csv(f"{path}/landing/part={part}", header=True)
        landing = J.read_landing(t.spark, f"{path}/landing/*")
        J.stream_to_silver(landing, f"{path}/silver", f"{path}/rejects", f"{path}/cp", by="month").awaitTermination()
    return day_text(t.spark.read.schema(f"{J.SILVER}, use_mm string").parquet(f"{path}/silver").drop("use_mm"))


def delivered(t, name):
    """All days in four deliveries: even stations up to a cut, one that repeats a year, later days, and at last the
    odd stations' half of everything, far behind the horizon of the others."""
    path = shared_dir(t.spark, name)
    daily = materialize(t.daily, name)
    even, cut = F.crc32(F.concat("station", "line").cast("binary")) % 2 == 0, F.lit("1999-01-01").cast("date")
    old = F.col("use_ymd") < cut
    late = F.dayofmonth("use_ymd") == 9
    for i, part in enumerate((old & even & ~late, F.year("use_ymd") == 1997, ~old & even, ~even | late)):
        daily.where(part).write.parquet(f"{path}/in/d={i}")
        source = t.spark.readStream.schema(daily.schema).parquet(f"{path}/in/*")
        J.stream_to_gold(source, f"{path}/gold", f"{path}/cp", HORIZON).awaitTermination()
    return f"{path}/gold"


@query("r02_stream_to_gold", f"""WITH {GOLD} SELECT line, station, round(avg_ride, 6) AS avg_ride, round(avg_alight, 6) AS avg_alight, max_ride, max_alight, data_days FROM gold""")
def _(t):
    return r(station_load(J.settled_gold(t.spark, delivered(t, "r02"))))


@query("r03_late_repeats", f"WITH {DAILY} SELECT {DAILY_OUT} FROM daily")
def _(t):
    return day_text(J.settled_rows(t.spark, delivered(t, "r03")))
