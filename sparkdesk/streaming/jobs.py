"""Streaming forms of the daily merge: landing folder to silver, silver to gold, late corrections.

State is kept by key in the state store. Each micro-batch reads its own rows, touches the keys that they name and writes
what changed; nothing that was written before is read or written again.
"""

from __future__ import annotations

import datetime
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from sparkdesk.operators.cube import LEVEL
from sparkdesk.operators.demand import DAILY, DAILY_KEY, daily_cube, daily_silver
from sparkdesk.operators.merging import fresh_rows
from sparkdesk.sources.readers import DAILY_CSV
from sparkdesk.sources.writers import append_new_keys, stored, write_partitioned

SILVER = "use_ymd date, line string, station string, ride_num bigint, alight_num bigint"
FIRST, LATE, TOTAL = "first", "late", "total"
_STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def read_landing(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Stream of raw daily CSV files."""
    reader = spark.readStream.schema(DAILY_CSV).option("header", True)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.csv(path)


def stream_to_silver(landing: DataFrame, silver: str, rejects: str, checkpoint: str, by: str = "day") -> StreamingQuery:
    """Typed silver rows, first row of a key wins, invalid rows to a side table.

    Each batch appends only keys that are not stored; a batch that is repeated after a failure adds nothing.
    The table is partitioned by day, or by month (column ``use_mm``) where days are small.
    """
    partition = {"day": "use_ymd", "month": "use_mm"}[by]

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.persist()
        rows = daily_silver(batch)
        if by == "month":
            rows = rows.withColumn("use_mm", F.date_format("use_ymd", "yyyyMM"))
        if stored(spark, silver):
            append_new_keys(spark, silver, rows, DAILY_KEY, partition)
        else:
            write_partitioned(rows, silver, partition)
        readable = (
            F.try_to_date("USE_YMD", "yyyyMMdd").isNotNull() & F.col("GTON_TNOPE").try_cast("bigint").isNotNull()
            & F.col("GTOFF_TNOPE").try_cast("bigint").isNotNull())
        bad = batch.where(~readable | F.col("SBWY_ROUT_LN_NM").isNull() | F.col("SBWY_STNS_NM").isNull())
        bad.write.mode("overwrite").parquet(f"{rejects}/batch={batch_id}")
        batch.unpersist()

    return landing.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


# --- keyed state ------------------------------------------------------------------------------------
_MEASURES = [m for m in DAILY.measures]
_KEY = ["line", "station"]
_STATS = [s for s in DAILY.stats]
OUTPUT = T.StructType([
    T.StructField("kind", T.StringType()), *[T.StructField(k, T.StringType()) for k in _KEY], T.StructField("use_ymd", T.DateType()),
    *[T.StructField(m, T.LongType()) for m in _MEASURES], *[T.StructField(s, T.LongType()) for s in _STATS]])


def _out(kind: str, key: tuple, day: datetime.date, values: list | None = None, stats: list | None = None) -> Row:
    every = [kind, *key, day, *(values or [None] * len(_MEASURES)), *(stats or [None] * len(_STATS))]
    return Row(**dict(zip(OUTPUT.names, every, strict=True)))


class StationState(StatefulProcessor):
    """Per (line, station): the days of the last ``horizon``, running totals, and the newest day.

    The first row of a day counts; repeats within the horizon are dropped. A day older than the horizon can't be told from
    a repeat any more: it leaves as a late row, to be settled against the stored table. The horizon is counted from the
    key's own newest day, so one key that runs ahead doesn't age the others, and a key never holds more than a horizon of
    days. So no timer is needed; one on processing time would also keep an ``availableNow`` run from ever ending.
    """

    def __init__(self, horizon_days: int):
        self.horizon = datetime.timedelta(days=horizon_days)

    def init(self, handle) -> None:
        # one value per key, read and written once a batch; the days are those of one horizon
        self.state = handle.getValueState("station", ", ".join(["newest date", "days array<date>", *[f"{s} bigint" for s in _STATS]]))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        held = self.state.get()
        newest, days, stats = (held[0], set(held[1]), list(held[2:])) if held else (None, set(), [None] * len(_STATS))
        counted = False
        together: dict[datetime.date, tuple] = {}  # of rows of one day that come together the smallest counts, whatever their order
        for row in rows:
            here = tuple((row[m] is not None, row[m] or 0) for m in _MEASURES)
            together[row["use_ymd"]] = min(here, together.get(row["use_ymd"], here))
        for day, found in sorted(together.items()):
            values = [v if known else None for known, v in found]
            if newest is not None and day < newest - self.horizon:
                yield _out(LATE, key, day, values)
            elif day not in days:
                days.add(day)
                newest = day if newest is None else max(newest, day)
                stats, counted = self._added(stats, values), True
                yield _out(FIRST, key, day, values)
        if counted:
            self.state.update((newest, sorted(d for d in days if d >= newest - self.horizon), *stats))
            yield _out(TOTAL, key, newest, stats=stats)

    def _added(self, stats: list, values: list) -> list:
        had = dict(zip(_STATS, stats, strict=True))
        out = {"n_rows": (had["n_rows"] or 0) + 1}
        for m, v in zip(_MEASURES, values, strict=True):
            known = [x for x in (had[f"{m}_top"], v) if x is not None]
            both = [x for x in (had[f"{m}_sum"], v) if x is not None]
            out |= {f"{m}_sum": sum(both) if both else None, f"{m}_n": (had[f"{m}_n"] or 0) + (v is not None), f"{m}_top": max(known) if known else None}
        return [out[s] for s in _STATS]

    def close(self) -> None:
        pass


@contextmanager
def _state_store(spark: SparkSession):
    """Arbitrary keyed state needs the RocksDB store; a query keeps the store it is started with."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, _STATE_STORE)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def stream_to_gold(silver_rows: DataFrame, gold: str, checkpoint: str, horizon_days: int = 7) -> StreamingQuery:
    """Running station totals and first arrivals out of a stream of silver rows.

    A batch writes its first arrivals, its late rows and the totals of the keys it touched, each to a folder of its own
    number, so that a repeated batch replaces what it wrote.
    """
    spark = silver_rows.sparkSession
    rows = silver_rows.where(" AND ".join(f"{c} IS NOT NULL" for c in DAILY_KEY))
    out = rows.groupBy(*_KEY).transformWithState(StationState(horizon_days), OUTPUT, "Update", "None")

    def apply(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        for kind, columns in ((FIRST, [*DAILY_KEY, *_MEASURES]), (LATE, [*DAILY_KEY, *_MEASURES]), (TOTAL, [*_KEY, *_STATS])):
            batch.where(F.col("kind") == kind).select(*columns).write.mode("overwrite").parquet(f"{gold}/{kind}/batch={batch_id}")
        batch.unpersist()

    with _state_store(spark):
        return out.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _written(spark: SparkSession, gold: str, kind: str) -> DataFrame:
    return spark.read.option("basePath", f"{gold}/{kind}").parquet(f"{gold}/{kind}/batch=*")


def settled_rows(spark: SparkSession, gold: str) -> DataFrame:
    """First arrivals and those late rows whose key never arrived before (R3): what a batch job over all deliveries keeps."""
    first = _written(spark, gold, FIRST).drop("batch")
    return first.unionByName(_late_rows(spark, gold, first))


def _late_rows(spark: SparkSession, gold: str, first: DataFrame) -> DataFrame:
    return fresh_rows(first, _written(spark, gold, LATE).drop("batch"), DAILY_KEY)


def settled_gold(spark: SparkSession, gold: str) -> DataFrame:
    """Cube state of the station level: the newest totals of each key, with the settled late rows merged in (R2)."""
    newest = _written(spark, gold, TOTAL).groupBy(*_KEY).agg(F.max_by(F.struct(*_STATS), "batch").alias("x")).select(*_KEY, "x.*")
    late = daily_cube(_late_rows(spark, gold, _written(spark, gold, FIRST).drop("batch")), "station")
    types = {f.name: f.dataType for f in late.schema.fields}
    every = [F.col(c) if c in newest.columns else F.lit("station" if c == LEVEL else None).cast(types[c]).alias(c) for c in late.columns]
    return DAILY.merge(newest.select(*every), late)
