"""Writers: partitioned tables, upserts by partition, versions, exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkdesk.operators.merging import fresh_rows, upsert
from sparkdesk.session import materialize


def write_partitioned(df: DataFrame, path: str, partition: str, mode: str = "overwrite", rows_per_file: int = 5_000_000) -> None:
    """Table partitioned by a key.

    Rows are spread by AQE around the partition key: a large partition is split over several tasks, small
    ones share a task, and no file exceeds ``rows_per_file``.
    """
    (
        df.hint("rebalance", F.col(partition)).write.mode(mode).option("maxRecordsPerFile", rows_per_file)
        .partitionBy(partition).parquet(path)
    )


def overwrite_partitions(df: DataFrame, path: str, partition: str, rows_per_file: int = 5_000_000) -> None:
    """Replace only the partitions present in ``df`` (S10). ``df`` must not read from ``path``."""
    (
        df.hint("rebalance", F.col(partition)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", rows_per_file).partitionBy(partition).parquet(path)
    )


MOST_LITERALS = 2000


def touched(spark: SparkSession, path: str, arriving: DataFrame, partition: str) -> DataFrame:
    """The stored rows of the partitions that arrive. Few of them become a literal filter, so that no other folder is read; many are joined."""
    stored = spark.read.schema(arriving.schema).parquet(path)
    here = [r[0] for r in arriving.select(partition).distinct().limit(MOST_LITERALS + 1).collect()]
    if len(here) > MOST_LITERALS or None in here:
        return stored.join(arriving.select(partition).distinct(), stored[partition].eqNullSafe(arriving[partition]), "left_semi")
    return stored.where(F.col(partition).isin(here))


def append_new_keys(spark: SparkSession, path: str, arriving: DataFrame, keys: list[str], partition: str) -> None:
    """Insert-only merge into a stored table (M1, M2, S14): stored files are only read, new rows appended.

    Of arriving rows that repeat a key the smallest is the one stored, in whatever order they come.
    """
    stored = touched(spark, path, arriving, partition)
    write_partitioned(materialize(fresh_rows(stored, arriving, keys), "append"), path, partition, "append")


def merge_partitions(spark: SparkSession, path: str, arriving: DataFrame, keys: list[str], partition: str, latest: str) -> None:
    """Upsert into the touched partitions only (S12); of several arriving rows of a key the one largest in ``latest`` counts.

    ``latest`` may be a column of the table or one that only the arriving rows have. The merged partitions are first
    written to the shared folder, so the table is never overwritten while it is being read and a failed run can be repeated.
    """
    known = spark.read.parquet(path).columns
    stored = touched(spark, path, arriving if latest in known else arriving.drop(latest), partition)
    if latest not in known:
        stored = stored.withColumn(latest, F.lit(None).cast(arriving.schema[latest].dataType))
    merged = upsert(stored, arriving, keys, latest).select(known)
    overwrite_partitions(materialize(merged, "merge"), path, partition)


def write_version(df: DataFrame, path: str, version: int) -> None:
    """A new version beside the old ones; the schema may differ."""
    df.write.mode("error").parquet(f"{path}/version={version}")


def latest_version(spark: SparkSession, path: str) -> int:
    """Highest version of a table (S11), from the names of its files; no file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
    number = F.regexp_extract("path", r"/version=(\d+)/", 1).cast("int")
    return files.agg(F.max(number)).first()[0]


def read_version(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    return spark.read.parquet(f"{path}/version={latest_version(spark, path) if version is None else version}")


def write_jsonl(df: DataFrame, path: str) -> None:
    """JSON lines, nulls left out."""
    df.write.mode("overwrite").json(path)


def export_csv(df: DataFrame, path: str) -> DataFrame:
    """Write CSV, read it back and report whether rows and columns agree."""
    df.write.mode("overwrite").csv(path, header=True, escape='"')
    return compare_export(df, path)


def compare_export(df: DataFrame, path: str) -> DataFrame:
    """(written, read, columns, same) of a table and its CSV export, whose own header tells the columns."""
    back = df.sparkSession.read.csv(path, header=True, escape='"', multiLine=True)
    count = lambda d, n: d.agg(F.count("*").alias(n))
    both = count(df, "written").select("written", count(back, "read").scalar().alias("read"), F.lit(len(back.columns)).alias("columns"))
    return both.withColumn("same", (F.col("written") == F.col("read")) & F.lit(back.columns == df.columns))


def save_two_track(spark: SparkSession, runs: DataFrame, latest_path: str, history_path: str, key: str, when: str) -> None:
    """Append the runs to the history and refresh the latest record of each key.

    The latest records are versions: each is the one before it and the new runs, so the history is never read again. Of
    equal times the largest row counts, always the same.
    """
    runs.write.mode("append").parquet(history_path)
    version = latest_version(spark, latest_path) if stored(spark, latest_path) else 0
    known = runs if not version else runs.unionByName(read_version(spark, latest_path, version).select(runs.columns))
    rest = [c for c in runs.columns if c not in (key, when)]
    newest = known.groupBy(key).agg(F.max(F.struct(when, *rest)).alias("_row")).select(key, "_row.*").select(runs.columns)
    write_version(newest, latest_path, version + 1)


def stored(spark: SparkSession, path: str) -> bool:
    """Whether anything was written at a path."""
    from pyspark.errors import AnalysisException

    try:
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        return True
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
