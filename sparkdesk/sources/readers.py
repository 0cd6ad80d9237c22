"""Readers with explicit schemas. Nothing is inferred from data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkdesk.sources.delimited import records

DAILY_CSV = "USE_YMD string, SBWY_ROUT_LN_NM string, SBWY_STNS_NM string, GTON_TNOPE string, GTOFF_TNOPE string"
CHUNK_JSON = ("chunk_id string, doc_id string, section string, title string, text string, keywords array<string>, "
              "cluster_id string, cluster_name string")
HOURS = tuple(range(4, 24))


def hourly_csv_schema(hours: Sequence[int] = HOURS) -> str:
    cells = [f"HR_{h}_{k} string" for h in hours for k in ("GET_ON_NOPE", "GET_OFF_NOPE")]
    return ", ".join(["USE_MM string", "SBWY_ROUT_LN_NM string", "STTN string", *cells])


def read_daily_csv(spark: SparkSession, path: str) -> DataFrame:
    """Raw daily rows, all text (S1); typing is the silver step's job."""
    return spark.read.schema(DAILY_CSV).csv(path, header=True, enforceSchema=False)


def read_hourly_csv(spark: SparkSession, path: str, hours: Sequence[int] = HOURS) -> DataFrame:
    """Raw wide month rows, all text."""
    return spark.read.schema(hourly_csv_schema(hours)).csv(path, header=True, enforceSchema=False)


def read_tree(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Every CSV below a folder as one table, with the file it came from (S3)."""
    df = spark.read.schema(schema).option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").csv(path, header=True)
    return df.withColumn("file_name", F.col("_metadata.file_name"))


# Fixed value: the code page of text that is not UTF-8.
FALLBACK_ENCODING = "cp949"
ENCODINGS = ("utf-8", FALLBACK_ENCODING)


def _typed(rows: DataFrame, schema: str, header: bool) -> DataFrame:
    """Records as columns of ``schema``; ``_fits`` tells whether the width is right and every filled cell can be read.

    With a header, a file's first record names its columns: they are taken by name if all asked names are there, in any
    order, and by position if the names are foreign.
    """
    fields = T.StructType.fromDDL(schema).fields
    rows = rows.select(F.col("file").alias("_file"), F.col("row_no").alias("_row_no"), F.col("line").alias("_line"), F.col("cells").alias("_cells"))
    names = F.array(*[F.lit(f.name) for f in fields])
    if header:
        trimmed = F.transform("_cells", lambda c: F.trim(c))
        heads = rows.where("_row_no = 0").select("_file", trimmed.alias("_head"))
        rows = rows.where("_row_no > 0").join(heads, "_file")  # one row per file: Spark broadcasts it while it is small
        by_name = F.forall(names, lambda n: F.array_contains("_head", n))
        place = lambda i, f: F.when(by_name, F.array_position("_head", f.name)).otherwise(F.lit(i + 1))
        width = F.size("_head")
    else:
        place, width = (lambda i, f: F.lit(i + 1)), F.lit(len(fields))
    cell = lambda i, f: F.nullif(F.try_element_at("_cells", place(i, f).cast("int")), F.lit(""))
    cells = [cell(i, f) for i, f in enumerate(fields)]
    typed = [c.try_cast(f.dataType) for c, f in zip(cells, fields)]
    fits = F.size("_cells") == width
    for c, t in zip(cells, typed):
        fits = fits & (c.isNull() | t.isNotNull())
    return rows.select("_file", "_row_no", "_line", fits.alias("_fits"), *[t.alias(f.name) for t, f in zip(typed, fields)])


def read_csv_any(spark: SparkSession, path: str, schema: str, header: bool = True) -> DataFrame:
    """CSV files in UTF-8 (with or without byte order mark) or in the Korean code page, file by file."""
    rows = _typed(records(spark, path, encodings=ENCODINGS), schema, header)
    return rows.select(*[f.name for f in T.StructType.fromDDL(schema).fields])


def read_headless(spark: SparkSession, path: str, width: int, skip: int) -> DataFrame:
    """Files with ``skip`` head records each, columns addressed by position as _c0, _c1, ...."""
    body = records(spark, path, encodings=ENCODINGS).where(F.col("row_no") >= skip)
    return body.select(*[F.nullif(F.try_element_at("cells", F.lit(i + 1)), F.lit("")).alias(f"_c{i}") for i in range(width)])


def read_block_table(spark: SparkSession, path: str, item: str | None, unit: str, value: str, key_column: int = 1) -> DataFrame:
    """Tables with three head records (year, item, unit) to (district, year, value).

    Each file's own head says which columns count: per year the first one whose item and unit match.
    """
    rows = records(spark, path, encodings=ENCODINGS)
    heads = rows.where("row_no < 3").groupBy("file").agg(F.sort_array(F.collect_list(F.struct("row_no", "cells"))).alias("h"))
    trimmed = lambda i: F.transform(F.col("h")[i]["cells"], lambda c: F.trim(c))
    columns = F.filter(
        F.arrays_zip(trimmed(0).alias("y"), trimmed(1).alias("item"), trimmed(2).alias("unit"), F.sequence(F.lit(1), F.size(F.col("h")[0]["cells"])).alias("at")),
        lambda c: c["y"].rlike(r"^\d+$") & (F.lit(True) if item is None else c["item"] == item) & F.contains(c["unit"], F.lit(unit)))
    first = F.filter(columns, lambda c, i: F.array_position(F.transform(columns, lambda x: x["y"]), c["y"]) == i + 1)
    heads = heads.select("file", first.alias("columns"))
    body = rows.where("row_no >= 3").join(heads, "file")
    number = lambda c: F.replace(F.try_element_at("cells", c["at"].cast("int")), F.lit(","), F.lit("")).try_cast("double")
    cells = F.transform("columns", lambda c: F.struct(c["y"].cast("bigint").alias("year"), number(c).alias(value)))
    return body.select(F.trim(F.try_element_at("cells", F.lit(key_column + 1))).alias("district"), F.inline(cells)).where(F.col("district") != "").dropna(subset=[value])


def read_tolerant_csv(spark: SparkSession, path: str, schema: str, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """Well-formed rows, and the records that do not fit the schema with their file and number."""
    rows = _typed(records(spark, path, encodings=ENCODINGS), schema, header)
    good = rows.where("_fits").select(*[f.name for f in T.StructType.fromDDL(schema).fields])
    return good, rows.where("NOT _fits").select(F.col("_file").alias("file"), F.col("_row_no").alias("row_no"), F.col("_line").alias("line"))


def read_jsonl(spark: SparkSession, path: str, schema: str = CHUNK_JSON) -> DataFrame:
    """JSON lines; blank lines are skipped."""
    return spark.read.schema(schema).json(path)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A stored table by path (S9); ``fmt='delta'`` where that format is on the classpath."""
    return spark.read.format(fmt).load(path)


def stored_periods(spark: SparkSession, path: str, start: str | None = None, end: str | None = None, digits: int = 8) -> DataFrame:
    """Periods named in file names such as ``daily_20240131.csv``, within optional bounds.

    Only names are listed; no file is opened.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").load(path)
    period = F.regexp_extract("path", rf"_(\d{{{digits}}})\.csv(?:/[^/]*)?$", 1).alias("period")  # a file, or a folder of one period's parts
    out = files.select(period).where("period <> ''").distinct()
    if start is not None:
        out = out.where(F.col("period") >= start)
    if end is not None:
        out = out.where(F.col("period") <= end)
    return out.orderBy("period")
