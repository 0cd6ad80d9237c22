"""Plain Spark helpers that several text operators need."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkdesk.session import materialize

BROADCAST_ROWS = 500_000  # rows of one or two numbers: at most some 10 MB


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: Column, parts: int) -> Column:
    """The remainder that deals rows into folds: crc32 of the key as text."""
    return F.crc32(key.cast("string").cast("binary")) % parts


def keep_ids(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose key is among ``ids`` (a stored table). A checked small set travels to the rows; a larger one is joined by shuffle."""
    small = ids.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return df.join(F.broadcast(ids) if small else ids, key, "left_semi")


def following(df: DataFrame, keys: list[str], what: list[str], name: str, ring: bool = False) -> DataFrame:
    """``df`` with ``after``: the columns ``what`` of the next row in the order of ``keys`` (null after the last; with ``ring`` the first).

    Rows are sorted by ranges whose bounds Spark samples; equal keys may be split when later keys differ, so no key
    gathers in one task. What crosses the edge of a range comes from the first row of the next one: one row per range.
    """
    ranged = df.repartitionByRange(*[F.col(k).asc_nulls_first() for k in keys])
    ranged = materialize(ranged.withColumn("_range", F.spark_partition_id()), name)
    order = Window.partitionBy("_range").orderBy(*[F.col(k).asc_nulls_first() for k in keys])
    heads = ranged.groupBy("_range").agg(F.min(F.struct(F.struct(*keys).alias("k"), F.struct(*what).alias("head"))).alias("x")).select("_range", "x.head")
    by_range = Window.orderBy("_range")
    nexts = F.lead("head").over(by_range)
    heads = heads.select("_range", (F.coalesce(nexts, F.first("head").over(by_range)) if ring else nexts).alias("head"))
    rows = ranged.withColumn("after", F.lead(F.struct(*what)).over(order)).join(F.broadcast(heads), "_range")
    return rows.withColumn("after", F.coalesce("after", "head")).drop("_range", "head")


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, label): the smallest node reachable over ``edges`` (u, v), for every node with an edge.

    Smallest labels of neighbours and of one's own label, repeated until nothing changes. Each round is a stored table,
    so a lost executor costs one round; nothing but the count of changes comes to the driver.
    """
    both = materialize(edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), f"{name}-edges")
    labels = materialize(both.groupBy(F.col("u").alias("node")).agg(F.least(F.min("v"), F.first("u")).alias("label")), f"{name}-labels")
    while True:
        near = both.join(labels, both["v"] == labels["node"]).groupBy("u").agg(F.min("label").alias("near"))
        best = labels.join(near, labels["node"] == near["u"]).select("node", F.col("label").alias("old"), F.least("label", "near").alias("mid"))
        over = labels.select(F.col("node").alias("mid"), F.col("label").alias("over"))
        moved = materialize(best.join(over, "mid", "left").select("node", "old", F.least("mid", "over").alias("label")), f"{name}-labels")
        if moved.where("label < old").limit(1).count() == 0:
            return moved.select("node", "label")
        labels = moved.select("node", "label")
