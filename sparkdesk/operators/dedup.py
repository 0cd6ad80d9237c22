"""First-per-key and duplicate handling.

"Keep the first" is a minimum over (order columns), computed as an aggregate: it is reduced on the
map side, so a key that owns a third of all rows is no larger than any other after the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The row of each key that comes first in ``order``."""
    rest = [c for c in df.columns if c not in keys]
    best = F.min_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(best).select(*keys, "_row.*")


def dedup_by_source(frames: list[DataFrame], keys: list[str], position: str) -> DataFrame:
    """Union of frames, earlier frames first, keeping the first row of each key."""
    ranked = [f.withColumn("_src", F.lit(i)) for i, f in enumerate(frames)]
    union = ranked[0]
    for f in ranked[1:]:
        union = union.unionByName(f)
    return first_per_key(union, keys, [F.col("_src"), F.col(position)]).drop("_src")


def dedup_trimmed(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per trimmed value of the columns."""
    clean = df.select(*[F.coalesce(F.trim(c), F.lit("")).alias(c) for c in columns])
    return clean.dropDuplicates(columns)


def duplicate_report(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows, distinct keys and surplus rows."""
    per_key = df.groupBy(*keys).agg(F.count("*").alias("c"))
    return per_key.agg(
        F.sum("c").alias("n_rows"), F.count("*").alias("n_keys"), (F.sum("c") - F.count("*")).alias("n_duplicates")
    )
