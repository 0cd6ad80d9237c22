"""Global shuffle into shards in two passes.

Pass one scatters the records over buckets that fit in a task's memory: a seeded hash of the record picks the bucket, so
buckets are alike in size however sources or copies are spread. Pass two orders each bucket with a seeded Fisher-Yates
shuffle. The buckets one after another are a random order of all records; shard s is the s-th of equal stretches of
it, so the counts of two shards differ by one at most (law ``rows``). Nothing passes the driver but counts.

Rows: a null or empty text has no bytes; a null id is an id like any other. Copies of a text with different ids scatter
like other records. Fully equal records are interchangeable: where there are more than ``HOT_COPIES`` of them, or more
bytes than a quarter of a bucket, they are dealt over all buckets. More shards than records leave shards empty; an empty table gives an empty result. Other columns travel along;
columns of the names ``shard`` and ``slot`` are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from sparkdesk.session import materialize

BUCKET_BYTES = 24 << 20
HOT_COPIES = 10_000
SHARDS = 24


def fisher_yates(n: int, rng: np.random.Generator) -> np.ndarray:
    """A uniform order of 0 … n-1: each place, from the last, swaps with a random one at or before it."""
    order = np.arange(n)
    swaps = rng.integers(0, np.arange(n, 0, -1)) if n else order  # one draw for each place n-1 … 0
    for place, other in zip(range(n - 1, 0, -1), swaps.tolist(), strict=False):
        order[place], order[other] = order[other], order[place]
    return order


def shuffled(docs: DataFrame, shards: int = SHARDS, seed: int = 17, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """All rows and columns of ``docs`` (doc_id, text, …) with ``shard`` (0 …) and ``slot`` (0 … in its shard)."""
    docs = docs.drop("shard", "slot")
    hashed = [f.name for f in docs.schema.fields if not isinstance(f.dataType, T.MapType)]
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.xxhash64(F.lit(seed), *hashed).alias("_content"))
    size = F.coalesce(F.octet_length("row.text"), F.lit(0)) + 64
    total = rows.agg(F.count("*"), F.sum(size)).first()
    buckets = max(1, -(-(total[1] or 0) // bucket_bytes))
    copies = rows.groupBy("_content").agg(F.count("*").alias("n"), F.sum(size).alias("bytes"))
    hot = materialize(copies.where((F.col("n") > HOT_COPIES) | ((F.col("bytes") > bucket_bytes / 4) & (F.col("n") > 1))).select("_content"), "shards-hot")
    rows = rows.join(hot.withColumn("_many", F.lit(True)), "_content", "left")
    spread = F.when(F.col("_many"), F.xxhash64("_content", F.monotonically_increasing_id())).otherwise(F.col("_content"))
    # written once: a copy dealt by its place stays in its bucket, whatever is read or lost later
    rows = materialize(rows.withColumn("_bucket", F.pmod(F.xxhash64(spread), F.lit(buckets))).drop("_many"), "shards-rows")

    group = F.floor(F.col("_bucket") / 1024)  # sums of sums, so that no task reads more than a share of the buckets
    counts = materialize(rows.groupBy("_bucket").agg(F.count("*").alias("n")), "shards-counts").withColumn("g", group)
    within = Window.partitionBy("g").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("g").rowsBetween(Window.unboundedPreceding, -1)
    groups = counts.groupBy("g").agg(F.sum("n").alias("m")).select("g", F.coalesce(F.sum("m").over(before), F.lit(0)).alias("base"))
    starts = counts.join(groups, "g").select("_bucket", (F.col("base") + F.coalesce(F.sum("n").over(within), F.lit(0))).alias("_start"))

    n, rest = divmod(total[0], shards)
    names = [*docs.columns, "shard", "slot"]

    def pass_two(bucket: pa.Table) -> pa.Table:
        bucket = bucket.take(pc.sort_indices(bucket.column("_content")))
        rng = np.random.default_rng([seed, bucket.column("_bucket")[0].as_py()])
        bucket = bucket.take(pa.array(fisher_yates(bucket.num_rows, rng)))
        place = bucket.column("_start")[0].as_py() + np.arange(bucket.num_rows)
        big = rest * (n + 1)  # the first shards hold one row more
        late = rest + (place - big) // max(n, 1)
        shard = np.where(place < big, place // (n + 1), late)
        slot = np.where(place < big, place % (n + 1), (place - big) % max(n, 1))
        row = bucket.column("row").combine_chunks()
        return pa.Table.from_arrays([*row.flatten(), pa.array(shard, pa.int32()), pa.array(slot, pa.int64())], names)

    schema = T.StructType([*docs.schema.fields, T.StructField("shard", T.IntegerType()), T.StructField("slot", T.LongType())])
    return rows.join(starts, "_bucket").groupBy("_bucket").applyInArrow(pass_two, schema)


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, seed: int = 17, bucket_bytes: int = BUCKET_BYTES) -> None:
    """The shuffled rows as Parquet, a folder per shard; a file holds a stretch of slots in order."""
    shuffled(docs, shards, seed, bucket_bytes).write.partitionBy("shard").parquet(path)
