"""Shuffled shards by a two-pass external shuffle.

First pass: every record draws a number by a seeded hash of its place in the input and is
written with it. The draws deal the records uniformly into as many buckets as the input
needs, each of about `bucket_bytes`, whatever the records hold: copies, hot sources and
repeated ids spread like all others. Second pass: each bucket is read whole, shuffled by
Fisher and Yates in memory, and written. The buckets laid end to end are one uniform order
of all records; shard s holds its s-th equal stretch, so counts differ by at most one, and
`slot` is the place within the shard. A shard's files hold their rows in that order.

The drawn numbers are a written table, so a task that runs again after a lost executor
sees the same buckets. The same seed over the same splits of the input gives the same
shards. The driver sees one row of totals.

Defined results: null and empty texts have size 1 and are records like others; repeated
rows are records of their own; an input without rows gives none. A record larger than a
bucket makes its bucket larger by itself. Input columns named like the two that are added,
in any case, are replaced.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperloom.llm.runtime import scratch_folder, ship, written

BUCKET_BYTES = 16 << 20
SEED = 13
_BLOCK = 1024


def shuffled(count, seed, bucket):
    """A uniform order of `count` records: numpy's in-place shuffle is Fisher and Yates's."""
    order = np.arange(count)
    np.random.default_rng([seed, bucket]).shuffle(order)
    return order


def _shuffle_bucket(seed):
    def run(key, table):
        order = np.argsort(table.column("place").to_numpy())[shuffled(table.num_rows, seed, key[0].as_py())]
        return pa.table(
            {
                "record": table.column("record").take(pa.array(order)),
                "position": pa.array(table.column("before")[0].as_py() + np.arange(table.num_rows)),
            }
        )

    return run


def _offsets(counts):
    """(bucket, before): records in earlier buckets, by prefix sums in blocks of buckets."""
    blocked = counts.withColumn("block", F.expr(f"bucket div {_BLOCK}"))
    earlier = (Window.unboundedPreceding, -1)
    inside = Window.partitionBy("block").orderBy("bucket").rowsBetween(*earlier)
    across = Window.orderBy("block").rowsBetween(*earlier)
    starts = blocked.groupBy("block").agg(F.sum("records").alias("total"))
    starts = starts.select("block", F.coalesce(F.sum("total").over(across), F.lit(0)).alias("start"))
    placed = blocked.withColumn("within", F.coalesce(F.sum("records").over(inside), F.lit(0)))
    return placed.join(starts, "block").select("bucket", (F.col("start") + F.col("within")).alias("before"))


def write_shards(docs, folder=None, shards=16, seed=SEED, bucket_bytes=BUCKET_BYTES, text_column="text"):
    """Write all rows into `shards` folders shard=0, shard=1, ... and return them read back.

    The frame has the input's columns, `slot` and `shard`. Without a folder one is made
    under the shared checkpoint folder.
    """
    spark = docs.sparkSession
    ship(spark)
    folder = folder or scratch_folder(spark)
    size = F.coalesce(F.octet_length(text_column), F.lit(0)).cast("long") + 1
    place = F.monotonically_increasing_id()
    drawn = docs.select(F.struct("*").alias("record"), size.alias("size"), place.alias("place"))
    drawn = written(drawn.withColumn("draw", F.xxhash64(F.lit(seed).cast("long"), "place")))
    total = drawn.agg(F.count("*").alias("records"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes")).first()
    buckets = max(1, -(-total["bytes"] // bucket_bytes))
    dealt = drawn.withColumn("bucket", F.pmod("draw", F.lit(buckets).cast("long")))
    counts = dealt.groupBy("bucket").agg(F.count("*").alias("records"))

    # Offsets come before the grouping, so that one shuffle by bucket serves join and group.
    placed = dealt.select("record", "place", "bucket").join(_offsets(counts), "bucket")
    schema = T.StructType([drawn.schema["record"], T.StructField("position", T.LongType())])
    ordered = placed.groupBy("bucket").applyInArrow(_shuffle_bucket(seed), schema)
    n = max(1, total["records"])
    ordered = ordered.withColumn("_shard", F.expr(f"cast(position * {shards} div {n} as int)"))
    start = F.expr(f"(cast(_shard as long) * {n} + {shards - 1}) div {shards}")
    kept = [c for c in docs.columns if c.lower() not in ("shard", "slot")]
    placed = ordered.select(
        *[F.col("record").getField(c).alias(c) for c in kept],
        (F.col("position") - start).alias("slot"),
        F.col("_shard").alias("shard"),
    )
    placed.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(folder, compression="zstd")
    return spark.read.schema(placed.schema).parquet(folder)
