"""Row numbers that no single task has to produce alone."""

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# monotonically_increasing_id keeps the partition above, the row below this bit.
_ROW_BITS = 33


# Persisted places of frames that were built and not released yet.
_held: list[DataFrame] = []


def release_places():
    """Free the places of all numbered frames; one that is read again sorts again."""
    while _held:
        _held.pop().unpersist()


def global_row_number(frame: DataFrame, order, name: str) -> DataFrame:
    """Number all rows 1..n by expressions that ascend in a total order.

    A plain global window sorts everything in one partition. Here rows are range
    partitioned on the complete order, so ties on the leading expression are split too;
    a row gets its place inside its partition, and the size of the partitions before is
    added. The places are persisted on the executors' disks because sizes and rows must
    come from the same partitioning; partitions lost with an executor are sorted again
    from the same borders. Nothing runs before the result is asked for, and the broadcast
    side holds one row per partition, whatever the data size. Call `release_places` once
    the result is written.

    Every column is sorted, so pass only what the number needs and join it back by id.
    """
    partitions = int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [f"_key{i}" for i in range(len(order))]
    mark = F.monotonically_increasing_id()
    placed = (
        frame.withColumns(dict(zip(keys, order)))
        .repartitionByRange(partitions, *keys)
        .sortWithinPartitions(*keys)
        .withColumns({"_part": F.spark_partition_id(), "_place": mark.bitwiseAND((1 << _ROW_BITS) - 1)})
        .drop(*keys)
        .persist(StorageLevel.DISK_ONLY)
    )
    _held.append(placed)
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    number = F.col("_offset") + F.col("_place") + 1
    return placed.join(F.broadcast(offsets), "_part").withColumn(name, number).select(*frame.columns, name)


def ordinal_within(frame: DataFrame, group: str, order, coarse, name: str) -> DataFrame:
    """Zero-based position of every row inside its group.

    `coarse` is an expression that never falls along the order. Rows are numbered per
    group and coarse value, and the rows of the lower values are added, so a group of any
    size is spread over as many tasks as it has coarse values.
    """
    cell = frame.withColumns({"_cell": coarse})
    counts = cell.groupBy(group, "_cell").agg(F.count("*").alias("_rows"))
    lower = Window.partitionBy(group).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        F.col(group).alias("_group"),
        F.col("_cell").alias("_at"),
        F.coalesce(F.sum("_rows").over(lower), F.lit(0)).alias("_start"),
    )
    place = F.row_number().over(Window.partitionBy(group, "_cell").orderBy(*order)) - 1
    same = F.col(group).eqNullSafe(F.col("_group")) & F.col("_cell").eqNullSafe(F.col("_at"))
    return (
        cell.withColumn("_place", place)
        .join(starts, same)
        .withColumn(name, (F.col("_start") + F.col("_place")).cast("long"))
        .select(*frame.columns, name)
    )
