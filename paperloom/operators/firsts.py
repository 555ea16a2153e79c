"""One deterministic row per key."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(frame: DataFrame, keys, order) -> DataFrame:
    """The first row of every key in the given order.

    Spark plans a window group limit on both sides of the shuffle, so a task sends
    at most one row per key: a key holding a third of the input costs its reducer
    no more than one row per map task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return (
        frame.withColumn("_place", F.row_number().over(window))
        .filter("_place = 1")
        .drop("_place")
    )


def lowest(frame: DataFrame, keys, order, fields) -> DataFrame:
    """The lowest row of every key as one value, `_lowest`, whose minimum over parts is that of all.

    Rows compare by the order, then by the fields in the given sequence with NULLs last.
    """
    ranked = [F.col(c).alias(f"_{i}") for i, c in enumerate(order)]
    for i, field in enumerate(fields):
        ranked += [F.col(field).isNull().alias(f"_null{i}"), F.col(field).alias(field)]
    return frame.groupBy(*keys).agg(F.min(F.struct(*ranked)).alias("_lowest"))


def fields_of(rows: DataFrame, keys, fields) -> DataFrame:
    return rows.select(*keys, *[F.col(f"_lowest.`{f}`").alias(f) for f in fields])


def earliest(frame: DataFrame, keys, order, fields) -> DataFrame:
    """The fields of the lowest row of every key, by the order and then the fields.

    As an aggregate this is cut to one row per key and task before the shuffle, and a
    plan that reads only the keys drops it altogether, leaving a plain distinct.
    """
    return fields_of(lowest(frame, keys, order, fields), keys, fields)
