"""Grain, reference and lineage checks as single passes."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def orphans(child: DataFrame, parent: DataFrame, child_key="_parent_id", parent_key="_row_id"):
    """Child rows without a parent; a NULL link counts as broken."""
    links = parent.select(F.col(parent_key).alias("_link"))
    return child.join(links, child[child_key] == links["_link"], "left_anti")


def duplicate_keys(frame: DataFrame, keys) -> DataFrame:
    """Keys held by more than one row, with their number of rows."""
    return frame.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def key_census(owner: DataFrame, key: str, references: dict[str, DataFrame]) -> DataFrame:
    """How often each key occurs in its owning table and in every referencing table.

    One union and one pre-aggregated shuffle on the key stand in for a join per
    check: uniqueness, broken references and coverage all follow from these counts.
    The state per key is a few counters, so a hot key is no heavier than others.
    """
    names = ["owner", *references]
    frames = [owner, *references.values()]

    def tagged(position):
        flags = [F.lit(int(i == position)).alias(f"_{n}") for i, n in enumerate(names)]
        return frames[position].select(F.col(key).alias("key"), *flags)

    stacked = reduce(DataFrame.unionAll, [tagged(i) for i in range(len(names))])
    return stacked.groupBy("key").agg(*[F.sum(f"_{n}").alias(n) for n in names])


def broken_references(census_key, references: str):
    """Referencing rows whose key is NULL or unknown to the owner, from a census."""
    missing = F.col(census_key).isNull() | (F.col("owner") == 0)
    return F.coalesce(F.sum(F.when(missing, F.col(references))), F.lit(0))
