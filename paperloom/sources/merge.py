"""Latest version of every work over a history of loads."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.operators.firsts import first_per_key
from paperloom.sources.relations import WORK_ID


def latest_works(history: DataFrame, order=("load_seq",)) -> DataFrame:
    """The last submitted version of every id, with all it carries.

    A later version replaces the whole record, nested arrays included; an id that is
    not submitted again stays. Resubmitted copies are cut to one per task before the
    shuffle.
    """
    return first_per_key(history, ["id"], [F.col(c).desc_nulls_last() for c in order])


def children_of(current: DataFrame, children: DataFrame) -> DataFrame:
    """Child rows that came with the current version of their work."""
    versions = current.select(F.col("id").alias(WORK_ID), F.col("load_seq").alias("_current"))
    linked = children.join(versions, WORK_ID)
    return linked.filter(F.col("load_seq") == F.col("_current")).drop("_current")
