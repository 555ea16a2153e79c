"""Counts that views are made of, and that follow changed papers without a rebuild.

A cell is the number of papers with equal values of a few columns. Papers that change
take their old values out and put their new ones in, so kept cells and a signed count of
the changes give the cells of the new state. Sums, means, shares, exact medians and yearly
growth all follow from cells.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COUNTS = ("n", "oa", "known", "cites")


def counted(rows: DataFrame, keys, open_access: str | None = None, citations: str | None = None) -> DataFrame:
    """Per cell: rows, open ones, rows with known citations, and the sum of these."""
    none = F.lit(0).cast("long")
    measures = [F.count("*").alias("n"), (F.count_if(open_access) if open_access else none).alias("oa")]
    if citations in keys:
        return _cited(rows.groupBy(*keys).agg(*measures), citations)
    return rows.groupBy(*keys).agg(
        *measures,
        (F.count(citations) if citations else none).alias("known"),
        (F.coalesce(F.sum(citations), none) if citations else none).alias("cites"),
    )


def _cited(cells: DataFrame, citations: str) -> DataFrame:
    """Rows of a cell by the citations themselves agree on them, so both counts follow from `n`.

    They are not shuffled: cells of this kind are almost as many as the links they count.
    """
    none, number = F.lit(0).cast("long"), F.col(citations)
    return cells.select(
        "*",
        F.when(number.isNotNull(), F.col("n")).otherwise(none).alias("known"),
        F.coalesce(number * F.col("n"), none).alias("cites"),
    )


def total_and_mean():
    """Sum and mean of known citations over cells; NULL where none is known."""
    known, total = F.sum("known"), F.sum("cites")
    return F.when(known > 0, total), total.cast("double") / F.nullif(known, F.lit(0))


def _signed(cells: DataFrame, sign: int) -> DataFrame:
    keys = [c for c in cells.columns if c not in COUNTS]
    return cells.select(*keys, *[(F.lit(sign) * F.col(c)).alias(c) for c in COUNTS])


def changes(before: DataFrame, after: DataFrame, citations: str | None = None) -> DataFrame:
    """Cells of changed rows: their old values count down, their new ones up."""
    return added(_signed(before, -1), after, citations=citations)


def added(*parts: DataFrame, citations: str | None = None) -> DataFrame:
    """The sum of cells; those that come to nothing are gone.

    `citations` names the column that `known` and `cites` were counted from.
    """
    keys = [c for c in parts[0].columns if c not in COUNTS]
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part)
    summed = ("n", "oa") if citations in keys else COUNTS
    total = stacked.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in summed])
    total = _cited(total, citations) if citations in keys else total
    return total.filter(" OR ".join(f"{c} <> 0" for c in COUNTS))
