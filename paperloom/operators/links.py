"""Measures of papers linked to an entity through a bridge."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.functions.columns import percentage


def linked_papers(bridge: DataFrame, papers: DataFrame, key: str, measures, unique_pairs=False):
    """Every distinct (entity, paper) link with the paper's measures.

    The bridge is dealt by paper once, which serves the distinct and the join alike. Pass
    unique_pairs for a bridge whose grain is already checked, to save the distinct.
    """
    pairs = bridge.select("paper_id", key)
    if not unique_pairs:
        pairs = pairs.repartition("paper_id").distinct()
    return pairs.join(papers.select("paper_id", *measures), "paper_id")


def exact_median(citations: str, frequency: str = "n"):
    """Interpolated median from values with frequencies; NULL values are ignored."""
    return F.percentile(citations, 0.5, F.col(frequency))


def open_access_share(count: str = "oa", rows: str = "n"):
    return percentage(F.sum(count), F.sum(rows))
