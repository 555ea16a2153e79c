"""Row counts and small ordered samples of a layer."""

from pyspark.sql import functions as F

from paperloom.model import TABLE_KEYS, VIEWS
from paperloom.plans.explore import ordering

UNAVAILABLE = "unavailable"


def table_samples(tables, n: int = 3) -> dict:
    """Row count and the first rows by key of every curated table."""
    return {
        name: (table.count(), table.orderBy(*ordering(*TABLE_KEYS[name])).limit(n))
        for name, table in tables.items()
    }


def sample_order(view) -> list:
    columns = view.columns
    if "citation_rank" in columns:
        return ["citation_rank"]
    if "publication_year" in columns and "paper_count" in columns:
        return ["-publication_year", *(["topic_id"] if "topic_id" in columns else [])]
    keys = [c for c in ("topic_id", "author_id", "institution_id", "oa_status") if c in columns]
    return ["-paper_count", keys[0]] if "paper_count" in columns and keys else columns[:1]


def view_samples(views, n: int = 5) -> dict:
    """The first rows of every view in its usual order; `UNAVAILABLE` for an absent one."""
    return {
        name: views[name].orderBy(*ordering(*sample_order(views[name]))).limit(n)
        if name in views
        else UNAVAILABLE
        for name in VIEWS
    }


def work_sample(works, n: int = 5):
    names = ("id", "title", "publication_year", "cited_by_count")
    shown = [c for c in names if c in works.columns]
    return works.select(*[F.col(c) for c in shown]).limit(n)
