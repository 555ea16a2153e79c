"""The eight analytical views over the curated tables.

Every builder takes the curated tables and returns a lazy DataFrame, or None when a
source column the whole view needs is absent. Single metrics are left out when their
column is absent. Uniqueness of `papers` is a checked property of the curated layer,
so distinct papers are counted as rows of the deduplicated links.
"""

from datetime import datetime, timezone

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paperloom.functions.columns import citations_per_year, known_status, percentage
from paperloom.model import VIEWS, table_columns
from paperloom.operators.cells import counted, total_and_mean
from paperloom.operators.growth import with_calendar_growth
from paperloom.operators.links import exact_median, linked_papers, open_access_share
from paperloom.operators.ranking import global_row_number

CITATIONS, OPEN, YEAR = "cited_by_count", "is_open_access", "publication_year"


def current_year() -> int:
    return datetime.now(timezone.utc).year


def _known(tables, *names):
    return [name for name in names if name in table_columns(tables, "papers")]


# Cells, the bridge and entity they count, and the paper columns that tell them apart.
CELLS = {
    "paper_cells": (None, None, (YEAR, CITATIONS, "oa_status")),
    "topic_cells": ("paper_topics", "topic_id", (YEAR, CITATIONS)),
    "author_cells": ("paper_authors", "author_id", ()),
    "institution_cells": ("paper_institutions", "institution_id", ()),
}


def cells(tables, name, unique_pairs=False, columns=None) -> DataFrame:
    """Papers, or their links to one kind of entity, counted by the columns that views need."""
    bridge, key, every = CELLS[name]
    columns = _known(tables, *(every if columns is None else columns))
    open_access, citations = (c if _known(tables, c) else None for c in (OPEN, CITATIONS))
    if bridge is None:
        return counted(tables["papers"], columns, open_access, citations)
    measures = dict.fromkeys([*columns, *filter(None, (open_access, citations))])
    links = linked_papers(tables[bridge], tables["papers"], key, list(measures), unique_pairs)
    return counted(links, [key, *columns], open_access, citations)


def all_cells(tables, unique_pairs=False) -> dict:
    return {name: cells(tables, name, unique_pairs) for name in CELLS}


def _cells(tables, kept, name, columns=(), unique_pairs=False):
    """Kept cells, or else cells by no more columns than one view needs."""
    return kept[name] if kept else cells(tables, name, unique_pairs, columns)


def overview_kpis(tables, kept=None, **_) -> DataFrame:
    """One row of totals over papers, with entity counts as scalar subqueries."""
    papers = _cells(tables, kept, "paper_cells", (YEAR, CITATIONS))
    has = set(_known(tables, CITATIONS, OPEN, YEAR))
    rows = F.coalesce(F.sum("n"), F.lit(0))
    metrics = [rows.alias("total_papers")]
    if CITATIONS in has:
        total, mean = total_and_mean()
        metrics += [
            total.alias("total_citations"),
            mean.alias("average_citations_per_paper"),
            exact_median(CITATIONS).alias("median_citations_per_paper"),
        ]
    if OPEN in has:
        metrics += [
            F.coalesce(F.sum("oa"), F.lit(0)).alias("open_access_papers"),
            open_access_share().alias("open_access_percentage"),
        ]
    if YEAR in has:
        metrics += [
            F.min(YEAR).alias("earliest_publication_year"),
            F.max(YEAR).alias("latest_publication_year"),
        ]
    counts = [
        tables[name].agg(F.count("*")).scalar().alias(f"unique_{name}")
        for name in ("authors", "topics", "institutions")
    ]
    return papers.agg(*metrics).select("*", *counts)


def publication_trends(tables, kept=None, **_) -> DataFrame | None:
    if YEAR not in _known(tables, YEAR):
        return None
    metrics = [F.sum("n").alias("paper_count"), *_sum_and_mean(tables, "average_citations")]
    papers = _cells(tables, kept, "paper_cells", (YEAR,))
    yearly = papers.filter(F.col(YEAR).isNotNull()).groupBy(YEAR).agg(*metrics)
    return with_calendar_growth(yearly)


def _sum_and_mean(tables, mean, total="total_citations"):
    if not _known(tables, CITATIONS):
        return []
    sums, means = total_and_mean()
    return [sums.alias(total), means.alias(mean)]


def topic_summary(tables, unique_pairs=False, kept=None, **_) -> DataFrame:
    measures = _known(tables, CITATIONS, OPEN)
    links = _cells(tables, kept, "topic_cells", (CITATIONS,), unique_pairs)
    metrics = [F.sum("n").alias("paper_count"), *_sum_and_mean(tables, "average_citations")]
    if CITATIONS in measures:
        metrics.append(exact_median(CITATIONS).alias("median_citations"))
    if OPEN in measures:
        metrics.append(open_access_share().alias("open_access_percentage"))
    return _labelled(links.groupBy("topic_id").agg(*metrics), tables["topics"], "topic_id", ["topic_name"])


def _labelled(totals, dimension, key, names):
    """Attach labels after the aggregation, when both sides hold one row per entity."""
    names = [n for n in names if n in dimension.columns]
    return totals.join(dimension.select(key, *names), key)


def topic_yearly_trends(tables, unique_pairs=False, kept=None, **_) -> DataFrame | None:
    if YEAR not in _known(tables, YEAR):
        return None
    links = _cells(tables, kept, "topic_cells", (YEAR,), unique_pairs).filter(F.col(YEAR).isNotNull())
    yearly = links.groupBy(YEAR, "topic_id").agg(
        F.sum("n").alias("paper_count"), *_sum_and_mean(tables, "average_citations")
    )
    return _labelled(
        with_calendar_growth(yearly, "topic_id"), tables["topics"], "topic_id", ["topic_name"]
    )


# The columns of the ranking, in order, each only where papers has it.
TOP_PAPER_COLUMNS = (
    "paper_id",
    "title",
    "doi",
    "publication_year",
    "cited_by_count",
    "primary_topic_name",
    "is_open_access",
    "oa_status",
)


def paper_facts(tables, reference_year: int | None = None) -> DataFrame:
    """`top_papers` without the rank: what filters and top-k queries read."""
    papers = tables["papers"]
    facts = papers.select(*[c for c in TOP_PAPER_COLUMNS if c in papers.columns])
    if len(_known(tables, CITATIONS, YEAR)) == 2:
        year = reference_year or current_year()
        facts = facts.withColumns(
            {
                "citation_reference_year": F.lit(year).cast("long"),
                "citations_per_year_since_publication": citations_per_year(CITATIONS, YEAR, year),
            }
        )
    return facts


def citation_order():
    """Most cited first, unknown citations last, then by id, as ascending expressions."""
    return [F.coalesce(-F.col(CITATIONS), F.lit(2**63 - 1)), F.col("paper_id")]


def top_papers(tables, reference_year: int | None = None, **_) -> DataFrame:
    """Every paper with its place by citations; ties resolve by paper id.

    Only ids and citations are sorted; the place is joined back by id.
    """
    facts = paper_facts(tables, reference_year)
    if CITATIONS not in facts.columns:
        return facts
    ranked = global_row_number(facts.select("paper_id", CITATIONS), citation_order(), "citation_rank")
    return facts.join(ranked.drop(CITATIONS), "paper_id")


def author_summary(tables, unique_pairs=False, kept=None, **_) -> DataFrame:
    """Full counting: every author receives all citations of the paper."""
    links = _cells(tables, kept, "author_cells", unique_pairs=unique_pairs)
    metrics = [F.sum("n").alias("paper_count")]
    metrics += _sum_and_mean(
        tables, "average_citations_per_paper", "total_citations_of_authored_papers"
    )
    if OPEN in _known(tables, OPEN):
        metrics += [F.sum("oa").alias("open_access_papers"), open_access_share().alias("open_access_percentage")]
    totals = links.groupBy("author_id").agg(*metrics)
    return _labelled(totals, tables["authors"], "author_id", ["author_name"])


def institution_summary(tables, unique_pairs=False, kept=None, **_) -> DataFrame:
    links = _cells(tables, kept, "institution_cells", unique_pairs=unique_pairs)
    totals = links.groupBy("institution_id").agg(
        F.sum("n").alias("paper_count"), *_sum_and_mean(tables, "average_citations")
    )
    names = ["institution_name", "country_code", "institution_type"]
    return _labelled(totals, tables["institutions"], "institution_id", names)


def open_access_summary(tables, kept=None, **_) -> DataFrame | None:
    if not _known(tables, "oa_status"):
        return None
    papers = _cells(tables, kept, "paper_cells", ("oa_status",))
    counts = papers.groupBy(known_status("oa_status").alias("oa_status")).agg(F.sum("n").alias("paper_count"))
    # A handful of statuses; one window over them is the total.
    total = F.sum("paper_count").over(Window.partitionBy())
    return counts.withColumn("percentage_of_papers", percentage("paper_count", total))


BUILDERS = {
    "overview_kpis": overview_kpis,
    "publication_trends": publication_trends,
    "topic_summary": topic_summary,
    "topic_yearly_trends": topic_yearly_trends,
    "top_papers": top_papers,
    "author_summary": author_summary,
    "institution_summary": institution_summary,
    "open_access_summary": open_access_summary,
}


def build(tables, reference_year: int | None = None, unique_pairs: bool = False, kept: dict | None = None) -> dict:
    """All views the curated columns support, by name.

    Pass unique_pairs for tables read from a published layer, whose bridge grain was
    checked before publication; it saves the shuffle that removes repeated links. Pass
    `kept` cells to read them in place of the bridges.
    """
    views = {
        name: BUILDERS[name](tables, reference_year=reference_year, unique_pairs=unique_pairs, kept=kept)
        for name in VIEWS
    }
    return {name: view for name, view in views.items() if view is not None}


def register_views(spark, views: dict[str, DataFrame]):
    """Expose the views under their names and drop those no longer supported."""
    for name in VIEWS:
        if name in views:
            views[name].createOrReplaceTempView(name)
        else:
            spark.catalog.dropTempView(name)
