"""Health of a warehouse as small DataFrames and values."""

from pyspark.sql import functions as F

from paperloom.plans import incremental
from paperloom.plans.explore import ordering
from paperloom.plans.quality import FAIL, PASS, WARN
from paperloom.plans.warehouse import Warehouse


def recent_runs(warehouse: Warehouse, n: int = 10):
    runs = warehouse.current("pipeline_runs")
    seconds = (
        F.unix_micros("finished_at") - F.unix_micros("started_at")
    ) / F.lit(1_000_000.0)
    return (
        runs.drop("sequence")
        .withColumn("duration_seconds", seconds)
        .orderBy(*ordering("-started_at", "run_id"))
        .limit(n)
    )


def last_success(warehouse: Warehouse):
    """When the last successful run ended and how many seconds ago that was."""
    done = warehouse.current("pipeline_runs").filter("status = 'success'")
    return done.agg(F.max("finished_at").alias("finished_at")).withColumn(
        "age_seconds", F.unix_seconds(F.current_timestamp()) - F.unix_seconds("finished_at")
    )


def recent_files(warehouse: Warehouse, n: int = 5):
    known = warehouse.current("processed_files").drop("sequence")
    return known.orderBy(*ordering("-processed_at", "file_path")).limit(n)


def latest_quality(warehouse: Warehouse):
    """Results of the latest run, or of the latest execution outside a run."""
    entries = warehouse.entries("data_quality_results")
    last = entries.orderBy(*ordering("-checked_at", "execution_id")).first()
    if last is None:
        return None
    scope = "run_id" if last["run_id"] else "execution_id"
    return entries.filter(F.col(scope) == F.lit(last[scope])).drop("sequence")


def quality_summary(results):
    """Overall status and the number of results per status."""
    counts = {r["status"]: r["count"] for r in results.groupBy("status").count().collect()}
    worst = next((s for s in (FAIL, WARN) if counts.get(s)), PASS)
    return worst, {s: counts.get(s, 0) for s in (PASS, WARN, FAIL)}


def findings(results):
    return results.filter(F.col("status") != PASS).orderBy("layer", "check_name")


def status(warehouse: Warehouse, raw_dir: str) -> dict:
    """Everything an operator looks at first; missing parts are None."""
    results = latest_quality(warehouse)
    layers = {name: warehouse.tables(name) for name in ("works", "curated")}
    papers = layers["curated"].get("papers")
    years = None
    if papers is not None and "publication_year" in papers.columns:
        years = papers.agg(
            F.min("publication_year").alias("first"),
            F.max("publication_year").alias("last"),
            F.countDistinct("publication_year").alias("years"),
        )
    downstream, charts = warehouse.state()
    return {
        "recent_runs": recent_runs(warehouse),
        "last_success": last_success(warehouse),
        "processed_files": warehouse.current("processed_files").count(),
        "recent_files": recent_files(warehouse),
        "downstream_pending": downstream,
        "charts_pending": charts,
        "quality": None if results is None else quality_summary(results),
        "findings": None if results is None else findings(results),
        "works": layers["works"]["works"].count() if layers["works"] else None,
        "papers": None if papers is None else papers.count(),
        "publication_years": years,
        "pending_files": incremental.pending_files(warehouse, raw_dir).count(),
    }
