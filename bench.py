"""Benchmark: three builds, the warm exploration queries on their result, and the
eight views computed straight from the source tables. Prints one JSON line.

Every build and view runs once untimed, so that JVM start-up and code generation are
not what is measured, and is then timed once. Queries on the built layers are the
median of three runs after one warm-up and include fetching the result. Keys that begin
with load are runs over raw extractions: all works, ten changed ones, nothing new; they,
the kept cells, views built from these, and the recording of check results are listed
beside the total, not in it.
"""

import json
import os
import statistics
import tempfile
import time

from paperloom.plans import analytics, explore, incremental, quality
from paperloom.plans.warehouse import Warehouse
from paperloom.registry import REFERENCE_YEAR, Data, nested_works, queries
from paperloom.session import local_session


def timed(action):
    start = time.perf_counter()
    result = action()
    return time.perf_counter() - start, result


def loads(spark, folder):
    """Seconds of a first run over one nested work for each order, a small one and an idle one."""
    base = tempfile.mkdtemp(prefix="paperloom-load-")
    works = nested_works(Data(spark, folder)).filter("id LIKE 'L%-1-%'")

    def extraction(name, frame):
        os.makedirs(f"{base}/raw", exist_ok=True)
        frame.write.json(f"{base}/raw/{name}.jsonl")
        with open(f"{base}/raw/{name}.metadata.json", "w") as sidecar:
            sidecar.write("{}")

    run = lambda: incremental.run(spark, f"{base}/store", f"{base}/raw", skip_charts=True, buckets=8)
    extraction("all", works)
    seconds = {"load_first": timed(run)[0]}
    extraction("few", works.orderBy("id").limit(10))
    seconds["load_ten_works"] = timed(run)[0]
    seconds["load_idle"] = timed(run)[0]
    return seconds


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, shuffle_partitions=cores, name="bench")
    spark.read.parquet(f"{folder}/region.parquet").count()
    store = Warehouse(spark, tempfile.mkdtemp(prefix="paperloom-bench-"), buckets=1)
    seconds = {}

    def build_curated():
        return store.publish("curated", Data(spark, folder).tables(with_primary=True))

    def build_analytics():
        views = analytics.build(tables, REFERENCE_YEAR, unique_pairs=True)
        return store.publish("analytics", views)

    def check():
        return quality.curated_checks(tables) + quality.analytics_checks(
            tables, views, unique_pairs=True
        )

    build_curated()
    seconds["build_curated"], tables = timed(build_curated)
    build_analytics()
    seconds["build_analytics"], views = timed(build_analytics)
    check()
    seconds["quality"], results = timed(check)
    quality.enforce(results)

    facts = analytics.paper_facts(tables, REFERENCE_YEAR)
    warm = {
        "top_topics": lambda: explore.top_entities(views["topic_summary"], "topic_id", 10),
        "top_papers": lambda: explore.most_cited(facts),
        "filtered_papers": lambda: explore.latest_year_of_first_topic(
            facts, tables["paper_topics"], trends=views["publication_trends"], topics=views["topic_summary"]
        ),
        "top_authors": lambda: explore.top_entities(views["author_summary"], "author_id", 10),
        "top_institutions": lambda: explore.top_entities(
            views["institution_summary"], "institution_id", 10
        ),
    }
    for name, query in warm.items():
        query().collect()
        seconds[name] = statistics.median(timed(lambda: query().collect())[0] for _ in range(3))

    registered = queries()
    for name in analytics.BUILDERS:
        run = lambda: registered[name](spark, folder).write.format("noop").mode("overwrite").save()  # noqa: E731, B023
        run()
        seconds[f"view_{name}"] = timed(run)[0]

    seconds_of_cells, kept = timed(lambda: incremental.update_cells(store, everything=True))
    from_cells = analytics.build(tables, REFERENCE_YEAR, unique_pairs=True, kept=kept)
    beside = {"cells_all": seconds_of_cells, "views_from_cells": timed(lambda: store.publish("analytics", from_cells))[0]}
    beside |= {"quality_recorded": timed(lambda: incremental.run_quality(store))[0]}
    beside |= loads(spark, folder)

    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total seconds of builds, warm queries and views",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": {k: round(v, 4) for k, v in {**seconds, **beside}.items()},
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
