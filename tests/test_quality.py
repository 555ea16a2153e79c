import json

import pytest

from paperloom.plans import analytics, curated, quality, rawgate
from paperloom.sources import files, works
from pyspark.sql import functions as F

from conftest import WORKS, rows, write_extraction
from test_curated import nested


@pytest.fixture(scope="module")
def layer(spark):
    tables = {n: t.persist() for n, t in curated.build_nested(nested(spark)).items()}
    views = {n: v.persist() for n, v in analytics.build(tables, 2026).items()}
    return tables, views


def failed(results):
    return {r.check_name for r in results if r.status == quality.FAIL}


def test_coverage_and_status(spark, layer):
    tables, views = layer
    results = quality.curated_checks(tables) + quality.analytics_checks(tables, views)
    quality.enforce(results)
    observed = {r.check_name: r.observed_value for r in results if r.layer == "coverage"}
    assert observed == {
        "coverage.doi": "25.0",
        "coverage.primary_topic": "50.0",
        "coverage.title": "75.0",
        "coverage.oa_information": "50.0",
        "coverage.authors": "50.0",
        "coverage.institutions": "25.0",
        "coverage.publication_years": "2",
    }
    row = quality.coverage(tables).first()
    assert (row["doi"], row["authors"], row["publication_years"]) == (25.0, 50.0, 2)
    frame = quality.results_frame(spark, results)
    assert rows(quality.roll_up(frame), "layer", "FAIL") == [("analytics", 0), ("coverage", 0), ("curated", 0)]
    assert quality.overall(results) == "WARN"
    with pytest.raises(quality.QualityError):
        quality.enforce([quality.Result("bad", "raw", quality.FAIL, "1", "0")])
    quality.enforce([quality.Result("sparse", "coverage", quality.WARN, "0", "")])


def test_broken_tables_fail(spark, layer):
    tables, _ = layer
    papers = tables["papers"]
    first = papers.filter("paper_id = 'M1'")
    broken = papers.withColumn(
        "cited_by_count", F.when(F.col("paper_id") == "M2", -1).otherwise(F.col("cited_by_count"))
    ).withColumn("paper_id", F.when(F.col("paper_id") != "M3", F.col("paper_id")))
    links = tables["paper_topics"]
    lost = links.limit(1).withColumn("paper_id", F.lit("missing"))
    changed = {
        **tables,
        "papers": broken.unionAll(first),
        "paper_topics": links.unionAll(lost),
        "paper_authors": tables["paper_authors"].withColumn("author_id", F.lit(None).cast("string")),
    }
    found = {r.check_name: r.observed_value for r in quality.curated_checks(changed) if r.status == quality.FAIL}
    assert found["papers.unique"] == "1" and found["papers.identity"] == "1"
    assert found["papers.cited_by_count.range"] == "1"
    assert found["paper_topics.papers.references"] == "1"
    assert found["paper_authors.identity"] == "3" and found["paper_authors.authors.references"] == "3"
    assert "paper_institutions.papers.references" not in found


def test_year_range_uses_the_next_year(spark):
    papers = spark.createDataFrame([(1499,), (1500,), (2027,), (2028,), (None,)], "publication_year bigint")
    assert quality.invalid_ranges(papers, 2027).first()["publication_year"] == 2


def test_infinite_citations_are_out_of_range(spark):
    papers = spark.createDataFrame([(float("inf"),), (float("nan"),), (1.0,), (None,)], "cited_by_count double")
    assert quality.invalid_ranges(papers).first()["cited_by_count"] == 2


def test_wrong_views_fail(spark, layer):
    tables, views = layer
    wrong = {
        **views,
        "overview_kpis": spark.sql("SELECT 999 total_papers, -1 total_citations, 150 open_access_percentage"),
        "author_summary": spark.sql("SELECT 'N1' author_id, 999 paper_count"),
    }
    assert failed(quality.analytics_checks(tables, wrong)) == {
        "analytics.reconciliation",
        "overview_kpis.total_citations.nonnegative",
    }


def test_each_reconciliation_rule(spark, layer):
    tables, views = layer
    more = lambda c: F.col(c) + 1
    for name, change in {
        "publication_trends": lambda v: v.filter("publication_year <> 2016"),
        "open_access_summary": lambda v: v.filter("oa_status <> 'diamond'"),
        "topic_summary": lambda v: v.filter("topic_id <> 'S2'"),
        "author_summary": lambda v: v.withColumn("open_access_percentage", F.lit(100.5)),
        "institution_summary": lambda v: v.withColumn("average_citations", F.lit(float("nan"))),
        "top_papers": lambda v: v.withColumn("citation_rank", more("citation_rank")),
    }.items():
        results = quality.analytics_checks(tables, {**views, name: change(views[name])})
        assert "analytics.reconciliation" in failed(results), name


def test_missing_views_and_tables(spark, layer):
    tables, views = layer
    results = quality.analytics_checks(tables, {k: v for k, v in views.items() if k != "top_papers"})
    assert failed(results) == {"top_papers.queryable", "analytics.reconciliation"}
    no_status = {**tables, "papers": tables["papers"].drop("oa_status")}
    results = quality.analytics_checks(no_status, analytics.build(no_status, 2026))
    assert [r.status for r in results if r.check_name == "open_access_summary.queryable"] == ["WARN"]
    assert failed(results) == set()
    assert len(failed(quality.curated_checks({}))) == 7
    assert "overview_kpis.queryable" in failed(quality.analytics_checks({}, {}))


def test_empty_papers_have_no_percentages(layer):
    tables, _ = layer
    results = quality.curated_checks({n: t.limit(0) for n, t in tables.items()})
    observed = {r.check_name: (r.status, r.observed_value) for r in results if r.layer == "coverage"}
    assert observed["coverage.doi"] == ("WARN", "None")
    assert observed["coverage.publication_years"] == ("WARN", "0")


def test_missing_coverage_columns_count_as_zero(layer):
    tables, _ = layer
    results = quality.curated_checks({**tables, "papers": tables["papers"].select("paper_id", "title")})
    observed = {r.check_name: r.observed_value for r in results if r.layer == "coverage"}
    assert observed["coverage.doi"] == "0.0" and observed["coverage.title"] == "75.0"
    assert observed["coverage.publication_years"] == "0"


# ------------------------------------------------------------ raw gate

CASES = {
    "empty": ("", {}),
    "broken": ("{invalid", {}),
    "no_id": ("{}", {}),
    "wrong_count": ('{"id":"W1"}', {"actual_record_count": 2}),
    "no_source": ('{"id":"W1"}', {"is_complete_extraction": True}),
    "plain": ('{"id":"W1"}', {}),
    "full": (
        '{"id":"W1"}',
        {
            "actual_record_count": 1,
            "records_extracted": 1,
            "source_match_count": 1,
            "requested_max_records": 5,
            "max_records_requested": 5,
            "is_complete_extraction": True,
        },
    ),
    "bool_count": ('{"id":"W1"}', {"records_extracted": True}),
    "float_count": ('{"id":"W1"}', {"records_extracted": 1.0}),
    "low_cap": ('{"id":"W1"}\n{"id":"W2"}', {"requested_max_records": 1}),
    "negative": ('{"id":"W1"}', {"source_match_count": -1, "is_complete_extraction": False}),
    "null_count": ('{"id":"W1"}', {"records_extracted": None}),
    "text_complete": ('{"id":"W1"}', {"is_complete_extraction": "yes"}),
    "bad_cap_complete": (
        '{"id":"W1"}',
        {"source_match_count": 1, "requested_max_records": 0, "is_complete_extraction": True},
    ),
    "bad_sidecar": ('{"id":"W1"}', "{invalid"),
    "list_sidecar": ('{"id":"W1"}', "[]"),
    "tail_sidecar": ('{"id":"W1"}', "{} x"),
}
FAILS = {
    "empty": {"nonempty"},
    "broken": {"identity_json"},
    "no_id": {"identity_json"},
    "wrong_count": {"actual_record_count"},
    "no_source": {"completeness"},
    "bool_count": {"records_extracted"},
    "float_count": {"records_extracted"},
    "low_cap": {"requested_max_records"},
    "negative": {"source_match_count"},
    "text_complete": {"completeness"},
    "bad_cap_complete": {"requested_max_records", "completeness"},
    "bad_sidecar": {"metadata"},
    "list_sidecar": {"metadata"},
    "tail_sidecar": {"metadata"},
}


def test_raw_contract(spark, tmp_path):
    for stem, (text, sidecar) in CASES.items():
        write_extraction(tmp_path, stem, text, sidecar if isinstance(sidecar, str) else json.dumps(sidecar))
    found = files.discover(spark, str(tmp_path))
    assert len(found) == len(CASES)
    listed = spark.createDataFrame([(e.path, True) for e in found], "path string, sidecar boolean")
    lines = works.visible_lines(works.read_lines(spark, [e.path for e in found]))
    counts = rawgate.file_counts(works.parse_works(lines))
    checks = rawgate.raw_checks(listed, counts, files.read_provenance(spark, [e.sidecar for e in found])).collect()
    bad, seen = {}, {}
    for r in checks:
        stem = r["path"].rsplit("/", 1)[-1].removesuffix(".jsonl")
        seen.setdefault(stem, {})[r["check_name"].removeprefix("raw.")] = r["observed_value"]
        if r["status"] == quality.FAIL:
            bad.setdefault(stem, set()).add(r["check_name"].removeprefix("raw."))
    assert bad == FAILS
    assert set(seen["broken"]) == {"identity_json"} and set(seen["plain"]) == {"identity_json", "nonempty"}
    assert seen["full"]["completeness"] == "True" and seen["text_complete"]["completeness"] == "invalid type"
    assert seen["bool_count"]["records_extracted"] == "invalid type"
    assert "records_extracted" not in seen["null_count"]


def test_absent_sidecar_is_a_warning(spark, tmp_path):
    path = write_extraction(tmp_path, "a", [WORKS[0]])
    write_extraction(tmp_path, "b", [WORKS[0]])
    listed = spark.createDataFrame([(f"file:{path}", False)], "path string, sidecar boolean")
    counts = rawgate.file_counts(works.parse_works(works.read_lines(spark, [str(path)])))
    provenance = files.read_provenance(spark, [str(tmp_path / "b.metadata.json")])
    checks = rawgate.raw_checks(listed, counts, provenance)
    assert rows(checks.filter("status <> 'PASS'"), "check_name", "status") == [("raw.metadata", "WARN")]
    assert rawgate.first_failure(checks) is None
