"""Every registered query against its SQL on the smallest tables, and plan rules."""

import pytest

import __spark_entry__ as entry
import compare
from paperloom import registry

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.connect(FOLDER)


def test_every_query_has_its_sql():
    from star_oracle import ORACLE

    assert set(registry.queries()) == set(ORACLE) == set(registry.BUILDERS)
    assert set(registry.queries()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(registry.BUILDERS))
def test_query_equals_sql(spark, con, name):
    same, ours, theirs = compare.compare(spark, con, FOLDER, name)
    assert same, (ours[0], theirs[0], ours[1][:3], theirs[1][:3])


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["topic_summary", "curated_topics", "papers_combined", "coverage"])
def test_plans_stay_in_the_jvm(spark, name):
    frame = entry.queries()[name](spark, FOLDER)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
