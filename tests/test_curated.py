import json

import pytest

from paperloom.model import TABLE_KEYS, WORK_DDL
from paperloom.plans import curated, quality
from paperloom.sources.relations import LineageError, Relations, attach_lineage, enforce_lineage, normalize

from conftest import WORKS, rows

WORK_TYPE = "id string, _row_id string, title string, publication_year bigint, primary_topic struct<id string>"
TOPIC_TYPE = "id string, _parent_id string, display_name string, score double"
AUTHOR_TYPE = "author struct<id string, display_name string>, _row_id string, _parent_id string"
INSTITUTION_TYPE = "id string, _parent_id string, display_name string"


def relations(spark, **replaced):
    """Four relations linked by row ids, as an external normalizer delivers them."""
    data = {
        "works": ([("X1", "u1", "Delta", 2012, ("Y1",)), ("X2", "u2", None, 2013, None)], WORK_TYPE),
        "topics": (
            [("Y1", "u1", "River", 0.25), ("Y2", "u1", "Sea", 0.1), ("Y1", "u1", "River", 0.5), ("Y1", "u2", "River", 0.75)],
            TOPIC_TYPE,
        ),
        "authorships": (
            [(("Z1", "Kim"), "b1", "u1"), (("Z2", "Lee"), "b2", "u1"), (("Z1", "Kim"), "b3", "u2")],
            AUTHOR_TYPE,
        ),
        "institutions": ([("V1", "b1", "College"), ("V1", "b2", "College"), ("V2", "b3", "Lab")], INSTITUTION_TYPE),
    }
    data |= replaced
    return Relations(**{k: v and spark.createDataFrame(*v) for k, v in data.items()})


def build(spark, **replaced):
    return curated.build(attach_lineage(enforce_lineage(relations(spark, **replaced))))


def sizes(tables):
    return {name: table.count() for name, table in tables.items()}


EXPECTED = dict(
    papers=2, topics=2, paper_topics=3, authors=2, paper_authors=3, institutions=2, paper_institutions=2
)


def test_counts_scores_and_repeatability(spark):
    first, second = build(spark), build(spark)
    assert sizes(first) == EXPECTED
    assert rows(first["paper_topics"]) == [
        ("X1", "Y1", 0.5, True), ("X1", "Y2", 0.1, False), ("X2", "Y1", 0.75, None),
    ]
    for name in TABLE_KEYS:
        assert first[name].exceptAll(second[name]).isEmpty()
        assert second[name].exceptAll(first[name]).isEmpty()
        assert not [c for c in first[name].columns if c.startswith("_")]


def test_optional_columns_follow_the_sources(spark):
    tables = build(spark)
    assert tables["papers"].columns == ["paper_id", "title", "publication_year", "primary_topic_id"]
    assert tables["topics"].columns == ["topic_id", "topic_name"]
    assert tables["paper_authors"].columns == ["paper_id", "author_id"]
    assert tables["institutions"].columns == ["institution_id", "institution_name"]


def test_institution_survives_an_unknown_author(spark):
    tables = build(
        spark,
        authorships=([("b1", "u1"), ("b2", "u1"), ("b3", "u2")], "_row_id string, _parent_id string"),
    )
    assert sizes(tables) == EXPECTED | dict(authors=0, paper_authors=0)
    assert tables["authors"].columns == ["author_id"]


def test_absent_children_give_empty_tables(spark):
    tables = build(spark, topics=None, authorships=None, institutions=None)
    assert sizes(tables) == {name: 2 if name == "papers" else 0 for name in TABLE_KEYS}
    assert all(set(keys) <= set(tables[name].columns) for name, keys in TABLE_KEYS.items())


def test_blank_and_missing_ids_are_left_out(spark):
    topics = [("Y1", "u1", "River", 0.5), (" ", "u1", "Blank", 0.6), (None, "u2", "None", 0.4)]
    tables = build(spark, topics=(topics, TOPIC_TYPE))
    assert rows(tables["paper_topics"], "paper_id", "topic_id") == [("X1", "Y1")]


def test_orphans_and_missing_lineage_are_refused(spark):
    for name, frame in (
        ("topics", ([("Y1", "u9", "River", 0.5)], TOPIC_TYPE)),
        ("topics", ([("Y1", None, "River", 0.5)], TOPIC_TYPE)),
        ("authorships", ([(("Z1", "Kim"), "b1", "u9")], AUTHOR_TYPE)),
        ("institutions", ([("V1", "b9", "Lab")], INSTITUTION_TYPE)),
        ("topics", ([("Y1",)], "id string")),
    ):
        with pytest.raises(LineageError):
            build(spark, **{name: frame})


def test_duplicate_works_stay_for_the_check_to_find(spark):
    twice = [("X1", "u1", "Delta", 2012, None), ("X1", "u2", "Delta", 2012, None)]
    tables = build(spark, works=(twice, WORK_TYPE), topics=None, authorships=None, institutions=None)
    failed = {r.check_name for r in quality.curated_checks(tables) if r.status == quality.FAIL}
    assert failed == {"papers.unique"}


def test_representative_comes_from_the_earliest_work(spark):
    topics = [("Y1", "u2", "Later", 0.1), ("Y1", "u1", "B", 0.2), ("Y1", "u1", "A", 0.3)]
    tables = build(spark, topics=(topics, TOPIC_TYPE))
    assert rows(tables["topics"]) == [("Y1", "A")]


# ------------------------------------------------------------ nested works


def nested(spark, records=WORKS):
    lines = spark.createDataFrame([(json.dumps(r),) for r in records], "line string")
    return lines.selectExpr(f"from_json(line, '{WORK_DDL}') AS w").select("w.*")


MESSY = [
    {
        "id": "W1",
        "primary_topic": {"id": "T2"},
        "topics": [
            {"id": "T2", "score": 0.1},
            {"id": "T1", "display_name": "n"},
            {"id": "T2", "score": 0.7, "display_name": "late"},
            {"id": " ", "score": 1.0},
            {"id": None},
        ],
        "authorships": [
            {"author": {"id": "A2"}, "author_position": "first", "is_corresponding": True},
            {"author": None, "institutions": [{"id": "I2"}, {"id": "I1"}]},
            {"author": {"id": "A1"}, "author_position": "middle", "institutions": None},
            {"author": {"id": "A2"}, "author_position": "last", "institutions": [{"id": "I2"}, {"id": ""}]},
        ],
    },
    {"id": "W0", "topics": [{"id": "T2", "score": 0.0, "display_name": "early"}], "authorships": []},
    {"id": "W5", "topics": None, "authorships": [{"author": {"id": "A1", "display_name": "x"}}]},
    *[
        {"id": f"V{i}", "topics": [{"id": f"T{j % 5}", "score": (i * j % 7) / 7} for j in range(i)]}
        for i in range(12)
    ],
]


@pytest.mark.parametrize("records", [WORKS, MESSY])
def test_nested_route_equals_the_relational_one(spark, records):
    works = nested(spark, records)
    relational, direct = curated.build(normalize(works)), curated.build_nested(works)
    for name in TABLE_KEYS:
        assert relational[name].columns == direct[name].columns
        assert rows(relational[name]) == rows(direct[name]), name


def test_nested_details(spark):
    tables = curated.build_nested(nested(spark, MESSY))
    pick = lambda name, key: [r for r in rows(tables[name]) if r[0] == key]
    assert pick("paper_topics", "W1") == [("W1", "T1", None, False), ("W1", "T2", 0.7, True)]
    assert pick("paper_authors", "W1") == [("W1", "A1", "middle", None), ("W1", "A2", "first", True)]
    assert pick("paper_institutions", "W1") == [("W1", "I1"), ("W1", "I2")]
    # V10 is the earliest work, in string order, that carries T2; it gives no label.
    assert ("T2", None) in rows(tables["topics"], "topic_id", "topic_name")


def test_nested_bridges_need_no_shuffle(spark):
    tables = curated.build_nested(nested(spark))
    for name in ("paper_topics", "paper_authors", "paper_institutions"):
        assert "Exchange" not in tables[name]._jdf.queryExecution().executedPlan().toString()
