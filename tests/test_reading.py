import hashlib

import pytest

from paperloom.model import WORK_DDL
from paperloom.sources import files, works

from conftest import rows, write_extraction


def parsed(spark, *lines):
    frame = spark.createDataFrame([(i, line) for i, line in enumerate(lines)], "n int, line string")
    return {r["n"]: r for r in works.parse_works(frame).collect()}


def test_valid_records_keep_nested_structure(spark):
    found = parsed(spark, '{"id":"W1","title":"Über Maß","topics":null}', '{"id":"W2","topics":[{"id":"T1","score":1}]}')
    assert found[0]["problem"] is None and found[0]["work"]["title"] == "Über Maß"
    assert found[0]["work"]["topics"] is None
    assert found[1]["work"]["topics"][0]["score"] == 1.0


@pytest.mark.parametrize(
    "line, problem",
    [
        ("not json", "not one JSON value"),
        ('{"id":"W1"} trailing', "not one JSON value"),
        ('{"id":"W1"}{"id":"W2"}', "not one JSON value"),
        ('{"id":"W1"},{"id":"W2"}', "not one JSON value"),
        ('{"id":"W1"}] x', "not one JSON value"),
        ('{"id":"W1"}]', "not one JSON value"),
        ('{"id":"W1",}', "not one JSON value"),
        ("[]", "not an object"),
        ('[{"id":"W1"}]', "not an object"),
        ('"text"', "not an object"),
        ("7", "not an object"),
        ("{}", "id is no visible text"),
        ('{"id":null}', "id is no visible text"),
        ('{"id":" "}', "id is no visible text"),
        ('{"id":"\\u00a0\\u2003"}', "id is no visible text"),
        ('{"id":1}', "id is no visible text"),
        ('{"id":{"a":1}}', "id is no visible text"),
    ],
)
def test_invalid_records(spark, line, problem):
    row = parsed(spark, line)[0]
    assert row["problem"] == problem and row["work"] is None


def test_first_problem_has_file_and_line_but_no_content(spark, tmp_path):
    write_extraction(tmp_path, "a", ["", '{"id":"W1"}', "  ", "not json secret", "bad"])
    write_extraction(tmp_path, "b", ['{"id":"W2"}'])
    valid, problems = works.read_works(spark, [str(tmp_path / "a.jsonl"), str(tmp_path / "b.jsonl")])
    assert rows(valid, "id") == [("W1",), ("W2",)]
    found = problems.collect()
    assert len(found) == 1 and found[0]["line_number"] == 4
    assert found[0]["part"].endswith("a.jsonl") and "secret" not in str(found[0])


def test_line_numbers_span_blocks(spark, tmp_path):
    lines = ['{"id":"W%d","title":"%s"}' % (i, "x" * 60) for i in range(400)]
    lines[277] = "{broken"
    write_extraction(tmp_path, "a", lines)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        assert works.read_lines(spark, [str(tmp_path / "a.jsonl")]).select("block").distinct().count() > 3
        found = works.first_problems(spark, [str(tmp_path / "a.jsonl")]).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [r["line_number"] for r in found] == [278]


def test_discovery_needs_the_sidecar(spark, tmp_path):
    path = write_extraction(tmp_path, "a", [{"id": "W1"}])
    write_extraction(tmp_path, "unfinished", [{"id": "W2"}], sidecar=None)
    (tmp_path / "bad.json").write_text("{}")
    (tmp_path / "b.jsonl.inprogress").write_text("{}")
    (tmp_path / "lonely.metadata.json").write_text("{}")
    found = files.discover(spark, str(tmp_path))
    assert [e.path for e in found] == [f"file:{path}"]
    assert found[0].size == path.stat().st_size
    assert files.resolve_input(spark, str(tmp_path)).endswith("/a.jsonl")


def test_discovery_of_an_empty_folder(spark, tmp_path):
    assert files.discover(spark, str(tmp_path)) == []
    with pytest.raises(FileNotFoundError):
        files.resolve_input(spark, str(tmp_path))
    with pytest.raises(ValueError):
        files.resolve_input(spark, str(tmp_path), str(tmp_path / "a.metadata.json"))
    with pytest.raises(FileNotFoundError):
        files.resolve_input(spark, str(tmp_path), str(tmp_path / "absent.jsonl"))


def test_latest_input_is_newest_then_by_name(spark, tmp_path):
    import os

    for stem, stamp in (("a", 2000), ("b", 3000), ("c", 3000)):
        os.utime(write_extraction(tmp_path, stem, [{"id": stem}]), (stamp, stamp))
    assert files.latest_input(spark, str(tmp_path)).path.endswith("/c.jsonl")


def test_fingerprints(spark, tmp_path):
    path = write_extraction(tmp_path, "a", [{"id": "W1"}])
    digest = lambda: files.fingerprint(spark, [str(path)]).first()["file_hash"]
    first = digest()
    assert first == hashlib.sha256(path.read_bytes()).hexdigest()
    path.write_text('{"id":"W9"}')
    assert digest() != first


def test_fingerprint_of_a_folder_follows_its_parts(spark, tmp_path):
    folder = tmp_path / "x.jsonl"
    folder.mkdir()
    (folder / "part-0").write_text('{"id":"W1"}')
    (folder / "part-1").write_text('{"id":"W2"}')
    (tmp_path / "x.metadata.json").write_text("{}")
    found = files.discover(spark, str(tmp_path))
    assert len(found) == 1 and found[0].path.endswith("/x.jsonl") and found[0].size == 22
    parts = "".join(hashlib.sha256((folder / p).read_bytes()).hexdigest() for p in ("part-0", "part-1"))
    digest = files.fingerprint(spark, [str(folder)]).first()
    assert digest["file_hash"] == hashlib.sha256(parts.encode()).hexdigest()
    assert works.read_works(spark, [str(folder)])[0].count() == 2


def test_file_keys():
    assert files.file_key("file:///data/raw/a.jsonl", "/data") == "raw/a.jsonl"
    assert files.file_key("file:/else/b.jsonl", "/data") == "/else/b.jsonl"


def test_paths_with_spaces_and_signs(spark, tmp_path):
    path = write_extraction(tmp_path, "a b+c%20é", [{"id": "W1"}])
    found = files.discover(spark, str(tmp_path))[0].path
    valid, _ = works.read_works(spark, [found])
    assert rows(valid, "path") == [(found,)] and found == f"file:{path}"
    assert files.fingerprint(spark, [found]).first()["path"] == found


def test_contract_names_match(spark):
    assert spark.createDataFrame([], WORK_DDL).columns[0] == "id"


def test_every_line_is_parsed_once(spark, tmp_path):
    path = write_extraction(tmp_path, "a", [{"id": "W1"}])
    rows_of = works.parse_works(works.visible_lines(works.read_lines(spark, [str(path)])))
    plan = rows_of._jdf.queryExecution().executedPlan().toString()
    assert plan.count("parseJson") == 1
