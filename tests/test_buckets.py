"""Layers by bucket, views kept up by retraction, digests of lines, the rank certificate."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows, write_extraction
from paperloom.operators import cells
from paperloom.plans import analytics, curated, incremental, quality
from paperloom.plans.warehouse import WHOLE, Warehouse, bucket_of
from paperloom.sources import files, works
from paperloom.sources.digest import digests
from paperloom.streaming.pickup import watch
from test_incremental import Site

BUCKETS = 4


@pytest.fixture
def site(spark, tmp_path):
    found = Site(spark, tmp_path)
    found.warehouse = Warehouse(spark, found.root, BUCKETS)
    return found


def work(number, citations=1, topics=("T1",), authors=("A1",), year=2020, places=("I1",)):
    return {
        "id": f"W{number}",
        "title": f"Work {number}",
        "publication_year": year,
        "cited_by_count": citations,
        "open_access": {"is_oa": number % 2 == 0, "oa_status": "gold"},
        "topics": [{"id": t, "display_name": f"{t} by {number}"} for t in topics],
        "authorships": [{"author": {"id": a}, "institutions": [{"id": p} for p in places]} for a in authors],
    }


def loaded(site, records, stem, until="analytics"):
    """Load one extraction and build the layers, without the gate and the ledgers of a run."""
    path = write_extraction(site.raw, stem, records)
    lines = works.parse_works(works.visible_lines(works.read_lines(site.spark, [str(path)])))
    batch = lines.filter("problem IS NULL").select("work.*", "path", "part", "block", "place")
    incremental.load_batch(site.warehouse, batch)
    if until != "works":
        incremental.build_curated(site.warehouse)
    if until == "cells":
        incremental.update_cells(site.warehouse)
    if until == "analytics":
        incremental.build_analytics(site.warehouse)


@pytest.fixture
def loads_only(monkeypatch):
    for name in ("build_curated", "build_analytics"):
        monkeypatch.setattr(incremental, name, lambda *_, **__: None)


def folders(site, layer, table):
    store = site.raw.parent / "store" / layer
    return {f"{p.parent.parent.name}/{p.name}" for p in store.glob(f"v=*/{table}/bucket=*")}


def same(one, two):
    columns = sorted(one.columns)
    assert columns == sorted(two.columns)
    return sorted(map(str, one.select(*columns).collect())) == sorted(map(str, two.select(*columns).collect()))


def assert_equals_a_rebuild(site):
    """Every layer kept up from load to load is the one built at once from its works."""
    store = site.warehouse
    built = curated.build_nested(incremental.restrict(store.tables("works")["works"], incremental.known_fields(store)))
    tables = store.tables("curated")
    assert set(built) == set(tables)
    for name, table in built.items():
        assert same(table, tables[name]), name
    for name, table in analytics.all_cells(tables, True).items():
        assert same(table, store.tables("cells")[name]), name
    views = analytics.build(tables, unique_pairs=True)
    kept = store.tables("analytics")
    assert set(views) == set(kept)
    for name, view in views.items():
        assert same(view, kept[name]), name


def test_a_small_load_writes_only_the_buckets_it_touches(site):
    first = [work(k, k % 50, (f"T{k % 7}",), (f"A{k % 900}",)) for k in range(20_000)]
    store = site.warehouse = Warehouse(site.spark, site.root, 16)
    loaded(site, first, "a", "curated")
    old = {layer: store.published(layer) for layer in ("works", "curated", "firsts")}
    before = {name: folders(site, "works" if name == "works" else "curated", name) for name in ("works", "papers", "paper_topics")}
    assert all(len(found) == 16 for found in before.values())

    loaded(site, [work(k, 1000, ("T1",), ("A1",)) for k in (3, 4, 5)], "b", "curated")
    ids = site.spark.createDataFrame([(f"W{k}",) for k in (3, 4, 5)], "id string")
    touched = {r[0] for r in ids.select(bucket_of("id", 16)).collect()}
    for name in before:
        layer = "works" if name == "works" else "curated"
        new = folders(site, layer, name) - before[name]
        assert {int(f.split("=")[-1]) for f in new} == touched, name
        now = store.published(layer)
        shared = {b: now.homes[name, b] for b in range(16) if b not in touched}
        assert shared == {b: old[layer].homes[name, b] for b in shared}
    assert store.tables("works")["works"].count() == 20_000
    assert rows(store.tables("works")["works"].filter("cited_by_count = 1000"), "id") == [("W3",), ("W4",), ("W5",)]
    assert store.read(old["works"])["works"].filter("cited_by_count = 1000").count() == 0
    assert store.read(old["curated"])["papers"].agg(F.sum("cited_by_count")).first()[0] == sum(k % 50 for k in range(20_000))
    topics = store.tables("curated")["topics"].filter("topic_id = 'T1'")
    assert rows(topics, "topic_name") == [("T1 by 1",)]


def test_a_failed_publish_leaves_the_old_version(site):
    loaded(site, [work(k) for k in range(40)], "a")
    before = site.warehouse.published("curated")
    with pytest.raises(quality.QualityError):
        loaded(site, [work(7, -5)], "b", "curated")
    assert site.warehouse.published("curated") == before
    assert site.warehouse.tables("curated")["papers"].filter("cited_by_count < 0").count() == 0
    loaded(site, [work(7, 5)], "c")
    assert rows(site.warehouse.tables("curated")["papers"].filter("paper_id = 'W7'"), "cited_by_count") == [(5,)]
    assert site.kpis()["total_citations"] == 39 + 5


def test_views_follow_changes_without_a_rebuild(site, monkeypatch):
    """Inserts, replaced topics, emptied authorships, other years and labels, unknown values."""
    rng = random.Random(3)
    many = lambda prefix, n: [f"{prefix}{rng.randrange(n)}" for _ in range(rng.randrange(4))]
    loaded(site, [work(k, rng.randrange(9), many("T", 6), many("A", 20), rng.choice([2018, 2019, None])) for k in range(120)], "a", "cells")
    publish, only = site.warehouse.publish, []
    monkeypatch.setattr(site.warehouse, "publish", lambda *a, **k: only.append((a[0], k.get("only"))) or publish(*a, **k))
    loaded(site, [work(k, 50 + k, ["T9"], [], 2021) for k in range(0, 60, 5)], "b", "cells")
    loaded(site, [work(k, None, many("T", 9), many("A", 30), None) for k in range(100, 140)], "c", "cells")
    loaded(site, [work(0, 3, [], ["A1", "A1"], 2018, places=())], "d")
    assert all(chosen is not None for layer, chosen in only if layer == "cells")
    assert_equals_a_rebuild(site)


def test_checks_of_changed_buckets_add_up(site, monkeypatch):
    """After three loads the merged checks are those of the whole layer, at a part of its rows."""
    whole, seen = incremental._bucket_counters, []
    monkeypatch.setattr(incremental, "_bucket_counters", lambda tables: seen.append(tables["papers"].count()) or whole(tables))
    loaded(site, [work(k, k, (f"T{k % 5}",), (f"A{k % 40}",), 2010 + k % 3) for k in range(400)], "a", "curated")
    loaded(site, [work(3, None, ("T1", "T8"), (), None)], "b", "curated")
    loaded(site, [{**work(9, 4, ("T1", "T8"), ()), "doi": None}, work(401, 2, ("T77",), ("A77",), None)], "c", "curated")
    loaded(site, [work(12, 1, (), ("A77",), 2012, ())], "d", "curated")
    assert seen[0] == 400 and max(seen[1:]) < 310
    latest = site.warehouse.entries("data_quality_results").filter("layer IN ('curated', 'coverage')")
    last = latest.orderBy(F.col("sequence").desc()).first()["execution_id"]
    recorded = latest.filter(F.col("execution_id") == last)
    found = {(r["check_name"], r["status"], r["observed_value"], r["details"]) for r in recorded.collect()}
    full = quality.curated_checks(site.warehouse.tables("curated"))
    assert found == {(r.check_name, r.status, r.observed_value, r.details) for r in full}
    assert len(full) == 36


def test_merged_checks_find_faults_in_changed_buckets_and_lost_entities(site):
    loaded(site, [work(k) for k in range(60)], "a", "curated")
    store = site.warehouse
    before, firsts = store.published("curated"), store.tables("firsts")
    only = {0, 1}
    tables = store.tables("curated")
    here = bucket_of("paper_id", BUCKETS).isin(only)
    sick = {
        "papers": tables["papers"].filter(here).unionAll(tables["papers"].filter(here).limit(1)),
        "paper_topics": tables["paper_topics"].filter(here).withColumn("topic_id", F.lit("T404")),
        "paper_authors": tables["paper_authors"].filter(here),
        "paper_institutions": tables["paper_institutions"].filter(here),
        "topics": tables["topics"],
        "authors": tables["authors"].filter("false"),
        "institutions": tables["institutions"],
    }
    version = store.stage("curated", sick, only)
    staged = store.read(version)
    results = incremental._checked_curated(store, only, firsts)(version, staged)
    bad = {r.check_name for r in results if r.status == quality.FAIL}
    assert bad == {"papers.unique", "paper_topics.topics.references", "paper_authors.authors.references"}
    assert bad == {r.check_name for r in quality.curated_checks(staged) if r.status == quality.FAIL}
    assert store.published("curated") == before


def test_a_new_field_rebuilds_what_depends_on_it(site):
    plain = [{"id": f"W{k}", "topics": [{"id": f"T{k % 3}"}]} for k in range(30)]
    loaded(site, plain, "a", "cells")
    assert "cited_by_count" not in site.warehouse.tables("curated")["papers"].columns
    loaded(site, [work(2, 8)], "b")
    assert "total_citations" in site.warehouse.tables("analytics")["topic_summary"].columns
    assert_equals_a_rebuild(site)


def test_old_folders_go_when_no_kept_version_names_them(site):
    loaded(site, [work(k) for k in range(200)], "a", "curated")
    for k in range(3):
        loaded(site, [work(k, 5 + k)], f"b{k}", "curated")
    for layer, table in (("works", "works"), ("curated", "papers"), ("curated", "paper_topics")):
        site.warehouse.expire(layer, 1)
        current = site.warehouse.published(layer)
        named = {f"v={home}/bucket={b}" for (t, b), home in current.homes.items() if t == table and b != WHOLE}
        assert folders(site, layer, table) == named and len(named) == BUCKETS
    assert site.warehouse.tables("curated")["papers"].count() == 200


def test_a_store_without_buckets_is_taken_over(site):
    """A layer published by an earlier release has one folder a table."""
    store = site.warehouse
    records = site.spark.createDataFrame([("W1", 4), ("W2", 5)], "id string, cited_by_count long")
    full = records.select(*[
        (F.col(n) if n in records.columns else F.lit(None)).cast(t).alias(n) for n, t in incremental.WORK_FIELDS.items()
    ])
    full.write.parquet(f"{store.root}/works/v=1/works")
    text = full.schema.json()
    row = site.spark.range(1).select(
        F.lit("works").alias("layer"), F.lit(1).cast("long").alias("version"),
        F.create_map(F.lit("works"), F.lit(text)).alias("tables"), F.lit(1).cast("long").alias("sequence"),
    )
    row.write.parquet(f"{store.root}/ops/layer_versions")
    loaded(site, [work(2, 9)], "a", "works")
    assert rows(store.tables("works")["works"], "id", "cited_by_count") == [("W1", 4), ("W2", 9)]


def test_cells_that_come_to_nothing_are_gone(spark):
    rows_ = spark.createDataFrame([("T1", 3, True), ("T1", 3, False), ("T2", None, None)], "topic string, c int, oa boolean")
    whole = cells.counted(rows_, ["topic", "c"], "oa", "c")
    assert rows(whole) == [("T1", 3, 2, 1, 2, 6), ("T2", None, 1, 0, 0, 0)]
    assert cells.changes(whole, whole).count() == 0
    assert rows(cells.added(whole, cells.changes(whole.filter("topic = 'T2'"), whole.limit(0)))) == [("T1", 3, 2, 1, 2, 6)]


# ------------------------------------------------------------ digests


def digest_of(spark, *paths):
    lines = works.visible_lines(works.read_lines(spark, [str(p) for p in paths])).drop("line")
    return [r["digest"] for r in digests(lines).orderBy("path").collect()]


def test_a_digest_does_not_depend_on_files_and_splits(spark, tmp_path):
    lines = [json.dumps({"id": f"W{k}", "title": "x" * (k % 90)}) for k in range(4000)]
    one = write_extraction(tmp_path, "one", lines)
    parts = tmp_path / "parts.jsonl"
    parts.mkdir()
    for k in range(5):
        (parts / f"part-{k}.json").write_text("\n\n".join(lines[k * 800 : (k + 1) * 800]) + "\n")
    first = digest_of(spark, one)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
        assert digest_of(spark, one) == first == digest_of(spark, parts)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    for name, other in (
        ("swapped", [lines[1], lines[0], *lines[2:]]),
        ("turned", [*lines[1:], lines[0]]),
        ("shorter", lines[:-1]),
        ("repeated", [*lines, lines[-1]]),
        ("changed", [*lines[:9], lines[9] + " ", *lines[10:]]),
    ):
        assert digest_of(spark, write_extraction(tmp_path, name, other)) != first, name


def test_a_touched_file_with_the_same_lines_is_not_loaded_again(site):
    path = write_extraction(site.raw, "a", [work(1)])
    site.load()
    path.write_text(path.read_text() + "\n")
    site.load()
    site.load()
    assert [r[:2] for r in site.runs()] == [("success", 1), ("success", 0), ("success", 0)]
    assert incremental.pending_files(site.warehouse, str(site.raw)).count() == 0


def test_no_file_is_read_as_bytes_by_a_load(site, monkeypatch):
    monkeypatch.setattr(incremental.files, "fingerprint", lambda *_: 1 / 0)
    write_extraction(site.raw, "a", [work(1)])
    site.load()
    assert site.works().count() == 1


def test_files_behind_a_refused_one_are_parsed_once(site, monkeypatch):
    write_extraction(site.raw, "a", "broken")
    for stem in "bcd":
        write_extraction(site.raw, stem, [work(ord(stem))])
    with pytest.raises(quality.QualityError):
        site.load()
    read, parsed = incremental.stage_batch, []

    def noting(spark, paths, folder):
        parsed.extend(p.rsplit("/", 1)[-1] for p in paths)
        return read(spark, paths, folder)

    monkeypatch.setattr(incremental, "stage_batch", noting)
    write_extraction(site.raw, "a", [work(1)])
    write_extraction(site.raw, "c", [work(ord("c"), 77)])
    site.load()
    assert sorted(parsed) == ["a.jsonl", "c.jsonl"]
    assert rows(site.works(), "id", "cited_by_count") == [("W1", 1), ("W100", 1), ("W98", 1), ("W99", 77)]
    parsed.clear()
    site.load(rehash=True)
    assert sorted(parsed) == ["a.jsonl", "b.jsonl", "c.jsonl", "d.jsonl"] and site.runs()[-1] == ("success", 0, None)


# ------------------------------------------------------------ discovery


def test_folders_are_listed_by_one_job(spark, tmp_path):
    """Many folder extractions, an empty one and one of empty parts; a part rewritten in place shows."""
    for k in range(40):
        parts = tmp_path / f"e{k:02}.jsonl"
        parts.mkdir()
        for n in range(k % 3):
            (parts / f"part-{n}").write_text("x" * k)
        (tmp_path / f"e{k:02}.metadata.json").write_text("{}")
    (tmp_path / "e03.jsonl" / "part-0").write_text("")
    (tmp_path / "single.jsonl").write_text("abc")
    (tmp_path / "single.metadata.json").write_text("{}")
    found = {e.path.rsplit("/", 1)[-1]: e for e in files.discover(spark, str(tmp_path))}
    assert len(found) == 41 and found["single.jsonl"].size == 3
    assert {name: e.size for name, e in found.items() if name.startswith("e")} == {
        f"e{k:02}.jsonl": k * (k % 3) for k in range(40)
    }
    part = tmp_path / "e05.jsonl" / "part-1"
    os.utime(part, (4_000_000_000, 4_000_000_000))
    assert files.extractions(spark, [str(tmp_path / "e05.jsonl")])[0].modified == 4_000_000_000_000


# ------------------------------------------------------------ pickup


def test_pickup_lists_only_what_arrived(site, monkeypatch, loads_only):
    for k in range(200):
        write_extraction(site.raw, f"old{k}", [work(k)])
    start = lambda: watch(site.spark, site.root, str(site.raw), site.root + "-stream", skip_charts=True)
    site.load()
    start().awaitTermination()
    monkeypatch.setattr(incremental.files, "discover", lambda *_: 1 / 0)
    looked, described = [], incremental.files._described
    names = lambda entries: [e.getPath().getName() for e in entries]
    monkeypatch.setattr(incremental.files, "_described", lambda s, entries: looked.extend(names(entries)) or described(s, entries))
    write_extraction(site.raw, "new", [work(7, 70)])
    start().awaitTermination()
    assert set(looked) == {"new.jsonl"}
    assert rows(site.works().filter("id = 'W7'"), "cited_by_count") == [(70,)]


def test_a_replayed_micro_batch_does_nothing(site, loads_only):
    write_extraction(site.raw, "a", [work(1)])
    checkpoint = site.root + "-stream"
    watch(site.spark, site.root, str(site.raw), checkpoint, skip_charts=True).awaitTermination()
    done = site.warehouse.entries("stream_batches").collect()
    assert [(r["checkpoint"], r["batch_id"]) for r in done] == [(checkpoint, 0)]
    for name in ("0", ".0.crc"):
        (site.raw.parent / "store-stream" / "commits" / name).unlink()
    write_extraction(site.raw, "a", [work(1, 99)])
    watch(site.spark, site.root, str(site.raw), checkpoint, skip_charts=True).awaitTermination()
    assert len(site.runs()) == 1


# ------------------------------------------------------------ ledgers


def test_ledgers_stay_small_and_lose_nothing(site):
    store = site.warehouse
    for k in range(30):
        store.append("pipeline_runs", [(f"r{k % 12}", None, None, f"s{k}", k, 0, None, None)])
        store.append("stream_batches", [("c", k, f"r{k}")])
        for name in ("pipeline_runs", "stream_batches"):
            store.compact(name, after=5)
    for name in ("pipeline_runs", "stream_batches"):
        _, base, logged = store._ledger_files(name)
        assert len(base) == 1 and len(logged) <= 5
        assert len(store._listed(f"{store.root}/ops/{name}/log/e=*")[1]) <= 12
        assert len(store._listed(f"{store.root}/ops/{name}/snapshots/s=*")[1]) <= 2
    latest = {r["run_id"]: r["status"] for r in store.current("pipeline_runs").collect()}
    assert latest == {f"r{k % 12}": f"s{k}" for k in range(18, 30)}
    assert sorted(r["batch_id"] for r in store.entries("stream_batches").collect()) == list(range(30))


def test_a_snapshot_cut_short_does_not_count(site):
    store = site.warehouse
    for k in range(12):
        store.append("stream_batches", [("c", k, "r")])
    folder = site.raw.parent / "store" / "ops" / "stream_batches" / "snapshots" / "s=99999999999999999999" / "_temporary"
    folder.mkdir(parents=True)
    assert store.entries("stream_batches").count() == 12
    store.compact("stream_batches", after=5)
    assert sorted(r["batch_id"] for r in store.entries("stream_batches").collect()) == list(range(12))
    store.append("stream_batches", [("c", 12, "r")])
    assert store.entries("stream_batches").count() == 13


# ------------------------------------------------------------ rank certificate


def ranked(spark, entries):
    return spark.createDataFrame(entries, "paper_id string, cited_by_count long, citation_rank long")


def faults(spark, entries, block=4):
    return rows(quality.rank_faults(ranked(spark, entries), block))


def test_the_certificate_finds_every_kind_of_fault(spark):
    good = [(f"P{k:02}", 40 - k // 2 if k < 20 else None, k + 1) for k in range(24)]
    for block in (1, 4, 5, 100):
        assert faults(spark, good, block) == []
        change = lambda k, rank: [*good[:k], (*good[k][:2], rank), *good[k + 1 :]]  # noqa: E731, B023
        assert ("gap" in {f for *_, f in faults(spark, change(5, None), block)})
        assert faults(spark, good[1:], block) == [(0, 2, "gap")]
        assert faults(spark, [*good[:7], *good[8:]], block) == [(7, 9, "gap")]
        assert {f for *_, f in faults(spark, change(9, 9), block)} == {"repeated", "gap"}
        swapped = [*good[:11], (*good[11][:2], 13), (*good[12][:2], 12), *good[13:]]
        assert faults(spark, swapped, block) == [(12, 13, "order")]
    assert faults(spark, []) == []


def test_the_gate_ranks_nothing_again(spark):
    frame = ranked(spark, [("a", 3, 1), ("b", 2, 2)])
    plan = quality.rank_faults(frame)._jdf.queryExecution().executedPlan().toString()
    assert "InMemory" not in plan and "rangepartitioning" not in plan
    views = {"top_papers": frame, "overview_kpis": spark.range(1).selectExpr("2L AS total_papers")}
    assert "row_number" not in plan and views["top_papers"].count() == 2
