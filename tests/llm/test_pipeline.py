import corpus_pipeline
from brute import components, shingles, without_windows, words
from fixtures import PROSE, awkward, awkward_rows, nothing  # noqa: F401
from paperloom.llm.queries import ORACLE, QUERIES
from paperloom.llm.runtime import written

PATH = "/root/testdata/sf0.001"


def test_stages_on_their_own_input(spark):
    docs = spark.read.parquet(f"{PATH}/documents.parquet")
    columns, before = docs.columns, None
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, written(stage(spark, docs, PATH))
        old = {r["doc_id"]: r["text"] for r in before.collect()}
        if name == "best-fit packing":
            sizes = {}
            for r in docs.collect():
                sizes[r["doc_id"]] = sizes.get(r["doc_id"], 0) + r["n_words"]
            assert sizes == {i: len(words(t)) for i, t in old.items()}
            continue
        assert docs.columns == columns and docs.schema == before.schema
        new = {r["doc_id"]: r["text"] for r in docs.collect()}
        assert all(r["n_chars"] == len(r["text"]) for r in docs.collect())
        if name == "minhash near-dedup":
            wanted = components(list(old.items()), 5, 80)
            assert set(new) == {i for i, (_, root) in wanted.items() if i == root}
            assert all(shingles(old[i], 5) or i in new for i in old)
        elif name == "substring dedup":
            rows = list(old.items())
            assert {i: words(t) for i, t in new.items()} == {
                i: kept for (i, _), (_, kept) in zip(rows, without_windows(rows, 35))
            }
        elif name == "line dedup":
            assert set(new) == set(old)
        else:
            quality = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{PATH}/labels.parquet").collect()}
            wrong = [i for i in old if i in quality and (i in new) != (quality[i] == 1)]
            assert len(wrong) <= 0.05 * len(quality) and all(new[i] == old[i] for i in new)


def test_line_stage_leaves_one_whole_text_of_many_copies(spark):
    text = "\n".join(f"{PROSE} line {k}" for k in range(5))
    rows = [(20 - k, text, "en", "a", len(text)) for k in range(12)] + [(50, PROSE, "en", "a", len(PROSE))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = written(corpus_pipeline.line_dedup(spark, docs, PATH))
    left = {r["doc_id"]: r["text"] for r in corpus_pipeline.minhash_near_dedup(spark, kept, PATH).collect() if r["text"]}
    assert left == {9: text, 50: PROSE}


def test_run_places_every_kept_document(spark):
    got = corpus_pipeline.run(spark, PATH)
    assert got.columns == ["doc_id", "piece", "first_word", "n_words", "bin_id", "bin_offset"]
    assert got.count() > 100


def test_stages_take_awkward_and_empty_tables(spark, awkward, nothing):
    for frame in (awkward, nothing):
        docs = written(frame.selectExpr("*", "cast(length(text) as long) as n_chars"))
        for _, stage in corpus_pipeline.STAGES:
            docs = written(stage(spark, docs, PATH))
        assert docs.columns[0] == "doc_id"
        assert (docs.count() > 0) == (frame is awkward)
    assert len(awkward_rows()) == 15


def test_names():
    import __spark_entry__ as entry

    assert [next(n for n in QUERIES if n.startswith(f"op{k}_")) for k in range(1, 11)]
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(ORACLE) <= set(QUERIES)
