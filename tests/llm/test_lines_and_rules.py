import random

import pytest
from brute import SPACES, folded, measures, sha, without_lines
from fixtures import awkward, awkward_rows, nothing, small  # noqa: F401
from paperloom.llm import linededup, rules
from paperloom.llm.queries import QUERIES
from pyspark.sql import functions as F


def digest(frame, least):
    marked = linededup.with_bitmaps(frame, linededup.keep_bitmaps(frame, min_documents=least))
    out = []
    for r in marked.collect():
        n, kept = linededup.surviving_lines(r["text"], r["_pl_keep"])
        out.append((r["doc_id"] if r["doc_id"] is not None else -1, n, kept))
    return sorted(out)


def brute(rows, least):
    return sorted((i if i is not None else -1, n, kept) for (i, _), (n, kept) in zip(rows, without_lines(rows, least)))


@pytest.mark.parametrize("partitions,least", [(1, 2), (2, 3), (13, 3), (40, 10)])
def test_hot_lines_split_over_partitions(spark, partitions, least):
    """A line of most documents, and lines just under and at the limit, at every split."""
    rng = random.Random(partitions)
    rows = []
    for i in range(150):
        lines = [f"own {i}"] + [f"line {rng.randrange(40)}" for _ in range(rng.randrange(8))]
        if rng.random() < 0.7:
            lines.insert(rng.randrange(len(lines)), rng.choice([" The common line", "the COMMON line\t"]))
        rows.append((i, "\n".join(lines)))
    rows += [(200 + k, "edge line") for k in range(least)] + [(300 + k, "low line") for k in range(least - 1)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        assert digest(frame, least) == brute(rows, least)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_line_query_equals_brute_force(spark, small):
    rows = [(r["doc_id"], r["text"]) for r in small.collect()]
    expected = {i: (n, n - len(k), sha("\n".join(k))) for (i, _), (n, k) in zip(rows, without_lines(rows, 10))}
    got = QUERIES["op7_line_dedup"](spark, "/root/testdata/sf0.001").collect()
    assert {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["kept_sha256"]) for r in got} == expected


def test_lines_of_awkward_rows(awkward, nothing):
    rows = [(i, t) for i, t, *_ in awkward_rows()]
    assert digest(awkward, 3) == brute(rows, 3)
    got = linededup.deduped(awkward, min_documents=3)
    assert got.columns == awkward.columns and got.count() == len(rows)
    assert linededup.deduped(nothing).count() == 0


def test_measures_equal_brute_force(awkward, small):
    for frame in (awkward, small):
        for r in rules.counted(frame, carried=("text",)).collect():
            assert tuple(r[c] for c in rules.COUNTS) == measures(r["text"])


def test_names_of_the_operator_itself_in_the_input(spark):
    from paperloom.llm import neardup, substrings

    names = ["_pl_id", "_pl_text", "_pl_keep", "_PL_SPANS", "_pl_gone"]
    docs = spark.range(12).selectExpr("id AS doc_id", "concat('same line\nown ', id) AS text", *[f"'{n}' AS {n}" for n in names])
    for got in (linededup.deduped(docs), substrings.without_repeats(docs), neardup.representatives(docs)):
        assert got.columns == docs.columns and got.count() == 12
        assert all(r[n] == n for r in got.collect() for n in names)
    assert {r["text"] for r in linededup.deduped(docs).collect()} == {f"own {k}" for k in range(12)}


def test_rules_on_awkward_rows(awkward, nothing):
    got = rules.rules(awkward)
    assert got.count() == len(awkward_rows())
    for r in got.collect():
        failed = r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]
        assert r["base_failed"] == failed and not (failed and r["kept"])
    assert rules.rules(nothing).count() == 0


def test_merged_sketches_equal_the_sketch_of_all(spark):
    docs = spark.range(2000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("source"),
        F.lit("en").alias("lang"),
        (100 + F.col("id") % 90).alias("n_words"),
        (500 + F.col("id") % 77).alias("word_chars"),
        (F.col("id") % 5).alias("n_symbols"),
        F.lit(0).cast("long").alias("n_dup_lines"),
        F.lit(0).cast("long").alias("n_repeat_words"),
    )
    parts = rules.sketches(docs, ["lang", "source"])
    merged = rules.merged(parts, ["lang"]).collect()
    whole = rules.sketches(docs, ["lang"]).collect()
    assert sorted(map(str, merged)) == sorted(map(str, whole))


def test_quantiles_are_within_the_stated_error(spark):
    values = [1 + k * 0.37 for k in range(1001)]
    frame = spark.createDataFrame([("en", int(1000 * v), 1000) for v in values], "lang string, n_symbols long, n_words long")
    frame = frame.withColumns({c: F.lit(0) for c in ("word_chars", "n_dup_lines", "n_repeat_words")})
    found = rules.quantiles(rules.sketches(frame, ["lang"]), ["lang"]).first()
    for name, at in (("low", 125), ("mid", 500), ("high", 875)):
        assert abs(found[f"symbols_per_word_{name}"] - values[at]) < 0.011 * values[at]


def test_planted_outliers_fail_and_the_rest_stays(spark):
    words = " ".join(f"word{k}" for k in range(80))
    noisy = " ".join(f"w{k}###" for k in range(80))
    long_words = " ".join(f"word{k}" * 4 for k in range(80))
    rows = [(k, f"{words} {k}", "en", "big" if k % 3 else "small") for k in range(300)]
    rows += [(1000 + k, f"{noisy} {k}", "en", "big") for k in range(15)]
    rows += [(2000, long_words, "en", "small"), (2001, " ".join("a" for _ in range(3)) + " " + " ".join("bcdefghijklm"[k % 12] + str(k % 10) for k in range(97)), "en", "big")]
    got = rules.rules(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()
    assert {r["doc_id"] for r in got if not r["kept"]} == {1000 + k for k in range(15)} | {2000, 2001}


def test_fences_follow_their_group(spark):
    """The same text stays where symbols are usual and goes where they are not."""
    prose = " ".join(f"word{k}" for k in range(200))
    code = " ".join(f"word{k}{'=$' if k % 4 == 0 else ''}" for k in range(200))
    rows = [(k, f"{prose} {k}", "en", "news") for k in range(3000)]
    rows += [(10_000 + k, f"{code if k % 5 else prose} {k}", "en", "code") for k in range(3000)]
    rows += [(20_000, code, "en", "news"), (20_001, code, "en", "code"), (20_002, code, "en", "tiny")]
    counts = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: r["kept"] for r in rules.rules(counts).collect()}
    assert not got[20_000] and got[20_001] and got[20_002]
    assert all(kept for doc_id, kept in got.items() if doc_id != 20_000)


def test_small_groups_lean_on_their_language(spark):
    """Own documents weigh n / (n + PRIOR), at every n."""
    def rows(n, symbols, source):
        frame = spark.range(n).select(F.lit("en").alias("lang"), F.lit(source).alias("source"))
        return frame.withColumns({"n_words": F.lit(100), "n_symbols": F.lit(symbols), **{c: F.lit(0) for c in ("word_chars", "n_dup_lines", "n_repeat_words")}})

    small, large = 30, 4000
    found = {r["g_source"]: r for r in rules.thresholds(rows(small, 50, "few").union(rows(large, 2, "many"))).collect()}
    wide = 0.02
    expected = (small * 0.5 + rules.PRIOR * wide) / (small + rules.PRIOR)
    assert abs(found["few"]["symbols_per_word_mid"] - expected) < 0.02 * expected
    assert abs(found["many"]["symbols_per_word_mid"] - wide) < 0.02 * wide


def first_kept(rows, least):
    """Per row the kept lines: of a common key only the line at the least (id, position)."""
    key = lambda line: folded(line.strip(SPACES))
    holders, first = {}, {}
    for i, t in rows:
        for at, line in enumerate(t.split("\n")):
            holders.setdefault(key(line), set()).add(i)
            first[key(line)] = min(first.get(key(line), (i, at)), (i, at))
    return sorted(
        (i, "\n".join(x for at, x in enumerate(t.split("\n")) if not key(x) or len(holders[key(x)]) < least or first[key(x)] == (i, at)))
        for i, t in rows
    )


@pytest.mark.parametrize("partitions", [1, 2, 13, 60])
def test_first_line_of_a_common_run_stays(spark, partitions):
    """Copies of whole texts, common lines and repeated rows, at every split."""
    rng = random.Random(partitions)
    texts = ["\n".join(f"{name} sentence {k}" for k in range(6)) for name in "ab"]
    rows = [(500 + 7 * k % 40, texts[0]) for k in range(25)] + [(700 + k, texts[1]) for k in range(12)]
    rows += [(i, "\n".join([f"own {i}", *rng.choices([" The common line", "the COMMON line", "rare", "", "low"], k=4)])) for i in range(80)]
    rows += [rows[0], rows[0], (0, rows[37][1])]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = linededup.deduped(frame, min_documents=10, keep_first=True).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted((r["doc_id"], r["text"]) for r in got) == first_kept(rows, 10)
    for text in texts:
        assert {r["doc_id"] for r in got if r["text"] == text} == {min(i for i, t in rows if t == text)}
