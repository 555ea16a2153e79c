import collections

from brute import folded, words
from fixtures import awkward, awkward_rows, nothing, small  # noqa: F401
from paperloom.llm import packing
from paperloom.llm.queries import QUERIES


def best_fit(items, capacity):
    """The same rule by looking at every bin."""
    bins, places = [], []
    for size, source, cluster in items:
        fits = [
            (b["left"], k)
            for k, b in enumerate(bins)
            if b["left"] >= size and source not in b["sources"] and cluster not in b["clusters"]
        ]
        if fits:
            k = min(fits)[1]
        else:
            k = len(bins)
            bins.append({"left": capacity, "sources": set(), "clusters": set()})
        places.append((k, capacity - bins[k]["left"]))
        bins[k]["left"] -= size
        bins[k]["sources"].add(source)
        bins[k]["clusters"].add(cluster)
    return places


def check(got, rows, capacity):
    """Nothing lost, nothing over the capacity, no gap, no conflict."""
    sizes = collections.Counter()
    bins = collections.defaultdict(list)
    for r in got:
        sizes[r["doc_id"]] += r["n_words"]
        bins[r["bin_id"]].append(r)
        assert r["first_word"] == r["piece"] * capacity
    wanted = collections.Counter()
    for i, t, *_ in rows:
        wanted[i] += len(words(t))
    assert sizes == wanted
    source = {i: s for i, _, _, s in rows}
    cluster = {i: tuple(words(folded(t or ""))) for i, t, *_ in rows}
    for found in bins.values():
        at = 0
        for r in sorted(found, key=lambda r: (r["bin_offset"], r["n_words"])):
            assert r["bin_offset"] == at
            at += r["n_words"]
        assert at <= capacity
        assert len({source[r["doc_id"]] for r in found}) == len(found)
        assert len({cluster[r["doc_id"]] for r in found}) == len(found)


def test_query_keeps_everything(spark, small):
    got = QUERIES["op2_best_fit_packing"](spark, "/root/testdata/sf0.001").collect()
    check(got, [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in small.collect()], packing.CAPACITY)


def test_awkward_rows(awkward, nothing):
    got = packing.packed(awkward, capacity=50).collect()
    check(got, awkward_rows(), 50)
    assert packing.packed(nothing).count() == 0


def test_bins_equal_the_plain_rule(spark):
    rows = [(k, " ".join(["w%d" % (k % 150)] * (k * 37 % 90 + 1)), f"s{k * k % 9}") for k in range(400)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r["doc_id"]: (r["bin_id"], r["bin_offset"]) for r in packing.packed(frame, capacity=100, cell=10**6).collect()}
    order = sorted(rows, key=lambda r: (-len(r[1].split()), r[0]))
    places = best_fit([(len(t.split()), s, t) for _, t, s in order], 100)
    assert {i: (f"0-{k}", at) for (i, *_), (k, at) in zip(order, places)} == got


def test_few_and_many_cells_keep_everything(spark):
    rows = [(k, "word " * (k % 70), "en", "hot" if k % 3 == 0 else f"s{k % 20}") for k in range(600)]
    rows = [(i, f"{i} {t}", lang, s) for i, t, lang, s in rows]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    for cell in (10, 100, 10_000):
        check(packing.packed(frame, capacity=128, cell=cell).collect(), rows, 128)
