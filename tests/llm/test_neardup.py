import random

from brute import components
from fixtures import awkward, awkward_rows, nothing, small  # noqa: F401
from paperloom.llm import components as graph
from paperloom.llm import neardup

from paperloom.llm.queries import QUERIES


def found(frame):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in frame.collect()}


def test_query_equals_all_pairs(spark, small):
    rows = QUERIES["op3_minhash_near_dedup"](spark, "/root/testdata/sf0.001")
    docs = [(r["doc_id"], r["text"]) for r in small.collect()]
    expected = components(docs, 3, 85)
    assert found(rows) == expected
    assert {r["doc_id"] for r in rows.collect() if r["kept"]} == {i for i, (_, c) in expected.items() if i == c}


def test_chain_of_near_copies_is_one_component(spark):
    """Neighbours are alike, the ends are not; no bucket's ends may be the link."""
    rng = random.Random(7)
    base = [f"t{rng.randrange(10**6)}" for _ in range(200)]
    docs, current = [], list(base)
    for i in range(60):
        docs.append((i, " ".join(current)))
        current[3 * i % 200] = f"new{i}"
    docs += [(100 + i, " ".join(f"u{rng.randrange(10**6)}" for _ in range(50))) for i in range(20)]
    result = neardup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), width=5, percent=80)
    assert found(result) == components(docs, 5, 80)


def near_copies(rng, count, words=100, replaced=2, base=None):
    """Texts that differ from one base by a few replaced words each."""
    base = base or [f"t{rng.randrange(10**6)}" for _ in range(words)]
    found = []
    for _ in range(count):
        text = list(base)
        for place in rng.sample(range(len(base)), replaced):
            text[place] = f"new{rng.randrange(10**9)}"
        found.append(" ".join(text))
    return base, found


def check_group(spark, texts, width, percent):
    docs = list(enumerate(texts))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert found(neardup.near_duplicates(frame, width=width, percent=percent)) == components(docs, width, percent)


def test_near_copies_just_under_the_limit(spark):
    """Most pairs of the group share bands and are no links; some chains run through it."""
    rng = random.Random(11)
    base, texts = near_copies(rng, 260)
    check_group(spark, texts, 3, 85)
    check_group(spark, [*texts, " ".join(base)], 3, 85)


def test_a_group_beside_its_outsiders(spark):
    """A large component, members that nearly belong to it, and pairs among these."""
    rng = random.Random(12)
    base, close = near_copies(rng, 150, replaced=1)
    _, far = near_copies(rng, 40, replaced=4, base=base)
    _, twins = near_copies(rng, 3, replaced=9, base=base)
    longer = [f"{text} {' '.join(f'end{rng.randrange(10**6)}' for _ in range(14))}" for text in close[:20]]
    again = [text.replace("new", "old", 1) for text in twins + far[:10]]
    texts = close + far + twins + longer + again
    rng.shuffle(texts)
    check_group(spark, texts, 3, 85)
    check_group(spark, texts, 5, 80)


def test_groups_without_anything_in_common_but_a_passage(spark):
    """Shared passages put unrelated texts into common buckets; lengths differ."""
    rng = random.Random(13)
    passage = " ".join(f"p{k}" for k in range(120))
    texts = [f"{passage} {' '.join(f'o{rng.randrange(10**6)}' for _ in range(rng.randrange(4, 60)))}" for _ in range(120)]
    check_group(spark, texts, 3, 85)


def sets_of(spark, texts, width=3):
    frame = spark.createDataFrame(list(enumerate(texts)), "vertex long, text string")
    return frame.mapInArrow(neardup._sets(width), neardup.SETS_DDL).cache()


def test_candidates_of_a_hot_group_are_few(spark):
    """No pair by pair comparison: what leaves the join is little more than the links."""
    for size in (200, 400):
        rng = random.Random(size)
        _, texts = near_copies(rng, size)
        sets = sets_of(spark, texts)
        groups = sets.selectExpr("0L AS ref", "vertex", "vertex AS root")
        expected = {(a, b) for a in range(size) for b in range(a) if near(texts[a], texts[b])}
        found_pairs = {tuple(sorted(r, reverse=True)) for r in neardup._across(groups, sets, 85).collect()}
        assert expected <= found_pairs
        assert len(found_pairs) < 8 * size


def near(one, other, width=3, percent=85):
    from brute import shingles

    x, y = shingles(one, width), shingles(other, width)
    return 100 * len(x & y) >= percent * len(x | y)


def test_parity_never_exceeds_the_difference():
    import numpy as np
    from paperloom.llm import arrays

    rng = np.random.default_rng(3)
    pool = arrays.mix(np.arange(1, 3000, dtype=np.uint64))
    rows = [np.unique(rng.choice(pool, rng.integers(1, 900))) for _ in range(40)]
    owners = np.repeat(np.arange(40), [len(r) for r in rows])
    bits = neardup.parity(owners, np.concatenate(rows), 40)
    for i in range(40):
        for j in range(i):
            turned = sum(int(x).bit_count() for x in bits[i] ^ bits[j])
            apart = len(np.setxor1d(rows[i], rows[j]))
            assert turned <= apart and turned % 2 == apart % 2


def test_awkward_rows(spark, awkward):
    got = [tuple(r) for r in neardup.near_duplicates(awkward, width=3, percent=85).collect()]
    assert len(got) == len(awkward_rows())
    by_id = {}
    for doc_id, n, component, kept in got:
        by_id.setdefault(doc_id, set()).add((n, component, kept))
    expected = components([(i, t) for i, t, *_ in awkward_rows() if i is not None], 3, 85)
    for doc_id, (n, component) in expected.items():
        assert by_id[doc_id] == {(n, component, doc_id == component)}
    assert by_id[None] == {(1, None, True)}
    assert by_id[4] == {(0, 4, True)} and by_id[7] == {(1, 7, True)} and by_id[8] == {(1, 7, False)}


def test_empty_table(nothing):
    assert neardup.near_duplicates(nothing).count() == 0


def test_representatives_keep_columns(awkward):
    kept = neardup.representatives(awkward, width=3, percent=85)
    assert kept.columns == awkward.columns
    assert {r["doc_id"] for r in kept.collect()} == {1, 4, 5, 6, 7, 9, 10, 11, 13, None}


def test_components_of_random_graphs(spark):
    rng = random.Random(3)
    for edges in ([(rng.randrange(300), rng.randrange(300)) for _ in range(170)], [(k, k + 1) for k in range(64)], []):
        root = {}

        def find(x):
            root.setdefault(x, x)
            while root[x] != x:
                x = root[x]
            return x

        for a, b in edges:
            low, high = sorted((find(a), find(b)))
            root[high] = low
        expected = {x: find(x) for a, b in edges if a != b for x in (a, b)}
        frame = spark.createDataFrame(edges, "a long, b long")
        assert {r["vertex"]: r["root"] for r in graph.connected(frame).collect()} == expected


def test_sketch_fills_every_coordinate_and_estimates():
    import numpy as np
    from paperloom.llm import arrays

    one = arrays.mix(np.arange(1, 1001, dtype=np.uint64))
    two = arrays.mix(np.arange(101, 1101, dtype=np.uint64))
    tiny = one[:1]
    owners = np.repeat([0, 1, 2], [1000, 1000, 1])
    bins = neardup.sketch(owners, np.concatenate([one, two, tiny]), 4)
    assert (bins[:3] < np.iinfo(np.uint64).max).all() and (bins[3] == np.iinfo(np.uint64).max).all()
    assert abs((bins[0] == bins[1]).mean() - 900 / 1100) < 0.12
