import random

import pytest
from brute import sha, without_windows, words
from fixtures import awkward, awkward_rows, nothing, small  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st
from paperloom.llm import substrings
from paperloom.llm.automaton import SuffixAutomaton
from paperloom.llm.queries import QUERIES


@settings(deadline=None, max_examples=200)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=12), min_size=1, max_size=5), st.integers(1, 4))
def test_matching_statistics_equal_search(sequences, least):
    automaton = SuffixAutomaton(least)
    for sequence in sequences:
        automaton.add(sequence)
    holds = lambda part: sum("".join(part) in "".join(s) for s in sequences)
    for sequence in sequences:
        expected = []
        for end in range(1, len(sequence) + 1):
            sizes = [n for n in range(least, end + 1) if holds(sequence[end - n : end]) >= 2]
            expected.append(max(sizes, default=0))
        assert automaton.matching_statistics(sequence, 2) == expected


def digest(frame, window, wide):
    marked = substrings.with_spans(frame, substrings.repeated_windows(frame, window, wide=wide))
    out = []
    for r in marked.collect():
        split = words(r["text"])
        gone = substrings.covered(r["_pl_spans"], len(split), window)
        out.append((r["doc_id"] if r["doc_id"] is not None else -1, len(split), [w for w, g in zip(split, gone) if not g]))
    return sorted(out)


def brute(rows, window):
    return sorted(
        (i if i is not None else -1, n, kept)
        for (i, _), (n, kept) in zip(rows, without_windows(rows, window))
    )


def passages(seed):
    """Random texts that share passages, periodic runs and a passage inside one text twice."""
    rng = random.Random(seed)
    word = lambda n: f"v{rng.randrange(n)}"
    shared = [[word(40) for _ in range(rng.randrange(14, 40))] for _ in range(6)]
    rows = []
    for i in range(60):
        text = []
        for _ in range(rng.randrange(1, 6)):
            kind = rng.random()
            if kind < 0.4:
                text += rng.choice(shared)
            elif kind < 0.5:
                text += [word(5)] * rng.randrange(2, 50)
            elif kind < 0.6:
                text += [word(5), word(5)] * rng.randrange(2, 30)
            else:
                text += [word(500) for _ in range(rng.randrange(30))]
        rows.append((i, " ".join(text)))
    return rows


@pytest.mark.parametrize("wide", [0, 1, 3, 10_000])
def test_every_split_gives_the_brute_force_result(spark, wide):
    rows = passages(11)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert digest(frame, 14, wide) == brute(rows, 14)


def test_query_equals_brute_force(spark, small):
    rows = [(r["doc_id"], r["text"]) for r in small.collect()]
    expected = {i: (n, n - len(kept), sha(" ".join(kept))) for (i, _), (n, kept) in zip(rows, without_windows(rows, 35))}
    got = QUERIES["op5_substring_dedup"](spark, "/root/testdata/sf0.001").collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got} == expected
    assert any(r["n_removed"] for r in got)


def test_awkward_rows(awkward, nothing):
    rows = [(i, t) for i, t, *_ in awkward_rows()]
    assert digest(awkward, 35, 200) == brute(rows, 35)
    assert substrings.without_repeats(nothing).count() == 0


def test_cut_texts_keep_columns_and_white_space(spark, awkward):
    got = substrings.without_repeats(awkward, window=35)
    assert got.columns == awkward.columns and got.count() == len(awkward_rows())
    texts = {r["doc_id"]: r["text"] for r in got.collect()}
    assert texts[13] == "line\r\n line \nLINE\n\nend" and texts[1] == "" and texts[3] == " tail" and texts[4] is None
