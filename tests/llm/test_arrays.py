import numpy as np
import pyarrow as pa
from brute import SPACES, folded, words
from hypothesis import given, settings
from hypothesis import strategies as st
from paperloom.llm import arrays

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aAbé ü \t\n\r\x0b", max_size=40)), max_size=12)


@settings(deadline=None, max_examples=200)
@given(TEXTS, st.integers(1, 30))
def test_words_and_lines_equal_splitting(texts, limit):
    found_words, found_lines = [], []
    for chunk in arrays.chunks(pa.array(texts, pa.string()), limit):
        w = arrays.words(chunk)
        for row in range(chunk.rows):
            at = range(w.first[row], w.first[row + 1])
            found_words.append([bytes(chunk.data[w.starts[k] : w.ends[k]]).decode() for k in at])
            assert all(w.row[k] == row for k in at)
        n = arrays.lines(chunk)
        low, high = arrays.stripped(chunk, n.starts, n.ends)
        for row in range(chunk.rows):
            at = np.flatnonzero(n.row == row)
            assert list(n.number[at]) == list(range(len(at)))
            found_lines.append([bytes(chunk.data[low[k] : high[k]]).decode() for k in at])
    assert found_words == [words(t) for t in texts]
    assert found_lines == [[x.strip(SPACES) for x in (t or "").split("\n")] for t in texts]


@settings(deadline=None, max_examples=100)
@given(st.lists(st.text(alphabet="ab ", max_size=12), min_size=1, max_size=10))
def test_equal_hashes_mean_equal_content(texts):
    seen = {}
    for chunk in arrays.chunks(pa.array(texts), 7):
        w = arrays.words(chunk)
        hashes = arrays.FIRST.of_bytes(arrays.LOWER[chunk.data], w.starts, w.ends)
        starts = arrays.runs(w, 2)
        pairs = arrays.FIRST.of_runs(hashes, starts, starts + 2)
        for k, value in zip(starts, pairs):
            content = tuple(bytes(chunk.data[w.starts[j] : w.ends[j]]) for j in (k, k + 1))
            assert seen.setdefault(int(value), content) == content
    assert len(set(seen.values())) == len(seen)
    assert {tuple(x.encode() for x in p) for t in texts for p in zip(words(folded(t)), words(folded(t))[1:])} == set(
        seen.values()
    )
