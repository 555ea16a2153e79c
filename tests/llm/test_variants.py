import collections
import random
import re
import zlib

import pytest
from brute import folded
from fixtures import SMALL, awkward, awkward_rows, nothing, small  # noqa: F401
from paperloom.llm import variants
from paperloom.llm.queries import QUERIES


def one_edit_away(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) > len(b):
        a, b = b, a
    k = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[k + 1 :] == b[k + 1 :] if len(a) == len(b) else a[k:] == b[k + 1 :]


def brute_words(docs, min_chars, min_count):
    counts = collections.Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = folded(run)
            crc = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if crc % 97 == 0:
                word = word[: crc % len(word)] + word[crc % len(word) + 1 :]
            counts[word] += 1
    return {w: n for w, n in counts.items() if len(w) >= min_chars and n >= min_count}


def brute(docs, min_chars=5, min_count=3, ratio=2):
    n = brute_words(docs, min_chars, min_count)
    near = {w: [v for v in n if one_edit_away(w, v)] for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None

    def last(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {(w, form[w], last(w), n[w], len(near[w]), n.get(form[w])) for w in n}


def collected(frame):
    assert frame.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    found = [tuple(r) for r in frame.collect()]
    assert len(found) == len(set(found))
    return set(found)


def test_query_equals_all_pairs(spark, small):
    docs = [(r["doc_id"], r["text"]) for r in small.collect()]
    assert collected(QUERIES["op11_spelling_variants"](spark, SMALL)) == brute(docs)


@pytest.mark.parametrize("dictionary", [1, 40, 20_000])
def test_every_dictionary_finds_the_same(spark, dictionary):
    """From no frequent gram at all to a deep dictionary; chains, ties, repeated letters, long words."""
    rng = random.Random(5)
    bases = ["aaaaaa", "abababab", "stone", "bridge", "river", "étésàÿ", "x" * 300, "mississippi"]
    bases += ["".join(rng.choice("abc") for _ in range(rng.randint(5, 9))) for _ in range(40)]
    words = []
    for base in bases:
        words += [base] * rng.randint(3, 40)
        for _ in range(4):
            k = rng.randrange(len(base))
            words += [rng.choice([base[:k] + base[k + 1 :], base[:k] + "c" + base[k:], base[:k] + "b" + base[k + 1 :]])] * 3
    rng.shuffle(words)
    docs = [(i, " ".join(words[i::7]).upper() if i % 2 else " ".join(words[i::7])) for i in range(7)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert collected(variants.spelling_variants(frame, dictionary=dictionary)) == brute(docs)
    assert collected(variants.spelling_variants(frame, min_chars=2, min_count=1, dictionary=dictionary)) == brute(docs, 2, 1)


def test_many_words_that_share_a_gram(spark):
    """A hot list: every word begins alike, few are near."""
    rng = random.Random(1)
    words = ["common" + "".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(600)]
    docs = [(0, " ".join(words * 3))]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert collected(variants.spelling_variants(frame)) == brute(docs)


def test_forms_are_followed_to_the_last(spark):
    steps = [("stona", 2), ("stone", 4), ("stones", 8), ("stonesx", 16)]
    docs = [(1, " ".join(" ".join([w] * n) for w, n in steps))]
    got = collected(variants.spelling_variants(spark.createDataFrame(docs, "doc_id long, text string"), min_count=1))
    assert got == brute(docs, 5, 1)
    assert {(w, r) for w, _, r, *_ in got if w == "stona"} == {("stona", "stonesx")}


def test_awkward_rows(awkward):
    docs = [(i, t) for i, t, *_ in awkward_rows()]
    assert collected(variants.spelling_variants(awkward, min_count=1)) == brute(docs, 5, 1)


def test_empty_table(nothing):
    assert collected(variants.spelling_variants(nothing)) == set()


def test_pieces_cut_no_run():
    text = "abc " * 50 + "d" * 40 + " eéf" * 20
    for size in (1, 7, 64, 1000):
        parts = list(variants.pieces(text, size))
        assert "".join(parts) == text
        assert [r for p in parts for r in variants.RUN.findall(p)] == variants.RUN.findall(text)


def test_a_bound_covers_every_edit():
    """Grams that an edit leaves alone are at least all less the bound."""
    rng = random.Random(2)
    frequent = {"ab", "ba", "aba", "^a", "abab"}
    for _ in range(300):
        word = "".join(rng.choice("abc") for _ in range(rng.randint(5, 10)))
        k = rng.randrange(len(word))
        other = rng.choice([word[:k] + word[k + 1 :], word[:k] + "c" + word[k:], word[:k] + "a" + word[k + 1 :]])
        one, two = variants.grams(word, frequent, 5), variants.grams(other, frequent, 5)
        same = {(g, p, "s") for g, p in one} & {(g, p, "s") for g, p in two}
        same |= {(g, len(word) - p, "e") for g, p in one} & {(g, len(other) - p, "e") for g, p in two}
        places = {p if side == "s" else len(word) - p for _, p, side in same}
        assert len(places) >= len(one) - variants.most_affected(one, len(word) + 2) >= 1
