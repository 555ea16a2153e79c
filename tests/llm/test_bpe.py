import base64
import random

import public_tokenizers
import pytest
import tiktoken
from brute import sha
from fixtures import awkward, awkward_rows, nothing, small  # noqa: F401
from paperloom.llm import bpe
from paperloom.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def expected(library, text):
    ids = library.encode_ordinary(text or "")
    return len(ids), sha(",".join(map(str, ids))), sha(text or "")


def test_query_equals_the_library(spark, small, library):
    got = QUERIES["op4_byte_bpe"](spark, "/root/testdata/sf0.001").collect()
    texts = {r["doc_id"]: r["text"] for r in small.collect()}
    assert len(got) == len(texts)
    for r in got:
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == expected(library, texts[r["doc_id"]])


def test_awkward_rows_and_round_trip(spark, awkward, nothing, library):
    got = bpe.digests(awkward, PATH, public_tokenizers.PATTERN).collect()
    key = lambda row: tuple(map(str, row))
    assert sorted(map(key, got)) == sorted(key((i, *expected(library, t))) for i, t, *_ in awkward_rows())
    assert bpe.digests(nothing, PATH, public_tokenizers.PATTERN).count() == 0
    encoded = bpe.encode(awkward, PATH, public_tokenizers.PATTERN)
    decoded = bpe.decode(encoded, PATH, public_tokenizers.PATTERN).collect()
    assert sorted((str(r["doc_id"]), bytes(r["data"]).decode()) for r in decoded) == sorted(
        (str(i), t or "") for i, t, *_ in awkward_rows()
    )


def test_pieces_of_any_length_and_script(library):
    rng = random.Random(5)
    texts = ["a" * 5000, "ab" * 700, "=" * 1500, " " * 1100 + "x", "éü" * 700, "<|endoftext|>", "日本語テキスト", "😀" * 30, "\x00\x7f"]
    texts += ["".join(rng.choice("abcdeéü'st 01\n") for _ in range(rng.randrange(1, 80))) for _ in range(300)]
    codec = bpe.Codec(bpe.read_ranks(PATH), public_tokenizers.PATTERN)
    for text, numbers in zip(texts, codec.encoded(texts)):
        ids = [int(i) for n in numbers for i in codec.ids[n].split(",")]
        assert ids == library.encode_ordinary(text)
        assert b"".join(codec.decoded[n] for n in numbers) == text.encode()


def test_forgetting_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "KNOWN", 5)
    codec = bpe.Codec(bpe.read_ranks(PATH), public_tokenizers.PATTERN)
    for part in (["one two three", "four five"], ["six seven one", "one eight nine ten"]):
        for text, numbers in zip(part, codec.encoded(part)):
            assert [int(i) for n in numbers for i in codec.ids[n].split(",")] == library.encode_ordinary(text)
