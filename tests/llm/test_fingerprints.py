import random

from brute import sha
from fixtures import awkward, awkward_rows, nothing, PROSE, small  # noqa: F401
from paperloom.llm import fingerprints as fp
from paperloom.llm.queries import QUERIES


def expected(rows):
    """Rows in id order with the text of the next one."""
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    out = []
    for k, (i, t) in enumerate(order):
        t, following = t or "", order[(k + 1) % len(order)][1] or ""
        half = len(t) // 2
        out.append((i, t, t[: len(t) - half] + following[:half], following))
    return out


def check(got, rows):
    wanted = sorted(
        (str(i), len(t), sha(e), fp.fingerprint(t.encode()), fp.fingerprint(e.encode())) for i, t, e, _ in expected(rows)
    )
    assert wanted == sorted(
        (str(r["doc_id"]), r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"]) for r in got
    )


def test_query_equals_brute_force(spark, small):
    got = QUERIES["op1_document_fingerprints"](spark, "/root/testdata/sf0.001").collect()
    check(got, [(r["doc_id"], r["text"]) for r in small.collect()])
    assert all(0 <= r[c] <= 1 for r in got for c in ("near_edited", "near_next"))
    longer = [r for r in got if r["n_chars"] > 300]
    assert sum(r["near_edited"] > r["near_next"] for r in longer) > 0.95 * len(longer)


def test_awkward_rows(spark, awkward, nothing, tmp_path):
    for frame, rows in ((awkward, [(i, t) for i, t, *_ in awkward_rows()]), (nothing, [])):
        out = frame.select("doc_id", "text")
        out.write.mode("overwrite").parquet(str(tmp_path / "documents.parquet"))
        check(QUERIES["op1_document_fingerprints"](spark, str(tmp_path)).collect(), rows)
    single = [(3, PROSE)]
    spark.createDataFrame(single, "doc_id long, text string").write.mode("overwrite").parquet(
        str(tmp_path / "documents.parquet")
    )
    check(QUERIES["op1_document_fingerprints"](spark, str(tmp_path)).collect(), single)


def test_equal_texts_and_only_they_have_equal_roots():
    rng = random.Random(1)
    texts = {"".join(rng.choice("ab. \n") for _ in range(rng.randrange(40))) for _ in range(3000)}
    marks = [fp.fingerprint(t.encode()) for t in texts]
    assert len(set(marks)) == len(texts) and len({m[:32] for m in marks}) == len(texts)
    assert all(fp.fingerprint(t.encode()) == m for t, m in zip(texts, marks))


def test_an_edit_is_located_and_the_rest_is_alike():
    sentences = [f"Sentence number {k} says {k * 7919 % 1000}." for k in range(200)]
    one = fp.fingerprint(" ".join(sentences).encode())
    changed = list(sentences)
    changed[120] = "Something else stands here."
    other = fp.fingerprint(" ".join(changed).encode())
    assert fp.differing(one, other) == [120] and fp.differing(one, one) == []
    assert 0.98 < fp.likeness(one, other) < 1 and fp.likeness(one, one) == 1
    inserted = fp.fingerprint(" ".join(sentences[:5] + ["New one."] + sentences[5:]).encode())
    assert fp.likeness(one, inserted) > 0.98
    assert fp.likeness(one, fp.fingerprint(b"Nothing in common.")) == 0
    assert fp.likeness(fp.fingerprint(b""), fp.fingerprint(b"x")) == 0


def test_pieces_cover_the_whole_text():
    rng = random.Random(2)
    for _ in range(300):
        data = "".join(rng.choice("abé .!\n\t") for _ in range(rng.randrange(300))).encode()
        assert b"".join(fp._PIECE.findall(data)) == data


def plain_tree(text):
    """The tree as the module's docstring tells it, without its code: (sections, root)."""
    import hashlib

    digest = lambda data, size: hashlib.blake2b(data, digest_size=size).hexdigest()
    data, at, pieces = text.encode(), 0, []
    while at < len(data):
        stop, begin = at, at
        while stop < len(data) and data[stop] not in b"\n.!?" and (stop - begin < 64 or data[stop] not in b" "):
            stop += 1
        if stop < len(data) and data[stop] in b".!?":
            while stop < len(data) and data[stop] in b".!?":
                stop += 1
            while stop < len(data) and data[stop] in b" \t":
                stop += 1
            stop += stop < len(data) and data[stop] == 10
        elif stop < len(data):
            stop += 1
        pieces.append(data[at:stop])
        at = stop
    sections, leaves = [], []
    for piece in pieces:
        leaves.append(digest(piece, 4))
        if leaves[-1][0] in "02":
            sections.append(leaves)
            leaves = []
    sections += [leaves] if leaves else []
    written = "".join(f"/{digest(''.join(s).encode(), 4)}:{''.join(s)}" for s in sections)
    return sections, digest(f"{len(data)}{hashlib.sha256(data).hexdigest()}{written}".encode(), 16) + written


def plain_likeness(one, other):
    """Twice the shared paragraphs over both texts' paragraphs; whole sections are matched first."""
    from collections import Counter

    (a, x), (b, y) = one, other
    if x == y:
        return 1.0
    total = sum(map(len, a)) + sum(map(len, b))
    if not total:
        return 0.0
    same = Counter(map(tuple, a)) & Counter(map(tuple, b))
    shared = sum(len(s) * k for s, k in same.items())
    left, right = (Counter(p for s, k in (Counter(map(tuple, t)) - same).items() for p in s for _ in range(k)) for t in (a, b))
    return 2 * (shared + sum((left & right).values())) / total


def test_tree_and_likeness_equal_a_plain_version(small):
    rng = random.Random(4)
    texts = [r["text"] or "" for r in small.limit(60).collect()]
    texts += ["".join(rng.choice(["ab", ". ", "!\n", " ", "\n", "?\t", "c" * 70, "é"]) for _ in range(rng.randrange(90))) for _ in range(150)]
    trees = [plain_tree(t) for t in texts]
    for text, (_, mark) in zip(texts, trees):
        assert fp.fingerprint(text.encode()) == mark
    for _ in range(300):
        i, j = rng.randrange(len(texts)), rng.randrange(len(texts))
        assert abs(fp.likeness(trees[i][1], trees[j][1]) - plain_likeness(trees[i], trees[j])) < 1e-9
