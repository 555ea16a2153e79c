import collections
import struct
import zlib

import numpy as np
import pytest
import xxhash
from fixtures import SMALL, awkward, awkward_rows, nothing, small  # noqa: F401
from paperloom.llm import sharding
from paperloom.llm.queries import QUERIES


def brute(rows, shards, seed, bucket_bytes):
    """[(row, shard, slot)] of rows in the order of their places, bucket by bucket in plain Python."""

    def draw(place):
        hashed = 42
        for value in (seed, place):
            hashed = xxhash.xxh64_intdigest(struct.pack("<q", value), hashed)
        return struct.unpack("<q", struct.pack("<Q", hashed))[0]

    total = sum(len((r[1] or "").encode()) + 1 for r in rows)
    buckets = collections.defaultdict(list)
    count = max(1, -(-total // bucket_bytes))
    for place, row in enumerate(rows):
        buckets[draw(place) % count].append(row)
    order = []
    for bucket in sorted(buckets):
        held = buckets[bucket]
        order += [held[k] for k in sharding.shuffled(len(held), seed, bucket)]
    found, starts = [], [-(-s * len(order) // shards) for s in range(shards + 1)]
    for s in range(shards):
        found += [(row, s, slot) for slot, row in enumerate(order[starts[s] : starts[s + 1]])]
    return found


def lawful(found, shards):
    """Counts at most one apart, slots gapless from 0."""
    slots = collections.defaultdict(list)
    for _, shard, slot in found:
        slots[shard].append(slot)
    sizes = [len(slots[s]) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and set(slots) <= set(range(shards))
    assert all(sorted(held) == list(range(len(held))) for held in slots.values())


@pytest.mark.parametrize("bucket_bytes", [200_000, 1 << 30])
def test_equals_plain_buckets(small, bucket_bytes):
    """One input partition, so that places are row numbers."""
    docs = small.select("doc_id", "text").coalesce(1)
    rows = [tuple(r) for r in docs.collect()]
    got = [((r["doc_id"], r["text"]), r["shard"], r["slot"]) for r in sharding.write_shards(docs, bucket_bytes=bucket_bytes).collect()]
    assert sorted(got) == sorted(brute(rows, 16, sharding.SEED, bucket_bytes))


def test_query_holds_its_law(spark, small):
    frame = QUERIES["op13_sharding"](spark, SMALL)
    assert frame.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    rows = frame.collect()
    text = {r["doc_id"]: (r["text"] or "").encode() for r in small.collect()}
    assert sorted(r["doc_id"] for r in rows) == sorted(text)
    for r in rows:
        held = text[r["doc_id"]]
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(held) + 1, zlib.crc32(held), "rows", None)
    lawful([(r["doc_id"], r["shard"], r["slot"]) for r in rows], 16)


def test_files_hold_their_shard_in_order(spark, tmp_path, small):
    folder = f"file://{tmp_path}/shards"
    sharding.write_shards(small.repartition(5), folder, shards=4, bucket_bytes=100_000)
    for shard in range(4):
        files = sorted((tmp_path / "shards" / f"shard={shard}").glob("*.parquet"))
        slots = [[r["slot"] for r in spark.read.parquet(f"file://{f}").collect()] for f in files]
        assert all(held == sorted(held) for held in slots)
        assert sorted(s for held in slots for s in held) == list(range(sum(map(len, slots))))


def test_seed_decides_and_order_is_mixed(spark):
    docs = spark.range(4000).selectExpr("id AS doc_id", "'word' AS text").coalesce(1)

    def of(seed):
        found = sharding.write_shards(docs, seed=seed, bucket_bytes=2000).collect()
        return {r["doc_id"]: (r["shard"], r["slot"]) for r in found}

    one, again, other = of(1), of(1), of(2)
    assert one == again != other
    place = np.array([one[i][0] * 250 + one[i][1] for i in range(4000)])
    assert abs(np.corrcoef(place, np.arange(4000))[0, 1]) < 0.06
    near = np.abs(np.diff(place)) <= 3
    assert near.mean() < 0.02


def test_one_row_held_by_all_spreads_over_buckets(spark):
    """Copies with the same id, a third of all rows and more, are records like others."""
    docs = spark.range(900).selectExpr("if(id % 3 = 0, id, 0L) AS doc_id", "if(id % 3 = 0, 'a', repeat('b', 99)) AS text")
    found = [(r["doc_id"], r["shard"], r["slot"]) for r in sharding.write_shards(docs, bucket_bytes=5000).collect()]
    lawful(found, 16)
    held = collections.Counter(shard for doc_id, shard, _ in found if doc_id == 0)
    assert len(held) == 16 and max(held.values()) < 57


def test_awkward_rows(awkward):
    frame = awkward.selectExpr("*", "'x' AS Shard", "'y' AS slot", "'z' AS record", "'z' AS turn")
    back = sharding.write_shards(frame, shards=4, bucket_bytes=100)
    assert back.columns == [*awkward.columns, "record", "turn", "slot", "shard"]
    rows = back.collect()
    assert collections.Counter((r["doc_id"], r["text"]) for r in rows) == collections.Counter(
        (i, t) for i, t, *_ in awkward_rows()
    )
    lawful([(r["doc_id"], r["shard"], r["slot"]) for r in rows], 4)


def test_empty_table_and_few_rows(spark, nothing):
    assert sharding.write_shards(nothing).count() == 0
    few = sharding.write_shards(spark.range(3).selectExpr("id AS doc_id", "cast(null AS string) AS text")).collect()
    lawful([(r["doc_id"], r["shard"], r["slot"]) for r in few], 16)
