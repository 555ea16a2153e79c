"""Line dedup: lines whose key stands in many documents are dropped everywhere, or all but the first.

A line's key is the line without white space at both ends and with A to Z in lower case.
Key hashes (128 bits) are range-partitioned by hash and document and sorted by hash,
document and position inside each partition. One pass over a partition streams the runs
of equal hashes: once a run has enough documents its rows are dropped for sure, so at
most the rows of `min_documents - 1` documents wait. A run that touches a partition's
edge may go on in the next one; its count is summed over partitions and only its rows
wait for that sum, which is how one line of a third of all documents is split over many
tasks. What comes back is a compressed bitmap for each document, not text.

With `keep_first` the first line of a run, by document id and position, stays. Of an edge
run each partition holds back its first line, and the least of these is the one that stays.

Defined results: a null text is one empty line; keys of fewer than `min_chars` code
points are never dropped; rows with equal id and text count as one document and get the
same bitmap, so a kept first line stays in each of them; a null id is an id like any other,
the least one; an empty table gives an empty table.
"""

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from paperloom.llm import arrays
from paperloom.llm.runtime import free_names, ship, written

KEY = ["h1", "h2"]
OWNER = ["owner_id", "owner_text"]
LINE_SCHEMA = pa.schema([(c, pa.int64()) for c in [*KEY, *OWNER, "position"]])
#: kind 0: a dropped line; 1: documents of an edge run seen here; 2: a line that waits; 3: an edge run's first line here
FOUND_SCHEMA = pa.schema([*LINE_SCHEMA, ("kind", pa.int8()), ("documents", pa.int64())])
FOUND_DDL = "h1 long, h2 long, owner_id long, owner_text long, position long, kind byte, documents long"


def _keyed_lines(min_chars):
    def run(batches):
        for batch in batches:
            owner_id, owner_text = batch.column(0), batch.column(1)
            for chunk in arrays.chunks(batch.column(2)):
                found = arrays.lines(chunk)
                low, high = arrays.stripped(chunk, found.starts, found.ends)
                folded = arrays.LOWER[chunk.data]
                # code points: bytes that do not continue one
                points = np.concatenate([[0], np.cumsum((chunk.data & 0xC0) != 0x80)])
                keep = np.flatnonzero(points[high] - points[low] >= max(min_chars, 1))
                low, high, rows = low[keep], high[keep], pa.array(found.row[keep] + chunk.first_row)
                yield arrays.rows_of(
                    [
                        arrays.signed(arrays.FIRST.of_bytes(folded, low, high)),
                        arrays.signed(arrays.SECOND.of_bytes(folded, low, high)),
                        owner_id.take(rows),
                        owner_text.take(rows),
                        found.number[keep],
                    ],
                    LINE_SCHEMA,
                )

    return run


def _stream_runs(min_documents, keep_first):
    """Over rows sorted by hash, document and position."""

    def run(batches):
        waiting, documents, first_run, current, first = [], 0, True, None, None
        last_owner, settled = None, False

        def out(columns, kind, counts):
            size = len(columns[0])
            kinds = pa.array(np.full(size, kind, np.int8))
            return arrays.rows_of([*columns, kinds, np.full(size, counts, np.int64)], FOUND_SCHEMA)

        def mark():
            """The count of an edge run."""
            return out([np.array([v], np.int64) for v in (*current, 0, 0, 0)], 1, documents)

        def held_back():
            """The first line of an edge run."""
            return out([np.array([v], np.int64) for v in (*current, *first)], 3, 0)

        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            h1, h2, owner_id, owner_text, position = columns
            changed = np.flatnonzero((h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])) + 1
            bounds = np.concatenate([[0], changed, [len(h1)]])
            new_owner = np.ones(len(h1), bool)
            new_owner[1:] = (owner_id[1:] != owner_id[:-1]) | (owner_text[1:] != owner_text[:-1])
            new_owner[changed] = True
            counts = np.add.reduceat(new_owner.astype(np.int64), bounds[:-1])
            dropped = []
            for k in range(len(bounds) - 1):
                low, high = bounds[k], bounds[k + 1]
                key = (h1[low], h2[low])
                if key != current:
                    if current is not None:
                        if first_run:
                            yield mark()
                            if keep_first:
                                yield held_back()
                            if not settled:
                                for held in waiting:
                                    yield out(held, 2, 0)
                        first_run = False if current is not None else first_run
                    waiting, documents, settled, current = [], 0, False, key
                    last_owner = first = None
                documents += int(counts[k])
                if last_owner == (owner_id[low], owner_text[low]):
                    documents -= 1
                last_owner = (owner_id[high - 1], owner_text[high - 1])
                if not settled and documents >= min_documents:
                    for held in waiting:
                        yield out(held, 0, 0)
                    waiting, settled = [], True
                going_on = first_run or k == len(bounds) - 2
                if keep_first and (settled or going_on):
                    if first is None:
                        first = (owner_id[low], owner_text[low], position[low])
                    while low < high and (owner_id[low], owner_text[low], position[low]) == first:
                        low += 1  # the line that stays, once for each repeated row
                if low < high and settled:
                    dropped.append(np.arange(low, high))
                elif low < high and going_on:
                    waiting.append([c[low:high] for c in columns])
            if dropped:
                rows = np.concatenate(dropped)
                yield out([c[rows] for c in columns], 0, 0)
        if current is not None:
            yield mark()
            if keep_first:
                yield held_back()
            for held in waiting:
                yield out(held, 2, 0)

    return run


def _bitmaps(batches):
    for batch in batches:
        packed = []
        for positions in batch.column(2):
            dropped = np.asarray(positions.as_py(), np.int64)
            keep = np.ones((int(dropped.max()) // 8 + 1) * 8, bool)
            keep[dropped] = False
            packed.append(zlib.compress(np.packbits(keep).tobytes(), 1))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(packed, pa.binary())], names=[*OWNER, "keep_bitmap"]
        )


def _owners(docs, id_column, text_column):
    return docs.select(
        F.coalesce(F.col(id_column).cast("long"), F.lit(-(2**63))).alias("owner_id"),
        F.xxhash64(text_column).alias("owner_text"),
        F.col(text_column).cast("string").alias("text"),
    )


def keep_bitmaps(docs, min_documents=10, min_chars=1, id_column="doc_id", text_column="text", keep_first=False):
    """(owner_id, owner_text, keep_bitmap) of documents that lose lines.

    Lines of at least `min_documents` documents go, with `keep_first` all but the first.
    The bitmap is zlib over bits, most significant first: 0 for a dropped line. Lines
    after its last 0 are kept.
    """
    spark = docs.sparkSession
    ship(spark)
    lines = written(
        _owners(docs, id_column, text_column).mapInArrow(
            _keyed_lines(min_chars), "h1 long, h2 long, owner_id long, owner_text long, position long"
        )
    )
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = written(
        lines.repartitionByRange(partitions, *KEY, *OWNER)
        .sortWithinPartitions(*KEY, *OWNER, "position")
        .mapInArrow(_stream_runs(min_documents, keep_first), FOUND_DDL)
    )
    totals = (
        found.where("kind = 1").groupBy(*KEY).agg(F.sum("documents").alias("total")).where(F.col("total") >= min_documents)
    )
    late = found.where("kind = 2").join(totals, KEY, "left_semi")
    dropped = found.where("kind = 0").select(*OWNER, "position").union(late.select(*OWNER, "position"))
    if keep_first:
        line = F.struct(*OWNER, "position")
        firsts = found.where("kind = 3")
        least = firsts.groupBy(*KEY).agg(F.min(line).alias("least")).join(totals, KEY, "left_semi")
        dropped = dropped.union(firsts.join(least, KEY).where(line != F.col("least")).select(*OWNER, "position"))
    return (
        dropped.groupBy(*OWNER)
        .agg(F.collect_set("position").alias("positions"))
        .mapInArrow(_bitmaps, "owner_id long, owner_text long, keep_bitmap binary")
    )


def with_bitmaps(docs, bitmaps, id_column="doc_id", text_column="text"):
    """The documents, all their columns, and their bitmap (null: keeps every line)."""
    own_id, own_text, keep = free_names(docs, "_pl_id", "_pl_text", "_pl_keep")
    keyed = docs.withColumns(
        {own_id: F.coalesce(F.col(id_column).cast("long"), F.lit(-(2**63))), own_text: F.xxhash64(text_column)}
    )
    right = bitmaps.select(
        F.col("owner_id").alias(own_id), F.col("owner_text").alias(own_text), F.col("keep_bitmap").alias(keep)
    )
    return keyed.join(right, [own_id, own_text], "left").drop(own_id, own_text)


def surviving_lines(text, bitmap):
    """(lines before, kept lines) of one text."""
    found = (text or "").split("\n")
    if bitmap is None:
        return len(found), found
    bits = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8))
    return len(found), [line for k, line in enumerate(found) if k >= len(bits) or bits[k]]


def deduped(docs, min_documents=10, min_chars=1, id_column="doc_id", text_column="text", keep_first=False):
    """The documents with the dropped lines gone from their text; other columns as they are."""
    bitmaps = keep_bitmaps(docs, min_documents, min_chars, id_column, text_column, keep_first)
    marked = with_bitmaps(docs, bitmaps, id_column, text_column)
    where, names = docs.columns.index(text_column), docs.columns

    def run(batches):
        for batch in batches:
            bitmaps = batch.column(batch.num_columns - 1)
            texts = batch.column(where)
            new = [
                text.as_py() if not keep.is_valid else "\n".join(surviving_lines(text.as_py(), keep.as_py())[1])
                for text, keep in zip(texts, bitmaps)
            ]
            columns = batch.columns[:-1]
            columns[where] = pa.array(new, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = docs.schema
    return marked.mapInArrow(run, schema)
