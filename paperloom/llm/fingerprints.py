"""Document fingerprints: a Merkle tree over the sections and paragraphs of a text.

Paragraphs are the leaves: text pieces that end with a line break, a sentence's end or, in
long sentences, the first word's end after 64 bytes.
A section closes after a paragraph whose own hash says so (one in eight on average), so
borders depend on content alone and an insertion moves no later border. A section's hash
covers its paragraphs' hashes, the root the sections' hashes and the length.

Written as text: the root in 32 hex digits, then for every section "/", its 8 digits, ":"
and 8 digits for each paragraph. Equal texts have equal fingerprints; unequal texts have
unequal roots (128 bits). `likeness` compares two of them: equal roots give 1; otherwise
equal sections count as a whole and only sections that differ are opened, which is also
how `differing` finds the edited places.

Defined results: a null text is the empty text, whose tree has no section; the next
document of the last one is the first, of a single one itself; rows with equal ids follow
each other by text; a null id comes before all ids; an empty table gives an empty table.
"""

import hashlib
import re
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from paperloom.llm.runtime import ship

_PIECE = re.compile(rb"[^\n.!?]{0,64}[^\n.!? ]*(?:[.!?]+[ \t]*\n?|\n| |$)")
_SECTION_ENDS = set("02")  # two of sixteen first hex digits


def _digest(data, size):
    return hashlib.blake2b(data, digest_size=size).hexdigest()


def fingerprint(data):
    """The Merkle tree of a text's bytes."""
    sections, leaves = [], []
    for piece in _PIECE.findall(data):
        if not piece:
            continue
        leaf = _digest(piece, 4)
        leaves.append(leaf)
        if leaf[0] in _SECTION_ENDS:
            sections.append(leaves)
            leaves = []
    if leaves:
        sections.append(leaves)
    tree = "".join(
        "/" + _digest("".join(leaves).encode(), 4) + ":" + "".join(leaves) for leaves in sections
    )
    whole = hashlib.sha256(data).hexdigest()
    return _digest(f"{len(data)}{whole}{tree}".encode(), 16) + tree


def _sections(mark):
    return [(part[:8], [part[i : i + 8] for i in range(9, len(part), 8)]) for part in mark.split("/")[1:]]


def likeness(one, other):
    """Shared paragraphs, as a share of both texts' paragraphs (0 to 1)."""
    if one == other:
        return 1.0
    if one[:32] == other[:32]:
        return 1.0
    left, right = _sections(one), _sections(other)
    total = sum(len(leaves) for _, leaves in left) + sum(len(leaves) for _, leaves in right)
    if not total:
        return 0.0
    ours = Counter(mark for mark, _ in left)
    both = ours & Counter(mark for mark, _ in right)
    shared, open_left, open_right = 0, Counter(), Counter()
    for side, seen, rest in ((left, both.copy(), open_left), (right, both.copy(), open_right)):
        for mark, leaves in side:
            if seen[mark]:
                seen[mark] -= 1
                shared += len(leaves)
            else:
                rest.update(leaves)
    shared += 2 * sum((open_left & open_right).values())
    return shared / total


def differing(one, other):
    """Numbers of the first text's paragraphs that the second one does not have."""
    if one[:32] == other[:32]:
        return []
    theirs = _sections(other)
    marks = Counter(mark for mark, _ in theirs)
    leaves_there = Counter(leaf for _, leaves in theirs for leaf in leaves)
    found, at = [], 0
    for mark, leaves in _sections(one):
        if marks[mark]:
            marks[mark] -= 1
        else:
            found.extend(at + k for k, leaf in enumerate(leaves) if not leaves_there[leaf])
        at += len(leaves)
    return found


def fingerprints(docs, id_column="doc_id", text_column="text"):
    """(id, fingerprint) of every row."""
    ship(docs.sparkSession)

    def run(batches):
        for batch in batches:
            marks = [fingerprint((text.as_py() or "").encode()) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(marks)], names=["doc_id", "fingerprint"])

    return docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string")).mapInArrow(
        run, "doc_id long, fingerprint string"
    )


def in_order(docs, id_column="doc_id", text_column="text"):
    """Rows (range, doc_id, text, guest) so that within a range each row's next one follows.

    Ranges of ids are dealt over the partitions and sorted. The rows of a range's least
    id go to the range before as well, as guests at its end, so that only one shuffle of
    the text is needed. The driver holds one border for each range, their number being
    four times the shuffle partitions.
    """
    spark = docs.sparkSession
    ship(spark)
    ids = docs.select(F.coalesce(F.col(id_column).cast("long"), F.lit(-(2**63))).alias("id"))
    count = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = ids.approxQuantile("id", [k / count for k in range(1, count)], 0.25 / count)
    cuts = np.array(sorted({int(cut) for cut in found}), np.int64)

    @F.pandas_udf("int")
    def own_range(id_: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, id_.to_numpy(), "right").astype(np.int32))

    firsts = ids.groupBy(own_range("id").alias("range")).agg(F.min("id").alias("first")).orderBy("range").collect()
    numbers = np.array([row["range"] for row in firsts], np.int32)
    least = np.array([row["first"] for row in firsts], np.int64)

    @F.pandas_udf("int")
    def range_before(id_: pd.Series) -> pd.Series:
        """Of a range's least id, the range before (of the very first, the last); else -1."""
        at = np.minimum(np.searchsorted(least, id_.to_numpy()), len(least) - 1)
        return pd.Series(np.where(least[at] == id_.to_numpy(), np.roll(numbers, 1)[at], np.int32(-1)))

    rows = docs.select(
        F.coalesce(F.col(id_column).cast("long"), F.lit(-(2**63))).alias("id"),
        F.col(id_column).cast("long").alias("doc_id"),
        F.col(text_column).cast("string").alias("text"),
    )
    places = F.filter(
        F.array(
            F.struct(F.col("own").alias("range"), F.lit(False).alias("guest")),
            F.struct(F.col("before").alias("range"), F.lit(True).alias("guest")),
        ),
        lambda place: place["range"] >= 0,
    )
    return (
        rows.withColumns({"own": own_range("id"), "before": range_before("id")})
        .select("id", "doc_id", "text", F.explode(places).alias("place"))
        .select("place.range", "id", "doc_id", "text", "place.guest")
        .repartition("range")
        .sortWithinPartitions("range", "guest", "id", "text")
    )


def with_next(docs, handle, schema, id_column="doc_id", text_column="text"):
    """Apply `handle(text, mark, next_text, next_mark)` to each row in id order.

    It returns the values of the columns after doc_id in `schema`.
    """
    ship(docs.sparkSession)
    arrow = to_arrow_schema(StructType.fromDDL(schema))
    names = arrow.names

    def run(batches):
        held = None  # the row whose next one is not known yet: range, id, text, mark
        out = []

        def flush():
            batch = pa.RecordBatch.from_pylist([dict(zip(names, row)) for row in out], schema=arrow)
            out.clear()
            return batch

        for batch in batches:
            for number, doc_id, text, guest in zip(*[batch.column(i) for i in (0, 2, 3, 4)]):
                number, guest = number.as_py(), guest.as_py()
                if guest and held is None:
                    continue
                text = text.as_py() or ""
                mark = fingerprint(text.encode())
                if held is not None and held[0] == number:
                    out.append((held[1], *handle(held[2], held[3], text, mark)))
                held = None if guest else (number, doc_id.as_py(), text, mark)
            yield flush()

    ordered = in_order(docs, id_column, text_column)
    return ordered.mapInArrow(run, schema)
