"""Best-fit packing of texts into bins of a fixed number of words, without conflicts.

No bin holds two pieces of one source or of one duplicate cluster. Whole bins are cut off
long texts first; the rest of each text is one item, so nothing is dropped or shortened.
Items are dealt over cells by a hash, which spreads every source and cluster evenly; the
number of cells follows the number of rows, so a cell has about `CELL` items at any size.
Within a cell, sorted from large to small, an item goes to the tightest bin that takes it:
open bins are ordered by residual, a bin carries bitmaps of its sources and clusters, and
from the least sufficient residual the search goes on to the successor until a bin is
compatible. If none is, a new bin opens.

Sizes count words (runs other than white space). Clusters are texts that are equal after
lower-casing A to Z and splitting at white space, unless a cluster column is given.

Defined results: a null or empty text is an item of size 0 and gets a place like any
other; a null source is a source like any other; repeated rows are items of their own and
share a cluster; an empty table gives an empty table.
"""

from bisect import bisect_left, insort

import pyarrow as pa
from pyspark.sql import functions as F

from paperloom.llm import arrays
from paperloom.llm.runtime import ship, written

CAPACITY, CELL = 2048, 4096
PLACE_DDL = "doc_id long, piece long, first_word long, n_words long, bin_id string, bin_offset long"


class Bins:
    """The open bins of one cell."""

    def __init__(self, capacity):
        self.capacity = capacity
        self.by_residual = []  # (residual, bin), ascending
        self.sources = []
        self.clusters = []

    def place(self, size, source_bit, cluster_bit):
        """(bin, offset) for an item; opens a bin when no bin is compatible."""
        at = bisect_left(self.by_residual, (size, -1))
        while at < len(self.by_residual):
            residual, found = self.by_residual[at]
            if not (self.sources[found] & source_bit or self.clusters[found] & cluster_bit):
                del self.by_residual[at]
                break
            at += 1
        else:
            residual, found = self.capacity, len(self.sources)
            self.sources.append(0)
            self.clusters.append(0)
        self.sources[found] |= source_bit
        self.clusters[found] |= cluster_bit
        insort(self.by_residual, (residual - size, found))
        return found, self.capacity - residual


def _sizes(batches):
    """Words and a 64-bit hash of the folded words of each text."""
    for batch in batches:
        for chunk in arrays.chunks(batch.column(0)):
            found = arrays.words(chunk)
            hashes = arrays.FIRST.of_bytes(arrays.LOWER[chunk.data], found.starts, found.ends)
            whole = arrays.SECOND.of_runs(hashes, found.first[:-1], found.first[1:])
            rest = [c.slice(chunk.first_row, chunk.rows) for c in batch.columns[1:]]
            size = pa.array(found.first[1:] - found.first[:-1], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*rest, size, pa.array(arrays.signed(whole))], names=[*batch.schema.names[1:], "size", "same"]
            )


def _pack(capacity):
    """Over rows sorted by cell and descending rest."""

    def run(batches):
        cell = bins = None
        source_bits, cluster_bits = {}, {}
        for batch in batches:
            out = []
            for number, doc_id, size, rest, source, cluster in zip(*[c.to_pylist() for c in batch.columns]):
                if number != cell:
                    cell, bins, source_bits, cluster_bits = number, Bins(capacity), {}, {}
                full = size // capacity
                if rest or not size:
                    source_bit = 1 << source_bits.setdefault(source, len(source_bits))
                    cluster_bit = 1 << cluster_bits.setdefault(cluster, len(cluster_bits))
                    found, offset = bins.place(rest, source_bit, cluster_bit)
                    out.append((doc_id, full, full * capacity, rest, f"{cell}-{found}", offset))
            names = PLACE_DDL.replace(" long", "").replace(" string", "").split(", ")
            columns = list(zip(*out)) or [[]] * 6
            kinds = [pa.int64()] * 4 + [pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return run


def packed(docs, capacity=CAPACITY, cell=CELL, id_column="doc_id", text_column="text", source_column="source",
           cluster_column=None):
    """One row for each piece: its words, its bin and where in the bin it begins."""
    ship(docs.sparkSession)
    carried = [F.col(id_column).cast("long").alias("doc_id"), F.col(source_column).cast("string").alias("source")]
    ddl = "doc_id long, source string, "
    if cluster_column:
        carried.append(F.col(cluster_column).cast("string").alias("cluster"))
        ddl += "cluster string, "
    items = docs.select(F.col(text_column).cast("string").alias("_pl_text"), *carried).mapInArrow(
        _sizes, ddl + "size long, same long"
    )
    if not cluster_column:
        items = items.withColumn("cluster", F.col("same").cast("string"))
    items = written(items)
    cells = max(1, -(-items.count() // cell))
    dealt = items.select(
        F.pmod(F.xxhash64("doc_id", "same", "source"), F.lit(cells)).alias("cell"),
        "doc_id",
        "size",
        (F.col("size") % capacity).alias("rest"),
        F.coalesce("source", F.lit("\x00null")).alias("source"),
        F.coalesce("cluster", F.lit("\x00null")).alias("cluster"),
    )
    rests = (
        dealt.repartition("cell")
        .sortWithinPartitions("cell", F.desc("rest"), "doc_id", "source", "cluster", "size")
        .mapInArrow(_pack(capacity), PLACE_DDL)
    )
    full = items.where(F.col("size") >= capacity).select(
        "doc_id",
        "same",
        "source",
        F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("size") / capacity) - 1)).alias("piece"),
    )
    whole_bins = full.select(
        "doc_id",
        "piece",
        (F.col("piece") * capacity).alias("first_word"),
        F.lit(capacity).cast("long").alias("n_words"),
        F.concat_ws("-", F.lit("full"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.col("piece")).alias("bin_id"),
        F.lit(0).cast("long").alias("bin_offset"),
    )
    return rests.union(whole_bins)
