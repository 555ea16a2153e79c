"""MinHash near-dedup by fast similarity sketching.

A document's set holds its distinct word shingles as 64-bit hashes. A sketch has
`COORDINATES` bins. In round i each shingle is thrown into one hashed bin with a hashed
value, higher rounds having higher values; after as many rounds as bins, round i throws
every shingle into bin i - `COORDINATES`, so every coordinate is filled whatever the set's
size. Bins keep their minimum. Most documents need two or three rounds, not one for each
coordinate, and the share of equal coordinates is concentrated around the similarity.

Equal sets are merged to one class first (partial aggregation), so copies never meet
pairwise. Classes that agree on a band of the sketch share a bucket. Each member is
compared with the bucket's least and greatest class, on full sets; what that links is
closed to components. What is left are buckets of four and more members in different
components. The members of such buckets with the same largest component form a group, and
a group has a reference: the shingles that most of five of its members hold. A member is
told by its differences from the reference, which are few in a group of near copies. Two
members with D1 and D2 differences, C of them common, are D1 + D2 - 2C shingles apart, so
the limit says how many differences a link needs in common, whatever else the texts hold.
Members that differ so little that none is needed are all linked with the nearest member
of the group, and are compared with that one only. For the others each of the differences
that could be the first common one is an index key (the need of a member gives their
number). Members that share a key leave the join only if their parity sketches allow a
link: the bits in which two of them differ never outnumber the shingles in which the sets
do. What leaves it is confirmed on full sets. Members of the largest component are looked
up but never look for each other. No link is lost, and a group of near copies is not
compared pair by pair: its shared text is in the reference.

Defined results: words are split at white space and A to Z lower-cased; with fewer words
than a shingle takes, the whole sequence is the one shingle; without words (null text too)
a document has an empty set and is linked with nothing. Rows that share an id share a
component. A row without id is in no component: its component is null and it is kept.
"""

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from paperloom.llm import arrays
from paperloom.llm.components import connected
from paperloom.llm.runtime import free_names, ship, written

COORDINATES, SAMPLED = 128, 5
PARITY_WORDS, SALTS = 8, 16
_SEEDS = arrays.mix(np.arange(1, 2 * COORDINATES + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))


def shingle_sets(chunk, width):
    """(row, hash) of the distinct shingles of a chunk, sorted by row and hash."""
    found = arrays.words(chunk)
    hashes = arrays.FIRST.of_bytes(arrays.LOWER[chunk.data], found.starts, found.ends)
    starts = arrays.runs(found, width)
    values, owners = arrays.FIRST.of_runs(hashes, starts, starts + width), found.row[starts]
    size = np.diff(found.first)
    short = np.flatnonzero((size > 0) & (size < width))
    if len(short):
        whole = arrays.FIRST.of_runs(hashes, found.first[short], found.first[short + 1])
        values, owners = np.concatenate([values, whole]), np.concatenate([owners, short])
    order = np.lexsort((values, owners))
    values, owners = values[order], owners[order]
    fresh = np.ones(len(values), bool)
    fresh[1:] = (values[1:] != values[:-1]) | (owners[1:] != owners[:-1])
    return owners[fresh], values[fresh]


def sketch(owners, values, rows):
    """A (rows, COORDINATES) array; rows without elements keep the greatest value."""
    bins = np.full(rows * COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    open_rows = np.zeros(rows, bool)
    open_rows[owners] = True
    for turn in range(2 * COORDINATES):
        active = open_rows[owners]
        if not active.all():
            owners, values = owners[active], values[active]
        if not len(owners):
            break
        thrown = arrays.mix(values ^ _SEEDS[turn])
        slot = (thrown % np.uint64(COORDINATES)).astype(np.int64) if turn < COORDINATES else turn - COORDINATES
        value = (np.uint64(turn) << np.uint64(56)) | (thrown >> np.uint64(8))
        np.minimum.at(bins, owners * COORDINATES + slot, value)
        still = np.flatnonzero(open_rows)
        full = bins.reshape(rows, COORDINATES)[still].max(axis=1) < np.iinfo(np.uint64).max
        open_rows[still[full]] = False
    return bins.reshape(rows, COORDINATES)


def _sums(values, first):
    """Sum of each row's values (mod 2^64); rows may be empty."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values)])
    return total[first[1:]] - total[first[:-1]]


def _sketches(width, band_rows):
    bands = COORDINATES // band_rows

    def run(batches):
        for batch in batches:
            for chunk in arrays.chunks(batch.column(2)):
                owners, values = shingle_sets(chunk, width)
                first = np.searchsorted(owners, np.arange(chunk.rows + 1))
                same_set = np.stack(
                    [_sums(arrays.mix(values), first), _sums(arrays.mix(values ^ _SEEDS[0]), first)], axis=1
                )
                bins = sketch(owners, values, chunk.rows)[:, : bands * band_rows].reshape(-1, band_rows)
                keys = np.zeros(len(bins), np.uint64)
                for c in range(band_rows):
                    keys = arrays.mix(keys ^ bins[:, c])
                keys = arrays.mix(keys + np.tile(_SEEDS[:bands], chunk.rows))
                ids = [batch.column(i).slice(chunk.first_row, chunk.rows) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays(
                    [
                        *ids,
                        pa.array(np.diff(first), pa.int64()),
                        pa.array([row.tobytes() for row in same_set], pa.binary()),
                        pa.ListArray.from_arrays(
                            np.arange(chunk.rows + 1, dtype=np.int32) * bands, arrays.signed(keys)
                        ),
                    ],
                    names=["doc_id", "text_hash", "n_shingles", "same_set", "bands"],
                )

    return run


def parity(owners, values, rows):
    """A (rows, PARITY_WORDS) array: each element of a row's set turns one hashed bit over."""
    bits = np.zeros((rows, PARITY_WORDS), np.uint64)
    place = (values >> np.uint64(20)) % np.uint64(64 * PARITY_WORDS)
    word = (place >> np.uint64(6)).astype(np.int64)
    np.bitwise_xor.at(bits, (owners, word), np.uint64(1) << (place & np.uint64(63)))
    return bits


SETS_DDL = "vertex long, shingles array<long>, parity array<long>"


def _sets(width):
    def run(batches):
        for batch in batches:
            for chunk in arrays.chunks(batch.column(1)):
                owners, values = shingle_sets(chunk, width)
                first = np.searchsorted(owners, np.arange(chunk.rows + 1)).astype(np.int32)
                bits = arrays.signed(parity(owners, values, chunk.rows).reshape(-1))
                ends = np.arange(chunk.rows + 1, dtype=np.int32) * PARITY_WORDS
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(chunk.first_row, chunk.rows),
                        pa.ListArray.from_arrays(first, arrays.signed(values)),
                        pa.ListArray.from_arrays(ends, bits),
                    ],
                    names=["vertex", "shingles", "parity"],
                )

    return run


def _confirmed(pairs, sets, percent):
    """The pairs (a, b) whose full sets are alike enough."""
    right = sets.select(F.col("vertex").alias("b"), F.col("shingles").alias("set_b"))
    left = sets.select(F.col("vertex").alias("a"), F.col("shingles").alias("set_a"))
    sized = pairs.join(right, "b").join(left, "a").select("a", "b", "set_a", "set_b")
    na, nb = F.size("set_a"), F.size("set_b")
    near_size = 100 * F.least(na, nb) >= percent * F.greatest(na, nb)
    common = sized.where(near_size).select(
        "a", "b", (na + nb).alias("both"), F.size(F.array_intersect("set_a", "set_b")).alias("common")
    )
    return common.where(100 * F.col("common") >= percent * (F.col("both") - F.col("common"))).select("a", "b")


def _groups(placed):
    """(ref, vertex, root) of buckets whose members are not all compared or linked yet.

    `ref` is the root of the bucket's largest component.
    """
    held = placed.groupBy("bucket", "root").agg(F.count("*").alias("held")).groupBy("bucket")
    open_buckets = held.agg(
        F.sum("held").alias("members"), F.count("*").alias("roots"), F.max(F.struct("held", "root")).alias("largest")
    ).where("roots > 1 and members > 3")
    mixed = open_buckets.select("bucket", F.col("largest.root").alias("ref"))
    return placed.join(mixed, "bucket").select("ref", "vertex", "root").distinct()


def _references(groups, sets):
    """(ref, base): the shingles that most of at most `SAMPLED` members hold."""
    drawn = groups.groupBy("ref").agg(
        F.array_distinct(
            F.array(*[F.min_by("vertex", F.struct(F.xxhash64("vertex", F.lit(i)), "vertex")) for i in range(SAMPLED)])
        ).alias("drawn")
    )
    each = drawn.select("ref", F.size("drawn").alias("of"), F.explode("drawn").alias("vertex")).join(sets, "vertex")
    common = each.select("ref", "of", F.explode("shingles").alias("shingle")).groupBy("ref", "of", "shingle").count()
    return common.where("2 * count > of").groupBy("ref").agg(F.collect_list("shingle").alias("base"))


def _across(groups, sets, percent):
    """Pairs of one group and two components that may be linked; every link is among them."""
    differing = groups.join(sets, "vertex").join(_references(groups, sets), "ref", "left")
    base = F.coalesce("base", F.array().cast("array<long>"))
    more, less = F.array_except("shingles", base), F.array_except(base, "shingles")
    differing = differing.select(
        "ref", "vertex", "root", "parity", F.size("shingles").alias("n"), F.concat(F.array_sort(more), F.array_sort(less)).alias("apart")
    )
    # A link of a and b needs slack_a + slack_b <= 2 * (100 + percent) * common differences.
    slack = (100 + percent) * F.size("apart").cast("long") - (100 - percent) * F.col("n").cast("long")
    differing = written(differing.withColumn("slack", slack))
    nearest = F.min(F.struct("slack", "vertex", "root")).alias("nearest")
    nearest = differing.groupBy("ref").agg(nearest).select("ref", "nearest.*")
    nearest = nearest.toDF("ref", "least_slack", "nearest", "nearest_root")
    # The members of a hot group are dealt over several tasks.
    dealt = differing.withColumn("salt", F.pmod(F.xxhash64("vertex"), F.lit(SALTS)))
    copies = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt")
    told = dealt.join(nearest.select("*", copies), ["ref", "salt"])
    need = F.greatest(F.lit(1), F.ceil((F.col("slack") + F.col("least_slack")) / (2.0 * (100 + percent))))
    keys = F.greatest(F.lit(0), F.size("apart") - need + 1).cast("int")
    listed = written(
        told.select("ref", "vertex", "root", "n", "parity", F.explode(F.slice("apart", F.lit(1), keys)).alias("key"))
    )

    def side(rows, name):
        return rows.select(
            F.col("ref").alias(f"ref_{name}"),
            F.col("key").alias(f"key_{name}"),
            F.col("vertex").alias(name),
            *[F.col(c).alias(f"{c}_{name}") for c in ("root", "n", "parity")],
        )

    asking, asked = side(listed.where("root <> ref"), "a"), side(listed, "b")
    once = (F.col("root_b") == F.col("ref_b")) | (F.col("a") < F.col("b"))
    near_size = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    turned = [F.bit_count(F.col("parity_a")[i].bitwiseXOR(F.col("parity_b")[i])) for i in range(PARITY_WORDS)]
    alike = (100 + percent) * reduce(lambda x, y: x + y, turned) <= (100 - percent) * (F.col("n_a") + F.col("n_b"))
    apart = (F.col("root_a") != F.col("root_b")) & once & near_size & alike
    same = (F.col("ref_a") == F.col("ref_b")) & (F.col("key_a") == F.col("key_b"))
    found = asking.join(asked, same & apart)
    close = told.where("root <> nearest_root").select(F.col("vertex").alias("a"), F.col("nearest").alias("b"))
    both = found.select("a", "b").union(close)
    return both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicates(docs, width=5, percent=80, band_rows=4, id_column="doc_id", text_column="text"):
    """(doc_id, n_shingles, component_id, kept) of every row.

    Links need 100 * common >= percent * union of full sets. With `band_rows` r a pair
    right at the limit is missed by all bands with probability
    (1 - (percent/100)^r)^(128/r): 5e-8 for 80 and 4, 6e-11 for 85 and 4.
    """
    ship(docs.sparkSession)
    source = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.xxhash64(text_column).alias("text_hash"),
        F.col(text_column).cast("string").alias("text"),
    )
    found = written(
        source.mapInArrow(
            _sketches(width, band_rows),
            "doc_id long, text_hash long, n_shingles long, same_set binary, bands array<long>",
        )
    )
    classes = written(
        found.where("doc_id is not null and n_shingles > 0")
        .groupBy("same_set")
        .agg(F.min(F.struct("doc_id", "text_hash")).alias("own"), F.any_value("bands").alias("bands"))
        .select("same_set", "own.*", "bands")
        .withColumnRenamed("doc_id", "vertex")
    )
    members = classes.select("vertex", F.explode("bands").alias("bucket"))
    ends = members.groupBy("bucket").agg(F.min("vertex").alias("low"), F.max("vertex").alias("high"))
    shared = written(members.join(ends.where("low < high"), "bucket"))
    pairs = written(
        shared.select(F.explode(F.array("low", "high")).alias("end"), "vertex")
        .where("end <> vertex")
        .select(F.least("end", "vertex").alias("a"), F.greatest("end", "vertex").alias("b"))
        .distinct()
    )
    needed = shared.select("vertex").distinct().join(classes.select("vertex", "text_hash"), "vertex")
    texts = source.withColumnRenamed("doc_id", "vertex").join(needed, ["vertex", "text_hash"], "left_semi")
    sets = written(
        texts.dropDuplicates(["vertex", "text_hash"])
        .select("vertex", "text")
        .mapInArrow(_sets(width), SETS_DDL)
    )
    links = written(_confirmed(pairs, sets, percent))
    roots = connected(links)

    placed = shared.select("bucket", "vertex").join(roots, "vertex", "left")
    groups = written(_groups(written(placed.withColumn("root", F.coalesce("root", "vertex")))))
    across = _across(groups, sets, percent)
    more = written(_confirmed(across.join(pairs, ["a", "b"], "left_anti"), sets, percent))
    # Components that the new links join, by their roots.
    ends = more.join(roots.select(F.col("vertex").alias("a"), F.col("root").alias("root_a")), "a", "left")
    ends = ends.join(roots.select(F.col("vertex").alias("b"), F.col("root").alias("root_b")), "b", "left")
    joined_roots = connected(ends.select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b")))

    component = classes.select("same_set", "vertex").join(roots, "vertex", "left")
    component = component.select("same_set", F.coalesce("root", "vertex").alias("vertex"))
    component = component.join(joined_roots, "vertex", "left")
    component = component.select("same_set", F.coalesce("root", "vertex").alias("component_id"))
    joined = found.select("doc_id", "n_shingles", "same_set").join(component, "same_set", "left")
    component_id = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    component_id = F.when(F.col("doc_id").isNotNull(), component_id)
    return joined.select("doc_id", "n_shingles", component_id.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def representatives(docs, **options):
    """One document of each group, with all columns; rows without id stay."""
    id_column = options.get("id_column", "doc_id")
    (name,) = free_names(docs, "_pl_gone")
    gone = near_duplicates(docs, **options).where(~F.col("kept")).select(F.col("doc_id").alias(name)).distinct()
    return docs.join(gone, docs[id_column] == gone[name], "left_anti")
