"""Embedding whitening by an exact characteristic polynomial.

Entries become integers, so the scatter of the distinct vectors, n * sum(x x') - S S', is a
matrix of integers and known exactly: tasks add their parts, Spark adds the tasks'. It is
n * n times the covariance, centred before anything is rounded. The polynomial of the
scatter is found modulo many primes, each by reduction to Hessenberg form in a task, and
put together by Chinese remainders. Its real roots are isolated by counting and narrowed to
`SCALE` binary places; zero roots are exact and have no component. Null spaces of the
scatter less a root, by inverse iteration in 192-bit fixed point, one task for each root or
repeated root, are the components. What is kept on the driver is bounded by the square of
the dimension, whatever the number of rows.

Defined results: rows whose vector is null or holds null, NaN or infinite entries are left
out. So are rows whose vector is not of the commonest length (ties: the longest). Entries
that no long can hold become the nearest long. Only components with a variance above zero
can be whitened, so equal vectors give no rows at all; neither do empty vectors or tables.
Of equal ids each row has its own result. A deviation that no long can hold is null. Only
the id and the vector of the input are read; other columns do not matter.
"""

import math
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperloom.llm import exact
from paperloom.llm.runtime import ship, written

STEPS, SHIFT = 64, 1_000_000
SCALE = 64
_LIMB = 60
_SAFE = 1 << 53


def _entries(column):
    """(rows to keep, their values as a flat array, their lengths) of a list column."""
    valid = np.array(column.is_valid())
    lists = column.filter(pa.array(valid))
    lengths = np.array(lists.value_lengths(), dtype=np.int64)
    flat = lists.flatten()
    values = flat.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
    owners = np.repeat(np.arange(len(lengths)), lengths)
    bad = np.zeros(len(lengths), bool)
    bad[owners[~np.isfinite(values)]] = True
    keep = np.flatnonzero(valid)[~bad]
    return keep, values[~bad[owners]], lengths[~bad]


def quantized(values):
    """floor(64 * value) + 1,000,000 as longs; what is beyond a long becomes the nearest."""
    scaled = np.floor(values * float(STEPS))
    inside = np.abs(scaled) < 2.0**62
    found = np.where(inside, scaled, 0).astype(np.int64) + SHIFT
    limits = np.iinfo(np.int64)
    return np.where(inside, found, np.where(scaled > 0, limits.max, limits.min))


def _quantize(batches):
    for batch in batches:
        keep, values, lengths = _entries(batch.column(1))
        with np.errstate(over="ignore"):
            x = quantized(values)
        offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(keep)), pa.ListArray.from_arrays(offsets, x)], names=["vec_id", "x"]
        )


def _matrix(column, size):
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def exact_gram(y):
    """y' y of a matrix of longs, as Python integers."""
    if not y.size:
        return np.zeros((y.shape[1], y.shape[1]), dtype=object)
    largest = max(abs(int(y.min())), abs(int(y.max())))
    if len(y) * largest * largest < _SAFE:
        small = y.astype(np.float64)
        return (small.T @ small).astype(np.int64).astype(object)
    if largest < 1 << 25 and len(y) > 1:
        half = len(y) // 2
        return exact_gram(y[:half]) + exact_gram(y[half:])
    wide = y.astype(object)
    return wide.T @ wide


def _parts(size):
    """Rows (i, j, high, low): sums of products, with j = -1 sums, with i = -1 the count."""

    def run(batches):
        n, sums, gram = 0, np.zeros(size, dtype=object), np.zeros((size, size), dtype=object)
        for batch in batches:
            x = _matrix(batch.column(0), size)
            y = x - SHIFT if x.size == 0 or x.min() > np.iinfo(np.int64).min + SHIFT else x.astype(object) - SHIFT
            n += len(y)
            sums = sums + (y.astype(object).sum(axis=0) if len(y) else 0)
            gram = gram + (exact_gram(y) if y.dtype != object else y.T @ y)
        if not n:
            return
        cells = [(-1, -1, n), *((i, -1, int(sums[i])) for i in range(size))]
        cells += [(i, j, int(gram[i, j])) for i in range(size) for j in range(i + 1)]
        limb = lambda v: Decimal(v)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([c[0] for c in cells], pa.int32()),
                pa.array([c[1] for c in cells], pa.int32()),
                pa.array([limb(c[2] >> _LIMB) for c in cells], pa.decimal128(38, 0)),
                pa.array([limb(c[2] & ((1 << _LIMB) - 1)) for c in cells], pa.decimal128(38, 0)),
            ],
            names=["i", "j", "high", "low"],
        )

    return run


def scatter_of(fit, size):
    """(n, sums, scatter) of the distinct vectors less SHIFT, exactly."""
    parts = fit.mapInArrow(_parts(size), "i int, j int, high decimal(38,0), low decimal(38,0)")
    total = parts.groupBy("i", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low"))
    n, sums, gram = 0, [0] * size, [[0] * size for _ in range(size)]
    for row in total.collect():  # (size + 1) * (size + 2) / 2 cells
        value = (int(row["high"]) << _LIMB) + int(row["low"])
        if row["i"] < 0:
            n = value
        elif row["j"] < 0:
            sums[row["i"]] = value
        else:
            gram[row["i"]][row["j"]] = gram[row["j"]][row["i"]] = value
    scatter = [[n * gram[i][j] - sums[i] * sums[j] for j in range(size)] for i in range(size)]
    return n, sums, scatter


def characteristic_polynomial(spark, matrix):
    """Exact coefficients, lowest first; every prime's residues are found in a task."""
    trace = sum(matrix[i][i] for i in range(len(matrix)))
    primes = exact.primes_below(exact.PRIME_LIMIT, exact.primes_needed(len(matrix), trace))

    def run(batches):
        for batch in batches:
            for k in batch.column(0).to_pylist():
                residues = exact.polynomial_mod(matrix, primes[k])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k], pa.int64()), pa.array([residues], pa.list_(pa.int64()))], names=["k", "residues"]
                )

    tasks = min(len(primes), spark.sparkContext.defaultParallelism)
    found = spark.range(0, len(primes), 1, tasks).mapInArrow(run, "k long, residues array<long>").collect()
    by_prime = {row["k"]: row["residues"] for row in found}  # dimension + 1 numbers for each prime
    return exact.remaindered([by_prime[k] for k in range(len(primes))], primes)


def components(spark, matrix, count=16, scale=SCALE):
    """(roots times 2^scale, matrix of unit eigenvectors as columns) of the largest roots above zero."""
    roots = exact.largest_roots(characteristic_polynomial(spark, matrix), count, scale)
    groups = []
    for root in roots:
        if groups and groups[-1][0] - root <= 1:
            groups[-1].append(root)
        else:
            groups.append([root])
    if not groups:
        return [], np.zeros((len(matrix), 0))

    def run(batches):
        for batch in batches:
            for k in batch.column(0).to_pylist():
                vectors = exact.null_vectors(matrix, groups[k][0], len(groups[k]), scale)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k] * len(vectors), pa.int64()), pa.array([list(v) for v in vectors], pa.list_(pa.float64()))],
                    names=["k", "vector"],
                )

    tasks = min(len(groups), spark.sparkContext.defaultParallelism)
    found = spark.range(0, len(groups), 1, tasks).mapInArrow(run, "k long, vector array<double>")
    found = sorted(found.collect(), key=lambda row: row["k"])  # at most `count` vectors
    return roots, np.array([row["vector"] for row in found]).T


def _centred(x, n, sums):
    """n * x - S exactly: as longs where they fit, else as Python integers."""
    largest = max(abs(int(x.min())), abs(int(x.max()))) + SHIFT if x.size else 0
    if (n * largest + max(map(abs, sums), default=0)) < 1 << 62:
        return n * (x - SHIFT) - np.array(sums, dtype=np.int64)
    return n * (x.astype(object) - SHIFT) - np.array(sums, dtype=object)


def _deviations(centred, size):
    if not centred.size:
        return []
    largest = int(max(abs(centred.min()), abs(centred.max())))
    if centred.dtype != object and size * largest * largest < 1 << 63:
        return (centred * centred).sum(axis=1).tolist()
    return [v if v < 1 << 63 else None for v in (centred.astype(object) ** 2).sum(axis=1).tolist()]


def whitened(vectors, count=16, id_column="vec_id", vector_column="embedding"):
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of every row left."""
    spark = vectors.sparkSession
    ship(spark)
    id_type = vectors.select(id_column).schema[0].dataType
    out = T.StructType(
        [
            T.StructField("vec_id", id_type),
            *T.StructType.fromDDL("component int, n long, deviation long, whitened double, explained double").fields,
        ]
    )
    source = vectors.select(F.col(id_column).alias("vec_id"), F.col(vector_column).alias("vector"))
    schema = T.StructType([T.StructField("vec_id", id_type), *T.StructType.fromDDL("x array<long>").fields])
    rows = source.mapInArrow(_quantize, schema).withColumn("size", F.size("x"))
    lengths = rows.groupBy("size").agg(F.count("*").alias("rows"))
    commonest = lengths.orderBy(F.col("rows").desc(), F.col("size").desc()).first()
    size = commonest["size"] if commonest is not None else 0
    rows = rows.where(F.col("size") == size)
    if not size:
        return spark.createDataFrame([], out).withColumn("identity_error", F.lit(None).cast("double"))
    fit = written(rows.select("x").distinct())
    n, sums, scatter = scatter_of(fit, size)
    roots, vectors_ = components(spark, scatter, count)
    trace = sum(scatter[i][i] for i in range(size))
    deviations = [math.sqrt(root / (n * n << SCALE)) for root in roots]
    explained = [root / (trace << SCALE) for root in roots]
    project = vectors_ / np.array(deviations) / n

    def whiten(x):
        centred = _centred(x, n, sums)
        return centred, centred.astype(np.float64) @ project

    def moments(batches):
        total, square, seen = np.zeros(len(roots)), np.zeros((len(roots), len(roots))), False
        for batch in batches:
            _, z = whiten(_matrix(batch.column(0), size))
            total, square, seen = total + z.sum(axis=0), square + z.T @ z, True
        if seen:
            cells = [(i, -1, total[i]) for i in range(len(roots))]
            cells += [(i, j, square[i, j]) for i in range(len(roots)) for j in range(i + 1)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([c[k] for c in cells], kind) for k, kind in enumerate((pa.int32(), pa.int32(), pa.float64()))],
                names=["i", "j", "value"],
            )

    summed = fit.mapInArrow(moments, "i int, j int, value double").groupBy("i", "j").agg(F.sum("value").alias("value"))
    cell = {(row["i"], row["j"]): row["value"] / n for row in summed.collect()}  # count * (count + 3) / 2 cells
    error = max(
        (abs(v - cell[i, -1] * cell[j, -1] - (i == j)) for (i, j), v in cell.items() if j >= 0),
        default=None,
    )

    def run(batches):
        k = len(roots)
        for batch in batches:
            x = _matrix(batch.column(1), size)
            if not k or not len(x):
                continue
            centred, z = whiten(x)
            deviation = pa.array(_deviations(centred, size), pa.int64())
            each = pa.array(np.repeat(np.arange(len(x)), k))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(each),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(x) * k, n, np.int64)),
                    deviation.take(each),
                    pa.array(z.reshape(-1)),
                    pa.array(np.tile(np.array(explained, dtype=np.float64), len(x))),
                ],
                schema=None,
                names=["vec_id", "component", "n", "deviation", "whitened", "explained"],
            )

    found = rows.select("vec_id", "x").mapInArrow(run, out)
    return found.withColumn("identity_error", F.lit(error).cast("double"))
