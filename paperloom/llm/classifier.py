"""Quality classifier: logistic regression over hashed word n-grams, trained by FTRL.

Features are runs of one and two words, folded, and runs of one and two word forms (case,
first and last character, length, same as the word before), hashed into `2^BITS` buckets.
A feature's value is its share of the text's runs, so length alone says nothing.

Training takes a bounded sample: the `SAMPLE` labelled rows whose id hashes lowest. They
are dealt over `SHARDS` groups, each group runs follow-the-regularised-leader updates of
its own, and the weights are averaged, so the driver sees at most `2^BITS` weights
whatever the size of the corpus. Scores are sparse dot products over whole texts.

Defined results: a null or empty text has no features and scores the bias; labels without
id or quality are ignored, of several labels of one id the least counts; repeated rows
score alike; without any label every score is 0.5; an empty table gives an empty table.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from paperloom.llm import arrays
from paperloom.llm.runtime import ship

BITS, SAMPLE, SHARDS, EPOCHS = 18, 16_384, 8, 3
ALPHA, BETA, L1, L2 = 1.0, 1.0, 0.0, 1e-4
SCALE = 16.0
SIZE = 1 << BITS
DECISION = 0.3

_KIND = np.zeros(256, np.uint64)
_KIND[ord("a") : ord("z") + 1] = 1
_KIND[ord("A") : ord("Z") + 1] = 2
_KIND[ord("0") : ord("9") + 1] = 3
_KIND[128:] = 4
for _mark in b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~":
    _KIND[_mark] = _mark


def _forms(chunk, found, hashes):
    """A number for each word that tells how it looks, not which word it is."""
    upper = np.concatenate([[0], np.cumsum(_KIND[chunk.data] == 2)])
    size = found.ends - found.starts
    capitals = upper[found.ends] - upper[found.starts]
    again = np.zeros(len(size), np.uint64)
    again[1:] = (hashes[1:] == hashes[:-1]) & (found.row[1:] == found.row[:-1])
    form = _KIND[chunk.data[found.starts]]
    for part in (
        _KIND[chunk.data[found.ends - 1]],
        _KIND[chunk.data[np.maximum(found.ends - 2, found.starts)]],
        (2 * capitals > size).astype(np.uint64),
        np.minimum(np.log2(size + 1).astype(np.uint64), np.uint64(5)),
        again,
    ):
        form = form * np.uint64(131) + part
    return arrays.mix(form + np.uint64(0xF0))


def features(chunk):
    """(row, bucket, value) of every run; buckets repeat."""
    found = arrays.words(chunk)
    rows, buckets, values = [], [], []
    if len(found.starts):
        hashes = arrays.FIRST.of_bytes(arrays.LOWER[chunk.data], found.starts, found.ends)
        forms = _forms(chunk, found, hashes)
        for width in (1, 2):
            starts = arrays.runs(found, width)
            row = found.row[starts]
            share = SCALE / np.maximum(np.bincount(row, minlength=chunk.rows), 1)[row]
            for source in (hashes, forms):
                rows.append(row)
                buckets.append(
                    (arrays.FIRST.of_runs(source, starts, starts + width) & np.uint64(SIZE - 1)).astype(np.int64)
                )
                values.append(share)
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return np.concatenate(rows), np.concatenate(buckets), np.concatenate(values)


class Ftrl:
    """Follow the regularised leader, with a learning rate for each weight; the last is the bias."""

    def __init__(self):
        self.z = np.zeros(SIZE + 1)
        self.n = np.zeros(SIZE + 1)

    def weights(self, at):
        z = self.z[at]
        w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(self.n[at])) / ALPHA + L2)
        return np.where(np.abs(z) <= L1, 0.0, w)

    def learn(self, at, values, label):
        w = self.weights(at)
        guess = 1 / (1 + np.exp(-np.clip(w @ values, -35, 35)))
        slope = (guess - label) * values
        n = self.n[at]
        self.z[at] += slope - (np.sqrt(n + slope * slope) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + slope * slope


def _train(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values(["place", "doc_id", "text"])
    examples = []
    for text, label in zip(rows["text"], rows["quality"]):
        for chunk in arrays.chunks(pa.array([text], pa.string())):
            _, buckets, values = features(chunk)
            at, inverse = np.unique(buckets, return_inverse=True)
            sums = np.bincount(inverse, values, len(at)) if len(at) else np.zeros(0)
            examples.append((np.append(at, SIZE), np.append(sums, 1.0), float(label)))
    model = Ftrl()
    for _ in range(EPOCHS):
        for example in examples:
            model.learn(*example)
    at = np.flatnonzero(model.n)
    return pd.DataFrame({"bucket": at, "weight": model.weights(at)})


def crc_of_id(column):
    return F.crc32(F.col(column).cast("string").cast("binary"))


def trained(docs, labels, sample=SAMPLE):
    """The weights, as an array whose last entry is the bias."""
    spark = docs.sparkSession
    ship(spark)
    known = labels.where("doc_id is not null and quality is not null")
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("quality"))
    known = known.withColumn("place", F.xxhash64("doc_id")).orderBy("place", "doc_id").limit(sample)
    # bounded by `sample` rows of three numbers
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).join(
        F.broadcast(known), "doc_id"
    )
    shards = rows.withColumn("shard", F.pmod("place", F.lit(SHARDS)))
    found = (
        shards.groupBy("shard")
        .applyInPandas(lambda part: _train(part), "bucket long, weight double")
        .groupBy("bucket")
        .agg(F.sum("weight").alias("weight"))
        .toPandas()
    )
    weights = np.zeros(SIZE + 1)
    weights[found["bucket"].to_numpy(np.int64)] = found["weight"].to_numpy(float) / SHARDS
    return weights


def _scores(weights, where):
    def run(batches):
        for batch in batches:
            parts = [np.zeros(0)]
            for chunk in arrays.chunks(batch.column(where)):
                row, buckets, values = features(chunk)
                order = np.argsort(row, kind="stable")
                terms = (weights[buckets] * values)[order]
                first = np.searchsorted(row[order], np.arange(chunk.rows))
                total = np.add.reduceat(np.append(terms, 0.0), first)
                total[np.bincount(row, minlength=chunk.rows) == 0] = 0.0
                parts.append(np.round(1 / (1 + np.exp(-(total + weights[SIZE]))), 6))
            scores = pa.array(np.concatenate(parts), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], names=[*batch.schema.names, "_pl_score"])

    return run


def scored(docs, weights, text_column="text"):
    """The rows with all columns, and `_pl_score` last; an input column of that name is replaced."""
    ship(docs.sparkSession)
    docs = docs.drop("_pl_score")
    schema = StructType([*docs.schema.fields, StructField("_pl_score", DoubleType())])
    return docs.mapInArrow(_scores(weights, docs.columns.index(text_column)), schema)
