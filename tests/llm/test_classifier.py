import zlib

from fixtures import awkward, awkward_rows, nothing  # noqa: F401
from paperloom.llm import classifier
from paperloom.llm.queries import QUERIES
from pyspark.sql import functions as F

PATH = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    got = QUERIES["op6_quality_classifier"](spark, PATH).collect()
    quality = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{PATH}/labels.parquet").collect()}
    assert len(got) == spark.read.parquet(f"{PATH}/documents.parquet").count()
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert r["predicted"] == (r["score"] >= 0.3) and 0 <= r["score"] <= 1
    judged = [(r["predicted"], quality[r["doc_id"]]) for r in got if r["held_out"] and r["doc_id"] in quality]
    assert len(judged) > 50 and sum(p == q for p, q in judged) >= 0.97 * len(judged)


def test_held_out_labels_teach_nothing(spark, tmp_path):
    """Turning the held-out labels round changes no score."""
    docs = spark.read.parquet(f"{PATH}/documents.parquet").limit(300)
    labels = spark.read.parquet(f"{PATH}/labels.parquet").join(docs.select("doc_id"), "doc_id")
    held = classifier.crc_of_id("doc_id") % 5 == 0
    scores = []
    for name, frame in (("a", labels), ("b", labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality"))))):
        docs.write.parquet(str(tmp_path / name / "documents.parquet"))
        frame.write.parquet(str(tmp_path / name / "labels.parquet"))
        scores.append({r["doc_id"]: r["score"] for r in QUERIES["op6_quality_classifier"](spark, str(tmp_path / name)).collect()})
    assert scores[0] == scores[1]


def test_awkward_rows_without_and_with_labels(spark, awkward, nothing):
    none = spark.createDataFrame([], "doc_id long, quality int")
    some = spark.createDataFrame([(1, 1), (1, 0), (11, 0), (4, 1), (None, 1), (9, None)], "doc_id long, quality int")
    for labels in (none, some):
        weights = classifier.trained(awkward, labels)
        got = classifier.scored(awkward, weights)
        assert got.columns[:-1] == awkward.columns and got.count() == len(awkward_rows())
        empty = {r["_pl_score"] for r in got.collect() if r["doc_id"] in (4, 5, 6)}
        assert len(empty) == 1
        if labels is none:
            assert {r["_pl_score"] for r in got.collect()} == {0.5}
    assert classifier.scored(nothing, weights).count() == 0


def test_the_sample_is_bounded(spark):
    docs = spark.createDataFrame([(k, f"word{k} text", "") for k in range(50)], "doc_id long, text string, x string")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).alias("quality"))
    learned = classifier.trained(docs, labels, sample=10)
    # a document brings at most two words, one pair, and as many forms
    assert 0 < (learned != 0).sum() <= 10 * 6 + 1


def test_updates_equal_plain_follow_the_regularised_leader():
    import math
    import random

    import numpy as np

    rng = random.Random(5)
    c = classifier
    examples = []
    for _ in range(400):
        at = sorted(rng.sample(range(60), rng.randrange(1, 9)))
        examples.append((at, [rng.uniform(0.01, 3) for _ in at], float(sum(at) % 3 == 0)))
    model, z, n = c.Ftrl(), {}, {}
    for at, values, label in examples * 2:
        model.learn(np.array(at), np.array(values), label)
        w = {}
        for i in at:
            zi, ni = z.get(i, 0.0), n.get(i, 0.0)
            w[i] = 0.0 if abs(zi) <= c.L1 else -(zi - math.copysign(c.L1, zi)) / ((c.BETA + math.sqrt(ni)) / c.ALPHA + c.L2)
        guess = 1 / (1 + math.exp(-sum(w[i] * v for i, v in zip(at, values))))
        for i, v in zip(at, values):
            slope = (guess - label) * v
            step = (math.sqrt(n.get(i, 0.0) + slope * slope) - math.sqrt(n.get(i, 0.0))) / c.ALPHA
            z[i] = z.get(i, 0.0) + slope - step * w[i]
            n[i] = n.get(i, 0.0) + slope * slope
    assert np.allclose(model.z[sorted(z)], [z[i] for i in sorted(z)]) and np.allclose(model.n[sorted(n)], [n[i] for i in sorted(n)])


def test_clashing_names(spark):
    docs = spark.createDataFrame([(1, "some words", 9.0, "x")], "doc_id long, text string, _pl_score double, score string")
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    got = classifier.scored(docs, classifier.trained(docs, labels))
    assert got.columns == ["doc_id", "text", "score", "_pl_score"] and 0 <= got.first()["_pl_score"] <= 1
