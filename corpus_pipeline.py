"""From raw documents to packed training examples, stage by stage.

Every stage takes (spark, docs, sf_dir), works on all documents that the one before kept
and returns a frame that is written as Parquet and read again by the next. All but the
last return the columns of `documents`; a stage that changes texts updates `n_chars`.
"""

from pyspark.sql import functions as F

from paperloom.llm import classifier, linededup, neardup, packing, substrings
from paperloom.llm.runtime import written


def _recounted(docs):
    return docs.withColumn("n_chars", F.length("text").cast("long"))


def quality_classifier(spark, docs, sf_dir):
    """Documents that score under the decision limit go; labels of the held-out fifth teach nothing."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(classifier.crc_of_id("doc_id") % 5 != 0)
    scored = classifier.scored(docs, classifier.trained(docs, labels.select("doc_id", "quality")))
    return scored.where(F.col("_pl_score") >= classifier.DECISION).select(*docs.columns)


def line_dedup(spark, docs, sf_dir):
    """Lines found in at least ten documents stay in the first place only."""
    return _recounted(linededup.deduped(docs, min_documents=10, min_chars=1, keep_first=True))


def minhash_near_dedup(spark, docs, sf_dir):
    """One document of each group stays: five-word shingles, similarity of 0.8 or more."""
    return neardup.representatives(docs, width=5, percent=80, band_rows=4)


def substring_dedup(spark, docs, sf_dir):
    """Runs of 35 words and more that occur elsewhere go."""
    return _recounted(substrings.without_repeats(docs, window=35))


def best_fit_packing(spark, docs, sf_dir):
    """Every text gets its place in a bin of 2048 words."""
    return packing.packed(docs, capacity=2048)


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("minhash near-dedup", minhash_near_dedup),
    ("substring dedup", substring_dedup),
    ("best-fit packing", best_fit_packing),
]

#: Trained weights and best-fit placement cannot be said in SQL.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
