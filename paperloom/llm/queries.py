"""The operators over their whole tables, as registered queries, and their SQL."""

import hashlib

import public_tokenizers
import pyarrow as pa
from pyspark.sql import functions as F

from paperloom.llm import (
    bpe,
    chat,
    classifier,
    extraction,
    fingerprints,
    linededup,
    neardup,
    oracle,
    packing,
    rules,
    sharding,
    substrings,
    variants,
    whitening,
)


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_document_fingerprints(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")

    def compare(text, mark, following, following_mark):
        half = len(text) // 2
        edited = (text[: len(text) - half] + following[:half]).encode()
        edited_mark = fingerprints.fingerprint(edited)
        return (
            len(text),
            hashlib.sha256(edited).hexdigest(),
            mark,
            edited_mark,
            fingerprints.likeness(mark, edited_mark),
            fingerprints.likeness(mark, following_mark),
        )

    return fingerprints.with_next(
        docs,
        compare,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )


def op2_best_fit_packing(spark, sf_dir):
    return packing.packed(table(spark, sf_dir, "documents"))


def op3_minhash_near_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return neardup.near_duplicates(docs, width=3, percent=85, band_rows=4)


def op4_byte_bpe(spark, sf_dir, vocabulary=None):
    path = vocabulary or public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.digests(docs, path, public_tokenizers.PATTERN)


def op5_substring_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = substrings.with_spans(docs, substrings.repeated_windows(docs, window=35))

    def digest(batches):
        for batch in batches:
            sizes, drops, shas = [], [], []
            for text, spans in zip(batch.column(1), batch.column(2)):
                words = (text.as_py() or "").encode().split()
                if spans.is_valid:
                    gone = substrings.covered(spans.as_py(), len(words), 35)
                    left = [word for word, drop in zip(words, gone) if not drop]
                else:
                    left = words
                sizes.append(len(words))
                drops.append(len(words) - len(left))
                shas.append(hashlib.sha256(b" ".join(left)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(drops, pa.int64()), pa.array(shas)],
                names=["doc_id", "n_words", "n_removed", "kept_sha256"],
            )

    return marked.mapInArrow(digest, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def op6_quality_classifier(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = classifier.crc_of_id("doc_id") % 5 == 0
    labels = table(spark, sf_dir, "labels").where(~held_out).select("doc_id", "quality")
    scored = classifier.scored(docs, classifier.trained(docs, labels))
    return scored.select(
        "doc_id",
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        F.col("_pl_score").alias("score"),
        (F.col("_pl_score") >= classifier.DECISION).cast("int").alias("predicted"),
    )


def op7_line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = linededup.with_bitmaps(docs, linededup.keep_bitmaps(docs, min_documents=10, min_chars=1))

    def digest(batches):
        for batch in batches:
            sizes, drops, shas = [], [], []
            for text, keep in zip(batch.column(1), batch.column(2)):
                size, left = linededup.surviving_lines(text.as_py(), keep.as_py())
                sizes.append(size)
                drops.append(size - len(left))
                shas.append(hashlib.sha256("\n".join(left).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(drops, pa.int64()), pa.array(shas)],
                names=["doc_id", "n_lines", "n_dropped", "kept_sha256"],
            )

    return marked.mapInArrow(digest, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")


def op8_chat_formatting(spark, sf_dir):
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").cast(conversations.schema["turn"].dataType).alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    found = chat.read_back(chat.examples(conversations.unionByName(probe)))
    turns = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    return found.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(turns, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op9_html_extraction(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = extraction.extracted(pages, extraction.trained(pages))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op10_quality_rules(spark, sf_dir):
    found = rules.rules(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op11_spelling_variants(spark, sf_dir):
    return variants.spelling_variants(table(spark, sf_dir, "documents"), min_chars=5, min_count=3, ratio=2)


def op12_embedding_whitening(spark, sf_dir):
    return whitening.whitened(table(spark, sf_dir, "embeddings"), count=16)


def op13_sharding(spark, sf_dir):
    """Read back from the written shards; their counts are at most one apart."""
    text = F.coalesce("text", F.lit(""))
    return sharding.write_shards(table(spark, sf_dir, "documents"), shards=16).select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


QUERIES = {
    "op1_document_fingerprints": op1_document_fingerprints,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_minhash_near_dedup": op3_minhash_near_dedup,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_line_dedup": op7_line_dedup,
    "op8_chat_formatting": op8_chat_formatting,
    "op9_html_extraction": op9_html_extraction,
    "op10_quality_rules": op10_quality_rules,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_sharding": op13_sharding,
}
ORACLE = {
    "op3_minhash_near_dedup": oracle.OP3,
    "op5_substring_dedup": oracle.OP5,
    "op7_line_dedup": oracle.OP7,
    "op8_chat_formatting": oracle.OP8,
    "op10_quality_rules": oracle.quality_rules(
        rules.MEASURES,
        rules.OCTILES,
        rules.SPREAD,
        rules.NOISE,
        rules.PRIOR,
        rules.ERROR,
        rules.BASE_WORDS,
        rules.BASE_REPEATS,
    ),
    "op11_spelling_variants": oracle.OP11,
}
