"""Quality rules: text measures, and thresholds that follow each language and source.

Fixed rules reject what is too short or repeats itself. Everything else is judged by two
fences on each measure, the middle value plus and minus `SPREAD` times its distance from the
outer octiles, which still tell something where quartiles are equal:
octile + SPREAD * (octile - median). There are no fixed cutoffs: what is usual in a language
and source passes there. A count may be past a fence by `NOISE` times the square root of what
is expected plus one, so one symbol or repeated line in a clean group proves nothing.

Octiles and medians come from mergeable sketches with relative error `ERROR`: a measure is
counted in buckets of geometric width, so sketches of parts merge by adding counts. Partial
aggregation sends one row per bucket and task, whatever share of the rows one source has.
Small groups lean on wider ones, by one rule at every size: n own documents weigh
n / (n + PRIOR), the rest is the language's value, itself blended with that of all.

Defined results: a null or empty text has no words and fails; a null language or source
is a group like any other; repeated rows are judged alike and count each; an empty table
gives an empty table.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from paperloom.llm import arrays
from paperloom.llm.runtime import ship, written

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
BASE_WORDS, BASE_REPEATS = 50, 50
SPREAD, NOISE, PRIOR, ERROR = 4.0, 4.0, 200, 0.01
#: the shares of documents under the lower octile, the median and the upper octile
OCTILES = {"low": 0.125, "mid": 0.5, "high": 0.875}
#: measure: (counted, out of)
MEASURES = {
    "symbols_per_word": ("n_symbols", "n_words"),
    "chars_per_word": ("word_chars", "n_words"),
    "repeated_share": ("n_repeat_words", "n_words"),
    "duplicate_lines_per_word": ("n_dup_lines", "n_words"),
}


def _earlier_equal(group, key):
    """How many entries have an equal one before them within the group, by group."""
    order = np.lexsort((key, group))
    same = (group[order][1:] == group[order][:-1]) & (key[order][1:] == key[order][:-1])
    return order[1:][same]


def measure(chunk):
    """The five counts of each row of a chunk."""
    found = arrays.words(chunk)
    rows = chunk.rows
    n_words = np.diff(found.first)
    points = np.concatenate([[0], np.cumsum((chunk.data & 0xC0) != 0x80)])
    word_chars = np.bincount(found.row, points[found.ends] - points[found.starts], rows).astype(np.int64)
    marks = np.concatenate([[0], np.cumsum(SYMBOLS[chunk.data])])
    n_symbols = np.diff(marks[chunk.offsets])

    each = arrays.lines(chunk)
    solid = np.concatenate([[0], np.cumsum(~arrays.SPACE[chunk.data])])
    with_word = np.flatnonzero(solid[each.ends] > solid[each.starts])
    keys = arrays.FIRST.of_bytes(chunk.data, each.starts[with_word], each.ends[with_word])
    again = _earlier_equal(each.row[with_word], keys)
    n_dup_lines = np.bincount(each.row[with_word][again], minlength=rows)

    n_repeat = np.zeros(rows, np.int64)
    starts = arrays.runs(found, 3)
    if len(starts):
        hashes = arrays.FIRST.of_bytes(chunk.data, found.starts, found.ends)
        windows = arrays.FIRST.of_runs(hashes, starts, starts + 3)
        owner = found.row[starts]
        order = np.lexsort((windows, owner))
        same = (owner[order][1:] == owner[order][:-1]) & (windows[order][1:] == windows[order][:-1])
        twice = np.zeros(len(order), bool)
        twice[1:] |= same
        twice[:-1] |= same
        covered = np.zeros(len(found.starts), bool)
        repeated = starts[order[twice]]
        for step in range(3):
            covered[repeated + step] = True
        n_repeat = np.bincount(found.row[covered], minlength=rows)
    return n_words, word_chars, n_symbols, n_dup_lines, n_repeat


def _measured(batches):
    for batch in batches:
        for chunk in arrays.chunks(batch.column(0)):
            kept = [c.slice(chunk.first_row, chunk.rows) for c in batch.columns[1:]]
            counts = [pa.array(c, pa.int64()) for c in measure(chunk)]
            yield pa.RecordBatch.from_arrays([*kept, *counts], names=[*batch.schema.names[1:], *COUNTS])


def counted(docs, text_column="text", carried=("doc_id", "lang", "source")):
    """The carried columns and the five counts of each row."""
    ship(docs.sparkSession)
    source = docs.select(F.col(text_column).cast("string").alias("_pl_text"), *carried)
    schema = ", ".join(f"`{name}` {kind}" for name, kind in docs.select(*carried).dtypes)
    return source.mapInArrow(_measured, f"{schema}, " + ", ".join(f"{c} long" for c in COUNTS))


def base_failed():
    return (F.col("n_words") < BASE_WORDS) | (100 * F.col("n_repeat_words") > BASE_REPEATS * F.col("n_words"))


def _value(measure_name):
    above, below = MEASURES[measure_name]
    return F.col(above) / F.greatest(F.col(below), F.lit(1))


_WIDTH = math.log((1 + ERROR) / (1 - ERROR))


def sketches(judged, levels):
    """Bucket counts of every measure for each group of the given columns."""
    values = F.array(*[F.struct(F.lit(m).alias("measure"), _value(m).alias("value")) for m in MEASURES])
    bucket = F.when(F.col("m.value") > 0, F.floor(F.log(F.col("m.value")) / _WIDTH)).otherwise(F.lit(None))
    return (
        judged.select(*levels, F.explode(values).alias("m"))
        .select(*levels, "m.measure", bucket.cast("long").alias("bucket"))
        .groupBy(*levels, "measure", "bucket")
        .agg(F.count("*").alias("n"))
    )


def merged(parts, levels):
    """Sketches of coarser groups: counts of equal buckets are added."""
    return parts.groupBy(*levels, "measure", "bucket").agg(F.sum("n").alias("n"))


def quantiles(parts, levels):
    """One row for each group: its documents, and low, mid and high of every measure."""
    whole = Window.partitionBy(*levels, "measure")
    upward = whole.orderBy(F.col("bucket").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    placed = parts.withColumns({"total": F.sum("n").over(whole), "upto": F.sum("n").over(upward)})
    value = F.coalesce(F.exp((F.col("bucket") + 0.5) * _WIDTH), F.lit(0.0))
    each = placed.groupBy(*levels, "measure").agg(
        F.max("total").alias("total"),
        *[F.min(F.when(F.col("upto") >= F.ceil(F.col("total") * q), value)).alias(k) for k, q in OCTILES.items()],
    )
    of_measure = [F.max(F.when(F.col("measure") == m, F.col(k))).alias(f"{m}_{k}") for m in MEASURES for k in OCTILES]
    return each.groupBy(*levels).agg(F.max("total").alias("total"), *of_measure)


def fences(measure_name):
    """(lower, upper) from the blended columns of a measure."""
    low, mid, high = (F.col(f"{measure_name}_{k}") for k in OCTILES)
    return low - SPREAD * (mid - low), high + SPREAD * (high - mid)


def outside(measure_name):
    """Whether a document's count is further past a fence than counting noise explains."""
    above, below = (F.col(c) for c in MEASURES[measure_name])
    least, most = (fence * F.greatest(below, F.lit(1)) for fence in fences(measure_name))
    too_many = above > most + NOISE * F.sqrt(most + 1)
    too_few = above < least - NOISE * F.sqrt(F.greatest(least, F.lit(0.0)) + 1)
    return too_many | too_few


def thresholds(counts, lang="lang", source="source"):
    """(g_lang, g_source, low, mid and high of every measure) of each language and source, blended."""
    fine = counts.where(~base_failed()).select(F.col(lang).alias("g_lang"), F.col(source).alias("g_source"), *COUNTS)
    by_source = sketches(fine, ["g_lang", "g_source"])
    by_lang = merged(by_source, ["g_lang"])
    overall = merged(by_lang, [])
    names = [f"{m}_{k}" for m in MEASURES for k in OCTILES]

    def of(frame, level, keys=()):
        return frame.select(*keys, F.struct("total", *names).alias(level))

    own = of(quantiles(by_source, ["g_lang", "g_source"]), "own", ["g_lang", "g_source"])
    wide = of(quantiles(by_lang, ["g_lang"]), "wide", [F.col("g_lang").alias("w_lang")])
    every = quantiles(overall.withColumn("all", F.lit(1)), ["all"]).select(F.struct(*names))
    table = own.join(wide, F.col("g_lang").eqNullSafe(F.col("w_lang")), "left").withColumn("every", every.scalar())

    def blended(level, name, wider):
        total = F.col(f"{level}.total")
        return (total * F.col(f"{level}.{name}") + PRIOR * wider) / (total + PRIOR)

    return table.select(
        "g_lang",
        "g_source",
        *[blended("own", n, blended("wide", n, F.col(f"every.{n}"))).alias(n) for n in names],
    )


def judged(counts, lang="lang", source="source"):
    """The counts with `base_failed` and `kept`. `counts` is read three times: write it first."""
    rows = counts.withColumn("base_failed", base_failed())
    usual = thresholds(counts, lang, source)
    own = F.col(lang).eqNullSafe(F.col("g_lang")) & F.col(source).eqNullSafe(F.col("g_source"))
    joined = rows.join(usual, own, "left")
    past = F.lit(False)
    for m in MEASURES:
        past = past | outside(m)
    gone = [f"{m}_{k}" for m in MEASURES for k in OCTILES]
    kept = ~F.col("base_failed") & ~F.coalesce(past, F.lit(False))
    return joined.withColumn("kept", kept).drop("g_lang", "g_source", *gone)


def rules(docs, text_column="text", id_column="doc_id", lang="lang", source="source"):
    """Counts, base failure and verdict of every document."""
    return judged(written(counted(docs, text_column, (id_column, lang, source))), lang, source)
