"""The identity of an extraction's content, from its lines as they are read.

Every visible line has four hashes of 31 bits. An extraction is told by its number of lines,
the sums of the hashes, and the sums of the hashes times the line's number, all modulo a
prime. Sums merge: a block knows its own without knowing where it begins, and the lines
before it shift the second sum by their number times the first. So the same lines in the
same order have the same digest, in one file or many parts and however Spark splits them,
and the pass that parses the lines takes the digest along.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

HASHES = 4
_PRIME = 2**31 - 1


def line_hash(line: str):
    """128 bits of a line, as text."""
    return F.md5(line)


def _hash(k):
    return F.pmod(F.conv(F.substring("hash", 8 * k + 1, 8), 16, 10).cast("long"), F.lit(_PRIME))


def _times(a, b):
    return F.pmod(F.pmod(a, F.lit(_PRIME)) * F.pmod(b, F.lit(_PRIME)), F.lit(_PRIME))


def digests(lines: DataFrame) -> DataFrame:
    """(path, lines, digest) from (path, part, block, place, hash); places rise without gaps in a block."""
    sums = [F.sum(_hash(k)).alias(f"plain{k}") for k in range(HASHES)]
    placed = [F.sum(_times(F.col("place"), _hash(k))).alias(f"placed{k}") for k in range(HASHES)]
    blocks = lines.groupBy("path", "part", "block").agg(
        F.count("*").alias("n"), F.min("place").alias("start"), *sums, *placed
    )
    # One row for each block of an extraction, as bounded as its listing.
    before = Window.partitionBy("path").orderBy("part", "block").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("start") + 1
    shifted = blocks.withColumn("shift", shift)
    whole = shifted.groupBy("path").agg(
        F.sum("n").alias("lines"),
        *[F.pmod(F.sum(F.pmod(f"plain{k}", F.lit(_PRIME))), F.lit(_PRIME)).alias(f"a{k}") for k in range(HASHES)],
        *[
            F.pmod(F.sum(F.pmod(f"placed{k}", F.lit(_PRIME)) + _times(F.col("shift"), F.col(f"plain{k}"))), F.lit(_PRIME)).alias(f"b{k}")
            for k in range(HASHES)
        ],
    )
    told = F.concat_ws("-", "lines", *[f"{s}{k}" for s in "ab" for k in range(HASHES)])
    return whole.select("path", "lines", F.sha2(told, 256).alias("digest"))
