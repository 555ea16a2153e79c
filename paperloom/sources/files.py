"""Completed raw extractions: discovery, identity and provenance sidecars.

An extraction is `<stem>.jsonl` next to `<stem>.metadata.json`, which is written last
and so marks completion. `<stem>.jsonl` is one file or a folder of part files, as a
Spark job writes it. A load knows content by its lines (`digest`); `fingerprint` hashes the
bytes of each part as one value, which Spark limits to 2 GiB, and no load calls it.
"""

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_EXTRACTION = r"^(.*?/[^/]+\.jsonl)(?:/[^/]*)?$"
_SIDECAR, _DATA = ".metadata.json", ".jsonl"


def extraction_of(file_path):
    """The extraction a part file belongs to; for a single file, the file itself."""
    return F.regexp_extract(file_path, _EXTRACTION, 1)


@dataclass(frozen=True)
class Extraction:
    """A completed extraction as the file system lists it."""

    path: str
    size: int
    modified: int
    sidecar: str


def _file_system(spark, path):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _glob(spark, pattern):
    target, system = _file_system(spark, pattern)
    return {f.getPath().toString(): f for f in system.globStatus(target) or []}, system


def sidecar_of(path: str) -> str:
    return path.removesuffix(_DATA) + _SIDECAR


def data_of(sidecar: str) -> str:
    return sidecar.removesuffix(_SIDECAR) + _DATA


def _described(spark, entries) -> list[Extraction]:
    """Extractions as they lie there, by path.

    A folder's size and time are those of its parts, so a part rewritten in place shows.
    All folders are listed by one job, dealt over its tasks; content is not read.
    """
    parts, folders = {}, [e.getPath().toString() for e in entries if e.isDirectory()]
    if folders:
        listed = spark.read.format("binaryFile").load(folders)
        told = listed.groupBy(extraction_of("path").alias("path")).agg(
            F.sum("length").alias("size"), F.max(F.unix_millis("modificationTime")).alias("modified")
        )
        parts = {row["path"]: row for row in told.collect()}  # one for each folder
    found = []
    for entry in entries:
        path, inner = entry.getPath().toString(), parts.get(entry.getPath().toString())
        size = (inner["size"] if inner else 0) if entry.isDirectory() else entry.getLen()
        modified = max(entry.getModificationTime(), inner["modified"] if inner else 0)
        found.append(Extraction(path, size, modified, sidecar_of(path)))
    return sorted(found, key=lambda e: e.path)


def discover(spark: SparkSession, raw_dir: str) -> list[Extraction]:
    """Completed extractions by path, from listings only: no content.

    The file system is asked directly because Spark's own listing hides empty files.
    """
    folder = raw_dir.rstrip("/")
    sidecars, _ = _glob(spark, f"{folder}/*{_SIDECAR}")
    data, _ = _glob(spark, f"{folder}/*{_DATA}")
    complete = {path for path, entry in sidecars.items() if not entry.isDirectory()}
    return _described(spark, [entry for path, entry in data.items() if sidecar_of(path) in complete])


def extractions(spark: SparkSession, paths: list[str]) -> list[Extraction]:
    """These extractions as they are now, without a listing of their folder; incomplete ones are left out."""
    found = []
    for path in sorted(set(paths)):
        target, system = _file_system(spark, path)
        sidecar, _ = _file_system(spark, sidecar_of(path))
        if system.exists(target) and system.exists(sidecar):
            found.append(system.getFileStatus(target))
    return _described(spark, found)


def latest_input(spark: SparkSession, raw_dir: str) -> Extraction | None:
    """The newest completed extraction; equal times resolve by name."""
    return max(
        discover(spark, raw_dir),
        key=lambda e: (e.modified, e.path.rsplit("/", 1)[-1]),
        default=None,
    )


def resolve_input(spark: SparkSession, raw_dir: str, path: str | None = None) -> str:
    """An explicit extraction, checked, or the newest completed one."""
    if path is None:
        newest = latest_input(spark, raw_dir)
        if newest is None:
            raise FileNotFoundError(f"{raw_dir} holds no extraction with a sidecar")
        return newest.path
    if not path.lower().endswith(_DATA):
        raise ValueError(f"{path} does not end in {_DATA}")
    target, system = _file_system(spark, path)
    if not system.exists(target):
        raise FileNotFoundError(f"{path} does not exist")
    return path


def fingerprint(spark: SparkSession, paths: list[str]) -> DataFrame:
    """SHA-256 per extraction: of the file's bytes, or of its parts' digests in order.

    Content is hashed where it is read, one part per row. An empty extraction has no
    part to read and no row here.
    """
    parts = (
        spark.read.format("binaryFile")
        .load(paths)
        .select(
            extraction_of("path").alias("path"),
            F.col("path").alias("part"),
            F.sha2("content", 256).alias("digest"),
        )
    )
    # One digest per part file: as bounded as the file listing itself.
    listed = F.array_sort(F.collect_list(F.struct("part", "digest")))
    whole = parts.groupBy("path").agg(listed.alias("parts"))
    single = F.col("parts")[0]["digest"]
    joined = F.sha2(F.array_join(F.col("parts.digest"), ""), 256)
    return whole.select(
        "path", F.when(F.size("parts") == 1, single).otherwise(joined).alias("file_hash")
    )


def file_key(path: str, root: str) -> str:
    """Path relative to the root where it lies below, else absolute; no URI scheme."""
    plain = re.sub(r"^file:/+", "/", path)
    return plain.removeprefix(root.rstrip("/") + "/")


def read_provenance(spark: SparkSession, sidecars: list[str]) -> DataFrame:
    """Sidecars as variants by extraction path; `metadata` is NULL when not an object."""
    text = spark.read.option("wholetext", True).text(sidecars)
    path = F.regexp_replace(plain_path("_metadata.file_path"), r"\.metadata\.json$", _DATA)
    parsed = with_json(text.select(path.alias("path"), "value"), "value", "parsed")
    is_object = F.schema_of_variant("parsed").startswith("OBJECT")
    return parsed.select("path", F.when(is_object, F.col("parsed")).alias("metadata"))


def plain_path(file_path):
    """A file's metadata path as the file system spells it: unescaped, single slash."""
    decoded = F.url_decode(F.replace(file_path, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(decoded, r"^file:/+", "file:/")


def with_json(frame: DataFrame, text: str, name: str) -> DataFrame:
    """Add the JSON value a text column holds, or NULL when it is not exactly one value.

    Spark's parser stops after the first value. The text is therefore parsed as the
    first element of an array closed by a hash of that text: with anything after the
    value, the hash is not found where it belongs. The array is a column of its own,
    which keeps Spark from parsing again wherever it is used.
    """
    mark = F.xxhash64(text)
    sealed = F.concat(F.lit("["), F.col(text), F.lit(","), mark.cast("string"), F.lit("]"))
    whole = F.col("_sealed")
    closed = F.try_variant_get(whole, "$[1]", "bigint") == mark
    return (
        frame.withColumn("_sealed", F.try_parse_json(sealed))
        .withColumn(
            name,
            F.when(closed & F.is_valid_utf8(text), F.variant_get(whole, "$[0]", "variant")),
        )
        .drop("_sealed")
    )
