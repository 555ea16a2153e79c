"""Versioned layers and append-only ledgers under one folder of the shared store."""

import json
import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperloom.operators.firsts import first_per_key

# The ledgers, their columns and types.
LEDGERS = {
    "pipeline_runs": (
        "run_id string, started_at timestamp, finished_at timestamp, status string, "
        "raw_files_discovered int, raw_files_processed int, error_stage string, error_message string"
    ),
    "processed_files": (
        "file_path string, file_hash string, file_size bigint, modified bigint, processed_at timestamp, "
        "records_loaded bigint, run_id string"
    ),
    # Extractions that were parsed, and the batch that holds their lines.
    "staged_files": "file_path string, file_size bigint, modified bigint, batch string",
    "stream_batches": "checkpoint string, batch_id bigint, run_id string",
    "pipeline_state": "downstream_pending boolean, visualizations_pending boolean",
    "data_quality_results": (
        "execution_id string, run_id string, check_name string, layer string, status string, "
        "observed_value string, expected_condition string, details string, checked_at timestamp"
    ),
    "layer_counters": "layer string, version bigint, name string, n bigint",
    "layer_versions": "layer string, version bigint, tables map<string, string>, buckets int",
    "known_fields": "relation string, path string",
}
# The columns whose latest entry stands for the ones before it.
LEDGER_KEYS = {"pipeline_runs": ["run_id"], "processed_files": ["file_path"], "staged_files": ["file_path"]}
# Tables laid out by bucket, and the column whose hash is the bucket.
BUCKETED = {
    "works": {"works": "id"},
    "curated": {
        "papers": "paper_id",
        "paper_topics": "paper_id",
        "paper_authors": "paper_id",
        "paper_institutions": "paper_id",
    },
    # One row for each bucket of works and entity, so the bucket is a column of its own.
    "firsts": {"topics": None, "authors": None, "institutions": None},
    "cells": {"topic_cells": "topic_id", "author_cells": "author_id", "institution_cells": "institution_id"},
}
BUCKET, BUCKETS = "bucket", 32
# Fixed value: files of layers, a quarter smaller than with Spark's default for sorted ids and cells.
CODEC = "zstd"
_HOMES = "of_source boolean, table string, bucket int, home bigint"
# A table that is not laid out by bucket has one folder, listed under this number.
WHOLE = -1


def bucket_of(key, buckets: int):
    """The bucket of a key, the same wherever the key occurs."""
    return F.pmod(F.xxhash64(key), F.lit(buckets).cast("long")).cast("int")


@dataclass(frozen=True)
class Version:
    """A staged or published version: schemas, and the version folder of every bucket.

    `source` are the homes of the layer that this one was built from.
    """

    layer: str
    number: int
    schemas: dict
    homes: dict
    buckets: int | None
    source: dict


def changed_buckets(before: dict, after: dict) -> set:
    """Buckets of which any table has another home."""
    return {bucket for table, bucket in before.keys() | after.keys() if before.get((table, bucket)) != after.get((table, bucket))}


def small_frame(spark: SparkSession, rows, ddl: str) -> DataFrame:
    """A few driver-side rows as a local relation: no Python worker, no extra stage."""
    schema = T.StructType.fromDDL(ddl)
    if not rows:
        return spark.createDataFrame([], schema)
    table = pa.table(
        {field.name: pa.array([row[i] for row in rows]) for i, field in enumerate(schema.fields)}
    )
    return spark.createDataFrame(table, schema)


class Warehouse:
    """Layers are written to a new version folder and become visible by a ledger entry.

    One writer at a time is a rule of deployment; readers always see whole versions.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        """`buckets` counts for a new store; one with works keeps the number it began with."""
        self.spark, self.root = spark, root.rstrip("/")
        self._buckets, self._settled = buckets, False
        self._known = {}

    # ---------------------------------------------------------- ledgers

    def _ledger_schema(self, name):
        return f"{LEDGERS[name]}, sequence bigint"

    def append(self, name: str, rows):
        """Append tuples, or a DataFrame with the ledger's columns, as one commit."""
        if not isinstance(rows, DataFrame):
            if not rows:
                return
            rows = small_frame(self.spark, rows, LEDGERS[name]).coalesce(1)
        sequence = time.time_ns()
        stamped = rows.withColumn("sequence", F.lit(sequence).cast("long"))
        stamped.write.parquet(f"{self.root}/ops/{name}/log/e={sequence}")

    def _ledger_files(self, name: str) -> tuple[int, list, list]:
        """The last snapshot's number and file, and the entries written after it."""
        folder = f"{self.root}/ops/{name}"
        number = lambda path: int(path.getName().split("=")[1])
        # A snapshot is one file, so it is there as a whole or not at all.
        snapshots = {number(p.getParent()): p.toString() for p in self._listed(f"{folder}/snapshots/s=*/*.parquet")[1]}
        last = max(snapshots, default=0)
        logged = [p.toString() for p in self._listed(f"{folder}/log/e=*")[1] if number(p) > last]
        # Entries of stores that are older than the log lie in the ledger's own folder.
        older = [] if last else [p.toString() for p in self._listed(f"{folder}/*.parquet")[1]]
        return last, ([snapshots[last]] if last else older), logged

    def entries(self, name: str) -> DataFrame:
        """All entries of a ledger, empty when nothing was ever written."""
        schema = self._ledger_schema(name)
        _, base, logged = self._ledger_files(name)
        if not base and not logged:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*base, *logged)

    def compact(self, name: str, after: int = 24):
        """Once more than `after` entries were logged, write a snapshot that stands for them.

        A ledger with a key keeps the latest entry of each key, others keep all. What the
        snapshot before this one stands for is removed, so a reader that has listed the
        files already still finds them; a crash at any point leaves either state whole.
        """
        before, _, logged = self._ledger_files(name)
        if len(logged) <= after:
            return
        folder = f"{self.root}/ops/{name}"
        number = max(int(path.rsplit("=", 1)[1]) for path in logged)
        rows = self.current(name) if name in LEDGER_KEYS else self.entries(name)
        rows.coalesce(1).write.mode("overwrite").parquet(f"{folder}/snapshots/s={number}")
        for pattern in ("log/e=*", "snapshots/s=*"):
            system, found = self._listed(f"{folder}/{pattern}")
            for path in found:
                at = int(path.getName().split("=")[1])
                if at < before or (at == before and pattern.startswith("log")):
                    system.delete(path, True)

    def current(self, name: str) -> DataFrame:
        """The latest entry per key."""
        latest = [F.col("sequence").desc()]
        return first_per_key(self.entries(name), LEDGER_KEYS[name], latest)

    def state(self) -> tuple[bool, bool]:
        """Whether downstream layers and charts are out of date."""
        row = self.entries("pipeline_state").orderBy(F.col("sequence").desc()).first()
        return (False, False) if row is None else (row[0], row[1])

    # ----------------------------------------------------------- layers

    def version(self, layer: str):
        entries = self.entries("layer_versions").filter(F.col("layer") == layer)
        return entries.orderBy(F.col("sequence").desc()).first()

    @property
    def buckets(self) -> int:
        row = None if self._settled else self.version("works")
        if row is not None and row["buckets"] is not None:
            self._buckets, self._settled = row["buckets"], True
        return self._buckets

    def published(self, layer: str) -> Version | None:
        """The current version of a layer, with the homes of its buckets.

        It is read again only when the ledger's listing shows another entry.
        """
        _, base, logged = self._ledger_files("layer_versions")
        listed = tuple(sorted([*base, *logged]))
        if self._known.get(layer, (None,))[0] != listed:
            row = self.version(layer)
            self._known[layer] = (listed, None if row is None else self._described(row))
        return self._known[layer][1]

    def _described(self, row) -> Version:
        recorded = (row["tables"] or {}).items()
        schemas = {name: T.StructType.fromJson(json.loads(text)) for name, text in recorded}
        if row["buckets"] is None:
            homes, source = {(name, WHOLE): row["version"] for name in schemas}, {}
        else:
            listed = self.spark.read.schema(_HOMES).parquet(f"{self.root}/{row['layer']}/v={row['version']}/homes")
            listed = listed.collect()  # buckets times tables
            homes, source = ({(r["table"], r["bucket"]): r["home"] for r in listed if r["of_source"] == own} for own in (False, True))
        return Version(row["layer"], row["version"], schemas, homes, row["buckets"], source)

    def tables(self, layer: str) -> dict[str, DataFrame]:
        """The published tables of a layer; none before its first publication."""
        current = self.published(layer)
        return {} if current is None else self.read(current)

    def read(self, version: Version, only=None) -> dict[str, DataFrame]:
        """Tables of one version, or of some of its buckets; recorded schemas spare the footer scan."""
        return {name: self.read_table(version, name, only) for name in version.schemas}

    def read_table(self, version: Version, name: str, only=None) -> DataFrame:
        folders = [
            self._folder(version.layer, home, name, bucket)
            for (table, bucket), home in sorted(version.homes.items())
            if table == name and (only is None or bucket == WHOLE or bucket in only)
        ]
        if not folders:
            return self.spark.createDataFrame([], version.schemas[name])
        return self.spark.read.schema(version.schemas[name]).parquet(*folders)

    def _folder(self, layer, home, name, bucket):
        path = f"{self.root}/{layer}/v={home}/{name}"
        return path if bucket == WHOLE else f"{path}/{BUCKET}={bucket}"

    def exists(self, path: str) -> bool:
        return bool(self._listed(path)[1])

    def remove_others(self, pattern: str, kept: set):
        """Remove the folders below the root that match a pattern, except the kept paths."""
        system, found = self._listed(f"{self.root}/{pattern}")
        names = {path.rsplit("/", 1)[-1] for path in kept}
        for entry in found:
            if entry.getName() not in names:
                system.delete(entry, True)

    def present(self, version: Version, homes: dict) -> bool:
        """Whether the folders of these homes are still there."""
        return all(self.exists(self._folder(version.layer, h, t, b)) for (t, b), h in homes.items())

    def _listed(self, path: str):
        target = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        system = target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return system, [entry.getPath() for entry in system.globStatus(target) or []]

    def stage(self, layer: str, tables: dict[str, DataFrame], only=None, source=None) -> Version:
        """Write tables to a fresh version folder without making them visible.

        With `only`, a set of buckets or one for each table, the bucketed tables hold
        nothing but the rows of these buckets; all other buckets stay in the folders that
        the current version names. The writes are independent jobs, so they are submitted
        together and fill the cluster where a single small table would not.
        """
        number, keys = time.time_ns(), BUCKETED.get(layer, {})
        buckets = self.buckets if keys else None
        before = self.published(layer) if only is not None else None

        def write(item):
            name, frame = item
            path = f"{self.root}/{layer}/v={number}/{name}"
            if name not in keys:
                frame.write.option("compression", CODEC).parquet(path)
                return {(name, WHOLE): number}
            if BUCKET not in frame.columns:
                frame = frame.withColumn(BUCKET, bucket_of(keys[name], buckets))
            # Tasks sort by bucket to write; rows of a key that follow each other store and shuffle smaller.
            order = [BUCKET] if keys[name] is None else [BUCKET, keys[name]]
            frame = frame.sortWithinPartitions(*order)
            frame.write.option("compression", CODEC).partitionBy(BUCKET).parquet(path)
            _, written = self._listed(f"{path}/{BUCKET}=*")
            return {(name, int(p.getName().removeprefix(f"{BUCKET}="))): number for p in written}

        with ThreadPoolExecutor(max_workers=8) as pool:
            written = list(pool.map(write, tables.items()))
        homes = {place: home for part in written for place, home in part.items()}
        if before is not None:
            chosen = only if isinstance(only, dict) else dict.fromkeys(tables, only)
            shared = {(t, b): h for (t, b), h in before.homes.items() if t in keys and t in tables and b not in chosen[t]}
            homes = shared | homes
        schemas = {
            name: T.StructType([f for f in t.schema.fields if not (name in keys and f.name == BUCKET)])
            for name, t in tables.items()
        }
        return Version(layer, number, schemas, homes, buckets, source or {})

    def release(self, version: Version):
        """Make a staged version the current one, with the schema of every table."""
        if version.buckets is not None:
            listed = ((False, version.homes), (True, version.source))
            rows = [(own, table, bucket, home) for own, of in listed for (table, bucket), home in sorted(of.items())]
            homes = small_frame(self.spark, rows, _HOMES).coalesce(1)
            homes.write.parquet(f"{self.root}/{version.layer}/v={version.number}/homes")
        schemas = [(name, schema.json()) for name, schema in version.schemas.items()]
        row = small_frame(self.spark, [(version.layer, version.number)], "layer string, version bigint")
        pairs = [c for name, text in schemas for c in (F.lit(name), F.lit(text))]
        listed = F.create_map(*pairs) if pairs else F.lit(None).cast("map<string, string>")
        row = row.withColumns({"tables": listed, "buckets": F.lit(version.buckets).cast("int")})
        self.append("layer_versions", row.coalesce(1))

    def expire(self, layer: str, keep: int):
        """Remove folders that none of the latest `keep` published versions names.

        Readers that still hold an older version lose it, so keep as many as are in use.
        Version folders that were staged and never published go too.
        """
        if type(keep) is not int or keep < 1:
            raise ValueError(f"At least one version stays, not {keep!r}")
        entries = self.entries("layer_versions").filter(F.col("layer") == layer)
        latest = entries.orderBy(F.col("sequence").desc()).limit(keep).collect()
        if not latest:
            return
        named, kept = set(), {row["version"] for row in latest}
        for row in latest:
            described = self._described(row)
            named |= {self._folder(layer, home, t, b) for (t, b), home in described.homes.items()}
        homes = kept | {int(folder.split("/v=")[1].split("/")[0]) for folder in named}
        system, versions = self._listed(f"{self.root}/{layer}/v=*")
        for path in versions:
            number = int(path.getName().removeprefix("v="))
            if number > max(kept):
                continue
            if number not in homes:
                system.delete(path, True)
            elif number not in kept:
                for part in self._listed(f"{self.root}/{layer}/v={number}/*/{BUCKET}=*")[1]:
                    table, bucket = part.getParent().getName(), int(part.getName().removeprefix(f"{BUCKET}="))
                    if self._folder(layer, number, table, bucket) not in named:
                        system.delete(part, True)

    def publish(self, layer: str, tables: dict[str, DataFrame], validate=None, only=None, source=None):
        """Stage, validate and release a layer; a failed check keeps the previous one."""
        version = self.stage(layer, tables, only, source)
        staged = self.read(version)
        if validate is not None:
            validate(version, staged)
        self.release(version)
        return staged
