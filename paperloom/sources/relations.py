"""Normalized relations of a set of works, and the lineage between them."""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.model import field_paths
from paperloom.operators.integrity import orphans

# Columns a child row carries from its work, so that no later join is needed.
WORK_ID = "work_id"
WORK_PRIMARY = "work_primary_topic_id"


class LineageError(ValueError):
    """Child rows that do not belong to any parent, or no lineage to tell."""


@dataclass(frozen=True)
class Relations:
    """Works and their three child relations; an absent child is None.

    Children carry `work_id`. Authorships carry an orderable `_row_id`, institutions
    the one of their authorship as `_parent_id`.
    """

    works: DataFrame
    topics: DataFrame | None = None
    authorships: DataFrame | None = None
    institutions: DataFrame | None = None


def normalize(works: DataFrame) -> Relations:
    """Explode nested works into four relations; no join and no shuffle.

    NULL and empty arrays give no child rows. Row ids are the parent's id and the
    position in its array.
    """
    columns = set(works.columns)
    primary = (
        [F.col("primary_topic.id").alias(WORK_PRIMARY)]
        if "primary_topic.id" in field_paths(works.schema)
        else []
    )
    scalars = [c for c in works.columns if c not in ("topics", "authorships")]
    topics = authorships = institutions = None
    if "topics" in columns:
        topics = works.select(
            F.col("id").alias(WORK_ID), *primary, F.posexplode("topics")
        ).select(
            WORK_ID,
            *([WORK_PRIMARY] if primary else []),
            F.col("pos").cast("long").alias("pos"),
            F.col(WORK_ID).alias("_parent_id"),
            "col.*",
        )
    if "authorships" in columns:
        exploded = works.select(F.col("id").alias(WORK_ID), F.posexplode("authorships")).select(
            WORK_ID,
            F.col("pos").cast("long").alias("pos"),
            F.col(WORK_ID).alias("_parent_id"),
            F.struct(F.col(WORK_ID), F.col("pos")).alias("_row_id"),
            "col.*",
        )
        if "institutions" in exploded.columns:
            authorships = exploded.drop("institutions")
            institutions = exploded.select(
                WORK_ID, F.col("_row_id").alias("_parent_id"), F.posexplode("institutions")
            ).select(WORK_ID, "_parent_id", F.col("pos").cast("long").alias("pos"), "col.*")
        else:
            authorships = exploded
    works = works.select(*scalars).withColumn("_row_id", F.col("id"))
    return Relations(works, topics, authorships, institutions)


def lost_children(relations: Relations) -> DataFrame:
    """(relation, rows): child rows whose parent does not exist, for every relation that has any."""
    pairs = (
        ("topics", relations.topics, relations.works),
        ("authorships", relations.authorships, relations.works),
        ("institutions", relations.institutions, relations.authorships),
    )
    lost = [
        (child if parent is None else orphans(child, parent)).agg(F.count("*").alias("rows")).select(F.lit(name).alias("relation"), "rows")
        for name, child, parent in pairs
        if child is not None
    ]
    if not lost:
        return relations.works.sparkSession.createDataFrame([], "relation string, rows bigint")
    return reduce(DataFrame.unionAll, lost).filter("rows > 0")


def _require_lineage(relations: Relations):
    required = {
        "works": {"id", "_row_id"},
        "topics": {"_parent_id"},
        "authorships": {"_row_id", "_parent_id"},
        "institutions": {"_parent_id"},
    }
    for name, names in required.items():
        frame = getattr(relations, name)
        if frame is not None and not names <= set(frame.columns):
            raise LineageError(f"{name} has no {', '.join(sorted(names - set(frame.columns)))}")


def enforce_lineage(relations: Relations) -> Relations:
    """The relations, once no child is found without its parent."""
    _require_lineage(relations)
    lost = lost_children(relations).collect()  # at most one row for each relation
    if lost:
        raise LineageError(f"{', '.join(row['relation'] for row in lost)}: rows whose parent does not exist")
    return relations


def attach_lineage(relations: Relations) -> Relations:
    """Give externally normalized children their work through `_parent_id` joins.

    Raises LineageError on missing lineage columns. Nothing runs: the inner joins leave
    out orphans, which `lost_children` finds and `enforce_lineage` refuses. Institutions
    reach their work by way of the authorship alone, so they survive an authorship
    without a known author.
    """
    _require_lineage(relations)
    works, topics = relations.works, relations.topics
    authorships = relations.authorships
    institutions = relations.institutions if authorships is not None else None

    has_primary = "primary_topic.id" in field_paths(works.schema)
    carried = [F.col("id").alias(WORK_ID)]
    carried += [F.col("primary_topic.id").alias(WORK_PRIMARY)] if has_primary else []
    parents = works.select(F.col("_row_id").alias("_work"), *carried)

    def with_work(child, link):
        return child.join(parents, F.col(link) == F.col("_work")).drop("_work")

    if topics is not None:
        topics = with_work(topics, "_parent_id")
    if institutions is not None:
        hops = authorships.select(
            F.col("_row_id").alias("_authorship"), F.col("_parent_id").alias("_grandparent")
        )
        institutions = with_work(
            institutions.join(hops, F.col("_parent_id") == F.col("_authorship")), "_grandparent"
        ).drop("_authorship", "_grandparent", WORK_PRIMARY)
    if authorships is not None:
        authorships = with_work(authorships, "_parent_id").drop(WORK_PRIMARY)
    return Relations(works, topics, authorships, institutions)
