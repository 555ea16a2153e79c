"""The seven curated tables, from normalized relations or straight from nested works."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions.columns import identified
from paperloom.model import (
    AUTHOR_ATTRIBUTES,
    INSTITUTION_ATTRIBUTES,
    PAPER_ATTRIBUTES,
    TABLE_KEYS,
    TOPIC_ATTRIBUTES,
    empty_relation,
    field_paths,
    present,
)
from paperloom.operators.firsts import earliest, fields_of, lowest
from paperloom.sources.relations import WORK_ID, WORK_PRIMARY, Relations, normalize


def _columns(attributes, paths):
    return [F.col(source).alias(name) for name, source in present(attributes, paths).items()]


def _own_fields(frame: DataFrame, lineage):
    return [c for c in frame.columns if c not in lineage]


def papers(works: DataFrame) -> DataFrame:
    """One row per work. Repeated ids stay, for the uniqueness check to find."""
    paths = field_paths(works.schema)
    if dict(works.dtypes).get("publication_date") == "string":
        works = works.withColumn("publication_date", F.try_to_date("publication_date"))
    return works.select(F.col("id").alias("paper_id"), *_columns(PAPER_ATTRIBUTES, paths))


@dataclass(frozen=True)
class Labelled:
    """An entity table before its rows are cut to one per entity: which row labels it."""

    rows: DataFrame
    key: str
    order: list
    fields: list
    columns: list

    def whole(self) -> DataFrame:
        return earliest(self.rows, [self.key], self.order, self.fields).select(*self.columns)

    def parts(self, name: str, part: Column) -> DataFrame:
        """The labelling row of every entity in every part of the works, for `merged`."""
        return lowest(self.rows.withColumn(name, part), [name, self.key], self.order, self.fields)

    def merged(self, parts: DataFrame) -> DataFrame:
        """The table from its parts: the lowest of their labelling rows."""
        rows = parts.groupBy(self.key).agg(F.min("_lowest").alias("_lowest"))
        return fields_of(rows, [self.key], self.fields).select(*self.columns)


def topic_labels(links: DataFrame) -> Labelled:
    """A topic is labelled by the earliest work that carries it."""
    lineage = ("id", WORK_ID, WORK_PRIMARY, "_parent_id", "_row_id", "pos")
    columns = [F.col("id").alias("topic_id"), *_columns(TOPIC_ATTRIBUTES, field_paths(links.schema))]
    return Labelled(links.filter(identified("id")), "id", [WORK_ID], _own_fields(links, lineage), columns)


def topics(links: DataFrame) -> DataFrame:
    """One row per topic."""
    return topic_labels(links).whole()


def paper_topics(links: DataFrame) -> DataFrame:
    """Distinct (paper, topic) pairs with the best score and the primary flag."""
    paths = field_paths(links.schema)
    attributes = [F.max("score").alias("topic_score")] if "score" in paths else []
    if WORK_PRIMARY in links.columns:
        flag = F.bool_or(F.col("id") == F.col(WORK_PRIMARY))
        attributes.append(flag.alias("is_primary_topic"))
    keys = [F.col(WORK_ID).alias("paper_id"), F.col("id").alias("topic_id")]
    grouped = links.filter(identified("id")).repartition(WORK_ID).groupBy(*keys)
    return grouped.agg(*attributes) if attributes else grouped.agg(F.count("*")).select(*TABLE_KEYS["paper_topics"])


def author_labels(links: DataFrame) -> Labelled:
    """An author is labelled by the earliest work and authorship."""
    columns = _columns(AUTHOR_ATTRIBUTES, field_paths(links.schema))
    rows = links.filter(identified("author.id")).select(
        F.col("author.id").alias("author_id"), *columns, WORK_ID, "_row_id"
    )
    fields = _own_fields(rows, ("author_id", WORK_ID, "_row_id"))
    return Labelled(rows, "author_id", [WORK_ID, "_row_id"], fields, ["author_id", *fields])


def authors(links: DataFrame) -> DataFrame:
    """One row per author."""
    return author_labels(links).whole()


def paper_authors(links: DataFrame) -> DataFrame:
    """Distinct (paper, author) pairs with the attributes of the first authorship.

    Few pairs repeat, so links are dealt by paper and not cut in each task before. That spares
    a sort of all of them, and a paper's links stay together, which stores smaller.
    """
    paths = field_paths(links.schema)
    attributes = [c for c in ("author_position", "is_corresponding") if c in paths]
    rows = links.filter(identified("author.id")).select(
        F.col(WORK_ID).alias("paper_id"), F.col("author.id").alias("author_id"), *attributes, "_row_id"
    )
    keys = TABLE_KEYS["paper_authors"]
    return earliest(rows.repartition("paper_id"), keys, ["_row_id"], attributes)


def institution_labels(links: DataFrame) -> Labelled:
    """An institution is labelled by the earliest work and authorship."""
    lineage = ("id", WORK_ID, "_parent_id", "_row_id", "pos")
    attributes = _columns(INSTITUTION_ATTRIBUTES, field_paths(links.schema))
    rows, fields = links.filter(identified("id")), _own_fields(links, lineage)
    return Labelled(rows, "id", [WORK_ID, "_parent_id"], fields, [F.col("id").alias("institution_id"), *attributes])


def institutions(links: DataFrame) -> DataFrame:
    """One row per institution."""
    return institution_labels(links).whole()


def paper_institutions(links: DataFrame) -> DataFrame:
    """Distinct (paper, institution) pairs; an affiliation shared by authors counts once."""
    return (
        links.filter(identified("id"))
        .select(F.col(WORK_ID).alias("paper_id"), F.col("id").alias("institution_id"))
        .repartition("paper_id")
        .distinct()
    )


def build(relations: Relations) -> dict:
    """All seven tables; an absent child relation gives empty key-only tables."""
    spark = relations.works.sparkSession

    def table(name, builder, source):
        return empty_relation(spark, TABLE_KEYS[name]) if source is None else builder(source)

    topic_links = _with_key(relations.topics, "id")
    author_links = _with_author(relations.authorships)
    institution_links = _with_key(relations.institutions, "id")
    return {
        "papers": papers(relations.works),
        "topics": table("topics", topics, topic_links),
        "paper_topics": table("paper_topics", paper_topics, topic_links),
        "authors": table("authors", authors, author_links),
        "paper_authors": table("paper_authors", paper_authors, author_links),
        "institutions": table(
            "institutions", institutions, institution_links
        ),
        "paper_institutions": table("paper_institutions", paper_institutions, institution_links),
    }


def entity_labels(works: DataFrame) -> dict[str, Labelled]:
    """What labels the entities of nested works; entities whose links never occurred are left out."""
    relations = normalize(works)
    sources = {
        "topics": (topic_labels, _with_key(relations.topics, "id")),
        "authors": (author_labels, _with_author(relations.authorships)),
        "institutions": (institution_labels, _with_key(relations.institutions, "id")),
    }
    return {name: label(links) for name, (label, links) in sources.items() if links is not None}


def _with_key(frame, key):
    """A child relation without its business key identifies nothing."""
    if frame is None or key in frame.columns:
        return frame
    return frame.withColumn(key, F.lit(None).cast("string"))


def _with_author(frame):
    if frame is None or "author.id" in field_paths(frame.schema):
        return frame
    return frame.withColumn("author", F.struct(F.lit(None).cast("string").alias("id")))


def build_nested(works: DataFrame) -> dict:
    """The same tables from nested works with unique ids.

    A work holds all its links in its own arrays, so the three bridges are made
    unique inside the row and need no shuffle. Only the entity tables shuffle, after
    each task has cut its rows to one per key.
    """
    columns = set(works.columns)
    tables = build(normalize(works))
    if "topics" in columns and "topics.id" in _element_paths(works, "topics"):
        tables["paper_topics"] = _nested_paper_topics(works)
    inner = _element_paths(works, "authorships") if "authorships" in columns else set()
    if "authorships.author.id" in inner:
        tables["paper_authors"] = _nested_paper_authors(works)
    if "authorships.institutions" in inner:
        ids = F.flatten(F.transform("authorships", lambda a: F.coalesce(a["institutions"]["id"], F.array())))
        pairs = works.select(F.col("id").alias("paper_id"), F.explode(F.array_distinct(ids)).alias("institution_id"))
        tables["paper_institutions"] = pairs.filter(identified("institution_id"))
    return tables


def _element_paths(works, column):
    element = works.schema[column].dataType.elementType
    return {f"{column}.{p}" for p in field_paths(element)}


def _first_of_runs(ordered, key):
    """Keep the first element of every run of equal keys in a sorted array."""
    return F.filter(
        ordered, lambda x, i: (i == 0) | (F.get(ordered, i - 1)[key] != x[key])
    )


def _nested_paper_topics(works):
    paths = {p.removeprefix("topics.") for p in _element_paths(works, "topics")}
    scored = "score" in paths
    # NULL scores sort last through the flag, higher scores first through the sign.
    entry = lambda t: F.struct(
        t["id"].alias("id"),
        *([t["score"].isNull().alias("unscored"), (-t["score"]).alias("order")] if scored else []),
    )
    kept = F.filter("topics", lambda t: identified(t["id"]))
    work = works.withColumn("_sorted", F.array_sort(F.transform(kept, entry)))
    links = work.withColumn("_link", F.explode(_first_of_runs(F.col("_sorted"), "id")))
    attributes = [(-F.col("_link.order")).alias("topic_score")] if scored else []
    if "primary_topic" in works.columns:
        attributes.append((F.col("_link.id") == F.col("primary_topic.id")).alias("is_primary_topic"))
    return links.select(F.col("id").alias("paper_id"), F.col("_link.id").alias("topic_id"), *attributes)


def _nested_paper_authors(works):
    paths = {p.removeprefix("authorships.") for p in _element_paths(works, "authorships")}
    attributes = [c for c in ("author_position", "is_corresponding") if c in paths]
    entry = lambda a, i: F.struct(
        a["author"]["id"].alias("id"), i.alias("place"), *[a[c].alias(c) for c in attributes]
    )
    kept = F.filter(
        F.transform("authorships", entry), lambda a: identified(a["id"])
    )
    work = works.withColumn("_sorted", F.array_sort(kept))
    links = work.withColumn("_link", F.explode(_first_of_runs(F.col("_sorted"), "id")))
    return links.select(
        F.col("id").alias("paper_id"),
        F.col("_link.id").alias("author_id"),
        *[F.col(f"_link.{c}") for c in attributes],
    )
