"""The data contract: raw Work schema, curated grains and optional attributes."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Table names, their keys and the attribute each source field feeds.
TABLE_KEYS = {
    "papers": ("paper_id",),
    "topics": ("topic_id",),
    "paper_topics": ("paper_id", "topic_id"),
    "authors": ("author_id",),
    "paper_authors": ("paper_id", "author_id"),
    "institutions": ("institution_id",),
    "paper_institutions": ("paper_id", "institution_id"),
}
PAPER_ATTRIBUTES = {
    "doi": "doi",
    "title": "title",
    "publication_year": "publication_year",
    "publication_date": "publication_date",
    "work_type": "type",
    "cited_by_count": "cited_by_count",
    "is_open_access": "open_access.is_oa",
    "oa_status": "open_access.oa_status",
    "primary_topic_id": "primary_topic.id",
    "primary_topic_name": "primary_topic.display_name",
    "source_id": "primary_location.source.id",
    "source_name": "primary_location.source.display_name",
}
TOPIC_ATTRIBUTES = {
    "topic_name": "display_name",
    "subfield_id": "subfield.id",
    "subfield_name": "subfield.display_name",
    "field_id": "field.id",
    "field_name": "field.display_name",
    "domain_id": "domain.id",
    "domain_name": "domain.display_name",
}
AUTHOR_ATTRIBUTES = {"author_name": "author.display_name"}
INSTITUTION_ATTRIBUTES = {
    "institution_name": "display_name",
    "country_code": "country_code",
    "institution_type": "type",
}
VIEWS = (
    "overview_kpis",
    "publication_trends",
    "topic_summary",
    "topic_yearly_trends",
    "top_papers",
    "author_summary",
    "institution_summary",
    "open_access_summary",
)
# bridge table -> (dimension table, its key)
BRIDGES = {
    "paper_topics": ("topics", "topic_id"),
    "paper_authors": ("authors", "author_id"),
    "paper_institutions": ("institutions", "institution_id"),
}

_LABELLED = "STRUCT<id: STRING, display_name: STRING>"
WORK_FIELDS = {
    "id": "STRING",
    "doi": "STRING",
    "title": "STRING",
    "publication_year": "BIGINT",
    "publication_date": "STRING",
    "type": "STRING",
    "cited_by_count": "BIGINT",
    "open_access": "STRUCT<is_oa: BOOLEAN, oa_status: STRING>",
    "primary_topic": _LABELLED,
    "primary_location": f"STRUCT<source: {_LABELLED}>",
    "topics": (
        "ARRAY<STRUCT<id: STRING, display_name: STRING, score: DOUBLE, "
        f"subfield: {_LABELLED}, field: {_LABELLED}, domain: {_LABELLED}>>"
    ),
    "authorships": (
        f"ARRAY<STRUCT<author: {_LABELLED}, author_position: STRING, "
        "is_corresponding: BOOLEAN, institutions: ARRAY<STRUCT<id: STRING, "
        "display_name: STRING, country_code: STRING, type: STRING>>>>"
    ),
    "keywords": f"ARRAY<{_LABELLED}>",
}
WORK_DDL = ", ".join(f"{n} {t}" for n, t in WORK_FIELDS.items())


def field_paths(schema) -> set[str]:
    """Dotted names of every field, descending into structs but not arrays."""
    found = set()
    for field in schema.fields:
        found.add(field.name)
        if isinstance(field.dataType, T.StructType):
            found |= {f"{field.name}.{inner}" for inner in field_paths(field.dataType)}
    return found


def present(attributes: dict[str, str], paths: set[str]) -> dict[str, str]:
    """The attributes whose source field exists."""
    return {target: source for target, source in attributes.items() if source in paths}


def empty_relation(spark: SparkSession, keys) -> DataFrame:
    """A typed relation without rows, standing in for an absent table."""
    return spark.createDataFrame([], T.StructType([T.StructField(k, T.StringType()) for k in keys]))


def table_columns(tables: dict[str, DataFrame], name: str) -> set[str]:
    """Column names of a table, empty when the table is absent."""
    table = tables.get(name)
    return set(table.columns) if table is not None else set()
