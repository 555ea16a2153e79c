"""The star-schema tables seen as works: one work per order, its lines as children."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.operators.ranking import ordinal_within
from paperloom.sources.relations import WORK_ID, WORK_PRIMARY, Relations

# The array order of an order's lines; unique within an order.
LINE_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_id(key: str):
    return F.concat(F.lit("W"), F.col(key))


def topic_id(key: str):
    return F.when(F.col(key) % 97 == 0, F.lit(" ")).otherwise(F.concat(F.lit("T"), F.col(key)))


def primary_topics(spark, sf_dir) -> DataFrame:
    """Topic of the first line of each order.

    Lines are dealt by order and cut there: an order has few, so cutting them in each task
    first would sort every line once more.
    """
    first = (
        table(spark, sf_dir, "lineitem")
        .select("l_orderkey", *LINE_ORDER)
        .repartition("l_orderkey")
        .groupBy("l_orderkey")
        .agg(F.min(F.struct(*LINE_ORDER)).alias("line"))
        .select("l_orderkey", F.col("line.l_partkey").alias("p_partkey"))
    )
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return first.join(parts, "p_partkey").select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.struct(
            topic_id("p_partkey").alias("id"), F.col("p_name").alias("display_name")
        ).alias("primary_topic"),
    )


def works(spark, sf_dir, with_primary: bool = False, primary: DataFrame | None = None) -> DataFrame:
    """Scalar work fields; the primary topic costs a pass over the lines, so it is opt-in.

    Pass `primary` where the primary topics are computed already.
    """
    orders = table(spark, sf_dir, "orders")
    key, status = F.col("o_orderkey"), F.col("o_orderstatus")
    doi = (
        F.when(key % 7 == 0, F.lit(None).cast("string"))
        .when(key % 11 == 0, F.lit(""))
        .when(key % 13 == 0, F.concat(F.lit("doi:"), key))
        .otherwise(F.concat(F.lit("https://doi.org/10.1/"), key))
    )
    unspecified = F.when(key % 2 == 0, F.lit(" "))
    oa_status = F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", unspecified).otherwise(
        F.lower(F.substring("o_orderpriority", 3, 100))
    )
    columns = [
        work_id("o_orderkey").alias("id"),
        work_id("o_orderkey").alias("_row_id"),
        F.when(key % 19 != 0, F.concat(F.lit("Order "), key)).alias("title"),
        doi.alias("doi"),
        F.when(key % 101 != 0, F.year("o_orderdate").cast("long")).alias("publication_year"),
        F.col("o_orderdate").cast("date").alias("publication_date"),
        status.alias("type"),
        F.when(key % 17 != 0, F.floor(F.col("o_totalprice") / 1000).cast("long")).alias(
            "cited_by_count"
        ),
        F.struct(
            F.when(status == "F", True).when(status == "O", False).alias("is_oa"),
            oa_status.alias("oa_status"),
        ).alias("open_access"),
    ]
    if with_primary:
        found = primary_topics(spark, sf_dir) if primary is None else primary
        orders = orders.join(found, "o_orderkey", "left")
        columns.append("primary_topic")
    return orders.select(*columns)


def topics(
    spark, sf_dir, with_primary: bool = False, with_position: bool = False, primary: DataFrame | None = None
) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    if with_position:
        lines = _positioned(lines)
    if with_primary:
        found = primary_topics(spark, sf_dir) if primary is None else primary
        first = found.select(F.col("o_orderkey").alias("l_orderkey"), F.col("primary_topic.id").alias(WORK_PRIMARY))
        lines = lines.join(first, "l_orderkey")
    parts = table(spark, sf_dir, "part")
    return lines.join(parts, lines["l_partkey"] == parts["p_partkey"]).select(
        work_id("l_orderkey").alias(WORK_ID),
        work_id("l_orderkey").alias("_parent_id"),
        *([WORK_PRIMARY] if with_primary else []),
        *(["pos"] if with_position else []),
        topic_id("l_partkey").alias("id"),
        F.col("p_name").alias("display_name"),
        F.col("l_discount").alias("score"),
        F.struct(F.col("p_brand").alias("id")).alias("subfield"),
        F.struct(F.col("p_type").alias("id")).alias("field"),
    )


def _positioned(lines: DataFrame) -> DataFrame:
    coarse = F.floor(F.col("l_linenumber") / 1000)
    return ordinal_within(lines, "l_orderkey", [F.col(c) for c in LINE_ORDER], coarse, "pos")


def authorships(spark, sf_dir, with_position: bool = False, within_pair: bool = False) -> DataFrame:
    """One authorship per line; its row id is the line's place, comparable as it stands.

    `within_pair` leaves order and supplier out of the row id, which then tells lines of one
    work and author apart and no others: it is most of what a shuffle of authorships sends.
    """
    lines = table(spark, sf_dir, "lineitem")
    if with_position:
        lines = _positioned(lines)
    suppliers = table(spark, sf_dir, "supplier")
    author = F.struct(
        F.when(F.col("l_suppkey") % 13 != 0, F.concat(F.lit("A"), F.col("l_suppkey"))).alias("id"),
        F.col("s_name").alias("display_name"),
    )
    position = F.when(F.col("pos") == 0, "first").otherwise("middle") if with_position else None
    place = [c for c in LINE_ORDER if c != "l_suppkey"] if within_pair else ["l_orderkey", *LINE_ORDER]
    return lines.join(suppliers, lines["l_suppkey"] == suppliers["s_suppkey"]).select(
        work_id("l_orderkey").alias(WORK_ID),
        work_id("l_orderkey").alias("_parent_id"),
        F.struct(*place).alias("_row_id"),
        author.alias("author"),
        *([F.col("pos"), position.alias("author_position")] if with_position else []),
        (F.col("l_returnflag") == "R").alias("is_corresponding"),
    )


def institutions(spark, sf_dir, with_position: bool = False) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    if with_position:
        lines = _positioned(lines)
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    nations, regions = (F.broadcast(table(spark, sf_dir, name)) for name in ("nation", "region"))
    # Spark guesses a join's size as the product of its sides, so a join of the small tables would
    # look too large to broadcast and all lines would be shuffled for it. One by one they are not.
    placed = (
        lines.join(suppliers, "l_suppkey")
        .join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return placed.select(
        work_id("l_orderkey").alias(WORK_ID),
        F.struct("l_orderkey", *LINE_ORDER).alias("_parent_id"),
        *([F.col("pos").alias("authorship_pos")] if with_position else []),
        F.concat(F.lit("I"), F.col("s_nationkey")).alias("id"),
        F.col("n_name").alias("display_name"),
        F.col("n_name").alias("country_code"),
        F.col("r_name").alias("type"),
    )


def relations(spark, sf_dir, with_primary: bool = False, with_position: bool = False) -> Relations:
    return Relations(
        works(spark, sf_dir, with_primary),
        topics(spark, sf_dir, with_primary),
        authorships(spark, sf_dir, with_position),
        institutions(spark, sf_dir),
    )
