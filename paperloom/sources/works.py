"""Strict reading of works from JSON lines."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperloom.model import WORK_DDL
from paperloom.sources.digest import line_hash
from paperloom.sources.files import extraction_of, plain_path, with_json

# A character that is not white space: the Unicode property and four separators.
_VISIBLE = r"(?U)[^\s\x1C-\x1F]"


def read_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Raw lines with their extraction, part file, block and order inside the block."""
    return spark.read.text(paths).select(
        F.col("value").alias("line"),
        extraction_of(plain_path("_metadata.file_path")).alias("path"),
        plain_path("_metadata.file_path").alias("part"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
    )


def parse_works(lines: DataFrame) -> DataFrame:
    """Add `work` and `problem` to lines; exactly one of them is set.

    A line must hold one JSON object whose id is a nonblank string. Every line is
    parsed once. The problem names the rule that failed and never shows content.
    Literals such as NaN and repeated keys count as malformed. A field whose value has
    another JSON type than the contract is named in `mistyped` and left out of the work:
    nothing is cut, rounded or read as something else.
    """
    parsed = with_json(lines, "line", "_json")
    identifier = F.try_variant_get("_json", "$.id", "variant")
    kept = [c for c in lines.columns if c != "line"]
    checked = parsed.withColumn(
        "_id",
        F.when(
            F.schema_of_variant(identifier) == "STRING",
            F.variant_get(identifier, "$", "string"),
        ),
    )
    problem = (
        F.when(F.col("_json").isNull(), "not one JSON value")
        .when(F.coalesce(F.col("_id").rlike(_VISIBLE), F.lit(False)), None)
        .when(F.schema_of_variant("_json").startswith("OBJECT"), "id is no visible text")
        .otherwise("not an object")
    )
    checked = checked.withColumn("problem", problem)
    wrong = F.array_compact(
        F.array(*[F.when(~_fits(path, kind), F.lit(path)) for path, kind in contract_types().items()])
    )
    checked = checked.withColumn("mistyped", F.when(F.col("problem").isNull(), wrong).otherwise(F.array()))
    columns = [_typed(field).alias(field.name) for field in T.StructType.fromDDL(WORK_DDL).fields]
    work = F.when(F.col("problem").isNull(), F.struct(*columns))
    return checked.select(*kept, work.alias("work"), "problem", "mistyped")


def batch_schema(spark: SparkSession) -> T.StructType:
    """The columns of parsed lines with their origin, as a batch stores them."""
    empty = spark.createDataFrame([], "line string, path string, part string, block bigint, place bigint")
    return parse_works(visible_lines(empty)).schema


def contract_types() -> dict[str, T.DataType]:
    """The type of every field outside arrays; an array counts as one value."""
    found = {}

    def walk(fields, prefix):
        for field in fields:
            found[prefix + field.name] = field.dataType
            if isinstance(field.dataType, T.StructType):
                walk(field.dataType.fields, f"{prefix}{field.name}.")

    walk(T.StructType.fromDDL(WORK_DDL).fields, "")
    return found


def _kind_of(path):
    return F.schema_of_variant(F.try_variant_get("_json", f"$.{path}", "variant"))


def _fits(path, data_type):
    """Whether a value is absent, null or of the contract's JSON type."""
    kind = _kind_of(path)
    if isinstance(data_type, T.StructType):
        good = kind.startswith("OBJECT")
    elif isinstance(data_type, T.ArrayType):
        good = kind.startswith("ARRAY")
    else:
        names = {"string": ["STRING"], "bigint": ["BIGINT"], "boolean": ["BOOLEAN"]}
        good = kind.isin(names[data_type.simpleString()])
    return F.coalesce(good | (kind == "VOID"), F.lit(True))


def _typed(field, prefix=""):
    """A field's value where it has the contract's type, NULL elsewhere."""
    path = prefix + field.name
    if isinstance(field.dataType, T.StructType):
        inner = [_typed(f, f"{path}.").alias(f.name) for f in field.dataType.fields]
        return F.when(_kind_of(path).startswith("OBJECT"), F.struct(*inner))
    value = F.try_variant_get("_json", f"$.{path}", field.dataType.simpleString())
    return F.when(_fits(path, field.dataType), value)


def visible_lines(lines: DataFrame) -> DataFrame:
    """Lines that are not blank, numbered anew, with their hash."""
    kept = lines.filter(F.col("line").rlike(_VISIBLE))
    if "place" not in lines.columns:
        return kept
    return kept.withColumn("place", F.monotonically_increasing_id()).withColumn("hash", line_hash("line"))


def read_works(spark: SparkSession, paths: list[str]) -> tuple[DataFrame, DataFrame]:
    """Valid works, and the first problem of every extraction with its line number."""
    rows = parse_works(visible_lines(read_lines(spark, paths)))
    valid = rows.filter("problem IS NULL").select("work.*", "path", "part", "block", "place")
    return valid, first_problems(spark, paths)


def first_problems(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The first invalid line of every extraction, by part and line number.

    Lines are counted per block in parallel; only blocks, a handful per file, are
    then put in order to turn a place inside a block into a line number.
    """
    lines = read_lines(spark, paths)
    blank = ~F.col("line").rlike(_VISIBLE)
    rows = parse_works(lines.withColumn("blank", blank))
    fault = F.when(~F.col("blank"), F.col("problem"))
    blocks = rows.groupBy("path", "part", "block").agg(
        F.count("*").alias("lines"),
        F.min("place").alias("start"),
        F.min(F.when(fault.isNotNull(), F.struct("place", fault.alias("problem")))).alias("fault"),
    )
    before = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    faults = blocks.withColumn(
        "line_number",
        F.coalesce(F.sum("lines").over(before), F.lit(0))
        + F.col("fault.place")
        - F.col("start")
        + 1,
    ).filter("fault IS NOT NULL")
    first = F.min(F.struct("part", "line_number", F.col("fault.problem").alias("problem")))
    return faults.groupBy("path").agg(first.alias("first")).select("path", "first.*")
