"""Which source fields were ever seen, and works cut down to them.

A field counts as present once a record gave it a value, and stays so. Absent fields
drop out of the schema, which is what decides the optional columns further on.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Stands for an array having elements at all.
ELEMENTS = "*"


def _leaves(data_type, column: str, path: str):
    """(path, SQL test for a value) of every scalar; arrays go on into their elements."""
    if isinstance(data_type, T.StructType):
        for field in data_type.fields:
            yield from _leaves(field.dataType, f"{column}.`{field.name}`", f"{path}.{field.name}")
    elif isinstance(data_type, T.ArrayType):
        yield f"{path}.{ELEMENTS}", f"size({column}) > 0"
        element = f"e{path.count(ELEMENTS)}"
        for inner, test in _leaves(data_type.elementType, element, f"{path}.{ELEMENTS}"):
            yield inner, f"exists({column}, {element} -> coalesce({test}, false))"
    else:
        yield path, f"{column} IS NOT NULL"


def observed_fields(works: DataFrame) -> DataFrame:
    """Paths with a value in any record, found in one pass over the works."""
    tests = [
        pair for f in works.schema.fields for pair in _leaves(f.dataType, f"`{f.name}`", f.name)
    ]
    flags = works.selectExpr(*[f"bool_or({test}) AS `{i}`" for i, (_, test) in enumerate(tests)])
    seen = ", ".join(f"IF(`{i}`, '{path}', NULL)" for i, (path, _) in enumerate(tests))
    return flags.selectExpr(f"explode(array_compact(array({seen}))) AS path").selectExpr(
        "'works' AS relation", "path"
    )


def _kept(data_type, column: Column, prefix, known):
    """The column without unknown fields, or None when nothing of it is known."""
    if isinstance(data_type, T.StructType):
        fields = [
            (f.name, _kept(f.dataType, column[f.name], f"{prefix}.{f.name}", known))
            for f in data_type.fields
        ]
        fields = [c.alias(name) for name, c in fields if c is not None]
        return F.when(column.isNotNull(), F.struct(*fields)) if fields else None
    if isinstance(data_type, T.ArrayType):
        if f"{prefix}.{ELEMENTS}" not in known:
            return None
        inner = f"{prefix}.{ELEMENTS}"
        if _all_known(data_type.elementType, inner, known):
            return column
        if _kept(data_type.elementType, F.lit(None), inner, known) is None:
            return column
        return F.transform(column, lambda e: _kept(data_type.elementType, e, inner, known))
    return column if prefix in known else None


def _all_known(data_type, prefix, known):
    if isinstance(data_type, T.StructType):
        checks = [_all_known(f.dataType, f"{prefix}.{f.name}", known) for f in data_type.fields]
        return reduce(lambda a, b: a and b, checks, True)
    if isinstance(data_type, T.ArrayType):
        inner = f"{prefix}.{ELEMENTS}"
        return inner in known and _all_known(data_type.elementType, inner, known)
    return prefix in known


def restrict(works: DataFrame, known: set[str]) -> DataFrame:
    """Works with the known fields only; complete columns are passed on untouched."""
    columns = []
    for field in works.schema.fields:
        if field.name == "id" or _all_known(field.dataType, field.name, known):
            columns.append(F.col(field.name))
            continue
        kept = _kept(field.dataType, F.col(field.name), field.name, known)
        if kept is not None:
            columns.append(kept.alias(field.name))
    return works.select(*columns)
