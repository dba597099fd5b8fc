"""Flattening documents and maps whose keys are not known beforehand.

One aggregation over all rows finds the schema: ``schema_of_variant_agg`` combines in
every task, and what it has gathered is as large as the schema. Then every leaf is
extracted with its type. Values whose kinds do not agree become text, as in the document.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.names import Columns, quoted


def document_schema(df: DataFrame, column: str) -> T.StructType:
    """The fields of all documents of a column of JSON text, VARIANT, map or struct. Runs one job.

    Whole numbers are bigint, or decimal beyond it, others double; what is of several kinds, or
    always null, is string; so is every document that is no object, which has no fields.
    """
    schema = T.StructType()
    for path, kind in _leaves(_measured(df, column)):
        schema.add(".".join(path), kind)
    return schema


def flatten_document(
    df: DataFrame, column: str, separator: str = "_", prefix: str | None = None, keep: bool = False, most: int = 500
) -> DataFrame:
    """The frame with a column for every leaf of its documents, in place of the document's column.

    Leaves are named by the path, after ``prefix`` (the column's name); arrays stay arrays.
    Text that is no JSON, and documents that are no objects, give NULL everywhere. Runs
    the job that measures the schema; over ``most`` leaves raise, for keys are data then
    and should be rows.
    """
    leaves = list(_leaves(_measured(df, column)))
    if len(leaves) > most:
        raise ValueError(f"{column} has {len(leaves)} different leaves, more than {most}; turn its keys into rows instead")
    own = Columns(df).require([column])[0]
    start = own if prefix is None else prefix
    kept = [c for c in df.columns if keep or c != own]
    names = [separator.join([start, *path] if start else path) for path, _ in leaves]
    key = Columns(df).key
    taken = [key(c) for c in kept] + [key(n) for n in names]
    clash = sorted({n for n in taken if taken.count(n) > 1})
    if clash:
        raise ValueError(f"flattening {column} would give several columns the names {clash}")
    variant = f"_{'_' * max(map(len, df.columns))}v"  # longer than any column's name
    parsed = df.withColumn(variant, _variant(df, own))
    values = [_extract(variant, path, kind).alias(name) for (path, kind), name in zip(leaves, names, strict=True)]
    return parsed.select(*(F.col(quoted(c)) for c in kept), *values)


def _variant(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType
    value = F.col(quoted(column))
    if isinstance(kind, T.VariantType):
        return value
    if isinstance(kind, T.StringType):
        return F.try_parse_json(value)
    if isinstance(kind, (T.MapType, T.StructType)):
        return F.to_variant_object(value)
    raise ValueError(f"{column} is a {kind.simpleString()}, which holds no documents")


def _measured(df: DataFrame, column: str) -> T.StructType:
    own = Columns(df).require([column])[0]
    documents = df.select(_variant(df, own).alias("v"))
    is_object = F.schema_of_variant("v").startswith("OBJECT")
    found = documents.agg(F.schema_of_variant_agg(F.when(is_object, F.col("v")))).first()[0]
    if not found or found in ("VOID", "OBJECT<>"):
        return T.StructType()
    return T.StructType.fromDDL(f"root {_as_struct(found)}")[0].dataType


def _as_struct(schema: str) -> str:
    """A measured schema in the names of column types; names in backticks stay as they are."""
    parts = re.split(r"(`(?:[^`]|``)*`)", schema)
    for i in range(0, len(parts), 2):
        parts[i] = parts[i].replace("OBJECT<>", "STRING").replace("OBJECT<", "STRUCT<")
        parts[i] = re.sub(r"\b(VARIANT|VOID)\b(?!:)", "STRING", parts[i])
        parts[i] = re.sub(r"DECIMAL\(\d+,\s*[1-9]\d*\)", "DOUBLE", parts[i])
    return "".join(parts)


def _leaves(schema: T.StructType, path: tuple[str, ...] = ()) -> Iterator[tuple[list[str], T.DataType]]:
    for field in schema:
        here = (*path, field.name)
        if isinstance(field.dataType, T.StructType):
            yield from _leaves(field.dataType, here)
        else:
            yield list(here), field.dataType


def _extract(variant: str, path: list[str], kind: T.DataType) -> Column:
    steps = "".join(_step(name) for name in path)
    return F.try_variant_get(F.col(quoted(variant)), f"${steps}", kind.simpleString())


def _step(name: str) -> str:
    if '"' not in name:
        return f'["{name}"]'
    if "'" not in name:
        return f"['{name}']"
    raise ValueError(f"the key {name} has both kinds of quotes, which no path can name")
