"""JSON whose fields differ by row: variants, with a schema found by Spark over all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType


def parsed(frame: DataFrame, text: str, alias: str) -> DataFrame:
    """Add the text as a variant, parsed once; null where it is no JSON."""
    return frame.withColumn(alias, F.try_parse_json(F.col(text)))


def merged_schema(frame: DataFrame, variant: str) -> str:
    """DDL of the type that all rows' objects fit, from one aggregate (a schema a task is exchanged).

    A field that some rows lack is in it; one whose type differs by row has the wider
    type, or stays a variant. Values that are no objects are left out.
    """
    value = F.col(variant)
    objects = F.when(F.schema_of_variant(value).startswith("OBJECT"), value)
    found = frame.agg(F.schema_of_variant_agg(objects).alias("schema")).first()["schema"]
    return (found or "VOID").replace("OBJECT<", "STRUCT<")


def typed_fields(frame: DataFrame, variant: str, schema: str, path: str = "$") -> list[tuple[str, Column]]:
    """(path, column) of every field of an object's merged schema, nested objects opened.

    Arrays, and fields of mixed type, stay one column each: the latter as text.
    """
    kind = DataType.fromDDL(f"x {schema}")["x"].dataType
    if not isinstance(kind, StructType):
        return []
    fields: list[tuple[str, Column]] = []

    def walk(struct: StructType, at: str) -> None:
        for field in struct.fields:
            place = f"{at}['{field.name}']" if not field.name.isidentifier() else f"{at}.{field.name}"
            if isinstance(field.dataType, StructType):
                walk(field.dataType, place)
                continue
            ddl = field.dataType.simpleString()
            plain = "string" if ddl in ("variant", "void") else ddl
            fields.append((place, F.try_variant_get(F.col(variant), place, plain)))

    walk(kind, path)
    return fields


def flatten_json(frame: DataFrame, text: str, keep: Sequence[str] = (), sep: str = "_") -> DataFrame:
    """The ``keep`` columns, and one column for each field that any row's JSON object has.

    Two passes over the rows: one merges their schemas, one extracts. No schema is
    inferred from a sample and no row's fields are lost; a row without a field has
    a null there, and a text that is no JSON object has nulls throughout.
    """
    values = parsed(frame, text, "_variant")
    fields = typed_fields(values, "_variant", merged_schema(values, "_variant"))
    names = [p.removeprefix("$.").replace("['", sep).replace("']", "").replace(".", sep).removeprefix("$") for p, _ in fields]
    return values.select(*keep, *[c.alias(n) for n, (_, c) in zip(names, fields)])
