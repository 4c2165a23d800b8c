"""Nested JSON frames to flat rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType


def flatten(frame: DataFrame, sep: str = "_") -> DataFrame:
    """Flat columns only: structs become ``parent_child`` columns, arrays become rows.

    Null and empty arrays keep their row. Sibling arrays multiply, as each is
    exploded in turn. One ``select`` is added per nesting level or array, all
    inside the same stage: nothing is shuffled. A name that is already taken
    gets a numeric suffix.
    """
    while True:
        fields = frame.schema.fields
        if any(isinstance(f.dataType, StructType) for f in fields):
            frame = _open_structs(frame, sep)
            continue
        array = next((f.name for f in fields if isinstance(f.dataType, ArrayType)), None)
        if array is None:
            return frame
        frame = frame.select(
            *[
                F.explode_outer(_quoted(f.name)).alias(f.name)
                if f.name == array
                else F.col(_quoted(f.name))
                for f in fields
            ]
        )


def _open_structs(frame: DataFrame, sep: str) -> DataFrame:
    taken = {f.name.lower() for f in frame.schema.fields if not isinstance(f.dataType, StructType)}
    columns = []
    for field in frame.schema.fields:
        if not isinstance(field.dataType, StructType):
            columns.append(F.col(_quoted(field.name)))
            continue
        for child in field.dataType.fields:
            name = _free_name(f"{field.name}{sep}{child.name}", taken)
            taken.add(name.lower())
            columns.append(F.col(_quoted(field.name)).getField(child.name).alias(name))
    return frame.select(*columns)


def _free_name(name: str, taken: set[str]) -> str:
    candidate, n = name, 2
    while candidate.lower() in taken:
        candidate, n = f"{name}_{n}", n + 1
    return candidate


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
