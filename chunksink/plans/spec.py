"""Table specifications and the checked projection onto them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column as SparkColumn
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunksink.functions.types import Type, not_null


@dataclass(frozen=True)
class Column:
    """A column's type, whether it may be null, and a codec of its own."""

    type: Type
    nullable: bool = False
    compression: str | None = None


Schema = dict[str, Column]


def conform(df: DataFrame, schema: Schema, keep: tuple[str, ...] = ()) -> DataFrame:
    """Declared columns in declared order, converted and checked; other fields go, but for ``keep``.

    Types that cannot match raise ``TypeError`` here; values that do not fit fail
    the job with the column's name.
    """
    out: list[SparkColumn] = [F.col(f"`{c}`") for c in keep]
    for name, column in schema.items():
        if name not in df.columns:
            if not column.nullable:
                raise TypeError(f"{name} is missing and must not be null")
            out.append(F.lit(None).cast(column.type.spark).alias(name))
            continue
        kind, value = df.schema[name].dataType, F.col(f"`{name}`")
        if kind.typeName() != "void" and not column.type.accepts(kind):
            raise TypeError(f"{name}: {kind.simpleString()} does not fit {type(column.type).__name__}")
        made = F.lit(None).cast(column.type.spark) if kind.typeName() == "void" else column.type.convert(value, kind, name)
        out.append((made if column.nullable else not_null(made, value, name)).alias(name))
    return df.select(*out)


def violations(df: DataFrame, checks: dict[str, SparkColumn]) -> DataFrame:
    """One row: how many rows break each check (null counts as broken)."""
    return df.agg(*(F.count_if(~F.coalesce(ok, F.lit(False))).alias(name) for name, ok in checks.items()))
