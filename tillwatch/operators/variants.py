"""Fields of JSON messages that nobody declared, by the VARIANT type."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BooleanType, NumericType, StringType, StructType


def kind_of(value: Column) -> Column:
    """``null``, ``boolean``, ``number``, ``string``, ``array`` or ``object``: the type of a value as JSON has it."""
    kind = F.schema_of_variant(value)
    return (
        F.when(kind.startswith("OBJECT"), "object").when(kind.startswith("ARRAY"), "array").when(kind == "STRING", "string")
        .when(kind == "BOOLEAN", "boolean").when(kind == "VOID", "null").otherwise("number")
    )


def fields(messages: DataFrame, value: str, carried: Sequence[str] = ()) -> DataFrame:
    """(carried, field, kind, _value) of the top-level fields of all messages that are JSON objects."""
    parsed = messages.select(*carried, F.try_parse_json(value).alias("_parsed"))
    objects = parsed.filter(F.schema_of_variant("_parsed").startswith("OBJECT"))
    exploded = objects.lateralJoin(objects.sparkSession.tvf.variant_explode(F.col("_parsed").outer()))
    return exploded.select(*carried, F.col("key").alias("field"), kind_of(F.col("value")).alias("kind"), F.col("value").alias("_value"))


def field_types(messages: DataFrame, value: str) -> DataFrame:
    """(field, kind, n) over all messages; combined before the shuffle, so a field of all messages is a few rows."""
    return fields(messages, value).groupBy("field", "kind").agg(F.count("*").alias("n"))


def declared_kind(schema: StructType) -> dict[str, str]:
    kinds = ((BooleanType, "boolean"), (NumericType, "number"), (StringType, "string"))
    return {f.name: next((name for kind, name in kinds if isinstance(f.dataType, kind)), "object") for f in schema.fields}


def mistyped(messages: DataFrame, value: str, schema: StructType, carried: Sequence[str] = ()) -> DataFrame:
    """(carried, field, kind, found): values of declared fields whose type is another one, nulls left out."""
    names = F.create_map(*[F.lit(x) for pair in declared_kind(schema).items() for x in pair])
    wrong = fields(messages, value, carried).filter(
        (F.col("kind") != "null") & (F.element_at(names, F.col("field")) != F.col("kind")))
    return wrong.select(*carried, "field", "kind", F.col("_value").cast("string").alias("found"))
