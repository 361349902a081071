"""Shorthand for building rows and reading results."""

from pyspark.sql.types import StructType


def frame(spark, schema, *rows):
    """Rows given as dictionaries over a full schema; absent fields are null."""
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    return spark.createDataFrame([tuple(row.get(name) for name in schema.fieldNames()) for row in rows], schema)


def column(df, name):
    return [row[name] for row in df.select(name).collect()]


def as_set(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)
