"""Static dimensions."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from tillwatch import schemas as S

CITY_SCHEMA = StructType([
    StructField("location_id", StringType()),
    StructField("city", StringType()),
    StructField("region_code", StringType()),
    StructField("postal_code", StringType()),
    StructField("lat", DoubleType()),
    StructField("long", DoubleType()),
    StructField("population", IntegerType()),
])


def local_table(spark: SparkSession, rows: Sequence[tuple], schema: StructType) -> DataFrame:
    """A small table held in the plan itself, so that its size is known to the optimizer."""
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    arrays = [pa.array(list(values), to_arrow_type(field.dataType)) for values, field in zip(columns, schema)]
    return spark.createDataFrame(pa.table(arrays, names=schema.fieldNames()), schema)


def city_table(spark: SparkSession) -> DataFrame:
    """The fixed city dimension."""
    return local_table(spark, S.CITIES, CITY_SCHEMA)
