"""Time series in partitions by series, span of time and batch.

A range opens the folders of its series and spans alone, a batch that runs again
replaces its own folders, and retention drops whole folders.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampNTZType

from tillwatch.sources.static import local_table
from tillwatch.streaming.stores import delete_path, path_exists

SPAN = "span"
# Spans by unit, as Spark and as Python writes them; both sort by time.
SPAN_FORMATS = {"hour": ("yyyyMMddHH", "%Y%m%d%H"), "day": ("yyyyMMdd", "%Y%m%d")}
SCHEMA = StructType([
    StructField("ts", TimestampNTZType()), StructField("value", LongType()), StructField("series", StringType()),
    StructField(SPAN, StringType()), StructField("batch_id", LongType())])


@dataclass(frozen=True)
class SeriesStore:
    """``unit`` is the length of a span: hours for points of some days, days for longer ones. It stays with the path."""

    path: str
    unit: str = "hour"

    def _span(self, ts: str) -> Column:
        return F.date_format(ts, SPAN_FORMATS[self.unit][0])

    def write(self, points: DataFrame, batch_id: int) -> None:
        """Write the points (series, ts, value) of a batch, in place of what it has written before.

        The folders that the batch wrote to before and does not any more stay, so
        a batch that runs again has to have the same points.
        """
        rows = points.select(
            F.col("ts").cast("timestamp_ntz").alias("ts"), F.col("value").cast("bigint").alias("value"), "series",
            self._span("ts").alias(SPAN), F.lit(batch_id).cast("bigint").alias("batch_id"))
        # One file for each folder.
        rows.repartition("series", SPAN).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "series", SPAN, "batch_id").parquet(self.path)

    def read(self, spark: SparkSession, series: str | None = None, since: datetime | None = None,
             until: datetime | None = None) -> DataFrame:
        """Points from ``since`` to ``until``, both included; spans outside are not listed among the files to read."""
        if not path_exists(spark, self.path):
            return local_table(spark, [], SCHEMA).select("series", "ts", "value")
        rows = spark.read.schema(SCHEMA).parquet(self.path)
        if series is not None:
            rows = rows.filter(F.col("series") == series)
        for moment, keeps in ((since, "__ge__"), (until, "__le__")):
            if moment is not None:
                span = moment.strftime(SPAN_FORMATS[self.unit][1])
                at = F.lit(moment).cast("timestamp_ntz")
                rows = rows.filter(getattr(F.col(SPAN), keeps)(span) & getattr(F.col("ts"), keeps)(at))
        return rows.select("series", "ts", "value")

    def retain(self, spark: SparkSession, retention_ms: int) -> int:
        """Drop the spans of each series that end before its retention begins, and return how many.

        Times come from the newest folder of each series; the driver sees names of
        folders, as many as there are series and spans.
        """
        rows = spark.read.schema(SCHEMA).parquet(self.path)
        newest = rows.groupBy("series", SPAN).agg(F.max("ts").alias("_last"))
        limits = newest.groupBy("series").agg((F.max("_last") - F.expr(f"interval {retention_ms} milliseconds")).alias("_from"))
        old = newest.join(limits, "series").filter(F.col(SPAN) < self._span("_from"))
        escaped = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
        gone = old.select("series", SPAN).collect()
        for row in gone:
            delete_path(spark, f"{self.path}/series={escaped(row.series)}/{SPAN}={row[SPAN]}")
        return len(gone)
