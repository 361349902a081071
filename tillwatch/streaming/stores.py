"""Parquet stores that micro-batches write to.

Each batch is one directory, so a batch that is run again after a failure
replaces what it wrote before and nothing is counted twice.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from tillwatch.operators.joins import lookup
from tillwatch.plans.flows import latest_entities
from tillwatch.sources.static import local_table

BATCH = "batch_id"
BUCKET = "_bucket"
BUCKETS = 256


def _file_system(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop = _file_system(spark, path)
    return fs.exists(hadoop)


def delete_path(spark: SparkSession, path: str) -> None:
    fs, hadoop = _file_system(spark, path)
    fs.delete(hadoop, True)


def numbered_directories(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """Sorted numbers ``n`` of the complete ``prefix=n`` directories under a path."""
    if not path_exists(spark, path):
        return []
    fs, hadoop = _file_system(spark, path)
    numbers = []
    for status in fs.listStatus(hadoop):
        name, _, number = status.getPath().getName().partition("=")
        done = spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
        if name == prefix and number.isdigit() and fs.exists(done):
            numbers.append(int(number))
    return sorted(numbers)


def bucket_of(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


@dataclass(frozen=True)
class BatchTable:
    """A table that grows by micro-batches, with an occasional snapshot of what they hold together.

    Batch ids restart when a query gets a new checkpoint, so give a new
    checkpoint a new ``path``. With ``bucket_by`` snapshots are in directories by
    a hash of that column, and a reader that knows its keys opens theirs alone.
    """

    path: str
    schema: StructType
    snapshot_path: str | None = None
    bucket_by: str | None = None

    @property
    def _full_schema(self) -> StructType:
        return StructType([*self.schema.fields, StructField(BATCH, LongType())])

    def write(self, df: DataFrame, batch_id: int) -> None:
        columns = df.select(*self.schema.fieldNames())
        columns.write.mode("overwrite").parquet(f"{self.path}/{BATCH}={batch_id}")

    def read_batch(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """What one batch has written."""
        return spark.read.schema(self.schema).parquet(f"{self.path}/{BATCH}={batch_id}")

    def tried(self, spark: SparkSession) -> bool:
        """Whether anything was ever written."""
        return path_exists(spark, self.path)

    def snapshots(self, spark: SparkSession) -> list[int]:
        return numbered_directories(spark, self.snapshot_path, "upto") if self.snapshot_path else []

    def read(self, spark: SparkSession, after: int | None = None, buckets: Sequence[int] | None = None) -> DataFrame:
        """The newest snapshot and the batches since, with their ``batch_id``; or what is later than ``after``.

        ``buckets`` are the ones to open of a snapshot. Call it inside the batch, to see new files.
        """
        snapshots = self.snapshots(spark)
        exists = path_exists(spark, self.path)
        rows = spark.read.schema(self._full_schema).parquet(self.path) if exists else local_table(
            spark, [], self._full_schema)
        if snapshots:
            schema = self._full_schema.add(BUCKET, IntegerType()) if self.bucket_by else self._full_schema
            snapshot = spark.read.schema(schema).parquet(f"{self.snapshot_path}/upto={snapshots[-1]}")
            if self.bucket_by and buckets is not None:
                snapshot = snapshot.filter(F.col(BUCKET).isin(list(buckets)))
            rows = snapshot.drop(BUCKET).unionByName(rows.filter(F.col(BATCH) > snapshots[-1]))
        return rows if after is None else rows.filter(F.col(BATCH) > after)

    def expire(self, spark: SparkSession, keep_after: int) -> None:
        """Delete the batches up to and including ``keep_after``."""
        for number in numbered_directories(spark, self.path, BATCH):
            if number <= keep_after:
                delete_path(spark, f"{self.path}/{BATCH}={number}")

    def compact(self, spark: SparkSession, reduced: Callable[[DataFrame], DataFrame] | None = None) -> int | None:
        """Write ``reduced`` of the table as a snapshot and return the last batch in it.

        The snapshot before and the batches since then stay, for readers that have
        already planned on them; anything older is deleted.
        """
        batches, snapshots = numbered_directories(spark, self.path, BATCH), self.snapshots(spark)
        if not batches or (snapshots and batches[-1] <= snapshots[-1]):
            return None
        upto = batches[-1]
        rows = self.read(spark).filter(F.col(BATCH) <= upto)
        rows = (reduced(rows) if reduced else rows).select(*self._full_schema.fieldNames())
        if self.bucket_by:
            rows = rows.withColumn(BUCKET, bucket_of(self.bucket_by)).repartition(BUCKET)
        writer = rows.write.mode("overwrite")
        (writer.partitionBy(BUCKET) if self.bucket_by else writer).parquet(f"{self.snapshot_path}/upto={upto}")
        if snapshots:
            self.expire(spark, snapshots[-1])
            for number in snapshots[:-1]:
                delete_path(spark, f"{self.snapshot_path}/upto={number}")
        return upto


@dataclass(frozen=True)
class EntityStore:
    """Latest value per key, kept as a change log and compacted snapshots of it in buckets of the key."""

    path: str
    key: str
    schema: StructType
    log: BatchTable = field(init=False)

    def __post_init__(self):
        object.__setattr__(
            self, "log", BatchTable(f"{self.path}/log", self.schema, f"{self.path}/snapshot", self.key))

    def upsert(self, df: DataFrame, batch_id: int) -> None:
        self.log.write(df, batch_id)

    def latest(
        self, spark: SparkSession, keys: DataFrame | None = None, columns: Sequence[str] | None = None
    ) -> DataFrame:
        """One row per key, of all keys or of the given ones.

        With ``keys`` (distinct, one column named as the key) a snapshot's buckets of
        these keys are opened alone, and only rows of the keys are kept before
        versions are compared, so a micro-batch neither reads nor shuffles the whole store.
        """
        if keys is None:
            return latest_entities(self.log.read(spark), self.key, columns)
        buckets = None
        if self.log.snapshots(spark):
            # At most ``BUCKETS`` numbers.
            buckets = [row[0] for row in keys.select(bucket_of(self.key)).distinct().collect()]
        rows = self.log.read(spark, buckets=buckets)
        return latest_entities(lookup(rows, keys, self.key, "left_semi"), self.key, columns)

    def compact(self, spark: SparkSession) -> int | None:
        """Write the current view as a snapshot and return the last batch in it."""
        return self.log.compact(spark, lambda rows: latest_entities(rows, self.key))
