"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: ASCII blanks that part words: space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = " \t\n\x0b\x0c\r"


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; a temporary one only where none is named."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = tempfile.mkdtemp(prefix="checkpoint-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet into the shared folder and read back, which cuts its lineage."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without columns whose names a result is about to use."""
    return df.drop(*[c for c in df.columns if c.lower() in {n.lower() for n in names}])


def set_aside(df: DataFrame, *names: str) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with columns of these names renamed, and how to rename them back with ``withColumnsRenamed``."""
    taken = {n.lower() for n in names}
    back = {f"_own_{c}": c for c in df.columns if c.lower() in taken}
    return df.withColumnsRenamed({c: name for name, c in back.items()}), back


def word_count(text: Column) -> Column:
    """Number of words between ASCII blanks; 0 for null."""
    trimmed = F.nullif(F.btrim(text, F.lit(BLANKS)), F.lit(""))
    return F.coalesce(F.array_size(F.split(trimmed, r"[\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, everything else as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def unit_hash(value: Column, salt: str) -> Column:
    """A number in (0, 1) that depends on the value and the salt alone; 52 bits of an MD5 digest."""
    digest = F.md5(F.concat(F.coalesce(value.cast("string"), F.lit("")), F.lit(f":{salt}")))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(2**52))
