"""CDC JSON-lines source (A1) and the parsed / corrupt split."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermart.schemas import CDC_ENVELOPE_WITH_CORRUPT, CORRUPT_COLUMN


def read_cdc_json(spark: SparkSession, path: str) -> DataFrame:
    """A1: declared envelope schema plus a corrupt-record column, PERMISSIVE,
    one JSON object per line (splittable, so large landings parallelise)."""
    return (
        spark.read.option("multiLine", "false")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
        .schema(CDC_ENVELOPE_WITH_CORRUPT)
        .json(path)
    )


def split_corrupt(raw: DataFrame, persist: bool = True) -> tuple[DataFrame, DataFrame]:
    """(parsed, corrupt). Spark refuses queries that reference only the
    corrupt column of an unpersisted JSON scan, so the scan is persisted once
    (memory and disk) and both branches read it."""
    if persist:
        raw = raw.persist(StorageLevel.MEMORY_AND_DISK)
    parsed = raw.where(F.col(CORRUPT_COLUMN).isNull()).drop(CORRUPT_COLUMN)
    corrupt = raw.where(F.col(CORRUPT_COLUMN).isNotNull())
    return parsed, corrupt
