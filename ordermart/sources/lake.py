"""Lake readers and the named-source registry."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermart.session import hadoop_path, sql_conf
from ordermart.sinks.versions import VersionedTable, part_values


def read_partition(spark: SparkSession, root: str, run_date: str, partition_col: str = "ingestion_date") -> DataFrame:
    """A2: exactly one partition, by a filter on the partition column:
    the scan prunes the other folders and the column stays in the frame."""
    return spark.read.parquet(root).where(F.col(partition_col) == F.lit(str(run_date)))


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a table folder exists (first-run detection), via the Hadoop
    file system of the path, so it works for object stores too."""
    fs, p = hadoop_path(spark, path)
    return fs.exists(p)


def read_history(spark: SparkSession, root: str) -> DataFrame:
    """A3: all partitions, of a versioned table those of its current version."""
    table = VersionedTable(spark, root)
    version = table.head()
    return table.read(version=version) if version else spark.read.parquet(root)


def newest_value(spark: SparkSession, path: str, column: str):
    """The largest value of a column (dates and numbers) from the file footers: the V2
    Parquet source answers MAX from row-group statistics, no column is read. A partition column is answered from the
    folder names, of a versioned table from its log."""
    table = VersionedTable(spark, path)
    version = table.head()
    if version is not None and version.partition_col == column:
        kind = version.schema[column].dataType.simpleString()
        names = [(v,) for v in part_values(version) if v is not None]
        found = spark.createDataFrame(names, "v string").agg(F.max(F.col("v").cast(kind)).alias("m")) if names else None
        return found.first()["m"] if found is not None else None
    return newest_plan(spark, table.paths(version) if version else [path], column).first()["m"]


def newest_plan(spark: SparkSession, paths: list[str], column: str) -> DataFrame:
    """The frame behind :func:`newest_value`: one row, planned over footers."""
    settings = {"spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text", "spark.sql.parquet.aggregatePushdown": "true"}
    with sql_conf(spark, settings):
        found = spark.read.parquet(*paths).agg(F.max(column).alias("m"))
        found._jdf.queryExecution().executedPlan()  # planned here, with these settings
    return found


class SourceRegistry:
    """Logical names for tables and models. A name maps to a loader
    (lazy DataFrame); models may read other names, which is the model graph.
    Registered frames are also temp views for SQL."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._loaders: dict[str, Callable[["SourceRegistry"], DataFrame]] = {}

    def register(self, name: str, loader: Callable[["SourceRegistry"], DataFrame]) -> None:
        self._loaders[name] = loader

    def register_path(self, name: str, path: str, fmt: str = "parquet") -> None:
        """A folder of files; Parquet ones may be a versioned table."""
        self._loaders[name] = lambda reg: (read_history(reg.spark, path) if fmt == "parquet"
                                           else reg.spark.read.format(fmt).load(path))

    def ref(self, name: str) -> DataFrame:
        df = self._loaders[name](self)
        df.createOrReplaceTempView(name)
        return df

    def names(self) -> list[str]:
        return sorted(self._loaders)
