"""Atomic table versions.

A versioned table is a folder of Parquet data that is never changed in place and a log:

    root/data/version=<tag>/[<column>=<value>/]part-*.parquet
    root/_keys/version=<tag>/   which folders may hold a key (``key_index``), where the writer names one
    root/_log/<number>.json     the data folders that version <number> consists of

A writer adds its data under a tag of its own and creates the next log file
last; creating it is the commit. Readers take the highest complete log entry, so they see all of a
change or nothing, and a reader that started before a commit still finds its files (the last ``KEEP``
versions stay). Nothing is renamed, so this works on object stores as well. A job that fails
anywhere before the log file leaves the table as it was, and what it wrote is never read; the next
commit clears it away. Two writers that start from the same version cannot both commit: the second
finds the log file present and fails.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ordermart.session import hadoop_path, sql_conf
from ordermart.sinks import key_index

KEEP = 2
MAX_RECORDS_PER_FILE = 2_000_000


# The only calls that touch the file system besides Spark's own reads (tests make each of them fail).
def list_folder(spark: SparkSession, path: str) -> list[str]:
    fs, p = hadoop_path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def read_file(spark: SparkSession, path: str) -> str:
    fs, p = hadoop_path(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_file(spark: SparkSession, path: str, text: str) -> None:
    """Create a file; fails when it exists."""
    fs, p = hadoop_path(spark, path)
    stream = fs.create(p, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def delete_folder(spark: SparkSession, path: str) -> None:
    fs, p = hadoop_path(spark, path)
    fs.delete(p, True)


def write_parquet(df: DataFrame, path: str, partition_col: str | None) -> None:
    """AQE splits a large partition value (REBALANCE) and, without partitions, joins small pieces;
    with partitions it does not, so many small dates are written by parallel tasks."""
    out = df.hint("rebalance", partition_col) if partition_col else df.hint("rebalance")
    with sql_conf(df.sparkSession, {"spark.sql.adaptive.coalescePartitions.enabled": "false"} if partition_col else {}):
        writer = out.write.option("compression", "snappy").option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
        (writer.partitionBy(partition_col) if partition_col else writer).parquet(path)


class Version(NamedTuple):
    """``parts``: data folder ('' without partitions) -> tag; ``schema`` with the partition column last."""

    number: int
    parts: dict[str, str]
    schema: StructType
    partition_col: str | None
    meta: dict  # what its writer noted with it


class VersionedTable:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _entries(self) -> list[int]:
        return sorted(int(n[:-5]) for n in list_folder(self.spark, f"{self.root}/_log") if n.endswith(".json") and n[:-5].isdigit())

    def _entry(self, number: int) -> Version | None:
        text = read_file(self.spark, f"{self.root}/_log/{number:012d}.json")
        if not text.endswith("\n"):  # its writer failed between creating and writing it
            return None
        e = json.loads(text)
        return Version(number, e["parts"], StructType.fromJson(e["schema"]), e["partition_col"], e.get("meta") or {})

    def head(self) -> Version | None:
        """The current version; None before the first commit."""
        for number in reversed(self._entries()):
            version = self._entry(number)
            if version:
                return version
        return None

    def paths(self, version: Version, parts: Iterable[str] | None = None) -> list[str]:
        chosen = version.parts if parts is None else [p for p in parts if p in version.parts]
        return [f"{self.root}/data/version={version.parts[p]}" + (f"/{p}" if p else "") for p in chosen]

    def read(self, parts: Iterable[str] | None = None, version: Version | None = None) -> DataFrame:
        """The current (or given) version, or only the named parts of it (their folders are all that is listed)."""
        version = version or self.head()
        if version is None:
            raise FileNotFoundError(f"no committed version of {self.root}")
        paths = self.paths(version, parts)
        if not paths:
            return self.spark.createDataFrame([], version.schema)
        listing = {"spark.sql.sources.parallelPartitionDiscovery.parallelism": str(max(8, len(paths) // 100))}
        with sql_conf(self.spark, listing):  # tasks list many folders each, not one
            found = self.spark.read.schema(version.schema).option("basePath", f"{self.root}/data").parquet(*paths)
        return found.select(version.schema.fieldNames())

    def commit(self, base: Version | None, parts: dict[str, str], schema: StructType, partition_col: str | None, meta: dict) -> int:
        """Make ``parts`` the current version, if none was committed since ``base``."""
        entries = self._entries()
        done = next((n for n in reversed(entries) if self._entry(n)), 0)
        if done != (base.number if base else 0):
            raise RuntimeError(f"{self.root}: version {done} was committed since this job started")
        number = (entries[-1] if entries else 0) + 1
        create_file(self.spark, f"{self.root}/_log/{number:012d}.json", json.dumps(
            {"parts": parts, "schema": schema.jsonValue(), "partition_col": partition_col, "meta": meta}) + "\n")
        return number

    def write(self, df: DataFrame, partition_col: str | None, base: Version | None, replaces: Iterable[str] | None,
              key: str | None = None, meta: dict | None = None) -> Version:
        """Commit ``df`` in place of the parts named by ``replaces`` (None: of the whole table)
        and of those it has rows for. With ``key`` its index is written as well, from the files written. ``meta``
        is committed with the version."""
        if partition_col:
            df = df.select(*(c for c in df.columns if c != partition_col), partition_col)
        tag = f"v{(base.number if base else 0) + 1:09d}-{uuid.uuid4().hex[:8]}"
        path = f"{self.root}/data/version={tag}"
        write_parquet(df, path, partition_col)
        if key:
            stored = self.spark.read.schema(df.schema).parquet(path)
            write_parquet(key_index.build(stored, key, partition_col), f"{self.root}/_keys/version={tag}", None)
        if partition_col:
            names = [n for n in list_folder(self.spark, path) if "=" in n]
            kept = {} if replaces is None or base is None else {p: t for p, t in base.parts.items() if p not in set(replaces)}
            parts = kept | dict.fromkeys(names, tag)
        else:
            parts = {"": tag}
        number = self.commit(base, parts, df.schema, partition_col, meta or {})
        self.vacuum()
        return Version(number, parts, df.schema, partition_col, meta or {})

    def holding(self, version: Version, keys: DataFrame, key: str) -> list[str]:
        """Parts of ``version`` that may hold one of the keys."""
        have = set(list_folder(self.spark, f"{self.root}/_keys"))
        tags = [t for t in dict.fromkeys(version.parts.values()) if f"version={t}" in have]
        if not tags:
            return list(version.parts)
        index = self.spark.read.schema(key_index.SCHEMA + ", version string").option("basePath", f"{self.root}/_keys").parquet(
            *(f"{self.root}/_keys/version={t}" for t in tags))
        return key_index.candidates(index, version.parts, keys, key)

    def replace(self, df: DataFrame) -> Version:
        """A whole new table, which ``df`` may read from the present one."""
        return self.write(df, None, self.head(), None)

    def vacuum(self, keep: int = KEEP) -> None:
        """Delete data that none of the last ``keep`` versions uses, then older log entries."""
        entries = [v for v in map(self._entry, self._entries()) if v]
        live = {(t, p) for v in entries[-keep:] for p, t in v.parts.items()}
        tags = {t for t, _ in live}
        for folder in ("data", "_keys"):
            for name in list_folder(self.spark, f"{self.root}/{folder}"):
                if name.startswith("version=") and name[8:] not in tags:
                    delete_folder(self.spark, f"{self.root}/{folder}/{name}")
        for p, t in {(p, t) for v in entries[:-keep] for p, t in v.parts.items()} - {(p, t) for t, p in live}:
            if t in tags and p:
                delete_folder(self.spark, f"{self.root}/data/version={t}/{p}")
        kept = {v.number for v in entries[-keep:]}
        for number in self._entries():
            if number not in kept and number < max(kept):
                delete_folder(self.spark, f"{self.root}/_log/{number:012d}.json")


def part_name(partition_col: str, value) -> str:
    """The folder of a partition value (dates and plain names need no escaping)."""
    return f"{partition_col}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}"


def part_values(version: Version) -> list[str | None]:
    values = [p.split("=", 1)[1] for p in version.parts]
    return [None if v == "__HIVE_DEFAULT_PARTITION__" else v for v in values]


def replace_table(df: DataFrame, path: str) -> None:
    VersionedTable(df.sparkSession, path).replace(df)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return VersionedTable(spark, path).read()


def table_exists(spark: SparkSession, path: str) -> bool:
    return VersionedTable(spark, path).head() is not None
