"""Batch ledger and compaction of the stream's outputs.

A micro-batch writes its outputs under ``<output>/run=R/batch_id=N`` and, when all are written, a
commit record ``_commits/run=R/batch_id=N``. Readers take committed batches only, so they see all
outputs of a batch or none; a replay of a failed batch replaces its folders before it commits.

The compactor turns committed batches into a versioned table per output with one folder per
event date. The marks (last batch taken, per run) are part of the version, so in one step the rows
appear in the table and the batches leave the reader's list. Batch folders go one compaction later,
for readers that resolved the version before. Partial counts are added up on the way, so the cost
of reading depends on the batches since the last compaction only, and a late count is added to its
window by the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermart.session import cut_lineage, discard_cut
from ordermart.sinks import versions
from ordermart.sinks.versions import VersionedTable, part_name

#: Outputs stored as JSON records (key and value, as on a topic); all others are Parquet with an ``event_date``. The
#: records carry their processing time only: their folders are those of its date.
JSON_OUTPUTS = {name: "key string, value string" for name in ("scored", "alerts")}
#: Outputs whose rows are partial counts: columns of the key, and the counts that add up.
ADDITIVE = {"windows": (["card_id", "window_start", "window_end", "event_date"], ["tx_count"])}


def commit_batch(spark: SparkSession, root: str, run_id: str, batch_id: int) -> None:
    """Record that all outputs of a batch are written (again, after a replay, is the same)."""
    name = f"batch_id={batch_id}"
    if name not in versions.list_folder(spark, f"{root}/_commits/run={run_id}"):
        versions.create_file(spark, f"{root}/_commits/run={run_id}/{name}", "\n")


def committed(spark: SparkSession, root: str) -> list[tuple[str, int]]:
    """(run, batch) of all committed batches."""
    out = []
    for run in versions.list_folder(spark, f"{root}/_commits"):
        if run.startswith("run="):
            out += [(run[4:], int(b[9:])) for b in versions.list_folder(spark, f"{root}/_commits/{run}") if b.startswith("batch_id=")]
    return sorted(out)


def _batches(spark: SparkSession, root: str, name: str, batches: list[tuple[str, int]]) -> DataFrame:
    paths = [f"{root}/{name}/run={r}/batch_id={b}" for r, b in batches]
    if name in JSON_OUTPUTS:
        processed = F.to_date(F.substring(F.get_json_object("value", "$.processed_at"), 1, 10))
        return spark.read.schema(JSON_OUTPUTS[name]).json(paths).withColumn("event_date", processed)
    return spark.read.parquet(*paths)


def _table(spark: SparkSession, root: str, name: str) -> VersionedTable:
    return VersionedTable(spark, f"{root}/_compacted/{name}")


def _added_up(rows: DataFrame, name: str) -> DataFrame:
    if name not in ADDITIVE:
        return rows
    keys, counts = ADDITIVE[name]
    return rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in counts])


def _new(spark: SparkSession, root: str, version) -> list[tuple[str, int]]:
    marks = version.meta if version else {}
    return [(r, b) for r, b in committed(spark, root) if b > marks.get(r, -1)]


def read_output(spark: SparkSession, root: str, name: str) -> DataFrame:
    """An output of all committed batches, compacted or not."""
    table = _table(spark, root, name)
    version = table.head()
    new = _new(spark, root, version)
    if not new:
        if version is None:
            raise FileNotFoundError(f"{root}: no committed batch")
        return table.read(version=version)
    rows = _batches(spark, root, name, new)
    if version is not None:
        rows = table.read(version=version).unionByName(rows)
    return _added_up(rows, name)


def compact(spark: SparkSession, root: str, name: str) -> int:
    """Move committed batches of an output into its table; returns how many. Only the dates
    that they hold are rewritten."""
    table = _table(spark, root, name)
    base = table.head()
    new = _new(spark, root, base)
    if not new:
        return 0
    rows = _batches(spark, root, name, new)
    days = [r[0] for r in rows.select("event_date").distinct().collect()]  # a row a day
    names = [part_name("event_date", d) for d in days]
    if base is not None:
        rows = table.read(names, base).unionByName(rows)
    merged = cut_lineage(_added_up(rows, name))
    before = dict(base.meta) if base else {}
    table.write(merged, "event_date", base, names, meta=before | dict(sorted(new)))
    discard_cut(merged)
    for run, mark in before.items():  # what the version before had taken
        for folder in versions.list_folder(spark, f"{root}/{name}/run={run}"):
            if folder.startswith("batch_id=") and int(folder[9:]) <= mark:
                versions.delete_folder(spark, f"{root}/{name}/run={run}/{folder}")
    return len(new)
