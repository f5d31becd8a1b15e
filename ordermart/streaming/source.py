"""Transaction stream source.

Production reads Kafka; tests read JSON-lines files. Both go through the same
``decode_transactions`` so the decode and quarantine behaviour is one code
path. Rows that fail to decode are kept with ``_decode_ok = false`` (routed to
quarantine by the sink) instead of turning into all-NULL rows that later
break scoring.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermart.functions import fixed
from ordermart.functions.columns import parse_iso_instant
from ordermart.schemas import TRANSACTION
from ordermart.session import cut_lineage, discard_cut

#: Tasks that write the files of one landing.
MAX_WRITERS = 1024


def decode_transactions(raw: DataFrame, value_col: str = "value", broker_ts_col: str | None = None) -> DataFrame:
    """JSON text -> declared transaction columns, ``event_ts`` parsed
    once, decode flag, broker time kept when present."""
    tx = F.from_json(F.col(value_col).cast("string"), TRANSACTION)
    cols = [tx.alias("tx"), F.col(value_col).cast("string").alias("_raw")]
    if broker_ts_col:
        cols.append(F.col(broker_ts_col).alias("kafka_timestamp"))
    extra = ["_raw"] + (["kafka_timestamp"] if broker_ts_col else [])
    df = raw.select(*cols).select("tx.*", *extra)
    df = df.withColumn("event_ts", parse_iso_instant(F.col("event_time")))
    ok = F.col("transaction_id").isNotNull() & F.col("card_id").isNotNull() & F.col("event_ts").isNotNull()
    return df.withColumn("_decode_ok", ok)


def read_transactions(
    spark: SparkSession,
    path: str | None = None,
    bootstrap: str | None = None,
    topic: str = "transactions.raw",
    max_per_trigger: int = fixed.MAX_RECORDS_PER_TRIGGER,
    max_files_per_trigger: int | None = None,
    starting_offsets: str = "latest",
    kafka_options: dict | None = None,
) -> DataFrame:
    """A4/A5: Kafka topic (``bootstrap`` given) or a folder of JSON lines;
    admission control by ``maxOffsetsPerTrigger`` / ``maxFilesPerTrigger``."""
    if bootstrap:
        reader = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap)
            .option("subscribe", topic)
            .option("startingOffsets", starting_offsets)
            .option("maxOffsetsPerTrigger", max_per_trigger)
        )
        for k, v in (kafka_options or {}).items():
            reader = reader.option(k, v)
        return decode_transactions(reader.load(), "value", "timestamp")
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return decode_transactions(reader.load(path), "value")


def land_capped(lines: DataFrame, path: str, max_records: int = fixed.MAX_RECORDS_PER_TRIGGER) -> int:
    """A5 for landed files: lines (one column) as files of ``max_records`` lines, the last of the rest, each in a folder
    ``file=N`` of ``path``; returns how many. A file source takes whole files, so with ``max_files_per_trigger=1`` no
    micro-batch has more records than that, however large a landing was.

    The lines are numbered by their partition and place in it, and the files are written side by side."""
    spark = lines.sparkSession
    place = F.monotonically_increasing_id()  # partition << 33 + place in it
    placed = cut_lineage(lines.toDF("value").withColumn("_place", place))  # numbered once
    part, place = F.shiftright("_place", 33), F.col("_place").bitwiseAND(2**33 - 1)
    counts = placed.groupBy(part.alias("_part")).agg(F.max(place).alias("last")).orderBy("_part").collect()  # a row a partition
    first, total = [], 0
    for r in counts:
        first.append((r["_part"], total))
        total += r["last"] + 1
    files = -(-total // max_records)
    if files:
        starts = F.broadcast(spark.createDataFrame(first, "_part long, _first long"))
        number = F.floor((F.col("_first") + place) / max_records).cast("int")
        (placed.withColumn("_part", part).join(starts, "_part").select("value", number.alias("file"))
         .repartitionByRange(min(files, MAX_WRITERS), "file").write.mode("append").partitionBy("file").text(path))
    discard_cut(placed)
    return files


def reject_future(tx: DataFrame, max_future: str = "1 day") -> DataFrame:
    """An event dated further ahead of the clock than ``max_future`` is not
    decodable as an event of now: it goes the way of undecodable messages
    instead of making all later traffic of its card late."""
    ahead = F.coalesce(F.col("event_ts") > F.current_timestamp() + F.expr(f"INTERVAL {max_future}"), F.lit(False))
    return tx.withColumn("_decode_ok", F.col("_decode_ok") & ~ahead)
