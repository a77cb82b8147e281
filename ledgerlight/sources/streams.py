"""Stream sources (S1): a file stream over a table folder, or Kafka when its connector is present.

Both give the same downstream frame, so every plan is written once. Schemas
are always explicit -- a stream never infers.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.decode import parse_json
from ..functions.timefn import epoch_micros, interval_text
from ..schemas import CORRUPT


def file_stream(spark: SparkSession, folder: str, schema: StructType, glob: str | None = None,
                max_files_per_trigger: int | None = None, fmt: str = "parquet") -> DataFrame:
    """New files in ``folder`` become micro-batches (oldest first)."""
    reader = spark.readStream.format(fmt).schema(schema).option("latestFirst", "false")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(int(max_files_per_trigger)))
    return reader.load(folder)


def replay(df: DataFrame, folder: str, slices: int, by: Column) -> Iterator[int]:
    """Write ``df`` into ``folder`` slice after slice (rows with ``by`` = 0, 1, ...), giving way after each.

    A stream over the folder that is run to the end of its input each time
    gets one micro-batch per slice, however many files a slice has.
    """
    for k in range(slices):
        df.filter(by == k).write.mode("append").parquet(folder)
        yield k


def time_slice(df: DataFrame, ts: str, slices: int) -> Column:
    """Slice number by event time: equal spans between the first and the last time (one aggregate)."""
    ends = df.agg(F.min(epoch_micros(ts)).alias("a"), F.max(epoch_micros(ts)).alias("b")).first()
    if ends["a"] is None:
        return F.lit(0)
    span = ends["b"] - ends["a"] + 1
    return F.floor((epoch_micros(ts) - F.lit(ends["a"])) * F.lit(slices) / F.lit(span)).cast("int")


def kafka_stream(spark: SparkSession, bootstrap_servers: str, topic: str,
                 starting_offsets: str = "earliest", **options: str) -> DataFrame:
    """Kafka records ``(key, value, topic, partition, offset, timestamp)``.

    Needs the ``spark-sql-kafka`` package on the classpath (not bundled
    here); without it ``load()`` raises Spark's "Failed to find data source:
    kafka" at once.
    """
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", bootstrap_servers)
              .option("subscribe", topic)
              .option("startingOffsets", starting_offsets))
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load()


def decode_json_values(records: DataFrame, ddl: str, value: str = "value") -> DataFrame:
    """Kafka/JSON records -> columns of ``ddl`` plus the record key and offset data."""
    parsed = parse_json(F.col(value).cast("string"), ddl)
    keep = [c for c in ("key", "topic", "partition", "offset", "timestamp") if c in records.columns]
    return records.select(*keep, parsed.alias("__v")).select(*keep, "__v.*")


#: identity of a record: where it lies in the log
RECORD_ID = ["topic", "partition", "offset"]


def dedup_records(records: DataFrame, delay: str, timestamp: str = "timestamp") -> DataFrame:
    """Kafka-shaped records without replays: one row per (topic, partition, offset).

    A producer or a restarted reader may deliver a record again. On a stream
    the identities seen are state, dropped once the watermark has passed a
    record by ``delay``, so state is bounded; a record delivered again later
    than that is behind the watermark and dropped as late. A batch frame is
    deduplicated as a whole. A record without a timestamp cannot be placed on
    the watermark: on a stream it is never late and never forgotten.
    """
    if not records.isStreaming:
        return records.dropDuplicates(RECORD_ID)
    return records.withWatermark(timestamp, interval_text(delay)).dropDuplicatesWithinWatermark(RECORD_ID)


def decode_records(records: DataFrame, ddl: str, value: str = "value") -> DataFrame:
    """Records -> the columns of ``ddl``, with the record's place and what it is.

    ``kind``: ``value``; ``tombstone`` for a null value, which deletes its key
    and has null columns; ``unreadable`` for a text that is no JSON object of
    this shape (its columns hold what could be read).
    """
    text = F.col(value).cast("string")
    parsed = parse_json(text, f"{ddl}, {CORRUPT} string")
    keep = [c for c in (*RECORD_ID, "timestamp") if c in records.columns]
    rows = records.select(*keep, F.col("key").cast("string").alias("record_key"), text.alias("__text"), parsed.alias("__v"))
    kind = F.when(F.col("__text").isNull(), "tombstone") \
        .when(F.col("__v").isNull() | F.col("__v")[CORRUPT].isNotNull(), "unreadable").otherwise("value")
    return rows.select(*keep, "record_key", kind.alias("kind"), "__v.*").drop(CORRUPT)
