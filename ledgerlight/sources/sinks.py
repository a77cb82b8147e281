"""Sinks: routed log files, alert table, idempotent batch tables, run counters.

Writers never collect: each one is a distributed ``DataFrame.write``. Batch
writers that may be replayed (a ``foreachBatch`` retried after an executor
loss) write to a location derived from the batch id with ``overwrite``, so a
replay replaces its own output instead of duplicating it.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F



def write_routed_logs(routed: DataFrame, path: str, columns: Sequence[str], sink: str = "sink",
                      mode: str = "append") -> None:
    """JSON lines per sink (S5 default sink, S6 restricted sink), ``sink=<name>/`` folders.

    The restricted sink is a separate folder so its access can be separated
    from the default one; one pass over the routed frame writes both.
    """
    out = routed.select(sink, F.to_json(F.struct(*columns)).alias("value"))
    out.write.mode(mode).partitionBy(sink).text(path)


def write_alerts(alerts: DataFrame, path: str, mode: str = "append") -> None:
    """Alert list -> Parquet table (S7); the chat delivery itself is outside Spark."""
    alerts.write.mode(mode).parquet(path)


def write_batch(df: DataFrame, root: str, batch_id: int) -> str:
    """Idempotent micro-batch write: ``root/batch=<id>`` overwritten on replay."""
    path = os.path.join(root, f"batch={int(batch_id)}")
    df.write.mode("overwrite").parquet(path)
    return path


def read_batches(spark: SparkSession, root: str, schema=None) -> DataFrame:
    """All micro-batch outputs with their ``batch`` id (from the folder name).

    A stream that saw no data wrote no batch: with ``schema`` (the batch
    rows' schema) that reads as an empty frame. Any other failure to read is
    an error: missing output must not pass for "nothing done yet".
    """
    from pyspark.sql.types import IntegerType, StructField, StructType
    if schema is not None and not path_exists(spark, os.path.join(root, "batch=*")):
        return spark.createDataFrame([], StructType([*schema.fields, StructField("batch", IntegerType())]))
    return spark.read.option("basePath", root).parquet(os.path.join(root, "batch=*"))


def run_to_files(stream: DataFrame, path: str, checkpoint: str, timeout_s: float | None = None):
    """Append a stream to Parquet files, to the end of its input; each row once, also after a restart (the sink's log)."""
    q = (stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination(timeout_s)
    return q


def read_files(spark: SparkSession, path: str, schema) -> DataFrame:
    """What a file sink holds; an empty frame of ``schema`` if the stream has not written."""
    if not path_exists(spark, os.path.join(path, "_spark_metadata")):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def path_exists(spark: SparkSession, pattern: str) -> bool:
    """Whether any path matches, asked of the path's own file system."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return found is not None and len(found) > 0


def observe_run(df: DataFrame, name: str, **counts: Column) -> tuple[DataFrame, Observation]:
    """Run counters of a pipeline step (S8): rows and ``count_if`` per condition.

    ``Observation`` collects the aggregates alongside the first action on the
    returned frame (no extra pass over the data); read them with
    ``observation.get`` after that action.
    """
    obs = Observation(name)
    aggs = [F.count(F.lit(1)).alias("rows")] + [F.count_if(c).alias(k) for k, c in counts.items()]
    return df.observe(obs, *aggs), obs


def write_outcomes(df: DataFrame, checks, root: str, error: str = "error", mode: str = "append") -> None:
    """T5 sink: the ok half and the dead-letter half in one pass over ``df``.

    One write partitioned by ``outcome`` (``root/outcome=ok`` and
    ``root/outcome=dead``): no cache and no second scan, and the dead half keeps
    the names of its failed checks in ``error``.
    """
    from ..operators.journal import tag_outcome
    out = tag_outcome(df, checks, error).withColumn("outcome", F.when(F.col(error).isNull(), F.lit("ok")).otherwise(F.lit("dead")))
    out.write.mode(mode).partitionBy("outcome").parquet(root)
