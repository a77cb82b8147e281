"""Journal finalisation on a stream (S1 + T3/T4, S8 through ``foreachBatch``).

The newest version of every key is a streaming aggregate in update mode: its
state, one fixed-width row per key, lives in the state store, and a
micro-batch gets the keys it touched with their newest version. Only *waiting*
entries, provisional ones without a ready decision, are carried along as a
table and looked at again with each micro-batch. So a batch reads its touched
keys, the waiting entries and the decisions; closed and final keys are not
read again, however many there are. The outcome equals the batch form over all
arrivals so far, whatever their order and whenever decisions come.

Tasks are issued by a second stream over the outcomes: the task id is dropped
if its state has seen it (``dropDuplicates``), so an entry that becomes final
twice, or a replayed batch, adds no task.

Run counters come from the same aggregate: one more group counts every input
row, partially in each task, and its running totals are kept by batch id. A
batch's counters are the difference to the totals of the batch before, so a
replayed batch writes the same ones and they sum to the input.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..operators import journal
from ..sources.sinks import path_exists, read_batches, write_batch
from .carried import Carried

TOTALS = "rows_total bigint, provisional_total bigint"
COUNTERS = "rows bigint, provisional bigint, final bigint, waiting bigint, closed bigint, " + TOTALS


def newest_versions(entries: DataFrame, *, key: str, status: str, version: str, tie: str | None = None) -> DataFrame:
    """Streaming (or batch) ``(total, key, version, open, n, provisional)``: the newest version of every key.

    One more row, ``total`` true and a null key, counts all rows. All results
    are of fixed width, so each side of the shuffle is a hash aggregate.
    """
    is_open = journal.is_provisional(status)
    rows = entries.select(
        F.col(key).alias("__key"), F.col(version).alias("__version"), is_open.alias("__open"),
        journal.version_order(entries, version, tie, is_open).alias("__order"),
        F.explode(F.array(F.lit(False), F.lit(True))).alias("total"))
    own = ~F.col("total")
    return rows.groupBy("total", F.when(own, F.col("__key")).alias(key)).agg(
        F.max(F.when(own, F.col("__version"))).alias(version),
        F.max_by("__open", "__order").alias("open"),
        F.count(F.lit(1)).alias("n"), F.count_if("__open").alias("provisional"))


def run_finalise_stream(spark: SparkSession, entries: DataFrame, decisions: DataFrame, cutoff, root: str,
                        checkpoint: str, *, key: str, status: str, version: str, task_kind: str,
                        timeout_s: float | None = None, compact_every: int = 20,
                        available_now: bool = True, interval: str = "10 seconds", tie: str | None = None):
    """Start (and, with ``available_now``, finish) the finalising stream under ``root``;
    otherwise it keeps running with a processing-time trigger of ``interval``.

    ``tie`` names a second version column. Decisions that come without new
    entries are seen by the next micro-batch that has any. With
    ``available_now`` the outbox stream runs after it; beside a stream that
    keeps running, start :func:`run_outbox_stream`. ``compact_every`` has no
    effect any more: nothing is compacted.
    """
    key_type, version_type = entries.schema[key].dataType, entries.schema[version].dataType
    waiting = Carried(spark, os.path.join(root, "waiting"), StructType([StructField(key, key_type), StructField(version, version_type)]))
    totals = Carried(spark, os.path.join(root, "counters"), COUNTERS)

    def process(batch_df: DataFrame, batch_id: int) -> None:
        batch_df = batch_df.persist()               # read several times, evaluated once
        touched = batch_df.filter("not total").select(key, version, "open", F.lit(1).alias("touched"))
        again = waiting.before(batch_id).select(key, version, F.lit(True).alias("open"), F.lit(0).alias("touched"))
        now = touched.unionByName(again).groupBy(key).agg(
            F.max_by(version, "touched").alias(version), F.max_by("open", "touched").alias("open"),
            F.max("touched").alias("touched"))
        # open and closed keys in one pass, so that the union above is aggregated and moved once
        every = journal.decide(now, decisions, cutoff, key=key, version=version, carry=["touched", "open"])
        of_open = {"decided_at": F.lit(None), "n_parts": F.lit(0), "outcome": F.lit("closed"), "new_status": F.lit(None)}
        res = every.select(key, version, *(F.when(F.col("open"), F.col(c)).otherwise(closed).cast(every.schema[c].dataType).alias(c)
                                           for c, closed in of_open.items()), "touched").persist()
        try:
            changed = res.filter("touched = 1 or outcome = 'final'")
            changed = changed.drop("touched")
            finalised = os.path.join(root, "finalised")
            write_batch(changed, finalised, batch_id)
            waiting.record(res.filter("outcome = 'waiting'").select(key, version), batch_id)
            # counted from what was written: a union with what comes of the batch itself would not find that cached,
            # and work through the state and the decisions again
            written = spark.read.schema(changed.schema).parquet(os.path.join(finalised, f"batch={batch_id}"))
            totals.record(_counters(batch_df.filter("total"), written, totals.before(batch_id)), batch_id)
        finally:
            res.unpersist()
            batch_df.unpersist()

    entries = entries.observe("journal_in", F.count(F.lit(1)).alias("rows"),
                              F.count_if(journal.is_provisional(status)).alias("provisional"))
    newest = newest_versions(entries, key=key, status=status, version=version, tie=tie)
    writer = newest.writeStream.outputMode("update").foreachBatch(process).option("checkpointLocation", checkpoint)
    if not available_now:
        return writer.trigger(processingTime=interval).start()
    q = writer.trigger(availableNow=True).start()
    q.awaitTermination(timeout_s)
    if path_exists(spark, os.path.join(root, "finalised", "batch=*")):
        out = journal.decide(spark.createDataFrame([], waiting.schema), decisions, cutoff, key=key, version=version).schema
        run_outbox_stream(spark, root, out, key=key, kind=task_kind, timeout_s=timeout_s)
    return q


def _counters(total: DataFrame, changed: DataFrame, before: DataFrame) -> DataFrame:
    """One row: what this batch read and what became of it, and the totals so far."""
    zero = F.lit(0).cast("bigint")
    parts = total.select(F.col("n").alias("now_n"), F.col("provisional").alias("now_p"), zero.alias("was_n"),
                         zero.alias("was_p"), F.lit(None).cast("string").alias("outcome")) \
        .unionByName(before.select(zero.alias("now_n"), zero.alias("now_p"), F.col("rows_total").alias("was_n"),
                                   F.col("provisional_total").alias("was_p"), F.lit(None).cast("string").alias("outcome"))) \
        .unionByName(changed.select(zero.alias("now_n"), zero.alias("now_p"), zero.alias("was_n"), zero.alias("was_p"), "outcome"))
    one = parts.agg(*(F.coalesce(F.max(c), zero).alias(c) for c in ("now_n", "now_p", "was_n", "was_p")),
                    *(F.count_if(F.col("outcome") == x).alias(x) for x in ("final", "waiting", "closed")))
    n, p = F.greatest("now_n", "was_n"), F.greatest("now_p", "was_p")
    return one.select((n - F.col("was_n")).alias("rows"), (p - F.col("was_p")).alias("provisional"),
                      "final", "waiting", "closed", n.alias("rows_total"), p.alias("provisional_total"))


def run_outbox_stream(spark: SparkSession, root: str, outcomes: StructType, *, key: str, kind: str,
                      timeout_s: float | None = None, available_now: bool = True, interval: str = "10 seconds"):
    """T4 on a stream: one task per entry that became final, from the outcomes under ``root``.

    ``outcomes`` is the schema of the outcome rows. Ids already issued are in
    the stream's state, so no earlier task is read.
    """
    schema = StructType([*outcomes.fields, StructField("batch", IntegerType())])
    rows = spark.readStream.schema(schema).option("maxFileAge", "3650d").option("ignoreMissingFiles", "true") \
        .parquet(os.path.join(root, "finalised"))
    tasks = journal.task_outbox(rows, key, kind, "decided_at").dropDuplicates(["task_id"])

    def write(batch_df: DataFrame, batch_id: int) -> None:
        write_batch(batch_df, os.path.join(root, "outbox"), batch_id)

    writer = tasks.writeStream.foreachBatch(write).option("checkpointLocation", os.path.join(root, "outbox_checkpoint"))
    if not available_now:
        return writer.trigger(processingTime=interval).start()
    q = writer.trigger(availableNow=True).start()
    q.awaitTermination(timeout_s)
    return q


def stream_counters(spark: SparkSession, root: str) -> DataFrame:
    """The counters of every micro-batch, ``(batch, rows, provisional, final, waiting, closed)``."""
    schema = spark.createDataFrame([], COUNTERS).schema
    return read_batches(spark, os.path.join(root, "counters"), schema) \
        .select("batch", "rows", "provisional", "final", "waiting", "closed")


def finalised_state(spark: SparkSession, root: str, key: str, schema=None) -> DataFrame:
    """Current outcome of every entry: the row from the latest batch that changed it
    (``schema``: the finalise output schema, for a stream that wrote nothing).
    Keys whose newest version is not provisional are no entries."""
    b = read_batches(spark, os.path.join(root, "finalised"), schema)
    return journal.latest_per_key(b, key, "batch").drop("batch").filter("outcome != 'closed'")


def issued_tasks(spark: SparkSession, root: str, schema=None) -> DataFrame:
    """The outbox: every task issued so far."""
    return read_batches(spark, os.path.join(root, "outbox"), schema).drop("batch")
