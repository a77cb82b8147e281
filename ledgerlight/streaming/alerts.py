"""Alert rules on a stream.

T1 -- the error share per (app, namespace) over a sliding event-time window:
``withWatermark`` + ``window(ts, w, step)`` aggregated in *update* mode, so
state for windows older than the watermark is dropped and every micro-batch
emits the windows it changed. A ``foreachBatch`` writer stores each batch
under its batch id (overwrite = idempotent on replay); the current value of
a window is the one from its latest batch.

T2 -- the held condition, evaluated incrementally (:func:`run_alert_stream`):
the stream keeps tumbling *panes* of ``step`` in state (one entry per pane,
not ``window / step`` windows per event); after each micro-batch the windows
the watermark has closed are final, they are summed from their panes, and
:func:`ledgerlight.operators.holds.sustained` runs over the newly closed ticks
plus a bounded look-back (``hold + 2 * step``); the firings are written under
the batch id. A window ending at ``E`` is closed once ``max event time -
delay >= E`` (late rows for it are dropped by Spark from then on). At the end
of a bounded input every window is closed (``flush``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timefn import as_instant, instant_to_ntz, interval_text, ntz_literal
from ..operators import holds, metrics
from ..sources.sinks import read_batches, write_batch


def error_counts(stream: DataFrame, keys: Sequence[str], window: str, step: str, delay: str,
                 error_cond: Column, ts: str = "ts") -> DataFrame:
    """Streaming (keys, tick, errors, total, max_et) with a watermark of ``delay``.

    ``max_et`` (latest event time in the window) lets a batch writer know how
    far the watermark has moved without asking the running query.
    """
    s = stream.withColumn("__et", as_instant(ts)).withWatermark("__et", interval_text(delay))
    w = F.window("__et", interval_text(window), interval_text(step))
    return (s.groupBy(w.alias("__w"), *keys)
             .agg(F.count(F.lit(1)).alias("total"), F.count_if(error_cond).alias("errors"),
                  F.max(F.col(ts)).alias("max_et"))
             .select(*keys, instant_to_ntz(F.col("__w.end")).alias("tick"), "errors", "total", "max_et"))


def error_panes(stream: DataFrame, keys: Sequence[str], step: str, delay: str,
                error_cond: Column, ts: str = "ts") -> DataFrame:
    """Streaming tumbling panes (keys, pane_end, errors, total, max_et).

    State holds one entry per pane instead of ``window / step`` overlapping
    windows per event; windows are summed from panes when evaluated.
    """
    s = stream.withColumn("__et", as_instant(ts)).withWatermark("__et", interval_text(delay))
    p = F.window("__et", interval_text(step))
    return (s.groupBy(p.alias("__p"), *keys)
             .agg(F.count(F.lit(1)).alias("total"), F.count_if(error_cond).alias("errors"),
                  F.max(F.col(ts)).alias("max_et"))
             .select(*keys, instant_to_ntz(F.col("__p.end")).alias("pane_end"), "errors", "total", "max_et"))


def run_update_stream(agg: DataFrame, sink_root: str, checkpoint: str, available_now: bool = True,
                      timeout_s: float | None = None, writer_fn=None, interval: str = "10 seconds",
                      mode: str = "update"):
    """Run a stream (an aggregating one in update mode) into batch folders under ``sink_root``
    (or through ``writer_fn(batch_df, batch_id)``). ``available_now`` processes
    what is there and returns when done; otherwise the query keeps running with
    a processing-time trigger of ``interval`` and is returned at once."""
    def write(batch_df: DataFrame, batch_id: int) -> None:
        write_batch(batch_df, sink_root, batch_id)

    writer = (agg.writeStream.outputMode(mode).foreachBatch(writer_fn or write)
                 .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    q = writer.start()
    if available_now:
        q.awaitTermination(timeout_s)
    return q


def current_ticks(spark: SparkSession, sink_root: str, keys: Sequence[str], batches: DataFrame | None = None,
                  schema=None) -> DataFrame:
    """Latest value of every (keys, tick) over all batch outputs (``schema``: the
    stream's row schema, for a stream that wrote nothing)."""
    b = read_batches(spark, sink_root, schema) if batches is None else batches
    from ..operators.journal import latest_per_key
    return latest_per_key(b, [*keys, "tick"], "batch").drop("batch", "max_et")


def run_incremental(spark: SparkSession, panes: DataFrame, root: str, pane_keys: Sequence[str], *,
                    fire, span: str, lookback: str, delay: str, flush: bool = True, compact_every: int = 20,
                    timeout_s: float | None = None, available_now: bool = True, interval: str = "10 seconds"):
    """The incremental core of the alert streams.

    ``panes`` is a streaming aggregate with ``pane_end`` and ``max_et`` per
    (``pane_keys``, pane). Per micro-batch the changed panes go to a
    :class:`RowLedger`; the closed mark moves to ``max event time through the
    previous batch - delay`` (Spark drops late rows against the previous
    batch's watermark, so this is the first mark no later row can cross);
    ``fire(pane_rows, lo, hi)`` returns the firings with ``lo < fires_at <= hi``
    from the panes of ``(lo - lookback - span, hi]`` and is written under the
    batch id. ``span`` is the longest window summed from panes, ``lookback``
    how far a firing decision looks back over ticks. Returns all firings (after
    the optional end-of-input flush), or the running query when not
    ``available_now``. Each batch stores the mark it closed; the flush reads
    the panes that still reach behind the last stored mark and fires only what
    lies after it, into a folder of its own that the next run's flush replaces. So a root may be run again, with or without
    new files, and holds each firing once.
    """
    import datetime as dt
    import os

    from ..functions.timefn import seconds
    from .carried import Carried, last_batch
    from .ledger import RowLedger

    panes_root, fired_root, closed_root = (os.path.join(root, x) for x in ("panes", "fired", "closed"))
    delay_td = dt.timedelta(seconds=seconds(delay))
    reach = dt.timedelta(seconds=seconds(lookback) + seconds(span))
    ledger = RowLedger(spark, panes_root, [*pane_keys, "pane_end"], compact_every)
    # per batch: the mark it closed, and the latest event time through it
    marks = Carried(spark, closed_root, T.StructType([T.StructField("mark", T.TimestampNTZType()),
                                                      T.StructField("latest", T.TimestampNTZType())]))

    def at(t: dt.datetime):
        return ntz_literal(t.isoformat(sep=" "))        # wall clock, no session zone involved

    def pane_range(lo, hi):
        cond = F.col("pane_end") <= at(hi) if hi is not None else F.lit(True)
        return cond & (F.col("pane_end") > at(lo - reach)) if lo is not None else cond

    def process(batch_df: DataFrame, batch_id: int) -> None:
        before = marks.before(batch_id).first()
        lo, latest = (before["mark"], before["latest"]) if before else (None, None)
        # Spark drops a batch's late rows against the *previous* batch's watermark, so windows up to the latest time
        # through the batch before, less the delay, get no more rows
        hi = None if latest is None else latest - delay_td
        # keep what this batch's and every later evaluation reads
        ledger.record(batch_df, batch_id, retain=None if lo is None else F.col("pane_end") > at(lo - reach))
        own = spark.read.parquet(os.path.join(panes_root, f"batch={batch_id}")).agg(F.max("max_et")).first()[0]
        if hi is not None and (lo is None or hi > lo):
            rows = ledger.rows_before(batch_id + 1, where=pane_range(lo, hi))
            if rows is not None:
                write_batch(fire(rows, None if lo is None else at(lo), at(hi)), fired_root, batch_id)
        latest = max((t for t in (latest, own) if t is not None), default=None)
        marks.record(spark.createDataFrame([(hi, latest)], marks.schema), batch_id)

    q = run_update_stream(panes, panes_root, os.path.join(root, "checkpoint"), timeout_s=timeout_s,
                          writer_fn=process, available_now=available_now, interval=interval)
    if not available_now:
        return q
    if flush:                                   # end of a bounded input closes every window
        n = last_batch(spark, closed_root)
        if n is None:
            every, closed = spark.createDataFrame([], panes.schema), None
        else:       # what micro-batches of this and earlier runs have not closed yet closes now
            done = marks.before(n + 1).first()["mark"]
            closed = None if done is None else at(done)
            every = ledger.rows_before(n + 1, where=pane_range(done, None))
        fire(every, closed, None).write.mode("overwrite").parquet(os.path.join(fired_root, "batch=flush"))
    return spark.read.option("basePath", fired_root).parquet(os.path.join(fired_root, "batch=*")).drop("batch")


def run_alert_stream(spark: SparkSession, panes: DataFrame, root: str, keys: Sequence[str], *,
                     window: str, step: str, delay: str, threshold: float, hold: str, flush: bool = True,
                     compact_every: int = 20, timeout_s: float | None = None,
                     available_now: bool = True, interval: str = "10 seconds"):
    """T1 + T2 on a stream of :func:`error_panes`: the error share summed from
    panes, held for ``hold``; firings per micro-batch (see :func:`run_incremental`)."""
    from ..functions.timefn import seconds
    look = f"{seconds(hold) + 2 * seconds(step)}s"

    def fire(pane_rows: DataFrame, lo, hi) -> DataFrame:
        ticks = metrics.slide_panes(pane_rows, keys, window, step, ["errors", "total"])
        if lo is not None:                     # earlier windows may miss panes: drop them
            ticks = ticks.filter(F.col("tick") > F.timestamp_add("SECOND", F.lit(-seconds(look)), lo))
        if hi is not None:
            ticks = ticks.filter(F.col("tick") <= hi)
        fired = held_from_ticks(error_ratio_from_ticks(ticks, threshold), keys, hold, step)
        return fired.filter(F.col("fires_at") > lo) if lo is not None else fired

    return run_incremental(spark, panes, root, keys, fire=fire, span=window, lookback=look, delay=delay,
                           flush=flush, compact_every=compact_every, timeout_s=timeout_s,
                           available_now=available_now, interval=interval)


def error_ratio_from_ticks(ticks: DataFrame, threshold: float) -> DataFrame:
    r = ticks.drop("max_et").withColumn("error_pct", metrics.percent_share("errors", "total"))
    return metrics.above(r, "error_pct", threshold).select(
        *[c for c in ticks.columns if c not in ("errors", "total", "tick", "max_et")],
        "tick", "errors", "total", "error_pct")


def held_from_ticks(ratio: DataFrame, keys: Sequence[str], hold: str, step: str) -> DataFrame:
    """Episodes of passing ticks that held for ``hold``."""
    return holds.sustained(ratio, keys, hold, step, ts="tick")
