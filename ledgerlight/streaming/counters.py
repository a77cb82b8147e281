"""Counter increase on a stream, resets across micro-batches included.

Samples arrive in any order within ``delay``. A micro-batch moves the closed
mark, a multiple of ``step`` at most ``delay`` before the latest sample time
seen; samples up to the mark are final. Carried from batch to batch, and
nothing else is read again:

* ``open``   samples after the mark,
* ``last``   the last closed sample of each series, the previous one of its next,
* ``panes``  the pane increments that windows after the mark still cover.

Series or panes older than a window before the mark are dropped, as no later
window reaches them. A batch writes the increases at the ticks it closed.
Samples at or before the mark of an earlier batch come too late: they are left
out and counted.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from ..functions.timefn import epoch_micros, seconds
from ..operators import counters
from ..sources.sinks import path_exists, read_batches, write_batch
from .alerts import run_update_stream
from .carried import Carried, last_batch

MARK = "mark long, latest long, late long"


def run_counter_stream(spark: SparkSession, samples: DataFrame, root: str, series: Sequence[str], *, window: str,
                       step: str, delay: str, ts: str = "ts", value: str = "value", flush: bool = True,
                       timeout_s: float | None = None, available_now: bool = True, interval: str = "10 seconds"):
    """Increases ``(series..., tick, increase)`` of a stream of counter samples.

    With ``available_now`` returns all of them; ``flush`` closes what is open
    at the end of the input into a folder of its own, which the next run's
    flush replaces, so a root may be run again with more files. Otherwise
    returns the running query.
    """
    series = list(series)
    kinds = samples.schema
    sample_schema = StructType([*(kinds[c] for c in series), kinds[ts], StructField(value, DoubleType())])
    pane_schema = StructType([*(kinds[c] for c in series), StructField("pane_end", kinds[ts].dataType),
                              StructField("n", LongType()), StructField("inc", DoubleType()), StructField("first_d", DoubleType())])
    out_schema = StructType([*(kinds[c] for c in series), StructField("tick", kinds[ts].dataType), StructField("increase", DoubleType())])
    open_, last, panes, marks = (Carried(spark, os.path.join(root, name), schema) for name, schema in (
        ("open", sample_schema), ("last", sample_schema), ("panes", pane_schema), ("mark", MARK)))
    step_us, window_us, delay_us = (seconds(x) * 1_000_000 for x in (step, window, delay))
    rates = os.path.join(root, "rates")

    def close(live: DataFrame, batch_id: int, was: int | None, mark: int | None):
        """Increases at the ticks after ``was`` up to ``mark`` (None: no limit), the panes behind them, and the closing samples."""
        closing = live if mark is None else live.filter(epoch_micros(ts) <= mark)
        new = counters.pane_increments(closing, series, step, window, ts=ts, value=value, context=last.before(batch_id))
        both = panes.before(batch_id).unionByName(new).persist()
        ticks = counters.increase_at_ticks(both, series, window, step)
        if was is not None:
            ticks = ticks.filter(F.col("tick") > counters.ticks_until(was))
        if mark is not None:
            ticks = ticks.filter(F.col("tick") <= counters.ticks_until(mark))
        return ticks, both, closing

    def process(batch_df: DataFrame, batch_id: int) -> None:
        rows = batch_df.filter(F.col(ts).isNotNull() & F.col(value).isNotNull()) \
            .select(*series, ts, F.col(value).cast("double").alias(value)).persist()
        before = marks.before(batch_id).first()
        was = before["mark"] if before else None
        in_time = rows if was is None else rows.filter(epoch_micros(ts) > was)
        seen = rows.agg(F.max(epoch_micros(ts)).alias("latest"), F.count(F.lit(1)).alias("n")).first()
        latest = max((x for x in (seen["latest"], before["latest"] if before else None) if x is not None), default=None)
        mark = was
        if latest is not None:
            aligned = (latest - delay_us) // step_us * step_us
            mark = aligned if was is None else max(was, aligned)
        live = open_.before(batch_id).unionByName(in_time).persist()
        late = 0 if was is None else seen["n"] - in_time.count()
        if mark is None:        # nothing seen yet
            for table in (open_, last, panes):
                table.record(table.before(batch_id), batch_id)
        else:
            ticks, both, closing = close(live, batch_id, was, mark)
            write_batch(ticks, rates, batch_id)
            open_.record(live.filter(epoch_micros(ts) > mark), batch_id)
            panes.record(both.filter(epoch_micros("pane_end") > mark - window_us), batch_id)
            last.record(counters.last_samples(closing.unionByName(last.before(batch_id)), series, ts, value)
                        .filter(epoch_micros(ts) > mark - window_us), batch_id)
            both.unpersist()
        marks.record(spark.createDataFrame([(mark, latest, late)], MARK), batch_id)
        live.unpersist()
        rows.unpersist()

    q = run_update_stream(samples, rates, os.path.join(root, "checkpoint"), available_now, timeout_s, process, interval,
                          mode="append")
    if not available_now:
        return q
    if flush:
        n = last_batch(spark, marks.root)
        if n is not None:
            was = marks.before(n + 1).first()["mark"]
            ticks, both, _ = close(open_.before(n + 1), n + 1, was, None)
            ticks.write.mode("overwrite").parquet(os.path.join(rates, "batch=flush"))
            both.unpersist()
        elif not path_exists(spark, os.path.join(rates, "batch=*")):
            return spark.createDataFrame([], out_schema)
    return read_batches(spark, rates, out_schema).select(*series, "tick", "increase")


def late_samples(spark: SparkSession, root: str) -> DataFrame:
    """Samples left out as too late, per batch."""
    schema = spark.createDataFrame([], MARK).schema
    return read_batches(spark, os.path.join(root, "mark"), schema).select("batch", "late")
