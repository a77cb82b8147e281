"""Sliding windows on a stream by pane deltas.

A micro-batch aggregates its raw rows once into tumbling panes of ``step``.
These panes are not the panes' totals but what this batch adds to them, so
they can be pushed to the ``window / step`` windows they touch and written as
deltas under the batch id, without looking at anything written before. The
value of a window is the sum of its deltas: late panes correct windows of
earlier batches, in whatever order rows arrive, and a replayed batch replaces
its own deltas. Raw rows are never expanded into windows and there is no
window state to evict.

:func:`current_windows` sums the deltas; :func:`changed_windows` gives the
windows a batch touched, which is what a consumer has to look at again.
"""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import metrics
from ..sources.sinks import read_batches, write_batch
from .alerts import run_update_stream


def window_deltas(rows: DataFrame, keys: Sequence[str], window: str, step: str, aggs: Mapping[str, Column],
                  ts: str = "ts") -> DataFrame:
    """``(keys..., tick, aggs...)`` that rows add to the windows they lie in; ``aggs`` are sums or counts."""
    panes = metrics.pane_counts(rows, keys, step, aggs, ts)
    return metrics.slide_panes(panes, keys, window, step, list(aggs)).select(*keys, "tick", *aggs)


def run_window_stream(spark: SparkSession, rows: DataFrame, root: str, keys: Sequence[str], *, window: str, step: str,
                      aggs: Mapping[str, Column], ts: str = "ts", timeout_s: float | None = None,
                      available_now: bool = True, interval: str = "10 seconds"):
    """Run the stream of deltas under ``root``; a root may be run again with more input."""
    def process(batch_df: DataFrame, batch_id: int) -> None:
        write_batch(window_deltas(batch_df, keys, window, step, aggs, ts), os.path.join(root, "deltas"), batch_id)

    return run_update_stream(rows, root, os.path.join(root, "checkpoint"), available_now, timeout_s, process, interval,
                             mode="append")


def current_windows(spark: SparkSession, root: str, keys: Sequence[str], sums: Sequence[str], schema=None) -> DataFrame:
    """Every window's value so far (``schema``: the deltas' schema, for a stream that wrote nothing)."""
    deltas = read_batches(spark, os.path.join(root, "deltas"), schema)
    return deltas.groupBy(*keys, "tick").agg(*(F.sum(c).alias(c) for c in sums))


def changed_windows(spark: SparkSession, root: str, keys: Sequence[str], sums: Sequence[str], batch_id: int) -> DataFrame:
    """The value after ``batch_id`` of the windows this batch touched."""
    deltas = read_batches(spark, os.path.join(root, "deltas")).filter(F.col("batch") <= batch_id)
    touched = deltas.filter(F.col("batch") == batch_id).select(*keys, "tick").distinct()
    return deltas.join(touched, [*keys, "tick"], "left_semi") \
        .groupBy(*keys, "tick").agg(*(F.sum(c).alias(c) for c in sums))
