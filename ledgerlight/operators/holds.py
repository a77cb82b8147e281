"""Held conditions: an alert fires once its condition has held for ``hold``.

Input: the ticks at which a condition is true (one row per series and tick).
A run of ticks with gaps of at most ``step`` is one episode; the episode
starts at its first tick and fires at the first tick ``t`` with
``t - start >= hold``. A missing tick ends the episode.

Classic gaps-and-islands needs a running sum from the start of the series,
i.e. one task per series. Everything here is a *bounded* range frame instead,
so the series can be cut into time slices (hot series spread over tasks):

* ``brk(u)``   no tick in ``[u - step, u)``                 (u starts an episode)
* ``last(t)``  latest ``brk`` in ``[t - H - step, t]``       (H = the largest hold)
* fires at ``t`` when ``t - last >= hold`` and the previous tick ``p`` has
  ``p - last < hold`` (for ``hold = 0``: when ``brk(t)``); ``start = last``.
  No ``last`` in the frame means the episode began more than ``H + step``
  ago, so it was already held at ``p`` and does not fire again.

Because the hold enters only as a comparison, it may differ per row: rules
with different ``for`` durations share one pass (frames sized by the largest).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timefn import epoch_micros, seconds
from . import slicing


def sustained(ticks: DataFrame, series: Sequence[str], hold: str, step: str,
              ts: str = "tick", slice_seconds: int | None = None, hold_col: str | None = None,
              rows_per_slice: int | None = None) -> DataFrame:
    """Rows of ``ticks`` at which a held condition fires, with ``start`` and ``fires_at``.

    Output: the input columns of the firing tick plus ``start`` (first tick of
    the episode) and ``fires_at`` (= the tick). Requires one row per series and tick.
    ``hold_col`` (seconds, per row) lets series with different holds share one
    pass; ``hold`` is then the largest of them. ``slice_seconds`` overrides the
    slice length (default: 16 look-backs, at least a day), ``rows_per_slice`` cuts by counted rows.
    """
    hold_us = seconds(hold) * 1_000_000
    step_us = seconds(step) * 1_000_000
    if step_us <= 0 or hold_us < 0:
        raise ValueError("step must be > 0 and hold >= 0")
    lookback = hold_us + 2 * step_us
    h = F.col(hold_col).cast("bigint") * F.lit(1_000_000) if hold_col else F.lit(hold_us)
    df = ticks.filter(F.col(ts).isNotNull()).withColumn("__t", epoch_micros(ts))
    df = slicing.add_slices(df, series, "__t", lookback, slice_seconds=slice_seconds, rows_per_slice=rows_per_slice)
    by_time = Window.partitionBy(*slicing.sliced_partition(*series)).orderBy("__t")

    # brk: no tick in [t - step, t) -- t opens an episode
    df = df.withColumn("__brk", F.count(F.lit(1)).over(by_time.rangeBetween(-step_us, -1)) == 0)
    # the latest episode start at or before t, if within the largest hold (+ one step)
    last = F.max(F.when(F.col("__brk"), F.col("__t"))).over(by_time.rangeBetween(-(hold_us + step_us), 0))
    df = df.withColumn("__last", last).withColumn("__prev", F.lag("__t").over(by_time))
    # held at t: t - start >= hold; first such tick: the previous tick was not held yet.
    # An episode older than the look-back has no __last and was held already.
    fires = F.when(h == 0, F.col("__brk")).otherwise(
        F.col("__last").isNotNull() & ((F.col("__t") - F.col("__last")) >= h)
        & ((F.col("__prev") - F.col("__last")) < h))
    start = F.when(h == 0, F.col("__t")).otherwise(F.col("__last"))
    out = (df.withColumn("__fires", fires).withColumn("__s", start)
             .filter(F.col(slicing.OWN) & F.col("__fires")))
    out = out.withColumn("start", F.timestamp_add("MICROSECOND", F.col("__s") - F.col("__t"), F.col(ts)))
    out = out.withColumn("fires_at", F.col(ts))
    return out.drop("__t", "__brk", "__last", "__prev", "__fires", "__s", slicing.SLICE, slicing.OWN)
