"""Counter increase by panes: samples are reduced once, windows are summed from panes.

A pane ``(end - step, end]`` of a series keeps what a window needs of its
samples: how many there are, the sum of their reset-corrected steps ``d`` and
the step of its first sample. The increase over a window is the sum of ``d``
over its panes less the first step of its first non-empty pane, as that step
began before the window. So only the small pane table is expanded ``window /
step`` times, and a stream carries panes and each series' last sample instead
of samples.

``d = v - previous v`` when that is not negative, else ``v`` (a reset restarts
at zero). A window with fewer than two samples has no increase. One sample per
series and time is expected.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timefn import epoch_micros, from_epoch_micros, seconds
from . import metrics, slicing

PANE_VALUES = ["n", "inc", "first_d"]


def pane_end(ts: str, step: str):
    """End of the pane ``(end - step, end]`` of a time."""
    us = seconds(step) * 1_000_000
    return F.timestamp_add("MICROSECOND", F.pmod(-epoch_micros(ts), F.lit(us)), F.col(ts))


def pane_increments(samples: DataFrame, series: Sequence[str], step: str, window: str, *, ts: str = "ts",
                    value: str = "value", context: DataFrame | None = None,
                    slice_seconds: int | None = None, rows_per_slice: int | None = None) -> DataFrame:
    """``(series..., pane_end, n, inc, first_d)`` of counter samples.

    ``window`` is the longest window that will be summed: a previous sample
    further back than that never counts, so a hot series is cut into time
    slices that look back no further (by counted rows with ``rows_per_slice``,
    see :mod:`slicing`). ``context``: earlier samples, at least
    the last of each series, that serve as previous samples only.
    """
    w_us = seconds(window) * 1_000_000
    rows = samples.select(*series, ts, value, F.lit(True).alias("__new"))
    if context is not None:
        rows = rows.unionByName(context.select(*series, ts, value, F.lit(False).alias("__new")))
    rows = rows.filter(F.col(ts).isNotNull() & F.col(value).isNotNull()).withColumn("__t", epoch_micros(ts))
    rows = slicing.add_slices(rows, series, "__t", w_us, slice_seconds=slice_seconds, rows_per_slice=rows_per_slice)
    prev = F.lag(value).over(Window.partitionBy(*slicing.sliced_partition(*series)).orderBy("__t"))
    d = F.when(prev.isNull(), F.lit(0.0)).when(F.col(value) >= prev, F.col(value) - prev).otherwise(F.col(value))
    steps = slicing.keep_owned(rows.withColumn("__d", d.cast("double"))).filter("__new")
    return steps.groupBy(*series, pane_end(ts, step).alias("pane_end")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("__d").alias("inc"), F.min_by("__d", "__t").alias("first_d"))


def increase_at_ticks(panes: DataFrame, series: Sequence[str], window: str, step: str, out: str = "increase",
                      panes_col: str | None = None) -> DataFrame:
    """``(series..., tick, increase)`` over ``(tick - window, tick]`` at every tick with two samples in the window.

    ``panes_col`` names a column with the window's number of panes, where it
    differs by series; ``window`` is then the longest.
    """
    w_s, s_s = seconds(window), seconds(step)
    if s_s <= 0 or w_s <= 0 or w_s % s_s:
        raise ValueError("window must be a positive multiple of step")
    n_panes = F.col(panes_col).cast("int") if panes_col else F.lit(w_s // s_s)
    after = F.explode(F.sequence(F.lit(0), n_panes - 1))
    spread = panes.select(*series, "pane_end", *PANE_VALUES, after.alias("__i")) \
        .withColumn("tick", F.timestamp_add("SECOND", F.col("__i") * F.lit(s_s), F.col("pane_end")))
    sums = spread.groupBy(*series, "tick").agg(F.sum("n").alias("n"), F.sum("inc").alias("inc"),
                                               F.min_by("first_d", "pane_end").alias("first_d"))
    return sums.filter("n >= 2").select(*series, "tick", (F.col("inc") - F.col("first_d")).alias(out))


def increase(samples: DataFrame, series: Sequence[str], window: str, step: str, *, ts: str = "ts",
             value: str = "value", out: str = "increase") -> DataFrame:
    """Increase at evaluation ticks, for any window and step: panes of their common measure, ticks at multiples of ``step``."""
    g = math.gcd(seconds(window), seconds(step))
    panes = pane_increments(samples, series, f"{g}s", window, ts=ts, value=value)
    ticks = increase_at_ticks(panes, series, window, f"{g}s", out)
    if g == seconds(step):
        return ticks
    return ticks.filter(F.pmod(epoch_micros("tick"), F.lit(seconds(step) * 1_000_000)) == 0)


def rate_share(increases: DataFrame, keys: Sequence[str], condition, value: str = "increase") -> DataFrame:
    """``100 * sum by (keys)(rate(c{condition})) / sum by (keys)(rate(c))`` per tick, one pass.

    Both rates share the window, which cancels. A key set without a matching
    series drops out, as in the vector match; no growth at all gives null.
    """
    hit = F.when(condition, F.col(value))
    sums = increases.groupBy(*keys, "tick").agg(F.sum(hit).alias("part"), F.sum(value).alias("whole"))
    return sums.filter(F.col("part").isNotNull()).withColumn("error_pct", metrics.percent_share("part", "whole"))


def last_samples(samples: DataFrame, series: Sequence[str], ts: str = "ts", value: str = "value") -> DataFrame:
    """The last sample of every series (two fixed-width results: a hash aggregate)."""
    return samples.groupBy(*series).agg(F.max_by(value, ts).alias(value), F.max(ts).alias(ts)).select(*series, ts, value)


def ticks_until(us: int):
    """A wall-clock time from microseconds, as a literal."""
    return from_epoch_micros(F.lit(int(us)))
