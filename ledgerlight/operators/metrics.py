"""Metric operators: label matchers, thresholds, windowed counts, counter rates.

Semantics (our reading of the alert expressions):

* label matcher ``m{a="x", b="y"}``  -> conjunction of equality filters
* ``expr > n``                       -> keep rows whose value is strictly greater
* ``100 * a / b``                    -> ``(100 * a) / b`` in double, ``b = 0`` gives null
  (never ``NaN``: Spark orders NaN above every number, so ``NaN > 90`` would pass)
* ``sum by (k) (v)``                 -> group on ``k`` per evaluation tick, other labels dropped
* ``rate(c[w])``                     -> reset-corrected increase over ``(t - w, t]`` divided by ``w``
* evaluation ticks of a raw event stream are ``window(ts, w, step)`` ends
  (``[end - w, end)``); rows without event time are in no window

Raw rows are aggregated once into ``step`` panes (``pane_counts``); sliding
windows are summed from the panes (``slide_panes``), so only the small pane
table is expanded ``w / step`` times. All aggregations are hash aggregates
with a map-side partial step, so a hot label set is collapsed inside each map
task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timefn import epoch_micros, interval_text, seconds
from . import slicing


# --------------------------------------------------------------------------- S4 samples

def series_frame(samples: DataFrame, metric: str, labels: Sequence[str], *, name_col: str = "metric",
                 labels_col: str = "labels", ts: str = "ts", value: str = "value") -> DataFrame:
    """Long metric samples ``(metric, labels map, ts, value)`` -> one metric's
    series with one column per used label: ``(labels..., ts, value)``.

    The metric-name equality reaches the Parquet scan as a pushed filter; the
    label map is read once per row (``element_at``), never exploded.
    """
    m = F.col(labels_col)
    return samples.filter(F.col(name_col) == F.lit(metric)).select(
        *[F.element_at(m, F.lit(l)).alias(l) for l in labels], ts, value)


# --------------------------------------------------------------------------- F1 F2 F3 F4

def match_labels(df: DataFrame, matchers: Mapping[str, str] | None = None, **kw: str) -> DataFrame:
    """``metric{l1="v1", l2="v2"}``: keep rows whose label columns equal all values.

    The filters are plain column equalities, so on a Parquet scan they show up
    as ``PushedFilters`` and prune row groups.
    """
    conds = dict(matchers or {}, **kw)
    if not conds:
        return df
    cond = None
    for label, value in conds.items():
        c = F.col(label) == F.lit(value)
        cond = c if cond is None else cond & c
    return df.filter(cond)


def above(df: DataFrame, value: str, threshold: float) -> DataFrame:
    """``expr > n`` as a filter: strict, null never passes."""
    return df.filter(F.col(value) > F.lit(float(threshold)))


def percent_share(num: Column | str, den: Column | str) -> Column:
    """``100 * num / den`` evaluated left to right in double; ``den = 0`` -> null."""
    n = F.col(num) if isinstance(num, str) else num
    d = F.col(den) if isinstance(den, str) else den
    return (F.lit(100.0) * n.cast("double")) / F.nullif(d.cast("double"), F.lit(0.0))


# --------------------------------------------------------------------------- A3 / J1' / J1

def pane_counts(msgs: DataFrame, keys: Sequence[str], step: str, aggs: Mapping[str, Column],
                ts: str = "ts") -> DataFrame:
    """Tumbling panes of ``step``: (keys, ``pane_end``, aggs...).

    The one pass over raw rows; a hash aggregate with a map-side partial
    step, so only (keys x panes) rows per map task reach the shuffle.
    """
    p = F.window(ts, interval_text(step))
    # a row without event time belongs to no window (window() would give it a null one)
    return (msgs.filter(F.col(ts).isNotNull()).groupBy(p.alias("__p"), *keys)
                .agg(*[c.alias(name) for name, c in aggs.items()])
                .select(*keys, F.col("__p.end").alias("pane_end"), *aggs))


def slide_panes(panes: DataFrame, keys: Sequence[str], window: str, step: str,
                sums: Sequence[str]) -> DataFrame:
    """Sliding windows from step panes: (keys, ``tick``, summed columns).

    The window ending at ``tick`` is the union of the ``window / step`` panes
    ending at ``tick - i * step``; each pane is sent to those ticks and summed.
    Only the (small) pane table is expanded, never the raw rows.
    """
    w_s, s_s = seconds(window), seconds(step)
    if s_s <= 0 or w_s % s_s:
        raise ValueError("window must be a positive multiple of step")
    k = w_s // s_s
    ticks = F.explode(F.sequence(F.lit(0), F.lit(k - 1)))
    out = panes.select(*keys, *sums, ticks.alias("__i"), "pane_end")
    out = out.withColumn("tick", F.timestamp_add("SECOND", F.col("__i") * F.lit(s_s), F.col("pane_end")))
    return out.groupBy(*keys, "tick").agg(*[F.sum(c).alias(c) for c in sums])


def windowed_counts(msgs: DataFrame, keys: Sequence[str], window: str, step: str,
                    error_cond: Column, ts: str = "ts") -> DataFrame:
    """Per (keys, tick): ``total`` messages and ``errors`` in ``[tick - window, tick)``.

    When ``window`` is a multiple of ``step`` (the usual case) the raw rows are
    aggregated once into step panes and the windows are summed from panes;
    otherwise one sliding ``window()`` aggregation expands every row into
    its ``ceil(window / step)`` windows before the partial aggregate.
    """
    w_s, s_s = seconds(window), seconds(step)
    if s_s > 0 and w_s % s_s == 0:
        panes = pane_counts(msgs, keys, step, {"total": F.count(F.lit(1)), "errors": F.count_if(error_cond)}, ts)
        return slide_panes(panes, keys, window, step, ["errors", "total"]).select(*keys, "tick", "errors", "total")
    w = F.window(ts, interval_text(window), interval_text(step))
    return (msgs.filter(F.col(ts).isNotNull()).groupBy(w.alias("__w"), *keys)
                .agg(F.count(F.lit(1)).alias("total"),
                     F.count_if(error_cond).alias("errors"))
                .select(*keys, F.col("__w.end").alias("tick"), "errors", "total"))


def error_ratio(msgs: DataFrame, keys: Sequence[str], window: str, step: str,
                error_cond: Column, threshold: float, ts: str = "ts") -> DataFrame:
    """Error share per key set and tick, kept where ``> threshold`` (J1', one pass).

    Equal to :func:`error_ratio_join` for every threshold >= 0: a key set
    without errors is dropped by the join and has share 0 here, which fails
    the strict comparison as well.
    """
    if threshold < 0:
        raise ValueError("the one-pass error share equals the join form only for thresholds >= 0")
    counts = windowed_counts(msgs, keys, window, step, error_cond, ts)
    return above(counts.withColumn("error_pct", percent_share("errors", "total")), "error_pct", threshold)


def error_ratio_join(msgs: DataFrame, keys: Sequence[str], window: str, step: str,
                     error_cond: Column, threshold: float, ts: str = "ts") -> DataFrame:
    """The literal vector-match form: ``sum by(k)(errors) / sum by(k)(all)`` as an inner join.

    Kept as the check of the one-pass form. Both sides are summed from panes,
    so raw rows are aggregated once a side and never expanded into windows (for
    a window that is no multiple of the step they are). The join inputs are
    (keys x ticks) rows; AQE picks a broadcast hash join when one side is small
    at run time.
    """
    if seconds(step) > 0 and seconds(window) % seconds(step) == 0:
        def summed(rows: DataFrame, name: str) -> DataFrame:
            return slide_panes(pane_counts(rows, keys, step, {name: F.count(F.lit(1))}, ts), keys, window, step, [name])

        joined = summed(msgs.filter(error_cond), "errors").join(summed(msgs, "total"), [*keys, "tick"], "inner")
        return above(joined.withColumn("error_pct", percent_share("errors", "total")), "error_pct", threshold)
    w = F.window(ts, interval_text(window), interval_text(step))
    msgs = msgs.filter(F.col(ts).isNotNull())
    num = (msgs.filter(error_cond).groupBy(w.alias("__w"), *keys)
               .agg(F.count(F.lit(1)).alias("errors"))
               .select(*keys, F.col("__w.end").alias("tick"), "errors"))
    den = (msgs.groupBy(w.alias("__w"), *keys)
               .agg(F.count(F.lit(1)).alias("total"))
               .select(*keys, F.col("__w.end").alias("tick"), "total"))
    joined = num.join(den, [*keys, "tick"], "inner")
    return above(joined.withColumn("error_pct", percent_share("errors", "total")), "error_pct", threshold)


# --------------------------------------------------------------------------- W1 W2 A2 A1

def counter_increase(samples: DataFrame, series: Sequence[str], window: str,
                     ts: str = "ts", value: str = "value", out: str = "increase",
                     slice_seconds: int | None = None, rows_per_slice: int | None = None) -> DataFrame:
    """Reset-corrected increase of a counter over ``(t - window, t]`` at every sample.

    ``d_i = v_i - v_{i-1}`` when non-negative, else ``v_i`` (a reset restarts at
    zero); ``increase(t) = sum(d) - first(d)`` over the frame, i.e. the sum of
    the steps whose both ends lie inside it. Fewer than two samples -> null.
    Rows without time or value are not samples and are left out.

    The frame is bounded, so the series is split into time slices (see
    :mod:`slicing`) and a hot series is processed by many tasks.
    ``slice_seconds`` overrides the slice length (default: 16 frames, at least a day);
    ``rows_per_slice`` cuts by counted rows instead, for a series that is dense in a short time.

    A sliding frame would visit its rows again for every sample. Here the time
    is cut into blocks of one window, so a frame is the end of one block and
    the start of the next. Both are running sums, one forwards and one
    backwards, so a sample costs the same however many its frame holds, and
    nothing is subtracted: the sums stay as exact as those of a frame.
    """
    w_us = seconds(window) * 1_000_000
    if w_us <= 0:
        raise ValueError("window must be positive")
    # a sample needs a time and a value; anything else is not a sample
    df = samples.filter(F.col(ts).isNotNull() & F.col(value).isNotNull()).withColumn("__t", epoch_micros(ts))
    df = slicing.add_slices(df, series, "__t", w_us, slice_seconds=slice_seconds, rows_per_slice=rows_per_slice)
    df = df.withColumn("__block", slicing.floor_div("`__t`", w_us))
    part = slicing.sliced_partition(*series)
    by_time = Window.partitionBy(*part).orderBy("__t")

    def step(before: Column, now: Column) -> Column:
        return F.when(before.isNull() | now.isNull(), F.lit(0.0)).when(now >= before, now - before).otherwise(now).cast("double")

    same = F.lag("__block").over(by_time) == F.col("__block")
    df = df.select(
        "*", step(F.lag(value).over(by_time), F.col(value)).alias("__d"), F.coalesce(same, F.lit(False)).alias("__inner"),
        # the step to the next sample, if that lies in the same block
        F.when(F.lead("__block").over(by_time) == F.col("__block"), step(F.col(value), F.lead(value).over(by_time)))
         .otherwise(F.lit(0.0)).alias("__next"))
    # from the start of the block to the sample and all of its time: all steps, and those within the block
    start = Window.partitionBy(*part, "__block").orderBy("__t").rangeBetween(Window.unboundedPreceding, 0)
    df = df.select("*", F.count(F.lit(1)).over(start).alias("__n"), F.sum("__d").over(start).alias("__all"),
                   F.sum(F.when(F.col("__inner"), F.col("__d")).otherwise(F.lit(0.0))).over(start).alias("__within"))
    # each sample stands in its block, and asks at t - window, in the block before, for all that comes after it there
    asks = F.col("__ask") == 1
    df = df.withColumn("__ask", F.explode(F.when(F.col(slicing.OWN), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    df = df.withColumn("__at", F.when(asks, F.col("__t") - F.lit(w_us)).otherwise(F.col("__t"))) \
        .withColumn("__block", F.when(asks, F.col("__block") - 1).otherwise(F.col("__block")))
    rest = Window.partitionBy(*part, "__block").orderBy(F.desc("__at"), F.desc("__ask")) \
        .rowsBetween(Window.unboundedPreceding, 0)
    df = df.select("*", F.count_if(~asks).over(rest).alias("__before"),
                   F.sum(F.when(asks, F.lit(0.0)).otherwise(F.col("__next"))).over(rest).alias("__tail"))
    total = F.when(F.col("__before") > 0, F.col("__tail") + F.col("__all")).otherwise(F.col("__within"))
    df = df.filter(asks).withColumn(out, F.when(F.col("__before") + F.col("__n") >= 2, total))
    return slicing.keep_owned(df).drop("__t", "__d", "__block", "__inner", "__next", "__n", "__all", "__within", "__ask", "__at",
                                       "__before", "__tail")


def counter_rate(samples: DataFrame, series: Sequence[str], window: str,
                 ts: str = "ts", value: str = "value", out: str = "rate") -> DataFrame:
    """``rate(counter[window])``: increase over the frame per second of frame."""
    inc = counter_increase(samples, series, window, ts, value, out="__inc")
    return inc.withColumn(out, F.col("__inc") / F.lit(float(seconds(window)))).drop("__inc")


def sum_by(df: DataFrame, keys: Sequence[str], value: str, ts: str = "ts", out: str | None = None) -> DataFrame:
    """``sum by (keys) (vector)`` at every tick; all other labels are dropped."""
    return df.groupBy(*keys, ts).agg(F.sum(value).alias(out or value))
