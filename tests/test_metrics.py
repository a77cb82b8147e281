"""Metric operators on literal edge rows (FIXTURES 2) and against brute force."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerlight.operators import metrics

T0 = dt.datetime(2024, 1, 1)


def ts(minutes: float) -> dt.datetime:
    return T0 + dt.timedelta(minutes=minutes)


def ntz(spark, rows, schema):
    df = spark.createDataFrame(rows, schema)
    return df.withColumn("ts", F.col("ts").cast("timestamp_ntz")) if "ts" in df.columns else df


def test_match_labels_is_conjunction(spark):
    df = spark.createDataFrame([("a", "x", 1.0), ("a", "y", 2.0), ("b", "x", 3.0)], "app string, job string, value double")
    out = metrics.match_labels(df, app="a", job="x").collect()
    assert [r.value for r in out] == [1.0]
    assert metrics.match_labels(df).count() == 3


def test_threshold_is_strict_and_null_never_passes(spark):
    df = spark.createDataFrame([(90.0,), (90.0000001,), (None,), (0.0,)], "value double")
    assert sorted(r.value for r in metrics.above(df, "value", 90).collect()) == [90.0000001]


def test_percent_share_divides_by_zero_to_null(spark):
    df = spark.createDataFrame([(0, 0), (1, 4), (3, 3)], "e long, t long")
    got = [r.p for r in df.select(metrics.percent_share("e", "t").alias("p")).collect()]
    assert got == [None, 25.0, 100.0]


def _msgs(spark, rows):
    return ntz(spark, rows, "ts timestamp, app string, lvl string")


def test_error_ratio_join_equals_one_pass(spark):
    rng = random.Random(7)
    rows = [(ts(rng.uniform(0, 600)), rng.choice("ab"), rng.choice(["Error", "Info", "Info"])) for _ in range(400)]
    rows += [(ts(30), "c", "Info")]                    # a series without errors
    m = _msgs(spark, rows)
    is_err = F.col("lvl") == "Error"
    for thr in (0.0, 25.0, 90.0):
        a = metrics.error_ratio(m, ["app"], "3h", "1h", is_err, thr)
        b = metrics.error_ratio_join(m, ["app"], "3h", "1h", is_err, thr)
        assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.select(*a.columns).collect()))
    with pytest.raises(ValueError):
        metrics.error_ratio(m, ["app"], "3h", "1h", is_err, -1)


def test_window_ticks_are_window_ends(spark):
    m = _msgs(spark, [(ts(59.999), "a", "Error"), (ts(60), "a", "Info")])
    out = metrics.windowed_counts(m, ["app"], "1h", "1h", F.col("lvl") == "Error")
    got = sorted((r.tick, r.errors, r.total) for r in out.collect())
    assert got == [(ts(60), 1, 1), (ts(120), 0, 1)]


# ---------------------------------------------------------------- counters

def brute_increase(samples, window_s):
    """Per sample: reset-corrected increase over (t - w, t] (None with < 2 samples)."""
    out = {}
    by_series = {}
    for s, t, v in samples:
        by_series.setdefault(s, []).append((t, v))
    for s, pts in by_series.items():
        pts.sort()
        for t, v in pts:
            inside = [(u, x) for u, x in pts if t - dt.timedelta(seconds=window_s) < u <= t]
            if len(inside) < 2:
                out[(s, t)] = None
                continue
            inc = 0.0
            for (_, a), (_, b) in zip(inside, inside[1:]):
                inc += b - a if b >= a else b
            out[(s, t)] = inc
    return out


def test_counter_increase_edge_rows(spark):
    rows = [("s", ts(0), 5.0), ("s", ts(1), 8.0), ("s", ts(2), 2.0),   # reset: 8 -> 2 counts 2
            ("s", ts(10), 4.0),                                         # alone in its 3m frame
            ("t", ts(0), 1.0)]                                          # one sample only
    df = ntz(spark, rows, "series string, ts timestamp, value double")
    got = {(r.series, r.ts): r.increase for r in metrics.counter_increase(df, ["series"], "3m").collect()}
    assert got == {("s", ts(0)): None, ("s", ts(1)): 3.0, ("s", ts(2)): 5.0,
                   ("s", ts(10)): None, ("t", ts(0)): None}


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("xy"), st.integers(0, 400), st.integers(0, 50)), min_size=1, max_size=60),
       st.sampled_from([60, 180, 600]), st.sampled_from([None, 420, 3600]))
def test_counter_increase_matches_brute_force(spark, raw, window_s, slice_s):
    seen, rows = set(), []
    for s, m, v in raw:
        if (s, m) not in seen:
            seen.add((s, m))
            rows.append((s, ts(m), float(v)))
    df = ntz(spark, rows, "series string, ts timestamp, value double")
    # short slices put many boundaries inside the data, so the copies are exercised
    res = metrics.counter_increase(df, ["series"], f"{window_s}s", slice_seconds=slice_s)
    got = {(r.series, r.ts): r.increase for r in res.collect()}
    assert got == brute_increase(rows, window_s)


def test_counter_rate_is_increase_per_second(spark):
    df = ntz(spark, [("s", ts(0), 0.0), ("s", ts(1), 60.0)], "series string, ts timestamp, value double")
    got = [r.rate for r in metrics.counter_rate(df, ["series"], "2m").orderBy("ts").collect()]
    assert got == [None, 0.5]


def test_sum_by_drops_other_labels(spark):
    df = ntz(spark, [("a", "x", ts(0), 1.0), ("a", "y", ts(0), 2.0), ("b", "x", ts(0), 4.0)],
             "app string, lvl string, ts timestamp, value double")
    got = sorted((r.app, r.value) for r in metrics.sum_by(df, ["app"], "value").collect())
    assert got == [("a", 3.0), ("b", 4.0)]


def test_hot_series_is_split_across_slices(spark):
    """One series holding most rows is processed as many (series, slice) groups."""
    from ledgerlight.functions.timefn import epoch_micros
    from ledgerlight.operators import slicing
    rows = [("hot", ts(i * 7), float(i)) for i in range(3000)]            # ~2 weeks of samples
    rows += [("cold", ts(i * 600), float(i)) for i in range(20)]
    df = ntz(spark, rows, "series string, ts timestamp, value double")
    w_us = 3 * 3600 * 1_000_000
    sliced = slicing.add_time_slices(df.withColumn("__t", epoch_micros("ts")), "__t", w_us,
                                     slicing.slice_length_us(w_us))
    groups = sliced.filter("series = 'hot'").groupBy(slicing.SLICE).count().collect()
    assert len(groups) >= 7                                             # ~15 days in 2-day slices, not one task
    assert max(g["count"] for g in groups) < 0.2 * 3000
    copies = sliced.count() - df.count()
    assert copies < 0.2 * df.count()                                    # few copied rows
    got = {(r.series, r.ts): r.increase for r in metrics.counter_increase(df, ["series"], "3h").collect()}
    assert got == brute_increase(rows, 3 * 3600)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.floats(0, 1440), st.sampled_from("ab"), st.booleans()), min_size=1, max_size=80),
       st.sampled_from([(60, 20), (30, 30), (90, 15)]))
def test_pane_windows_equal_sliding_window_aggregation(spark, raw, ws):
    """Windows summed from step panes == Spark's sliding window() over the raw rows."""
    window_m, step_m = ws
    rows = [(ts(x), a, "Error" if e else "Info") for x, a, e in raw]
    m = _msgs(spark, rows)
    is_err = F.col("lvl") == "Error"
    got = metrics.windowed_counts(m, ["app"], f"{window_m}m", f"{step_m}m", is_err)
    w = F.window("ts", f"{window_m} minutes", f"{step_m} minutes")
    want = (m.groupBy(w.alias("w"), "app").agg(F.count_if(is_err).alias("errors"), F.count(F.lit(1)).alias("total"))
             .select("app", F.col("w.end").alias("tick"), "errors", "total"))
    assert sorted(map(tuple, got.select("app", "tick", "errors", "total").collect())) == \
        sorted(map(tuple, want.collect()))


def test_rows_without_time_or_labels(spark):
    """No event time: in no window. Null labels: a series of their own. Never an error."""
    rows = [(ts(10), "a", "Error"), (None, "a", "Error"), (ts(20), None, "Info"), (ts(30), "a", None)]
    m = _msgs(spark, rows)
    is_err = F.col("lvl") == "Error"
    for step in ("1h", "20m"):          # pane path (window a multiple of step)
        got = sorted(((r.app or ""), r.tick, r.errors, r.total)
                     for r in metrics.windowed_counts(m, ["app"], "1h", step, is_err).collect()
                     if r.tick == ts(60))
        assert got == [("", ts(60), 0, 1), ("a", ts(60), 1, 2)]
    direct = metrics.windowed_counts(m, ["app"], "45m", "30m", is_err).collect()   # direct window() path
    assert direct and all(r.tick is not None for r in direct)
    # brute force: windows start every 30 minutes and last 45
    expect = sum(1 for t, _, _ in rows if t is not None for k in range(-4, 8)
                 if T0 + dt.timedelta(minutes=30 * k) <= t < T0 + dt.timedelta(minutes=30 * k + 45))
    assert sum(r.total for r in direct) == expect
    j = metrics.error_ratio_join(m, ["app"], "1h", "1h", is_err, 0.0).collect()
    assert [(r.app, r.errors, r.total) for r in j] == [("a", 1, 2)]


def test_counter_samples_without_value_are_left_out(spark):
    rows = [("s", ts(0), 1.0), ("s", ts(1), None), ("s", ts(2), 4.0), ("s", None, 9.0)]
    df = ntz(spark, rows, "series string, ts timestamp, value double")
    got = {r.ts: r.increase for r in metrics.counter_increase(df, ["series"], "5m").collect()}
    assert got == {ts(0): None, ts(2): 3.0}
