"""Held conditions (W3): edge rows and a brute-force gaps-and-islands check."""

from __future__ import annotations

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerlight.operators import holds

T0 = dt.datetime(2024, 1, 1)


def m(x: float) -> dt.datetime:
    return T0 + dt.timedelta(minutes=x)


def frame(spark, rows):
    df = spark.createDataFrame(rows, "s string, tick timestamp, value double")
    return df.withColumn("tick", F.col("tick").cast("timestamp_ntz"))


def fired(spark, rows, hold, step, **kw):
    out = holds.sustained(frame(spark, rows), ["s"], hold, step, **kw)
    return sorted((r.s, r.start, r.fires_at) for r in out.collect())


def brute(rows, hold_s, step_s):
    """Classic islands: break when the gap exceeds the step; fire at the first
    tick at least ``hold`` after the island start."""
    res = []
    by = {}
    for s, t, _ in rows:
        by.setdefault(s, []).append(t)
    for s, ticks in by.items():
        ticks.sort()
        start, prev, done = None, None, False
        for t in ticks:
            if prev is None or (t - prev).total_seconds() > step_s:
                start, done = t, False
            if not done and (t - start).total_seconds() >= hold_s:
                res.append((s, start, t))
                done = True
            prev = t
    return sorted(res)


def test_hold_exactly_equal_fires(spark):
    rows = [("a", m(0), 1.0), ("a", m(1), 1.0), ("a", m(2), 1.0), ("a", m(3), 1.0)]
    assert fired(spark, rows, "3m", "1m") == [("a", m(0), m(3))]


def test_missing_tick_ends_the_hold(spark):
    rows = [("a", m(0), 1.0), ("a", m(1), 1.0), ("a", m(3), 1.0), ("a", m(4), 1.0)]
    assert fired(spark, rows, "2m", "1m") == []


def test_fires_once_per_episode_and_again_after_a_break(spark):
    rows = [("a", m(i), 1.0) for i in range(6)] + [("a", m(i), 1.0) for i in range(8, 11)]
    assert fired(spark, rows, "2m", "1m") == [("a", m(0), m(2)), ("a", m(8), m(10))]


def test_zero_hold_fires_at_episode_start(spark):
    rows = [("a", m(0), 1.0), ("a", m(1), 1.0), ("a", m(5), 1.0)]
    assert fired(spark, rows, "0s", "1m") == [("a", m(0), m(0)), ("a", m(5), m(5))]


def test_hold_shorter_than_step(spark):
    rows = [("a", m(0), 1.0), ("a", m(60), 1.0), ("b", m(0), 1.0)]
    assert fired(spark, rows, "1m", "1h") == [("a", m(0), m(60))]


@settings(max_examples=20, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 300)), max_size=80),
       st.sampled_from([0, 60, 120, 300, 90]), st.sampled_from([60, 120]), st.sampled_from([None, 600, 1800]))
def test_matches_brute_force_on_irregular_ticks(spark, raw, hold_s, step_s, slice_s):
    rows = sorted({(s, m(x / 2), 1.0) for s, x in raw})   # half-minute grid, irregular gaps
    got = fired(spark, rows, f"{hold_s}s", f"{step_s}s", slice_seconds=slice_s) if rows else []
    assert got == brute(rows, hold_s, step_s)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 300)), max_size=80),
       st.sampled_from([0, 60, 150]), st.sampled_from([60, 300, 90]), st.sampled_from([None, 600]))
def test_per_row_holds_in_one_pass(spark, raw, hold_a, hold_b, slice_s):
    """Series with different holds evaluated together equal each evaluated alone."""
    rows = sorted({(s, m(x / 2), 1.0) for s, x in raw})
    if not rows:
        return
    holds_by = {"a": hold_a, "b": hold_b}
    df = frame(spark, rows).withColumn("h", F.when(F.col("s") == "a", hold_a).otherwise(hold_b))
    out = holds.sustained(df, ["s"], f"{max(hold_a, hold_b)}s", "60s", slice_seconds=slice_s, hold_col="h")
    got = sorted((r.s, r.start, r.fires_at) for r in out.collect())
    want = sorted(x for s in "ab" for x in brute([r for r in rows if r[0] == s], holds_by[s], 60))
    assert got == want
