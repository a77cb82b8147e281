"""Pane increments against samples one by one, and the counter stream against the batch form."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgerlight.operators import counters, metrics
from ledgerlight.session import scratch_path
from ledgerlight.sources.streams import file_stream, replay
from ledgerlight.streaming import counters as scounters

T0 = dt.datetime(2024, 3, 30, 22, 0, 0)
SCHEMA = "app string, lvl string, ts timestamp_ntz, value double"


def at(s):
    return T0 + dt.timedelta(seconds=s)


def random_samples(seed, n=400, span=6 * 3600):
    """Irregular scrapes of a few series with resets, gaps and a hot series."""
    rng = random.Random(seed)
    rows, value = [], {}
    for s in sorted(rng.sample(range(span), n)):
        key = ("hot", "e") if rng.random() < 0.5 else (rng.choice(["a", "b"]), rng.choice(["e", "w"]))
        value[key] = float(rng.randint(0, 3)) if rng.random() < 0.1 else value.get(key, 0.0) + rng.randint(0, 5)
        rows.append((*key, at(s), value[key]))
    return rows


def brute(rows, window, step):
    """Increase over (tick - window, tick] at every tick on the step grid with two samples in the window."""
    out = {}
    by = {}
    for a, lvl, ts, v in rows:
        if ts is not None and v is not None:
            by.setdefault((a, lvl), []).append((int((ts - T0).total_seconds()), v))
    base = int((T0 - dt.datetime(1970, 1, 1)).total_seconds())
    for key, xs in by.items():
        xs.sort()
        first = -((-(xs[0][0] + base)) // step) * step - base
        for tick in range(first, xs[-1][0] + window + step, step):
            inside = [x for x in xs if tick - window < x[0] <= tick]
            if len(inside) >= 2:
                out[(*key, at(tick))] = sum(b - a if b >= a else b for (_, a), (_, b) in zip(inside, inside[1:]))
    return out


@pytest.mark.parametrize("window,step", [(900, 300), (600, 600), (700, 300), (60, 60)])
def test_increase_at_ticks_equals_brute_force(spark, window, step):
    rows = random_samples(window) + [("n", "e", None, 1.0), ("n", "e", at(5), None), ("one", "e", at(7), 3.0)]
    got = counters.increase(spark.createDataFrame(rows, SCHEMA), ["app", "lvl"], f"{window}s", f"{step}s").collect()
    assert {(r.app, r.lvl, r.tick): r.increase for r in got} == brute(rows, window, step)


def test_slices_shorter_than_the_window_change_nothing(spark):
    rows = random_samples(3)
    df = spark.createDataFrame(rows, SCHEMA)
    panes = counters.pane_increments(df, ["app", "lvl"], "300s", "900s", slice_seconds=400)
    got = counters.increase_at_ticks(panes, ["app", "lvl"], "900s", "300s").collect()
    assert {(r.app, r.lvl, r.tick): r.increase for r in got} == brute(rows, 900, 300)


def test_equals_the_sample_form_where_samples_lie_on_ticks(spark):
    rows = [("a", "e", at(300 * k), float(v)) for k, v in enumerate([1, 4, 4, 2, 9, 0, 3, 3, 8])]
    df = spark.createDataFrame(rows, SCHEMA)
    want = metrics.counter_increase(df, ["app", "lvl"], "900s").filter("increase is not null")
    got = counters.increase(df, ["app", "lvl"], "900s", "300s").join(df.select(F.col("ts").alias("tick")), "tick", "left_semi")
    assert {(r.tick, r.increase) for r in got.collect()} == {(r.ts, r.increase) for r in want.collect()}


def test_rate_share_drops_key_sets_without_a_matching_series(spark):
    inc = spark.createDataFrame([("a", "e", at(0), 1.0), ("a", "w", at(0), 3.0), ("b", "w", at(0), 2.0), ("c", "e", at(0), 0.0)],
                                "app string, lvl string, tick timestamp_ntz, increase double")
    got = {r.app: r.error_pct for r in counters.rate_share(inc, ["app"], F.col("lvl") == "e").collect()}
    assert got == {"a": 25.0, "c": None}


def stream(spark, rows, slices, window="900s", step="300s", delay="10m"):
    df = spark.createDataFrame([(*r, k) for r, k in zip(rows, slices)], SCHEMA + ", slice int")
    folder, root = scratch_path(spark, "test", "samples_in"), scratch_path(spark, "test", "samples")
    outs = []
    for _ in replay(df, folder, max(slices) + 1, F.col("slice")):
        live = file_stream(spark, folder, df.schema).drop("slice")
        out = scounters.run_counter_stream(spark, live, root, ["app", "lvl"], window=window, step=step, delay=delay)
        outs.append({(r.app, r.lvl, r.tick): r.increase for r in out.collect()})
    return outs, root


def test_stream_equals_batch_over_batches_and_resets(spark):
    """Cuts fall inside windows and panes, a reset lies on a cut, and samples come up to the delay out of order."""
    rng = random.Random(11)
    rows = random_samples(12)
    rows += [("cut", "e", at(7150), 50.0), ("cut", "e", at(7250), 2.0), ("cut", "e", at(7400), 5.0)]
    place = [min(3, max(0, int((int((r[2] - T0).total_seconds()) + rng.randint(-280, 280)) // 5400))) for r in rows]
    outs, root = stream(spark, rows, place)
    for k, got in enumerate(outs):
        assert got == brute([r for r, p in zip(rows, place) if p <= k], 900, 300)
    assert scounters.late_samples(spark, root).agg(F.sum("late")).first()[0] == 0
    # what is carried stays small: no sample or pane older than a window (and the delay) is kept
    kept = spark.read.parquet(root + "/panes/batch=3")
    assert kept.agg(F.min("pane_end")).first()[0] > at(6 * 3600 - 900 - 600 - 600)
    assert spark.read.parquet(root + "/last/batch=3").count() <= 6


def test_samples_behind_the_closed_mark_are_left_out_and_counted(spark):
    rows = [("a", "e", at(s), float(s)) for s in (0, 300, 600, 4000, 4300)] + [("a", "e", at(450), 900.0), ("a", "e", at(4200), 4200.0)]
    outs, root = stream(spark, rows, [0, 0, 0, 0, 0, 1, 1])
    assert outs[1] == brute([r for r in rows if r[2] != at(450)], 900, 300)
    assert {r.batch: r.late for r in scounters.late_samples(spark, root).collect()} == {0: 0, 1: 1}


def test_stream_without_input_has_no_rates(spark):
    folder = scratch_path(spark, "test", "no_samples")
    spark.createDataFrame([], SCHEMA).write.parquet(folder)
    out = scounters.run_counter_stream(spark, file_stream(spark, folder, spark.read.parquet(folder).schema),
                                       scratch_path(spark, "test", "no_rates"), ["app", "lvl"], window="900s", step="300s", delay="1m")
    assert out.count() == 0
