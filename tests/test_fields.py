"""Documents with wrong fields by name, retry rounds, replayed records, and slices by counted rows."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgerlight.functions.timefn import epoch_micros, ntz_literal
from ledgerlight.operators import documents, holds, metrics, slicing
from ledgerlight.session import scratch_path
from ledgerlight.sources import sinks, streams
from ledgerlight.streaming import retries

DDL = "a int, b string, c struct<d: date, e: boolean, f: bigint>, l array<struct<p: int, `første`: struct<g: date, h: string>>>"


@pytest.mark.parametrize("text,unreadable,wrong", [
    ('{"a":5,"b":"x","c":{"d":"2019-01-01","e":true,"f":12345678901},"l":[{"p":1,"første":{"g":"2019-02-02"}}]}', False, []),
    ('{"l":[{"p":1,"første":{"g":"x"}},{"p":"no"},{"p":"no"},{"p":2,"første":{"g":"2019-02-02"}}]}', False, ["l[].første.g", "l[].p"]),
    ('{"a":"12","c":7,"l":"x"}', False, ["a", "c", "l"]),
    ('{"a":null,"b":5.0,"c":{"d":"x","f":1e3,"e":null}}', False, ["c.d", "c.f"]),
    ('{"a":3000000000,"c":{"e":"true","f":1}}', False, ["a", "c.e"]),
    ('{"a":5.5,"b":{"x":1}}', False, ["a"]), ('{}', False, []), ('null', False, []), (None, False, []), ('', False, []),
    ('[1,2]', False, ["$"]), ('"str"', False, ["$"]), ('{"a":5, "b', True, []), ('{"a":1,"a":"z"}', True, [])])
def test_wrong_fields_by_name(spark, text, unreadable, wrong):
    row = documents.decode_fields(spark.createDataFrame([(1, text, "kept")], "k int, t string, doc2 string"), "t", ddl=DDL).first()
    assert (row.unreadable, sorted(row.wrong_fields), row.k, row.doc2) == (unreadable, wrong, 1, "kept")


def test_valid_branches_survive_wrong_fields(spark):
    text = '{"a":"x","b":"y","c":{"d":"bad","e":true,"f":7},"l":[{"p":"no","første":{"g":"2019-02-02","h":"i"}},{"p":2}]}'
    doc = documents.decode_fields(spark.createDataFrame([(text,)], "t string"), "t", ddl=DDL).first().doc
    assert (doc.a, doc.b, doc.c.d, doc.c.e, doc.c.f) == (None, "y", None, True, 7)
    assert [(x.p, x["første"] and x["første"].g) for x in doc.l] == [(None, dt.date(2019, 2, 2)), (2, None)]


# ------------------------------------------------------------------ retries

def _rounds(spark, letters, root=None, times=4, max_attempts=3):
    df = spark.createDataFrame(letters, "k long, error string, attempt int, failed_at timestamp_ntz, mends int")
    root = root or scratch_path(spark, "test", "retries")
    now = [F.timestamp_add("DAY", F.lit(30 * (2 ** n - 1)), ntz_literal("2024-01-01 00:00:00")) for n in range(1, times + 1)]

    def checks(at):
        return [("late", F.timestamp_add("DAY", F.col("mends"), ntz_literal("2024-01-01 00:00:00")) > at), ("broken", F.col("mends").isNull())]

    return retries.run_retry_rounds(df, root, checks, now, max_attempts, "30d", key="k"), root


def test_every_letter_ends_recovered_or_parked(spark):
    old = dt.datetime(2023, 1, 1)
    letters = [(1, "late", 1, old, 0), (2, "late", 1, old, 60), (3, "late", 1, old, 1000), (4, "broken", 1, old, None),
               (5, "late", 3, old, 0), (6, "late", None, old, 0), (7, "late", 2, old, 100)]
    log, _ = _rounds(spark, letters)
    rows = {(r["round"], r.k): (r.state, r.attempt) for r in log.collect()}
    assert {k: v for k, v in rows.items() if k[1] == 2} == {(1, 2): ("again", 2), (2, 2): ("recovered", 2)}
    assert {k: v for k, v in rows.items() if k[1] == 3} == {(1, 3): ("again", 2), (2, 3): ("again", 3), (3, 3): ("parked", 3)}
    ends = {r.k: (r.state, r["round"]) for r in retries.outcome(log, "k").collect()}
    assert ends == {1: ("recovered", 1), 2: ("recovered", 2), 3: ("parked", 3), 4: ("parked", 3), 5: ("parked", 1), 6: ("parked", 1), 7: ("parked", 2)}
    assert max(r for r, _ in rows) <= 3
    assert {r.k: r.error for r in log.filter("round = 2").collect()} == {2: None, 3: "late", 4: "broken", 7: "late"}


def test_a_round_that_runs_again_advances_nothing_twice(spark):
    import os

    letters = [(k, "late", 1, dt.datetime(2023, 1, 1), 40 * k) for k in range(6)]
    log, root = _rounds(spark, letters)
    want = sorted(map(tuple, log.collect()))
    assert sorted(map(tuple, _rounds(spark, letters, root)[0].collect())) == want          # nothing left to do
    for name in ("_SUCCESS", "._SUCCESS.crc"):                                             # a round that did not complete
        path = os.path.join(root.removeprefix("file:"), "open", "batch=2", name)
        if os.path.exists(path):
            os.remove(path)
    assert sorted(map(tuple, _rounds(spark, letters, root)[0].collect())) == want


# ------------------------------------------------------------------ records

def test_replayed_records_count_once(spark):
    t0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    schema = "key binary, value binary, topic string, partition int, offset long, timestamp timestamp, slice int"

    def rec(o, minute, text, slice_, part=0):
        return (b"k%d" % o, None if text is None else text.encode(), "t", part, o, t0 + dt.timedelta(minutes=minute), slice_)

    sent = [rec(1, 0, '{"a":1}', 0), rec(1, 0, '{"a":1}', 0), rec(1, 1, '{"a":9}', 0, part=1), rec(2, 5, None, 0), rec(3, 6, '{"a"', 0),
            rec(2, 5, None, 1), rec(4, 40, '{"a":"x"}', 1), rec(3, 6, '{"a"', 1), rec(5, 41, '{"a":5}', 2), rec(4, 40, '{"a":"x"}', 2), rec(1, 0, '{"a":1}', 2)]
    df = spark.createDataFrame(sent, schema)
    folder, out = scratch_path(spark, "test", "rec_in"), scratch_path(spark, "test", "rec")
    for _ in streams.replay(df, folder, 3, F.col("slice")):
        live = streams.dedup_records(streams.file_stream(spark, folder, df.schema).drop("slice"), "10m")
        sinks.run_to_files(streams.decode_records(live, "a int"), out, out + "_cp")
    batch = streams.decode_records(streams.dedup_records(df.drop("slice"), "10m"), "a int")
    got = sinks.read_files(spark, out, batch.schema)
    assert sorted(map(str, got.collect())) == sorted(map(str, batch.collect()))
    assert {(r.record_key, r.partition, r.kind, r.a) for r in got.collect()} == {
        ("k1", 0, "value", 1), ("k1", 1, "value", 9), ("k2", 0, "tombstone", None), ("k3", 0, "unreadable", None),
        ("k4", 0, "unreadable", None), ("k5", 0, "value", 5)}
    assert sinks.read_files(spark, out + "_none", batch.schema).count() == 0


# ------------------------------------------------------------------ slices by counted rows

def _dense(spark, seed=2, n=3000):
    """A third of all rows in one hour of one series."""
    rng = random.Random(seed)
    t0 = dt.datetime(2024, 1, 1)
    rows = [("hot", t0 + dt.timedelta(microseconds=rng.randrange(3_600_000_000)), float(rng.randint(0, 50))) for _ in range(n // 3)]
    rows += [(rng.choice(["hot", "a", "b", None]), t0 + dt.timedelta(seconds=rng.randrange(86_400 * 9)), float(rng.randint(0, 50))) for _ in range(n - n // 3)]
    return spark.createDataFrame(rows, "s string, ts timestamp_ntz, value double").dropDuplicates(["s", "ts"])


def test_density_slices_are_balanced_and_exact(spark):
    df = _dense(spark)
    want = sorted(map(tuple, metrics.counter_increase(df, ["s"], "5m").collect()), key=repr)
    assert sorted(map(tuple, metrics.counter_increase(df, ["s"], "5m", rows_per_slice=100).collect()), key=repr) == want
    cut = slicing.add_density_slices(df.withColumn("t", epoch_micros("ts")), ["s"], "t", 300_000_000, 100)
    assert cut.filter(slicing.OWN).count() == df.count()
    busiest = cut.groupBy("s", slicing.SLICE).count().agg(F.max("count")).first()[0]
    assert busiest < 0.1 * df.count()
    fixed = slicing.add_time_slices(df.withColumn("t", epoch_micros("ts")), "t", 300_000_000, slicing.slice_length_us(300_000_000))
    assert fixed.groupBy("s", slicing.SLICE).count().agg(F.max("count")).first()[0] > 0.3 * df.count()


def test_density_slices_under_held_conditions(spark):
    df = _dense(spark, 5).select("s", F.date_trunc("minute", "ts").cast("timestamp_ntz").alias("tick")).distinct()
    want = sorted(map(tuple, holds.sustained(df, ["s"], "4m", "1m").collect()), key=repr)
    got = sorted(map(tuple, holds.sustained(df, ["s"], "4m", "1m", rows_per_slice=20).select("s", "tick", "start", "fires_at").collect()), key=repr)
    assert got == want and len(want) > 0


def test_density_slices_copy_a_dense_series_a_bounded_number_of_times(spark):
    """150 rows in every one of 40 minutes: the slices that a row is copied to do not grow with the rows of a frame."""
    t0 = dt.datetime(2024, 1, 1)
    rows = [("hot", t0 + dt.timedelta(minutes=m, microseconds=i), float(i % 7)) for m in range(40) for i in range(150)]
    df = spark.createDataFrame(rows, "s string, ts timestamp_ntz, value double")
    cut = slicing.add_density_slices(df.withColumn("t", epoch_micros("ts")), ["s"], "t", 600_000_000, 10)
    assert cut.filter(slicing.OWN).count() == df.count()
    assert cut.count() < 4 * df.count()
    owned = [r[0] for r in cut.filter(slicing.OWN).select(slicing.SLICE).distinct().collect()]
    assert len(owned) >= 3 and max(owned) - min(owned) == len(owned) - 1


def test_counter_increase_needs_no_sliding_frame(spark):
    """Every frame starts at the start of its partition, so a sample costs the same however many its window holds."""
    df = spark.createDataFrame([("a", dt.datetime(2024, 1, 1), 1.0)], "s string, ts timestamp_ntz, value double")
    for kw in ({}, {"rows_per_slice": 10}):
        plan = metrics.counter_increase(df, ["s"], "5m", **kw).drop(slicing.SLICE)._jdf.queryExecution().optimizedPlan().toString()
        values = [f for f in plan.split("specifiedwindowframe(")[1:] if "sum(" in plan]
        frames = {f.split(")")[0] for f in values}
        # buckets and neighbours (lag, lead) aside, which look at a fixed number of rows
        assert not any("RangeFrame, -" in f and str(299_999_999) in f for f in frames), frames


def test_counter_increase_keeps_a_wild_value_to_its_own_frames(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [("a", t0 + dt.timedelta(seconds=60 * i), v) for i, v in enumerate([1.0, 2.0, float("inf"), 5.0, 6.0, 8.5, 0.25, 1e300, 1.0, 2.5])]
    df = spark.createDataFrame(rows, "s string, ts timestamp_ntz, value double")
    got = [r.increase for r in metrics.counter_increase(df, ["s"], "2m").orderBy("ts").collect()]
    assert got == [None, 1.0, float("inf"), 5.0, 1.0, 2.5, 0.25, 1e300, 1.0, 1.5]
