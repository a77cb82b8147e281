"""Streams (T1, T2, S1+T3) against their batch forms, over several micro-batches, and replays."""

from __future__ import annotations

import datetime as dt
import os
import time

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerlight.functions.timefn import ntz_literal
from ledgerlight.operators import holds, journal, metrics
from ledgerlight.plans import standins
from ledgerlight.schemas import EVENTS_SCHEMA, ORDERS_SCHEMA
from ledgerlight.session import scratch_path
from ledgerlight.sources.sinks import read_batches, write_batch
from ledgerlight.sources.streams import file_stream
from ledgerlight.streaming import alerts as salerts
from ledgerlight.streaming import journal as sjournal

from conftest import SF01

KEYS = ["log_app", "log_namespace"]


def is_err():
    return F.col("log_level") == "Error"


def _time_ordered_files(spark, src, folder, n_files, order_col):
    """Split a table into ``n_files`` files in time order with rising modification times."""
    df = spark.read.parquet(src).withColumn("__b", F.ntile(n_files).over(Window.orderBy(order_col)))
    os.makedirs(folder, exist_ok=True)
    for b in range(1, n_files + 1):
        part = os.path.join(folder, f"part{b:03d}")
        df.filter(F.col("__b") == b).drop("__b").coalesce(1).write.parquet(part + ".tmp")
        f = [x for x in os.listdir(part + ".tmp") if x.endswith(".parquet")][0]
        os.rename(os.path.join(part + ".tmp", f), part + ".parquet")
        t = time.time() - (n_files - b) * 10
        os.utime(part + ".parquet", (t, t))


def test_stream_error_ratio_and_holds_equal_batch(spark):
    folder = scratch_path(spark, "test", "events_in")
    _time_ordered_files(spark, os.path.join(SF01, "events.parquet"), folder, 4, "ts")
    stream = file_stream(spark, folder, EVENTS_SCHEMA, glob="*.parquet", max_files_per_trigger=1)
    agg = salerts.error_counts(standins.log_messages(stream), KEYS, "3h", "1h", "1h", is_err())
    root = scratch_path(spark, "test", "ticks")
    salerts.run_update_stream(agg, root + "/t", root + "/cp")
    assert read_batches(spark, root + "/t").select("batch").distinct().count() >= 4   # several micro-batches
    ticks = salerts.current_ticks(spark, root + "/t", KEYS)
    got = salerts.error_ratio_from_ticks(ticks, 25.0)

    batch_msgs = standins.log_messages(spark.read.parquet(os.path.join(SF01, "events.parquet")))
    want = metrics.error_ratio(batch_msgs, KEYS, "3h", "1h", is_err(), 25.0)
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))

    held_s = salerts.held_from_ticks(got, KEYS, "3h", "1h").select(*KEYS, "start", "fires_at")
    held_b = holds.sustained(want, KEYS, "3h", "1h").select(*KEYS, "start", "fires_at")
    assert sorted(map(tuple, held_s.collect())) == sorted(map(tuple, held_b.collect()))
    assert held_b.count() > 0


def test_write_batch_replay_overwrites(spark):
    root = scratch_path(spark, "test", "replay")
    df = spark.range(5)
    write_batch(df, root, 0)
    write_batch(df, root, 0)          # replayed batch
    write_batch(spark.range(2), root, 1)
    assert read_batches(spark, root).count() == 7


def test_stream_finalise_equals_batch_and_replay_is_idempotent(spark):
    folder = scratch_path(spark, "test", "orders_in")
    _time_ordered_files(spark, os.path.join(SF01, "orders.parquet"), folder, 3, "o_orderdate")
    lines = spark.read.parquet(os.path.join(SF01, "lineitem.parquet"))
    dec = journal.decisions_from_lines(lines, "l_orderkey", "l_shipdate")
    cutoff = ntz_literal("1998-01-01 00:00:00")
    root = scratch_path(spark, "test", "fin")
    kw = dict(key="o_orderkey", status="o_orderstatus", version="o_orderdate", task_kind="t")

    stream = file_stream(spark, folder, ORDERS_SCHEMA, glob="*.parquet", max_files_per_trigger=1)
    sjournal.run_finalise_stream(spark, stream, dec, cutoff, root, root + "/cp", compact_every=2, **kw)
    # the same input again under a new checkpoint = a full replay into the same tables
    stream = file_stream(spark, folder, ORDERS_SCHEMA, glob="*.parquet", max_files_per_trigger=1)
    sjournal.run_finalise_stream(spark, stream, dec, cutoff, root, root + "/cp2", compact_every=2, **kw)

    state = sjournal.finalised_state(spark, root, "o_orderkey")
    want = journal.finalise(spark.read.parquet(os.path.join(SF01, "orders.parquet")), dec, cutoff,
                            key="o_orderkey", status="o_orderstatus", version="o_orderdate")
    assert sorted(map(tuple, state.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))
    tasks = read_batches(spark, os.path.join(root, "outbox"))
    assert tasks.count() == tasks.select("task_id").distinct().count() == want.filter("outcome = 'final'").count()


def test_alerts_fire_during_the_stream_and_equal_batch(spark):
    folder = scratch_path(spark, "test", "events_in2")
    _time_ordered_files(spark, os.path.join(SF01, "events.parquet"), folder, 5, "ts")
    stream = file_stream(spark, folder, EVENTS_SCHEMA, glob="*.parquet", max_files_per_trigger=1)
    panes = salerts.error_panes(standins.log_messages(stream), KEYS, "1h", "1h", is_err())
    root = scratch_path(spark, "test", "alert_stream")
    fired = salerts.run_alert_stream(spark, panes, root, KEYS, window="3h", step="1h", delay="1h",
                                     threshold=25.0, hold="3h", compact_every=2)
    got = sorted(map(tuple, fired.select(*KEYS, "start", "fires_at").collect()))

    batch_msgs = standins.log_messages(spark.read.parquet(os.path.join(SF01, "events.parquet")))
    ratio = metrics.error_ratio(batch_msgs, KEYS, "3h", "1h", is_err(), 25.0)
    want = sorted(map(tuple, holds.sustained(ratio, KEYS, "3h", "1h").select(*KEYS, "start", "fires_at").collect()))
    assert got == want and len(want) > 0
    # most alerts are emitted by micro-batches, before the end-of-input flush
    by_batch = read_batches(spark, os.path.join(root, "fired")).groupBy("batch").count().collect()
    early = sum(r["count"] for r in by_batch if r["batch"] != "flush")
    assert early > len(want) // 2


def test_key_ledger_equals_union_of_earlier_batches(spark):
    from ledgerlight.streaming.ledger import KeyLedger
    led = KeyLedger(spark, scratch_path(spark, "test", "ledger"), "k", compact_every=3)
    batches = {i: list(range(i * 10, i * 10 + (i % 4))) for i in range(10)}   # some batches are empty
    for i, keys in batches.items():
        led.record(spark.createDataFrame([(k,) for k in keys], "k long"), i)
        if i == 5:                                   # a replayed batch rewrites its own folder
            led.record(spark.createDataFrame([(k,) for k in keys], "k long"), i)
    for n in (0, 1, 3, 4, 6, 7, 10):
        got = led.keys_before(n)
        want = sorted(k for i, ks in batches.items() if i < n for k in ks)
        assert (sorted(r.k for r in got.distinct().collect()) if got is not None else []) == want, n


def test_stream_counters_and_stream_static_lookup(spark):
    folder = scratch_path(spark, "test", "orders_in3")
    _time_ordered_files(spark, os.path.join(SF01, "orders.parquet"), folder, 2, "o_orderdate")
    lines = spark.read.parquet(os.path.join(SF01, "lineitem.parquet"))
    dec = journal.decisions_from_lines(lines, "l_orderkey", "l_shipdate")
    root = scratch_path(spark, "test", "fin3")
    stream = file_stream(spark, folder, ORDERS_SCHEMA, glob="*.parquet", max_files_per_trigger=1)
    q = sjournal.run_finalise_stream(spark, stream, dec, ntz_literal("1998-01-01 00:00:00"), root, root + "/cp",
                                     key="o_orderkey", status="o_orderstatus", version="o_orderdate", task_kind="t")
    seen = [p["observedMetrics"]["journal_in"] for p in q.recentProgress if p.get("observedMetrics")]
    orders = spark.read.parquet(os.path.join(SF01, "orders.parquet"))
    assert sum(m["rows"] for m in seen) == orders.count()
    assert sum(m["provisional"] for m in seen) == orders.filter("o_orderstatus = 'P'").count()

    # J3 on a stream: stream-static left join, every entry kept
    out = scratch_path(spark, "test", "enriched")
    stream = file_stream(spark, folder, ORDERS_SCHEMA, glob="*.parquet", max_files_per_trigger=1)
    customers = spark.read.parquet(os.path.join(SF01, "customer.parquet"))
    enriched = journal.enrich_left(stream, customers, "o_custkey", "c_custkey", ["c_mktsegment"])
    (enriched.writeStream.format("parquet").option("path", out).option("checkpointLocation", out + "_cp")
     .trigger(availableNow=True).start().awaitTermination())
    got = spark.read.parquet(out)
    assert got.count() == orders.count() and got.filter("c_mktsegment IS NULL").count() == 0


def test_continuous_finalise_stream_picks_up_new_files(spark):
    """A running (processing-time) stream finalises files as they arrive."""
    folder = scratch_path(spark, "test", "orders_live")
    os.makedirs(folder, exist_ok=True)
    orders = spark.read.parquet(os.path.join(SF01, "orders.parquet"))
    lines = spark.read.parquet(os.path.join(SF01, "lineitem.parquet"))
    dec = journal.decisions_from_lines(lines, "l_orderkey", "l_shipdate")
    root = scratch_path(spark, "test", "fin_live")
    orders.filter("o_orderkey % 2 = 0").write.parquet(os.path.join(folder, "a"))
    stream = file_stream(spark, os.path.join(folder, "*"), ORDERS_SCHEMA)
    q = sjournal.run_finalise_stream(spark, stream, dec, ntz_literal("1998-01-01 00:00:00"), root, root + "/cp",
                                     key="o_orderkey", status="o_orderstatus", version="o_orderdate",
                                     task_kind="t", available_now=False, interval="1 second")
    try:
        q.processAllAvailable()
        orders.filter("o_orderkey % 2 = 1").write.parquet(os.path.join(folder, "b"))
        q.processAllAvailable()
    finally:
        q.stop()
    state = sjournal.finalised_state(spark, root, "o_orderkey")
    assert state.count() == orders.filter("o_orderstatus = 'P'").count()


def test_rule_set_stream_equals_batch_rule_set(spark):
    from ledgerlight.plans import rules
    from ledgerlight.streaming import rules as srules
    folder = scratch_path(spark, "test", "events_rules")
    _time_ordered_files(spark, os.path.join(SF01, "events.parquet"), folder, 5, "ts")
    params = rules.params_for("app-0", step="1h", errors={"window": "3h", "threshold": 25.0, "hold": "3h"})
    stream = file_stream(spark, folder, EVENTS_SCHEMA, glob="*.parquet", max_files_per_trigger=1)
    root = scratch_path(spark, "test", "rule_stream")
    got = srules.run_rule_stream(spark, standins.log_messages(stream), root, params, delay="1h", compact_every=2)
    batch = rules.alerts_all(rules.MetricInputs.from_events(spark.read.parquet(os.path.join(SF01, "events.parquet"))),
                             params)
    cols = rules.ALERT_COLUMNS
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, batch.select(*cols).collect()))
    by_batch = read_batches(spark, os.path.join(root, "fired")).groupBy("batch").count().collect()
    assert sum(r["count"] for r in by_batch if r["batch"] != "flush") > batch.count() // 2


def test_rule_set_stream_runs_continuously(spark):
    """A running (processing-time) rule-set stream fires as files arrive, without a flush."""
    from ledgerlight.plans import rules
    from ledgerlight.streaming import rules as srules
    folder = scratch_path(spark, "test", "events_live")
    src = spark.read.parquet(os.path.join(SF01, "events.parquet"))
    mid = src.selectExpr("percentile_approx(event_id, 0.5)").first()[0]
    src.filter(f"event_id <= {mid}").write.parquet(os.path.join(folder, "a"))
    params = rules.params_for(None, step="1h", errors={"window": "3h", "threshold": 25.0, "hold": "3h"})
    root = scratch_path(spark, "test", "rules_live")
    stream = file_stream(spark, os.path.join(folder, "*"), EVENTS_SCHEMA)
    q = srules.run_rule_stream(spark, standins.log_messages(stream), root, params, delay="1h",
                               available_now=False, interval="1 second")
    try:
        q.processAllAvailable()
        first = read_batches(spark, os.path.join(root, "fired")).count()
        src.filter(f"event_id > {mid}").write.parquet(os.path.join(folder, "b"))
        q.processAllAvailable()
        second = read_batches(spark, os.path.join(root, "fired")).count()
    finally:
        q.stop()
    assert 0 < first < second


def test_rows_later_than_the_watermark_are_dropped(spark):
    """Late data: Spark drops a batch's rows that are older than the *previous* batch's
    watermark. Two on-time arrivals, then the early days: those are dropped, and the
    result equals the batch result over the on-time rows."""
    folder = scratch_path(spark, "test", "late_in")
    os.makedirs(folder, exist_ok=True)
    ev = spark.read.parquet(os.path.join(SF01, "events.parquet"))
    ts15, ts25 = (F.to_timestamp_ntz(F.lit(x)) for x in ("2024-01-15 00:00:00", "2024-01-25 00:00:00"))
    first = ev.filter((F.col("ts") >= ts15) & (F.col("ts") < ts25))
    second = ev.filter(F.col("ts") >= ts25)
    late = ev.filter(F.col("ts") < ts15)
    for name, part, age in (("a", first, 30), ("b", second, 20), ("c", late, 10)):
        part.coalesce(1).write.parquet(os.path.join(folder, name + ".tmp"))
        f = [x for x in os.listdir(os.path.join(folder, name + ".tmp")) if x.endswith(".parquet")][0]
        os.rename(os.path.join(folder, name + ".tmp", f), os.path.join(folder, name + ".parquet"))
        t = time.time() - age
        os.utime(os.path.join(folder, name + ".parquet"), (t, t))
    stream = file_stream(spark, folder, EVENTS_SCHEMA, glob="*.parquet", max_files_per_trigger=1)
    agg = salerts.error_counts(standins.log_messages(stream), KEYS, "3h", "1h", "1h", is_err())
    root = scratch_path(spark, "test", "late_ticks")
    salerts.run_update_stream(agg, root + "/t", root + "/cp")
    got = salerts.current_ticks(spark, root + "/t", KEYS)
    on_time = first.unionByName(second)
    want = metrics.windowed_counts(standins.log_messages(on_time), KEYS, "3h", "1h", is_err())
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))
    assert late.count() > 0


def test_alert_stream_run_again_holds_each_firing_once(spark):
    """The same root run twice, and again with new files: the batch rule's firings, none doubled."""
    import datetime as dt

    from ledgerlight.operators import holds, metrics
    from ledgerlight.streaming import alerts

    start = dt.datetime(2024, 1, 1)
    schema = "app string, level string, ts timestamp_ntz"

    def rows(lo, hi):
        return spark.createDataFrame([("a" if m % 2 else "b", "Error", start + dt.timedelta(minutes=m)) for m in range(lo, hi)], schema)

    folder, root = scratch_path(spark, "test", "again_in"), scratch_path(spark, "test", "again")
    rows(0, 60).coalesce(1).write.parquet(folder)

    def run():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
        panes = alerts.error_panes(stream, ["app"], "5m", "10m", F.col("level") == "Error")
        out = alerts.run_alert_stream(spark, panes, root, ["app"], window="10m", step="5m", delay="10m", threshold=50, hold="10m")
        return sorted((r.app, r.fires_at) for r in out.collect())

    def batch(n):
        ratio = metrics.error_ratio(rows(0, n), ["app"], "10m", "5m", F.col("level") == "Error", 50)
        return sorted((r.app, r.fires_at) for r in holds.sustained(ratio, ["app"], "10m", "5m", ts="tick").collect())

    first = run()
    assert first == batch(60) and first == run() == run()
    rows(60, 120).coalesce(1).write.mode("append").parquet(folder)
    assert run() == batch(120) == run()


def test_finalise_stream_equals_batch_for_any_arrival_order(spark):
    """Newer version first, newer version later, decision later: state and tasks as the batch form has them."""
    import datetime as dt

    from ledgerlight.operators import journal
    from ledgerlight.sources.sinks import read_batches
    from ledgerlight.streaming import journal as sjournal

    day = lambda n: dt.datetime(2024, 1, n)
    schema = "k long, s string, v timestamp_ntz"
    cutoff = ntz_literal("2024-02-01 00:00:00")
    folder, root = scratch_path(spark, "test", "order_in"), scratch_path(spark, "test", "order")
    runs = [[(1, "F", day(5)), (2, "P", day(1)), (3, "P", day(1)), (4, "P", day(1)), (5, "P", day(1))],
            [(1, "P", day(2)), (2, "F", day(6)), (6, "P", day(1)), (4, "P", day(3))],
            [(6, "P", day(1)), (7, "P", day(9))]]
    decided = [[(4, day(2))], [(4, day(2)), (3, day(4))], [(4, day(2)), (3, day(4)), (6, day(3)), (7, dt.datetime(2024, 3, 1))]]
    kw = dict(key="k", status="s", version="v")
    arrived = []
    for rows, done in zip(runs, decided):
        arrived += rows
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
        dec = journal.decisions_from_lines(spark.createDataFrame(done, "k long, t timestamp_ntz"), "k", "t")
        stream = spark.readStream.schema(schema).parquet(folder)
        sjournal.run_finalise_stream(spark, stream, dec, cutoff, root, root + "/cp", task_kind="t", compact_every=2, **kw)
        batch = journal.finalise(spark.createDataFrame(arrived, schema), dec, cutoff, **kw)
        got = sjournal.finalised_state(spark, root, "k")
        assert sorted(map(tuple, got.select(*batch.columns).collect())) == sorted(map(tuple, batch.collect()))
    tasks = [r.k for r in read_batches(spark, f"{root}/outbox").collect()]
    assert sorted(tasks) == [3, 4, 6]


def _records(spark, rows, folder):
    spark.createDataFrame(rows, "k long, s string, v timestamp_ntz, line long").write.mode("append").parquet(folder)


def test_finalise_state_is_carried_by_key(spark):
    """Ties by the second version column, closed keys never read again, counters per batch, and a replayed batch."""
    import datetime as dt

    day = lambda n: dt.datetime(2024, 1, n)
    folder, root = scratch_path(spark, "test", "keyed_in"), scratch_path(spark, "test", "keyed")
    kw = dict(key="k", status="s", version="v", tie="line")
    cutoff = ntz_literal("2024-02-01 00:00:00")
    dec = journal.decisions_from_lines(spark.createDataFrame([(2, day(3)), (5, day(4))], "k long, t timestamp_ntz"), "k", "t")
    batches = [
        [(1, "P", day(1), 1), (1, "F", day(1), 2), (2, "P", day(1), 1), (3, "P", day(1), 1), (None, "P", day(1), 1)] + [(k, "F", day(1), 1) for k in range(100, 200)],
        [(1, "P", day(1), 1), (3, "P", day(1), 0), (3, "F", day(1), 1), (4, "P", None, 1)],       # equal in both: closed wins
        [(5, "P", day(2), 7), (5, "F", day(2), 6), (2, "P", day(9), 1), (4, "F", None, None)]]
    arrived = []
    for rows in batches:
        arrived += rows
        _records(spark, rows, folder)
        stream = file_stream(spark, folder, spark.read.parquet(folder).schema)
        sjournal.run_finalise_stream(spark, stream, dec, cutoff, root, root + "/cp", task_kind="t", **kw)
        batch = journal.finalise(spark.createDataFrame(arrived, "k long, s string, v timestamp_ntz, line long"), dec, cutoff, **kw)
        got = sjournal.finalised_state(spark, root, "k")
        assert sorted(map(tuple, got.select(*batch.columns).collect()), key=repr) == sorted(map(tuple, batch.collect()), key=repr)

    def counters():
        return sorted(map(tuple, sjournal.stream_counters(spark, root).collect()))

    want = [(0, 105, 4, 1, 2, 101), (1, 4, 3, 0, 1, 2), (2, 4, 2, 2, 1, 0)]
    assert counters() == want
    # what a batch reads and writes besides its arrivals: the waiting entries, not the closed keys
    assert [spark.read.parquet(f"{root}/waiting/batch={n}").count() for n in range(3)] == [2, 2, 2]
    assert [spark.read.parquet(f"{root}/finalised/batch={n}").count() for n in range(3)] == [104, 3, 3]
    tasks = sorted(map(tuple, sjournal.issued_tasks(spark, root).select("k", "created_at").collect()))
    assert tasks == [(2, day(3)), (5, day(4))]         # 2 became final twice, one task

    # the last batch runs again, as after a failure before its commit
    os.remove(os.path.join(root.removeprefix("file:"), "cp", "commits", "2"))
    crc = os.path.join(root.removeprefix("file:"), "cp", "commits", ".2.crc")
    if os.path.exists(crc):
        os.remove(crc)
    stream = file_stream(spark, folder, spark.read.parquet(folder).schema)
    sjournal.run_finalise_stream(spark, stream, dec, cutoff, root, root + "/cp", task_kind="t", **kw)
    assert counters() == want and sorted(map(tuple, sjournal.issued_tasks(spark, root).select("k", "created_at").collect())) == tasks
    assert sum(r[1] for r in want) == len(arrived) and sum(r[2] for r in want) == sum(r[1] == "P" for r in arrived)


def test_waiting_entries_become_final_without_arriving_again(spark):
    import datetime as dt

    day = lambda n: dt.datetime(2024, 1, n)
    folder, root = scratch_path(spark, "test", "wait_in"), scratch_path(spark, "test", "wait")
    cutoff = ntz_literal("2024-02-01 00:00:00")
    for n, done in enumerate([[(9, day(1))], [(1, day(5))]]):
        _records(spark, [(1 + n, "P", day(1), 1)], folder)
        dec = journal.decisions_from_lines(spark.createDataFrame(done, "k long, t timestamp_ntz"), "k", "t")
        stream = file_stream(spark, folder, spark.read.parquet(folder).schema)
        sjournal.run_finalise_stream(spark, stream, dec, cutoff, root, root + "/cp", key="k", status="s", version="v", task_kind="t")
    assert {(r.k, r.outcome) for r in sjournal.finalised_state(spark, root, "k").collect()} == {(1, "final"), (2, "waiting")}
    assert [r.k for r in sjournal.issued_tasks(spark, root).collect()] == [1]
    assert [tuple(r)[3:] for r in sjournal.stream_counters(spark, root).orderBy("batch").collect()] == [(0, 1, 0), (1, 1, 0)]


def test_version_order(spark):
    rows = [(1, "P", "2024-01-01", 5), (1, "P", "1969-12-31", 9), (1, "P", None, 99), (1, "P", "2024-01-01", None), (1, "F", "2024-01-01", 5)]
    df = spark.createDataFrame(rows, "k long, s string, v string, t long").withColumn("v", F.to_timestamp_ntz("v"))
    order = journal.version_order(df, "v", "t", journal.is_provisional("s"))
    got = [(r.s, r.t) for r in df.withColumn("o", order).orderBy("o").collect()]
    assert got == [("P", 99), ("P", 9), ("P", None), ("P", 5), ("F", 5)]


def test_late_panes_correct_earlier_windows(spark):
    """Deltas by batch: rows in any order, at most one slice at a time, sum to the batch form after every slice."""
    from ledgerlight.sources.streams import replay
    from ledgerlight.streaming import windows as swindows

    ev = spark.read.parquet(os.path.join(SF01, "events.parquet")).withColumn("slice", F.pmod(F.xxhash64("event_id"), F.lit(3)))
    folder, root = scratch_path(spark, "test", "late_windows_in"), scratch_path(spark, "test", "late_windows")
    aggs = {"errors": F.count_if(F.col("log_level") == "Error"), "total": F.count(F.lit(1))}
    for k in replay(ev, folder, 3, F.col("slice")):
        msgs = standins.log_messages(file_stream(spark, folder, ev.schema))
        swindows.run_window_stream(spark, msgs, root, KEYS, window="3h", step="1h", aggs=aggs)
        got = swindows.current_windows(spark, root, KEYS, list(aggs))
        want = metrics.windowed_counts(standins.log_messages(ev.filter(F.col("slice") <= k)), KEYS, "3h", "1h", is_err())
        assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))
    touched = swindows.changed_windows(spark, root, KEYS, list(aggs), 2)
    assert 0 < touched.count() <= want.count() and touched.join(want, want.columns, "left_anti").count() == 0


def test_finalising_batch_works_through_its_state_once(spark, monkeypatch):
    """Counters come from what was written, and open and closed keys from one aggregate of the touched and waiting ones."""
    folder, root = scratch_path(spark, "test", "once_in"), scratch_path(spark, "test", "once")
    plans = {}

    def seen(df, path, batch_id):
        plans[os.path.basename(path)] = df._jdf.queryExecution().executedPlan().toString()
        write_batch(df, path, batch_id)

    monkeypatch.setattr(sjournal, "write_batch", seen)
    monkeypatch.setattr("ledgerlight.streaming.carried.write_batch", seen)
    day = dt.datetime(2024, 1, 1)
    _records(spark, [(1, "P", day, 1), (2, "F", day, 1), (3, "P", day, 1)], folder)
    dec = journal.decisions_from_lines(spark.createDataFrame([(1, day)], "k long, t timestamp_ntz"), "k", "t")
    stream = file_stream(spark, folder, spark.read.parquet(folder).schema)
    sjournal.run_finalise_stream(spark, stream, dec, ntz_literal("2024-02-01 00:00:00"), root, root + "/cp",
                                 key="k", status="s", version="v", task_kind="t")
    assert "Join" not in plans["counters"] and "Join" in plans["finalised"]
    assert plans["finalised"].split("Initial Plan")[0].count("Union") == 1
    one = sjournal.stream_counters(spark, root).collect()
    assert [tuple(r) for r in one] == [(0, 3, 2, 1, 1, 1)]
