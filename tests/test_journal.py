"""Journal operators (W4, J3, T3-T6, S8): literal rows, idempotent re-runs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ledgerlight.functions.timefn import ntz_literal
from ledgerlight.operators import journal
from ledgerlight.sources.sinks import observe_run

D0 = dt.datetime(2024, 1, 1)


def entries(spark, rows):
    df = spark.createDataFrame(rows, "key long, status string, version timestamp")
    return df.withColumn("version", F.col("version").cast("timestamp_ntz"))


def lines(spark, rows):
    df = spark.createDataFrame(rows, "key long, done timestamp")
    return df.withColumn("done", F.col("done").cast("timestamp_ntz"))


def test_latest_per_key_breaks_ties_with_later_columns(spark):
    df = spark.createDataFrame([(1, 10, "a"), (1, 10, "b"), (1, 9, "c"), (2, 1, "d")], "k int, v int, x string")
    got = sorted(map(tuple, journal.latest_per_key(df, "k", ["v", "x"]).collect()))
    assert got == [(1, 10, "b"), (2, 1, "d")]


def test_enrich_left_keeps_misses(spark):
    left = spark.createDataFrame([(1, 10), (2, 99)], "id int, ck int")
    right = spark.createDataFrame([(10, "x", 5)], "ck int, name string, other int")
    got = sorted(map(tuple, journal.enrich_left(left, right, "ck", "ck", ["name"]).collect()))
    assert got == [(1, 10, "x"), (2, 99, None)]


def _finalise(spark, already=None):
    e = entries(spark, [(1, "P", D0), (1, "F", D0 + dt.timedelta(days=1)),   # newest version is final
                        (2, "P", D0), (3, "P", D0), (4, "P", D0), (5, "O", D0)])
    dec = journal.decisions_from_lines(lines(spark, [(2, D0), (2, D0 + dt.timedelta(days=3)),
                                                     (3, D0 + dt.timedelta(days=30))]), "key", "done")
    return journal.finalise(e, dec, ntz_literal("2024-01-10 00:00:00"), key="key", status="status",
                            version="version", already_final=already)


def test_finalise_outcomes(spark):
    got = {r.key: (r.outcome, r.new_status, r.n_parts) for r in _finalise(spark).collect()}
    assert got == {2: ("final", "F", 2), 3: ("waiting", "P", 1), 4: ("waiting", "P", 0)}


def test_finalise_and_outbox_rerun_add_nothing(spark):
    first = _finalise(spark)
    done = first.filter(F.col("outcome") == "final").select("key")
    again = _finalise(spark, already=done)
    assert sorted(r.key for r in again.collect()) == [3, 4]
    tasks = journal.task_outbox(first, "key", "k", "decided_at")
    ids = [r.task_id for r in tasks.collect()]
    assert len(ids) == 1 and len(ids[0]) == 64
    assert journal.task_outbox(first, "key", "k", "decided_at", existing=tasks).count() == 0


def test_split_outcome_and_retry(spark):
    df = spark.createDataFrame([(1, "10", 1, D0), (2, "x", 1, D0), (3, "x", 3, D0), (4, None, 2, D0)],
                               "key int, amount string, attempt int, failed_at timestamp") \
        .withColumn("failed_at", F.col("failed_at").cast("timestamp_ntz"))
    ok, bad = journal.split_outcome(df, [("bad_amount", F.col("amount").isNotNull() & F.col("amount").try_cast("int").isNull()),
                                         ("missing", F.col("amount").isNull())])
    assert [r.key for r in ok.collect()] == [1]
    assert sorted((r.key, r.error) for r in bad.collect()) == [(2, "bad_amount"), (3, "bad_amount"), (4, "missing")]
    # backoff 1 day doubling: attempt 1 due after 1 day, attempt 2 after 2 days; attempt 3 is the last
    due = journal.retry_due(bad, ntz_literal("2024-01-02 12:00:00"), 3, "1d")
    assert sorted((r.key, r.next_attempt) for r in due.collect()) == [(2, 2)]
    due = journal.retry_due(bad, ntz_literal("2024-01-03 00:00:00"), 3, "1d")
    assert sorted((r.key, r.next_attempt) for r in due.collect()) == [(2, 2), (4, 3)]


def test_observe_run_counts_alongside_the_action(spark):
    df, obs = observe_run(_finalise(spark), "finalise", final=F.col("outcome") == "final")
    assert df.count() == 3
    assert obs.get == {"rows": 3, "final": 1}


def test_alert_sink_round_trip(spark):
    import os
    from ledgerlight.plans import rules
    from ledgerlight.session import scratch_path
    from ledgerlight.sources.sinks import write_alerts
    from conftest import SF001
    inp = rules.MetricInputs.from_events(spark.read.parquet(os.path.join(SF001, "events.parquet")), materialize=False)
    alerts = rules.alerts_all(inp, rules.params_for("app-0", errors={"window": "3h", "threshold": 25.0, "hold": "3h"}))
    path = scratch_path(spark, "test", "alerts")
    write_alerts(alerts, path)
    back = spark.read.parquet(path)
    assert back.columns == rules.ALERT_COLUMNS
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, alerts.collect()))


def test_rule_set_from_a_message_table_at_a_short_step(spark):
    """The README recipe: rules from a message table with a 15-minute pane step."""
    import os
    from ledgerlight.plans import rules, standins
    from conftest import SF001
    msgs = standins.log_messages(spark.read.parquet(os.path.join(SF001, "events.parquet")))
    inp = rules.MetricInputs.from_messages(msgs, step="15m")
    params = rules.params_for("app-0", step="15m", errors={"window": "45m", "threshold": 25.0, "hold": "30m"})
    out = rules.alerts_all(inp, params)
    assert out.columns == rules.ALERT_COLUMNS and out.count() >= 0
    # the error rule summed from 15-minute panes equals the same rule on the raw messages
    a = rules.high_error_share(inp, params["errors"])
    raw = rules.MetricInputs(msgs, inp.apps, inp.replicas, inp.selftests, pane_step="1h")
    b = rules.high_error_share(raw, params["errors"])
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_retry_round_recovers_requeues_and_parks(spark):
    rows = [(1, "7", 1, D0), (2, "x", 1, D0), (3, "x", 3, D0), (4, "x", 1, D0 + dt.timedelta(days=5))]
    dead = spark.createDataFrame([(k, a, n, t, "bad_amount") for k, a, n, t in rows],
                                 "key int, amount string, attempt int, failed_at timestamp, error string") \
        .withColumn("failed_at", F.col("failed_at").cast("timestamp_ntz"))
    checks = [("bad_amount", F.col("amount").try_cast("int").isNull())]
    now = ntz_literal("2024-01-03 00:00:00")
    recovered, dead_next, parked = journal.retry_round(dead, checks, now, 3, "1d")
    assert [r.key for r in recovered.collect()] == [1]
    nxt = {r.key: (r.attempt, r.failed_at, r.error) for r in dead_next.collect()}
    assert nxt == {2: (2, dt.datetime(2024, 1, 3), "bad_amount"), 4: (1, D0 + dt.timedelta(days=5), "bad_amount")}
    assert [r.key for r in parked.collect()] == [3]
    assert recovered.count() + dead_next.count() + parked.count() == dead.count()     # nothing lost


def test_write_outcomes_one_pass_two_folders(spark):
    from ledgerlight.session import scratch_path
    from ledgerlight.sources.sinks import write_outcomes
    df = spark.createDataFrame([(1, "5"), (2, "x"), (3, None)], "key int, amount string")
    root = scratch_path(spark, "test", "outcomes")
    write_outcomes(df, [("bad_amount", F.col("amount").isNotNull() & F.col("amount").try_cast("int").isNull()),
                        ("missing", F.col("amount").isNull())], root)
    back = spark.read.parquet(root)
    assert sorted((r.key, r.outcome, r.error) for r in back.collect()) == [
        (1, "ok", None), (2, "dead", "bad_amount"), (3, "dead", "missing")]


def test_custom_rule_set(spark):
    """A rule set of one's own: a condition function, labels and texts."""
    import os
    from ledgerlight.operators import metrics
    from ledgerlight.plans import rules
    from conftest import SF001

    def many_warnings(inp, p):
        return metrics.above(inp.selftests, "value", p.threshold).withColumnRenamed("ts", "tick")

    mine = {"warn": rules.Rule("mange advarsler", ("app", "kubernetes_namespace"), many_warnings,
                               "Se på {{ $labels.app }} ({{ $labels.kubernetes_namespace }})")}
    params = {"warn": rules.RuleParams(app=None, step="1h", threshold=0.0, hold="0s")}
    inp = rules.MetricInputs.from_events(spark.read.parquet(os.path.join(SF001, "events.parquet")),
                                         materialize=False)
    out = rules.alerts_all(inp, params, rules=mine).collect()
    assert out and all(r.alert == "mange advarsler" and r.action.startswith("Se på app-") for r in out)
    assert all(r.start == r.fires_at for r in out)          # hold 0: fires at the episode start
