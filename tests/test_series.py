"""Series identity of label sets, and the rule set with its parameters as rows."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerlight.operators import metrics, series
from ledgerlight.plans import rules, standins

SAMPLES = "metric string, labels map<string,string>, ts timestamp_ntz, value double"
NOW = dt.datetime(2024, 1, 1)


def samples(spark):
    return spark.createDataFrame([
        ("up", {"a": "1", "b": "2"}, NOW, 1.0), ("up", {"b": "2", "a": "1"}, NOW, 2.0), ("up", {"a": "1", "b": "2", "c": ""}, NOW, 3.0),
        ("up", {"a": "1", "b": "2", "c": None}, NOW, 4.0), ("up", {"a": "12", "b": ""}, NOW, 5.0), ("up", {"a": "1"}, NOW, 6.0),
        ("down", {"a": "1"}, NOW, 7.0), ("up", {}, NOW, 8.0), ("up", None, NOW, 9.0), (None, {"a": "1"}, NOW, 10.0)], SAMPLES)


def test_one_series_per_label_set(spark):
    df = series.with_series(samples(spark))
    assert df.columns == ["series", "ts", "value"]
    groups = {}
    for r in df.collect():
        groups.setdefault(r.series, set()).add(r.value)
    assert sorted(map(sorted, groups.values())) == [[1, 2, 3, 4], [5], [6], [7], [8, 9], [10]]
    d = series.series_dictionary(samples(spark))
    assert d.count() == 6 and {r.series for r in d.collect()} == set(groups)
    assert sorted((r.metric or "", sorted(r.labels.items())) for r in d.collect()) == [
        ("", [("a", "1")]), ("down", [("a", "1")]), ("up", []), ("up", [("a", "1")]), ("up", [("a", "1"), ("b", "2")]), ("up", [("a", "12")])]
    assert series.collisions(samples(spark)).count() == 0


def test_matchers_and_labels_through_the_dictionary(spark):
    d = series.series_dictionary(samples(spark))
    assert series.match_series(d, "up", {"a": "1"}).count() == 2
    assert [r.labels for r in series.match_series(d, "up", {"a": "1", "b": ""}).collect()] == [{"a": "1"}]
    out = series.with_labels(series.with_series(samples(spark)), series.match_series(d, "up"), ["a", "b"])
    assert {(r.a, r.b, r.value) for r in out.collect()} == {
        ("1", "2", 1.0), ("1", "2", 2.0), ("1", "2", 3.0), ("1", "2", 4.0), ("12", None, 5.0), ("1", None, 6.0), (None, None, 8.0), (None, None, 9.0)}


def test_series_frame_reads_differing_label_sets(spark):
    f = metrics.series_frame(samples(spark), "up", ["a", "b"])
    assert f.count() == 8 and metrics.match_labels(f, a="1", b="2").count() == 4


def _events(spark):
    rows = []
    for h in range(12):
        for u in (0, 1, 2):             # apps 0, 1 and 2
            rows += [(len(rows) + k, NOW + dt.timedelta(hours=h, minutes=k), u, "error" if k < 3 + u else "view", 1.0, "{}") for k in range(10)]
    return spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")


def test_parameter_rows_equal_function_arguments(spark):
    """One app at a time by arguments gives what the table gives at once; an app without a row has no alert."""
    inp = rules.MetricInputs.from_events(_events(spark))
    table = [("down", "app-0", 2.0, 7200, 3600), ("errors", "app-0", 20.0, 3600, 10800), ("errors", "app-1", 45.0, 7200, 7200),
             ("down", "app-1", 3.5, 0, 3600), ("selftest", "app-1", 0.0, 0, 3600)]
    got = rules.alerts_by_params(inp, spark.createDataFrame(table, rules.PARAMS_DDL), "1h").collect()
    want = []
    for rule, app, threshold, hold, window in table:
        p = rules.RuleParams(app=app, step="1h", threshold=threshold, hold=f"{hold}s", window=f"{window}s")
        want += rules.alerts_all(inp, {rule: p}, rules=[rule]).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, want), key=repr)
    assert {r.alert for r in got} >= {rules.ALERT_DOWN, rules.ALERT_ERRORS} and not any("app-2" in r.labels for r in got)


def test_no_parameter_rows_no_alerts(spark):
    inp = rules.MetricInputs.from_events(_events(spark))
    assert rules.alerts_by_params(inp, spark.createDataFrame([], rules.PARAMS_DDL), "1h").count() == 0


def test_rule_two_uses_the_rate(spark):
    """A counter without growth in the window has no share, and a reset counts from zero."""
    c = [("x", "n", "Error", NOW + dt.timedelta(hours=h), v) for h, v in enumerate([5.0, 5.0, 5.0, 1.0])]
    c += [("x", "n", "Info", NOW + dt.timedelta(hours=h), v) for h, v in enumerate([9.0, 9.0, 9.0, 12.0])]
    df = spark.createDataFrame(c, "log_app string, log_namespace string, log_level string, ts timestamp_ntz, value double")
    inp = rules.MetricInputs(None, None, None, None, "1h", df)
    p = rules.RuleParams(app=None, step="1h", window="2h", threshold=10.0)
    got = {r.tick: r.value for r in rules.high_error_rate(inp, p).collect()}
    assert got == {NOW + dt.timedelta(hours=3): pytest.approx(25.0)}
    assert rules.high_error_rate(inp, rules.RuleParams(app="y", step="1h", window="2h")).count() == 0


def test_sample_table_has_a_label_set_per_metric(spark):
    df = standins.metric_samples(_events(spark))
    keys = {r.metric: set(r.k) for r in df.groupBy("metric").agg(F.collect_set(F.array_sort(F.map_keys("labels"))).alias("s"))
            .select("metric", F.flatten("s").alias("k")).collect()}
    assert len(keys) == 3 and all("zone" in v for v in keys.values()) and len(set(map(frozenset, keys.values()))) == 3
