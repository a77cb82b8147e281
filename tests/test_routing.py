"""Log routing (J2, F5, X11, X2) on the edge rows of FIXTURES 3, and the sink writers."""

from __future__ import annotations

import json
import os
import tempfile

from ledgerlight.operators import routing
from ledgerlight.operators.routing import Route
from ledgerlight.sources.sinks import write_routed_logs

RESTRICTED = routing.DEFAULT_ROUTES[1]
LIBRARY = routing.DEFAULT_ROUTES[0].logger


def routed(spark, rows, routes=routing.DEFAULT_ROUTES):
    df = spark.createDataFrame(rows, "id int, logger string, level string")
    out = routing.route_logs(df, routes)
    got = {}
    for r in out.collect():
        got.setdefault(r.id, set()).add(r.sink)
    return {i: got.get(i, set()) for i, *_ in rows}


def test_fixture_table(spark):
    rows = [(1, "tjenestekall", "DEBUG"), (2, "tjenestekall.soap", "INFO"), (3, "tjenestekallX", "INFO"),
            (4, "a.b", "DEBUG"), (5, "a.b", "WARN"), (6, LIBRARY + ".x", "DEBUG"), (7, "tjenestekallX", "DEBUG"),
            (8, "tjenestekall", "TRACE"), (9, LIBRARY, "TRACE")]
    assert routed(spark, rows) == {
        1: {"secureLog"}, 2: {"secureLog"}, 3: {"STDOUT_JSON"}, 4: set(), 5: {"STDOUT_JSON"},
        6: {"STDOUT_JSON"}, 7: set(), 8: set(), 9: set()}


def test_resolve_walks_up_to_first_non_additive():
    routes = [Route("", "INFO", sinks=("root",)), Route("a", None, additive=True, sinks=("A",)),
              Route("a.b", "DEBUG", additive=False, sinks=("B",)), Route("a.b.c", None, sinks=("C",))]
    res = {name: (rank, sinks) for name, rank, sinks in routing.resolve(routes)}
    assert res["a.b.c"] == (2, ("C", "B"))       # level from a.b; stops at non-additive a.b
    assert res["a"] == (3, ("A", "root"))         # inherits the root level
    assert res[""] == (3, ("root",))


def test_level_inherited_from_nearest_ancestor_with_a_level(spark):
    routes = [Route("", "WARN", sinks=("out",)), Route("x", "TRACE"), Route("x.y", None, sinks=("y",))]
    assert routed(spark, [(1, "x.y.z", "TRACE"), (2, "q", "INFO"), (3, "q", "ERROR")], routes) == {
        1: {"y", "out"}, 2: set(), 3: {"out"}}


def test_unknown_level_is_kept(spark):
    assert routed(spark, [(1, "a", "LOUD"), (2, "a", None)]) == {1: {"STDOUT_JSON"}, 2: {"STDOUT_JSON"}}


def test_write_routed_logs_one_folder_per_sink(spark):
    rows = [(1, "tjenestekall", "INFO"), (2, "other", "ERROR")]
    df = routing.route_logs(spark.createDataFrame(rows, "id int, logger string, level string"))
    out = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    write_routed_logs(df, out, ["id", "logger", "level"], mode="overwrite")
    got = {}
    for sink in ("secureLog", "STDOUT_JSON"):
        folder = os.path.join(out, f"sink={sink}")
        lines = [ln for f in os.listdir(folder) if f.startswith("part-")
                 for ln in open(os.path.join(folder, f)).read().splitlines()]
        got[sink] = [json.loads(x) for x in lines]
    assert got == {"secureLog": [{"id": 1, "logger": "tjenestekall", "level": "INFO"}],
                   "STDOUT_JSON": [{"id": 2, "logger": "other", "level": "ERROR"}]}


def test_log_records_layout(spark):
    import datetime as dt
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(dt.datetime(2024, 1, 2, 3, 4, 5, 678901), 'a "quoted" text', "x.y", "WARN")],
                               "ts timestamp, message string, logger string, level string") \
        .withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    line = routing.log_records(df).first().value
    assert line == ('{"@timestamp":"2024-01-02T03:04:05.678+00:00","@version":"1",'
                    '"message":"a \\"quoted\\" text","logger_name":"x.y","level":"WARN","level_value":30000}')
    assert json.loads(line)["message"] == 'a "quoted" text'
