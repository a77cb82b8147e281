"""Alert-rule queries over the stand-in metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import counters, holds, metrics, series
from . import rules, standins
from .catalog import register, table

# Test parameters: the driver data has about one event per app, namespace and
# hour, so the rule set's 3-minute range is widened; the cited
# values stay the defaults of :mod:`rules`.
APP = standins.app_name(0)
WINDOW, STEP, THRESHOLD, HOLD = "3h", "1h", 25.0, "3h"
KEYS = ["log_app", "log_namespace"]


def _msgs(spark, sf_dir):
    return standins.log_messages(table(spark, sf_dir, "events"))


# The error-share, held-condition and counter queries evaluate every app at once
# (log_app is a grouping label), so they read the whole events table; the app
# matcher of the rule set itself is exercised by alerts_all and label_match.


def _is_error():
    return F.col("log_level") == "Error"

SQL_MSGS = f"WITH msgs AS ({standins.sql_log_messages()})"

SQL_ERROR_COUNTS = SQL_MSGS + f""",
m AS (SELECT * FROM msgs),
ticks AS (SELECT DISTINCT log_app, log_namespace, date_trunc('hour', ts) + to_hours(k) AS tick
          FROM m, range(1, 4) r(k)),
counts AS (
  SELECT t.log_app, t.log_namespace, t.tick,
         count(*) FILTER (WHERE m.log_level = 'Error') AS errors, count(*) AS total
  FROM ticks t JOIN m
    ON m.log_app = t.log_app AND m.log_namespace = t.log_namespace
   AND m.ts >= t.tick - INTERVAL 3 HOUR AND m.ts < t.tick
  GROUP BY t.log_app, t.log_namespace, t.tick),
ratio AS (
  SELECT log_app, log_namespace, tick, errors, total,
         CAST(100 AS DOUBLE) * errors / NULLIF(total, 0) AS error_pct
  FROM counts WHERE CAST(100 AS DOUBLE) * errors / NULLIF(total, 0) > {THRESHOLD})"""


@register("error_ratio", "A3 F1 F3 F4 J1'", SQL_ERROR_COUNTS + " SELECT * FROM ratio")
def q_error_ratio(spark, sf_dir):
    return metrics.error_ratio(_msgs(spark, sf_dir), KEYS, WINDOW, STEP, _is_error(), THRESHOLD)


# The oracle of the join form is the one-pass form: J1 must equal J1'.
@register("error_ratio_join", "J1 A1", SQL_ERROR_COUNTS + " SELECT * FROM ratio")
def q_error_ratio_join(spark, sf_dir):
    return metrics.error_ratio_join(_msgs(spark, sf_dir), KEYS, WINDOW, STEP, _is_error(), THRESHOLD)


SQL_SUSTAINED = SQL_ERROR_COUNTS + """,
g AS (SELECT *, CASE WHEN lag(tick) OVER w IS NULL OR tick - lag(tick) OVER w > INTERVAL 1 HOUR
                     THEN 1 ELSE 0 END AS brk
      FROM ratio WINDOW w AS (PARTITION BY log_app, log_namespace ORDER BY tick)),
isl AS (SELECT *, sum(brk) OVER (PARTITION BY log_app, log_namespace ORDER BY tick
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island FROM g),
st AS (SELECT *, min(tick) OVER (PARTITION BY log_app, log_namespace, island) AS start FROM isl)
SELECT log_app, log_namespace, start, min(tick) AS fires_at, arg_min(error_pct, tick) AS error_pct
FROM st WHERE tick - start >= INTERVAL 3 HOUR
GROUP BY log_app, log_namespace, island, start"""


@register("sustained_for", "W3 F3", SQL_SUSTAINED)
def q_sustained_for(spark, sf_dir):
    ratio = metrics.error_ratio(_msgs(spark, sf_dir), KEYS, WINDOW, STEP, _is_error(), THRESHOLD)
    return holds.sustained(ratio, KEYS, HOLD, STEP, ts="tick") \
        .select(*KEYS, "start", "fires_at", "error_pct")


SQL_REPLICAS = SQL_MSGS + f", g AS ({standins.sql_replica_gauge()})"


def _replicas(spark, sf_dir):
    return standins.replica_gauge(standins.app_panes(standins.message_panes(_msgs(spark, sf_dir))))


@register("label_match", "F1 F2 S4", SQL_REPLICAS + f"""
SELECT * FROM g WHERE deployment = '{APP}' AND job = '{standins.SERVICE_JOB}'""")
def q_label_match(spark, sf_dir):
    return metrics.match_labels(_replicas(spark, sf_dir), deployment=APP, job=standins.SERVICE_JOB)


@register("gauge_threshold", "F3 F1 F2", SQL_REPLICAS + f"""
SELECT * FROM g WHERE deployment = '{APP}' AND job = '{standins.SERVICE_JOB}' AND value > 0""")
def q_gauge_threshold(spark, sf_dir):
    g = metrics.match_labels(_replicas(spark, sf_dir), deployment=APP, job=standins.SERVICE_JOB)
    return metrics.above(g, "value", 0.0)


# ------------------------------------------------------------------ counters

SQL_COUNTER = SQL_MSGS + f", c AS ({standins.sql_message_counter()})"
CKEYS = ["log_app", "log_namespace", "log_level"]

SQL_INCREASE = SQL_COUNTER + """,
d AS (SELECT *, lag(ts) OVER w AS pts,
             CASE WHEN lag(value) OVER w IS NULL THEN 0
                  WHEN value >= lag(value) OVER w THEN value - lag(value) OVER w
                  ELSE value END AS d
      FROM c WINDOW w AS (PARTITION BY log_app, log_namespace, log_level ORDER BY ts)),
inc AS (
  SELECT a.log_app, a.log_namespace, a.log_level, a.ts, a.value,
         CASE WHEN count(*) >= 2
              THEN CAST(sum(b.d) FILTER (WHERE b.pts > a.ts - INTERVAL 3 HOUR) AS DOUBLE) END AS increase
  FROM d a JOIN d b
    ON a.log_app = b.log_app AND a.log_namespace = b.log_namespace AND a.log_level = b.log_level
   AND b.ts > a.ts - INTERVAL 3 HOUR AND b.ts <= a.ts
  GROUP BY a.log_app, a.log_namespace, a.log_level, a.ts, a.value)"""


def _counter(spark, sf_dir):
    return standins.message_counter(standins.message_panes(_msgs(spark, sf_dir)))


@register("counter_increase", "W1 W2", SQL_INCREASE + " SELECT * FROM inc")
def q_counter_increase(spark, sf_dir):
    return metrics.counter_increase(_counter(spark, sf_dir), CKEYS, WINDOW)


@register("counter_rate", "A2 W1 W2", SQL_INCREASE + """
SELECT log_app, log_namespace, log_level, ts, value, increase / 10800.0 AS rate FROM inc""")
def q_counter_rate(spark, sf_dir):
    return metrics.counter_rate(_counter(spark, sf_dir), CKEYS, WINDOW)


# sum by (app, ns) (rate(c{app}[w])): series with fewer than two samples have
# no rate and drop out before the sum. Every rate of a group shares the
# divisor w, so the sum is taken over increases and divided once (exact).
@register("sum_by", "A1 A2", SQL_INCREASE + """
SELECT log_app, log_namespace, ts, sum(increase) / 10800.0 AS rate
FROM inc WHERE increase IS NOT NULL
GROUP BY log_app, log_namespace, ts""")
def q_sum_by(spark, sf_dir):
    inc = metrics.counter_increase(_counter(spark, sf_dir), CKEYS, WINDOW).filter(F.col("increase").isNotNull())
    s = metrics.sum_by(inc, KEYS, "increase", ts="ts")
    return s.select(*KEYS, "ts", (F.col("increase") / F.lit(10800.0)).alias("rate"))


# ------------------------------------------------------------------ the rule set

def _rule_params():
    # the rule set for every app at once (app=None): the whole events table, app kept as a label
    return rules.params_for(None, step=STEP,
                            errors={"window": WINDOW, "threshold": THRESHOLD, "hold": HOLD})


def _sql_render(template: str | None) -> str:
    from ..functions.templates import template_parts
    if template is None:
        return "CAST(NULL AS VARCHAR)"
    parts = []
    for kind, v in template_parts(template):
        parts.append("'" + v.replace("'", "''") + "'" if kind == "text" else f"COALESCE({v}, '')")
    return " || ".join(parts)


def _sql_islands(src: str, labels: list[str], hold_sql: str, value: str) -> str:
    part = ", ".join(labels)
    return f"""
  (SELECT {part}, start, min(tick) AS fires_at, arg_min({value}, tick) AS value
   FROM (SELECT *, min(tick) OVER (PARTITION BY {part}, island) AS start
         FROM (SELECT *, sum(brk) OVER (PARTITION BY {part} ORDER BY tick
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island
               FROM (SELECT *, CASE WHEN lag(tick) OVER (PARTITION BY {part} ORDER BY tick) IS NULL
                                     OR tick - lag(tick) OVER (PARTITION BY {part} ORDER BY tick)
                                        > INTERVAL 1 HOUR THEN 1 ELSE 0 END AS brk
                     FROM {src})))
   WHERE tick - start >= {hold_sql}
   GROUP BY {part}, island, start)"""


def _sql_labels(labels: list[str]) -> str:
    return " || ',' || ".join(f"'{k}=' || COALESCE({k}, '')" for k in sorted(labels))


def _sql_alert(name: str, src: str, labels: list[str], rule: rules.Rule) -> str:
    return (f"SELECT '{rule.alert}' AS alert, {_sql_labels(labels)} AS labels, start, fires_at, value, "
            f"{_sql_render(rule.action)} AS action, {_sql_render(rule.description)} AS description FROM {src}")


def sql_tick_increase(window_h: int, out: str = "tinc") -> str:
    """CTEs: the counter's increase over ``(tick - window, tick]`` at every tick with two samples in the window."""
    return f""",
d AS (SELECT *, lag(ts) OVER w AS pts,
             CASE WHEN lag(value) OVER w IS NULL THEN 0
                  WHEN value >= lag(value) OVER w THEN value - lag(value) OVER w
                  ELSE value END AS d
      FROM c WINDOW w AS (PARTITION BY log_app, log_namespace, log_level ORDER BY ts)),
tk AS (SELECT DISTINCT log_app, log_namespace, log_level, ts + to_hours(k) AS tick FROM c, range(0, {window_h}) r(k)),
{out} AS (SELECT t.log_app, t.log_namespace, t.log_level, t.tick,
                 CAST(sum(d.d) FILTER (WHERE d.pts > t.tick - INTERVAL {window_h} HOUR) AS DOUBLE) AS increase
          FROM tk t JOIN d ON t.log_app = d.log_app AND t.log_namespace = d.log_namespace AND t.log_level = d.log_level
           AND d.ts > t.tick - INTERVAL {window_h} HOUR AND d.ts <= t.tick
          GROUP BY t.log_app, t.log_namespace, t.log_level, t.tick HAVING count(*) >= 2)"""


SQL_RATE_SHARE = """
rshare AS (SELECT log_app, log_namespace, tick,
                  CAST(100 AS DOUBLE) * sum(increase) FILTER (WHERE log_level = 'Error') / NULLIF(sum(increase), 0) AS error_pct
           FROM tinc GROUP BY log_app, log_namespace, tick)"""


@register("rate_at_ticks", "A2 W1 W2", SQL_COUNTER + sql_tick_increase(3) + """
SELECT log_app, log_namespace, log_level, tick, increase / 10800.0 AS rate FROM tinc""")
def q_rate_at_ticks(spark, sf_dir):
    """The rate at every evaluation tick, from pane increments."""
    inc = counters.increase(_counter(spark, sf_dir), CKEYS, WINDOW, STEP)
    return inc.select(*CKEYS, "tick", (F.col("increase") / F.lit(10800.0)).alias("rate"))


SQL_ALERTS = SQL_COUNTER + sql_tick_increase(3) + f""",
{SQL_RATE_SHARE},
rg AS ({standins.sql_replica_gauge()}),
sg AS ({standins.sql_selftest_gauge()}),
c1 AS (SELECT deployment, namespace, job, ts AS tick, value FROM rg
       WHERE job = '{standins.SERVICE_JOB}' AND value > 0),
c2 AS (SELECT log_app, log_namespace, tick, error_pct FROM rshare WHERE error_pct > {THRESHOLD}),
c3 AS (SELECT app, kubernetes_namespace, ts AS tick, value FROM sg WHERE value > 0),
a1 AS {_sql_islands('c1', ['deployment', 'namespace', 'job'], 'INTERVAL 2 MINUTE', 'value')},
a2 AS {_sql_islands('c2', ['log_app', 'log_namespace'], 'INTERVAL 3 HOUR', 'error_pct')},
a3 AS {_sql_islands('c3', ['app', 'kubernetes_namespace'], 'INTERVAL 1 MINUTE', 'value')}
{_sql_alert('down', 'a1', ['deployment', 'namespace', 'job'], rules.RULES['down'])}
UNION ALL
{_sql_alert('errors', 'a2', ['log_app', 'log_namespace'], rules.RULES['errors'])}
UNION ALL
{_sql_alert('selftest', 'a3', ['app', 'kubernetes_namespace'], rules.RULES['selftest'])}"""


@register("alerts_all", "U1 X10 S7 W3 F1-F4 F7", SQL_ALERTS)   # every app (fleet-wide)
def q_alerts_all(spark, sf_dir):
    inp = rules.MetricInputs.from_events(table(spark, sf_dir, "events"))
    return rules.alerts_all(inp, _rule_params())


# Rule 2 exactly as written, over the message counter:
# 100 * sum by(app, ns)(rate(c{app, level="Error"}[w])) / sum by(app, ns)(rate(c{app}[w])) > threshold.
# Both rates share the divisor w, which cancels: the share is taken from sums of
# increases (exact). A zero total gives null, never NaN, so it never fires.
# Spark side: one conditional aggregate (one pass, as J1'); the oracle is the join.
@register("error_ratio_rate", "J1 A1 A2 F4 F3 W2", SQL_INCREASE + f""",
num AS (SELECT log_app, log_namespace, ts, sum(increase) AS err_inc FROM inc
        WHERE increase IS NOT NULL AND log_level = 'Error' GROUP BY log_app, log_namespace, ts),
den AS (SELECT log_app, log_namespace, ts, sum(increase) AS all_inc FROM inc
        WHERE increase IS NOT NULL GROUP BY log_app, log_namespace, ts)
SELECT n.log_app, n.log_namespace, n.ts, n.err_inc, d.all_inc,
       CAST(100 AS DOUBLE) * n.err_inc / NULLIF(d.all_inc, 0) AS error_pct
FROM num n JOIN den d ON n.log_app = d.log_app AND n.log_namespace = d.log_namespace AND n.ts = d.ts
WHERE CAST(100 AS DOUBLE) * n.err_inc / NULLIF(d.all_inc, 0) > {THRESHOLD}""")
def q_error_ratio_rate(spark, sf_dir):
    inc = metrics.counter_increase(_counter(spark, sf_dir), CKEYS, WINDOW).filter(F.col("increase").isNotNull())
    sums = inc.groupBy(*KEYS, "ts").agg(
        F.sum(F.when(F.col("log_level") == "Error", F.col("increase"))).alias("err_inc"),
        F.sum("increase").alias("all_inc"))
    return metrics.above(sums.withColumn("error_pct", metrics.percent_share("err_inc", "all_inc")),
                         "error_pct", THRESHOLD)


# ------------------------------------------------------------------ long sample tables

SQL_SAMPLES = f"""{SQL_COUNTER}, rg AS ({standins.sql_replica_gauge()})"""


def _samples(spark, sf_dir):
    return standins.metric_samples(table(spark, sf_dir, "events"))


@register("label_match_samples", "S4 F1 F2 F3", SQL_SAMPLES + f"""
SELECT * FROM rg WHERE deployment = '{APP}' AND job = '{standins.SERVICE_JOB}' AND value > 0""")
def q_label_match_samples(spark, sf_dir):
    """A matcher with two labels over a long sample table whose metrics carry different label sets."""
    g = metrics.series_frame(_samples(spark, sf_dir), standins.REPLICAS_NAME, ["deployment", "namespace", "job"])
    return metrics.above(metrics.match_labels(g, deployment=APP, job=standins.SERVICE_JOB), "value", 0.0)


@register("series_rate", "S4 F1 A1 A2 W2", SQL_SAMPLES + sql_tick_increase(3) + f"""
SELECT log_app, log_namespace, CASE WHEN log_namespace = '{standins.EXTRA_NAMESPACE}' THEN '{standins.EXTRA_LABEL[1]}' END AS zone,
       tick, sum(increase) / 10800.0 AS rate
FROM tinc GROUP BY ALL""")
def q_series_rate(spark, sf_dir):
    """``sum by (log_app, log_namespace, zone)(rate(c[w]))`` with series keyed by one long; labels join back at the end."""
    samples = _samples(spark, sf_dir)
    dictionary = series.match_series(series.series_dictionary(samples), standins.COUNTER_NAME)
    mine = series.with_series(metrics.match_labels(samples, metric=standins.COUNTER_NAME))
    inc = series.with_labels(counters.increase(mine, ["series"], WINDOW, STEP), dictionary, [*KEYS, standins.EXTRA_LABEL[0]])
    out = metrics.sum_by(inc, [*KEYS, standins.EXTRA_LABEL[0]], "increase", ts="tick")
    return out.select(*KEYS, standins.EXTRA_LABEL[0], "tick", (F.col("increase") / F.lit(10800.0)).alias("rate"))


# ------------------------------------------------------------------ parameters as data

#: (rule, app, threshold, hold, window) in hours; the third app has no row, the second none for the self-test
PARAM_ROWS = [("down", "app-0", 0.0, 1, 1), ("errors", "app-0", 25.0, 3, 3), ("selftest", "app-0", 0.0, 2, 1),
              ("down", "app-1", 1.0, 2, 1), ("errors", "app-1", 20.0, 2, 2)]


def _sql_param_alerts() -> str:
    values = ", ".join(f"('{r}', '{a}', CAST({t} AS DOUBLE), {h}, {w})" for r, a, t, h, w in PARAM_ROWS)

    def islands(name, src, labels):
        return f"{name} AS " + _sql_islands(src, [*labels, "hold_h"], "to_hours(hold_h)", "value")

    share = "".join(f"""
s{w} AS (SELECT t.log_app, t.log_namespace, t.tick, t.log_level,
                sum(d.d) FILTER (WHERE d.pts > t.tick - INTERVAL {w} HOUR) AS increase
         FROM (SELECT DISTINCT log_app, log_namespace, log_level, ts + to_hours(k) AS tick FROM c, range(0, {w}) r(k)) t
         JOIN d ON t.log_app = d.log_app AND t.log_namespace = d.log_namespace AND t.log_level = d.log_level
          AND d.ts > t.tick - INTERVAL {w} HOUR AND d.ts <= t.tick
         GROUP BY t.log_app, t.log_namespace, t.log_level, t.tick HAVING count(*) >= 2),""" for w in (2, 3))
    return SQL_COUNTER + sql_tick_increase(3) + f""",
p AS (SELECT * FROM (VALUES {values}) v(rule, app, threshold, hold_h, window_h)),{share}
pct AS (SELECT log_app, log_namespace, tick, window_h,
               CAST(100 AS DOUBLE) * sum(increase) FILTER (WHERE log_level = 'Error') / NULLIF(sum(increase), 0) AS error_pct
        FROM (SELECT *, 2 AS window_h FROM s2 UNION ALL SELECT *, 3 FROM s3) GROUP BY ALL),
rg AS ({standins.sql_replica_gauge()}),
sg AS ({standins.sql_selftest_gauge()}),
c1 AS (SELECT deployment, namespace, job, ts AS tick, value, hold_h FROM rg JOIN p ON rule = 'down' AND app = deployment
       WHERE job = '{standins.SERVICE_JOB}' AND value > threshold),
c2 AS (SELECT log_app, log_namespace, tick, error_pct AS value, hold_h FROM pct JOIN p ON rule = 'errors' AND app = log_app
       AND p.window_h = pct.window_h WHERE error_pct > threshold),
c3 AS (SELECT sg.app, kubernetes_namespace, ts AS tick, value, hold_h FROM sg JOIN p ON rule = 'selftest' AND p.app = sg.app
       WHERE value > threshold),
{islands('a1', 'c1', ['deployment', 'namespace', 'job'])},
{islands('a2', 'c2', ['log_app', 'log_namespace'])},
{islands('a3', 'c3', ['app', 'kubernetes_namespace'])}
{_sql_alert('down', 'a1', ['deployment', 'namespace', 'job'], rules.RULES['down'])}
UNION ALL
{_sql_alert('errors', 'a2', ['log_app', 'log_namespace'], rules.RULES['errors'])}
UNION ALL
{_sql_alert('selftest', 'a3', ['app', 'kubernetes_namespace'], rules.RULES['selftest'])}"""


@register("alerts_by_params", "F7 U1 F3 W3 A2", _sql_param_alerts())
def q_alerts_by_params(spark, sf_dir):
    """The rule set over all apps with its parameters as a table: thresholds, holds and windows by app."""
    rows = [(r, a, t, h * 3600, w * 3600) for r, a, t, h, w in PARAM_ROWS]
    inp = rules.MetricInputs.from_events(table(spark, sf_dir, "events"))
    return rules.alerts_by_params(inp, spark.createDataFrame(rows, rules.PARAMS_DDL), STEP)


# ------------------------------------------------------------------ a dense series, cut by counted rows

DENSE_WINDOW, DENSE_ROWS = "2h", 2000


@register("dense_counter_increase", "W1 W2", f"""
WITH c AS (SELECT event_id, event_type = 'error' AS err, ts, CAST(event_id % 1000 AS DOUBLE) AS value FROM events WHERE ts IS NOT NULL),
d AS (SELECT *, lag(ts) OVER w AS pts,
             CASE WHEN lag(value) OVER w IS NULL THEN 0 WHEN value >= lag(value) OVER w THEN value - lag(value) OVER w ELSE value END AS d
      FROM c WINDOW w AS (PARTITION BY err ORDER BY ts))
SELECT a.event_id, a.err, CASE WHEN count(*) >= 2
       THEN CAST(sum(b.d) FILTER (WHERE b.pts > a.ts - INTERVAL 2 HOUR) AS DOUBLE) END AS increase
FROM d a JOIN d b ON a.err = b.err AND b.ts > a.ts - INTERVAL 2 HOUR AND b.ts <= a.ts GROUP BY a.event_id, a.err""")
def q_dense_counter_increase(spark, sf_dir):
    """One sample per event in two series, one of which holds four fifths of all rows: slices by counted rows."""
    ev = table(spark, sf_dir, "events")
    c = ev.select("event_id", F.coalesce(F.col("event_type") == "error", F.lit(False)).alias("err"), "ts",
                  (F.col("event_id") % 1000).cast("double").alias("value"))
    return metrics.counter_increase(c, ["err"], DENSE_WINDOW, rows_per_slice=DENSE_ROWS).select("event_id", "err", "increase")
