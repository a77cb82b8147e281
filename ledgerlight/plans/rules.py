"""The alert rule set as DataFrame plans (rules, U1, X10, S7).

Each rule is a function from the metric inputs to *condition ticks*
``(labels..., tick, value)``; :func:`fired` applies the hold (W3) and renders
the texts; :func:`alerts_all` unions every rule into one alert list
``(alert, labels, start, fires_at, value, action, description)``.

Rule parameters (app, window, step, threshold, hold) are function arguments,
never spliced into SQL text.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.templates import labels_map, labels_text, render, render_from_map
from ..functions.timefn import seconds
from ..operators import counters, holds, metrics
from . import standins

# Alert names and texts of the rule set (templates use {{ $labels.x }}).
ALERT_DOWN = "applikasjon nede"
ACTION_DOWN = ("`kubectl describe pod -l app=\\{{ $labels.deployment }} -n \\{{ $labels.namespace }}` "
               "for events og `kubectl get  pods -l app=\\{{ $labels.deployment }} -n "
               "\\{{ $labels.namespace }}` for å se feilende podder")
DESCRIPTION_DOWN = "\\{{ $labels.deployment }} har utilgjengelige podder i \\{{ $labels.namespace }}"
ALERT_ERRORS = "høy feilrate i logger"
ACTION_ERRORS = ("Sjekk loggene til \\{{ $labels.log_app }} i \\{{ $labels.log_namespace }}, "
                 "for å se hvorfor det er så mye feil")
ALERT_SELFTEST = "feil i selftest"
ACTION_SELFTEST = ("Sjekk \\{{ $labels.app }} i \\{{ $labels.kubernetes_namespace }} "
                   "sine selftest for å se hva som er galt")
# Thresholds, holds and range of the rule set.
DEFAULTS = {"down": {"threshold": 0.0, "hold": "2m"},
            "errors": {"threshold": 90.0, "hold": "3m", "window": "3m"},
            "selftest": {"threshold": 0.0, "hold": "1m"}}


@dataclass(frozen=True)
class MetricInputs:
    """The frames the rules read, all derived from one pane aggregate of the
    messages, so the whole rule set scans the events once."""
    messages: DataFrame
    apps: DataFrame          # per pane (log_app, log_namespace, pane_end, total, errors, warns)
    replicas: DataFrame
    selftests: DataFrame
    pane_step: str = standins.PANE
    counter: DataFrame | None = None    # message counter samples (log_app, log_namespace, log_level, ts, value)

    @staticmethod
    def from_messages(messages: DataFrame, step: str = standins.PANE, materialize: bool = True) -> "MetricInputs":
        """Inputs from a log-message table (ts, log_app, log_namespace, log_level, level, ...)."""
        panes = standins.message_panes(messages, step)
        if materialize:
            from ..session import ensure_checkpoint_dir
            ensure_checkpoint_dir(panes.sparkSession)
            panes = panes.checkpoint(eager=True)
        return MetricInputs.from_panes(panes, step, messages)

    @staticmethod
    def from_panes(panes: DataFrame, step: str = standins.PANE, messages: DataFrame | None = None) -> "MetricInputs":
        """Inputs from a message pane table (log_app, log_namespace, log_level, pane_end, n)."""
        apps = standins.app_panes(panes)
        return MetricInputs(messages, apps, standins.replica_gauge(apps), standins.selftest_gauge(apps), step,
                            standins.message_counter(panes, step))

    @staticmethod
    def from_events(events: DataFrame, materialize: bool = True) -> "MetricInputs":
        """``materialize``: write the pane table once to the session's checkpoint
        folder (reliable ``checkpoint``, not a local one). Every rule then reads
        that small table, so the events are scanned once however many rules
        run -- Spark does not reuse the pane exchange across the union branches
        under AQE, and a lost executor no longer forces a rescan."""
        return MetricInputs.from_messages(standins.log_messages(events), materialize=materialize)


@dataclass(frozen=True)
class Rule:
    alert: str
    labels: tuple[str, ...]
    condition: Callable[[MetricInputs, "RuleParams"], DataFrame]
    action: str
    description: str | None = None


@dataclass(frozen=True)
class RuleParams:
    app: str | None                  # None: every app at once (the app stays a label)
    step: str = "1h"
    threshold: float = 0.0
    hold: str = "0s"
    window: str = "3m"


def _app(label: str, p: RuleParams) -> dict:
    return {} if p.app is None else {label: p.app}


def replicas_down(inp: MetricInputs, p: RuleParams) -> DataFrame:
    """``kube_deployment_status_replicas_unavailable{deployment=app, job=...} > threshold``."""
    g = metrics.match_labels(inp.replicas, _app("deployment", p), job=standins.SERVICE_JOB)
    return metrics.above(g, "value", p.threshold).withColumnRenamed("ts", "tick")


def high_error_rate(inp: MetricInputs, p: RuleParams) -> DataFrame:
    """``100 * sum by(app, ns)(rate(c{level="Error"}[w])) / sum by(app, ns)(rate(c[w])) > threshold``, as the rule is written.

    Rates of the message counter, resets corrected, at every evaluation tick.
    """
    keys = ["log_app", "log_namespace"]
    c = metrics.match_labels(inp.counter, _app("log_app", p))
    inc = counters.increase(c, [*keys, "log_level"], p.window, p.step)
    share = counters.rate_share(inc, keys, F.col("log_level") == "Error")
    return metrics.above(share, "error_pct", p.threshold).select(*keys, "tick", F.col("error_pct").alias("value"))


def high_error_share(inp: MetricInputs, p: RuleParams) -> DataFrame:
    """The share by counted messages instead of rates: for a log table without a message counter.

    With the evaluation step equal to the pane step the windows are summed
    from the shared panes; otherwise from the raw messages.
    """
    keys = ["log_app", "log_namespace"]
    if seconds(p.step) == seconds(inp.pane_step) and seconds(p.window) % seconds(p.step) == 0:
        apps = metrics.match_labels(inp.apps, _app("log_app", p))
        counts = metrics.slide_panes(apps, keys, p.window, p.step, ["errors", "total"])
        r = metrics.above(counts.withColumn("error_pct", metrics.percent_share("errors", "total")),
                          "error_pct", p.threshold)
    else:
        msgs = metrics.match_labels(inp.messages, _app("log_app", p))
        r = metrics.error_ratio(msgs, keys, p.window, p.step, F.col("log_level") == "Error", p.threshold)
    return r.select(*keys, "tick", F.col("error_pct").alias("value"))


def selftest_failing(inp: MetricInputs, p: RuleParams) -> DataFrame:
    """``selftests_aggregate_result_status{app=app} > threshold``."""
    g = metrics.match_labels(inp.selftests, _app("app", p))
    return metrics.above(g, "value", p.threshold).withColumnRenamed("ts", "tick")


RULES: dict[str, Rule] = {
    "down": Rule(ALERT_DOWN, ("deployment", "namespace", "job"), replicas_down, ACTION_DOWN, DESCRIPTION_DOWN),
    "errors": Rule(ALERT_ERRORS, ("log_app", "log_namespace"), high_error_rate, ACTION_ERRORS),
    "selftest": Rule(ALERT_SELFTEST, ("app", "kubernetes_namespace"), selftest_failing, ACTION_SELFTEST),
}

ALERT_COLUMNS = ["alert", "labels", "start", "fires_at", "value", "action", "description"]


def fired(rule: Rule, inp: MetricInputs, params: RuleParams) -> DataFrame:
    """Condition ticks -> held episodes -> rendered alert rows."""
    ticks = rule.condition(inp, params).select(*rule.labels, "tick", "value")
    firing = holds.sustained(ticks, rule.labels, params.hold, params.step, ts="tick")
    return firing.select(F.lit(rule.alert).alias("alert"), labels_text(list(rule.labels)).alias("labels"),
                         "start", "fires_at", F.col("value").cast("double").alias("value"),
                         render(rule.action).alias("action"), render(rule.description).alias("description"))


def alerts_all(inp: MetricInputs, params: dict[str, RuleParams],
               rules: Sequence[str] | dict[str, Rule] | None = None, where=None) -> DataFrame:
    """Every rule of the set -> one alert list.

    The condition ticks of all rules are unioned first, keyed by (rule, label
    text) with the labels carried as a map, so one held-condition pass (one
    shuffle) serves any number of rules; the texts are rendered from the map.
    Each row carries its rule's hold, so rules with different ``for``
    durations share the pass; only rules with a different evaluation step
    need a pass of their own. ``where`` (over ``tick``) bounds the condition
    ticks first -- the incremental stream evaluates a recent range only.
    ``rules``: names of built-in rules, or a mapping ``name -> Rule`` for a
    rule set of your own (``params`` keyed by the same names).
    """
    catalog = rules if isinstance(rules, dict) else RULES
    names = list(catalog) if isinstance(rules, dict) or rules is None else list(rules)
    groups: dict[int, list[str]] = {}
    for name in names:
        groups.setdefault(seconds(params[name].step), []).append(name)
    frames = []
    for step_s, members in groups.items():
        ticks = None
        for name in members:
            t = _labelled(name, catalog[name], catalog[name].condition(inp, params[name]), F.lit(seconds(params[name].hold)))
            if where is not None:
                t = t.filter(where)
            ticks = t if ticks is None else ticks.unionByName(t)
        max_hold = max(seconds(params[name].hold) for name in members)
        frames.append(_held_alerts(ticks, {n: catalog[n] for n in members}, max_hold, step_s))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _labelled(name: str, rule: Rule, ticks: DataFrame, hold_s) -> DataFrame:
    """Condition ticks of a rule in the common form of every rule: labels as text, as a key and as a map."""
    return ticks.select(
        F.lit(name).alias("__rule"), labels_text(list(rule.labels)).alias("labels"),
        F.to_json(labels_map(list(rule.labels))).alias("__key"),      # no two label sets share it, as their texts may
        labels_map(list(rule.labels)).alias("__lbl"), "tick", F.col("value").cast("double").alias("value"),
        hold_s.alias("__hold"))


def _held_alerts(ticks: DataFrame, catalog: dict[str, Rule], max_hold_s: int, step_s: int) -> DataFrame:
    """Held and rendered alerts of labelled ticks, one pass for all rules."""
    firing = holds.sustained(ticks, ["__rule", "__key"], f"{max_hold_s}s", f"{step_s}s", ts="tick", hold_col="__hold")

    def by_rule(of: Callable[[Rule], Column]) -> Column:
        return F.coalesce(*(F.when(F.col("__rule") == name, of(rule)) for name, rule in catalog.items()))

    return firing.select(by_rule(lambda r: F.lit(r.alert)).alias("alert"), "labels", "start", "fires_at", "value",
                         by_rule(lambda r: render_from_map(r.action, "__lbl")).alias("action"),
                         by_rule(lambda r: render_from_map(r.description, "__lbl")).alias("description"))


# ------------------------------------------------------------------ parameters as data

#: one row per rule and app that is to be watched; an app without a row has no alert of that rule
PARAMS_DDL = "rule string, app string, threshold double, hold_s bigint, window_s bigint"


def alerts_by_params(inp: MetricInputs, params: DataFrame, step: str) -> DataFrame:
    """The rule set with its parameters as rows ``(rule, app, threshold, hold_s, window_s)``, in one pass for all apps.

    Each value meets the parameters of its rule and app by an equi join, so
    thresholds, holds and windows differ per row and no plan is built per app.
    ``(rule, app)`` is unique; windows are multiples of ``step`` and matter to
    the error rate alone. The two values read on the driver are the longest
    hold and window, which bound the frames.
    """
    top = params.agg(F.max("hold_s").alias("hold"), F.max("window_s").alias("window")).first()
    hold, window = int(top["hold"] or 0), int(top["window"] or seconds(step))

    def of(rule: str, app: str) -> DataFrame:
        return params.filter(F.col("rule") == rule).select(F.col("app").alias(app), "threshold", "hold_s", "window_s")

    def passing(df: DataFrame, value: str) -> DataFrame:
        return df.filter(F.col(value) > F.col("threshold")).withColumn("value", F.col(value))

    keys = ["log_app", "log_namespace"]
    panes = counters.pane_increments(inp.counter, [*keys, "log_level"], step, f"{window}s") \
        .join(of("errors", "log_app"), "log_app").withColumn("panes", F.floor(F.col("window_s") / seconds(step)))
    carried = ["threshold", "hold_s"]
    inc = counters.increase_at_ticks(panes, [*keys, "log_level", *carried], f"{window}s", step, panes_col="panes")
    share = counters.rate_share(inc, [*keys, *carried], F.col("log_level") == "Error")
    down = metrics.match_labels(inp.replicas, job=standins.SERVICE_JOB).join(of("down", "deployment"), "deployment")
    selftest = inp.selftests.join(of("selftest", "app"), "app")
    found = {"down": passing(down.withColumnRenamed("ts", "tick"), "value"), "errors": passing(share, "error_pct"),
             "selftest": passing(selftest.withColumnRenamed("ts", "tick"), "value")}
    ticks = None
    for name, df in found.items():
        t = _labelled(name, RULES[name], df, F.col("hold_s"))
        ticks = t if ticks is None else ticks.unionByName(t)
    return _held_alerts(ticks, RULES, hold, seconds(step))


def params_for(app: str | None, step: str = "1h", **overrides: dict) -> dict[str, RuleParams]:
    """Rule parameters: the rule set's defaults, then per-rule overrides."""
    out = {}
    for name, d in DEFAULTS.items():
        p = RuleParams(app=app, step=step, **d)
        if name in overrides:
            p = replace(p, **overrides[name])
        out[name] = p
    return out
