"""The whole alert rule set on a stream of log messages (T1, T2, U1 on a stream).

State holds one message pane per (app, namespace, level, step): the same
table every batch rule reads. After each micro-batch the rules are evaluated
by :func:`ledgerlight.plans.rules.alerts_all` over the panes of the ticks the
watermark has just closed (plus the look-back of the longest hold and the
span of the longest window), so alerts fire while the stream runs and the
result equals the batch rule set over the same data.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timefn import as_instant, instant_to_ntz, interval_text, seconds
from ..plans import rules, standins
from .alerts import run_incremental

PANE_KEYS = ["log_app", "log_namespace", "log_level"]


def message_panes(messages: DataFrame, step: str, delay: str, ts: str = "ts") -> DataFrame:
    """Streaming message panes (log_app, log_namespace, log_level, pane_end, n, max_et)."""
    s = messages.filter(F.col(ts).isNotNull()).withColumn("__et", as_instant(ts)) \
        .withWatermark("__et", interval_text(delay))
    p = F.window("__et", interval_text(step))
    return (s.groupBy(p.alias("__p"), *PANE_KEYS)
             .agg(F.count(F.lit(1)).alias("n"), F.max(F.col(ts)).alias("max_et"))
             .select(*PANE_KEYS, instant_to_ntz(F.col("__p.end")).alias("pane_end"), "n", "max_et"))


def run_rule_stream(spark: SparkSession, messages: DataFrame, root: str, params: dict[str, rules.RuleParams], *,
                    delay: str, step: str = standins.PANE, flush: bool = True, compact_every: int = 20,
                    timeout_s: float | None = None, available_now: bool = True, interval: str = "10 seconds",
                    rule_set: dict[str, rules.Rule] | None = None):
    """Alerts of every rule (the built-in set, or ``rule_set``), fired per
    micro-batch; returns the alert list (see :func:`run_incremental`)."""
    if any(seconds(p.step) != seconds(step) for p in params.values()):
        raise ValueError("the stream evaluates every rule at the pane step")
    look = max(seconds(p.hold) for p in params.values()) + 2 * seconds(step)
    window = max(seconds(p.window) for p in params.values())
    span = window + 86_400 + seconds(step)      # a sample of the message counter needs the panes of its day

    def fire(pane_rows: DataFrame, lo, hi) -> DataFrame:
        inp = rules.MetricInputs.from_panes(pane_rows, step)
        if lo is not None:                     # earlier samples may miss panes of their day
            from_ = F.timestamp_add("SECOND", F.lit(-look - window), lo)
            inp = replace(inp, counter=inp.counter.filter(F.col("ts") > from_))
        where = F.lit(True)
        if lo is not None:                     # ticks whose windows may miss panes are left out
            where = where & (F.col("tick") > F.timestamp_add("SECOND", F.lit(-look), lo))
        if hi is not None:
            where = where & (F.col("tick") <= hi)
        fired = rules.alerts_all(inp, params, rules=rule_set, where=where)
        return fired.filter(F.col("fires_at") > lo) if lo is not None else fired

    return run_incremental(spark, message_panes(messages, step, delay), root, PANE_KEYS, fire=fire,
                           span=f"{span}s", lookback=f"{look}s", delay=delay, flush=flush,
                           compact_every=compact_every, timeout_s=timeout_s,
                           available_now=available_now, interval=interval)
