"""Journal finalisation: provisional entries -> final, idempotently.

The reference only states *that* temporary journal entries are read from a
stream and finalised; which entries, which outcome and which task are not
in it. These operators are therefore generic and the semantics are ours:

* :func:`latest_per_key`   newest version of each key (W4)
* :func:`enrich_left`      left equi join with a lookup table (J3)
* :func:`finalise`         provisional entries whose decision is ready become
                           final; the rest wait; keys already final are skipped (T3)
* :func:`task_outbox`      one task row per finalised entry with a
                           deterministic id, re-runs add nothing (T4)
* :func:`split_outcome`    ok / error halves by ``try_*`` checks (T5)
* :func:`retry_due`        dead letters due for another attempt (T6)

Idempotency comes from keys, not from run bookkeeping: every writer
anti-joins against what the target already holds (``left_anti`` is a
shuffle on the key, or a broadcast of the target when AQE measures it small).
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PROVISIONAL, FINAL = "P", "F"


def latest_per_key(df: DataFrame, key: str | Sequence[str], version: str | Sequence[str]) -> DataFrame:
    """Newest row per key, ties broken by the later version columns.

    ``max_by(struct(row), struct(version))`` is an ordinary aggregate: it is
    computed partially in every map task, so a key holding a third of all
    rows is reduced to one row per task before the shuffle (no sort of the
    whole group, unlike ``row_number``).
    """
    keys = [key] if isinstance(key, str) else list(key)
    order = [version] if isinstance(version, str) else list(version)
    payload = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*payload), F.struct(*order)).alias("__row")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col("__row")[c].alias(c) for c in payload])


def enrich_left(df: DataFrame, lookup: DataFrame, left_key: str, right_key: str,
                columns: Sequence[str]) -> DataFrame:
    """Left equi join: every entry kept, lookup ``columns`` null on a miss.

    The lookup side is pruned to its key and the needed columns before the
    join. No broadcast hint: the lookup table grows with the data, so the
    choice is left to AQE's measured size (``autoBroadcastJoinThreshold``),
    with a sort-merge join -- and skew splitting -- beyond it.
    """
    right = lookup.select(F.col(right_key).alias("__rk"), *columns)
    return df.join(right, F.col(left_key) == F.col("__rk"), "left").drop("__rk")


def decisions_from_lines(lines: DataFrame, key: str, done_at: str) -> DataFrame:
    """Decision data per entry: the last completion time and the number of parts."""
    return lines.groupBy(F.col(key).alias("__key")).agg(
        F.max(done_at).alias("decided_at"), F.count(F.lit(1)).alias("n_parts"))


def version_order(df: DataFrame, version: str, tie: str | None, is_open: Column) -> Column:
    """One number that orders the rows of a key: version, then ``tie``, then closed after open.

    ``version`` is a timestamp or a whole number below 10**18, ``tie`` a whole
    number (an offset or a line id); null ones come first. A decimal of fixed
    width keeps the aggregate over it a hash aggregate.
    """
    from ..functions.timefn import epoch_micros

    is_time = df.schema[version].dataType.typeName().startswith("timestamp")
    at = epoch_micros(version) if is_time else F.col(version).cast("bigint")
    at = F.coalesce(at, F.lit(-10 ** 18)).cast("decimal(19,0)")
    second = F.coalesce(F.col(tie).cast("bigint"), F.lit(-(1 << 63))) if tie else F.lit(0)
    # digits from the left: version, tie (shifted to be positive), closed
    return (at * F.lit(Decimal(1 << 64)) + second.cast("decimal(19,0)")) * F.lit(Decimal(2)) \
        + F.when(is_open, 0).otherwise(1).cast("decimal(1,0)")


def is_provisional(status: str) -> Column:
    return F.coalesce(F.col(status) == PROVISIONAL, F.lit(False))


def finalise(entries: DataFrame, decisions: DataFrame, cutoff, *, key: str, status: str,
             version: str, already_final: DataFrame | None = None, tie: str | None = None) -> DataFrame:
    """Provisional entries -> ``final`` (decision ready by ``cutoff``) or ``waiting``.

    ``entries``: journal rows (several versions per key allowed; the newest
    counts: by ``version``, then ``tie``, and of rows equal in both one that is
    not provisional); ``decisions``: one row per key (``__key, decided_at, n_parts``);
    ``already_final``: keys finalised by earlier runs (skipped; re-runs are no-ops).
    Output: ``key, version, decided_at, n_parts, outcome, new_status``.
    """
    # two fixed-width results: a hash aggregate on both sides of the shuffle, no sort of the entries
    is_open = is_provisional(status)
    order = version_order(entries, version, tie, is_open)
    prov = entries.groupBy(key).agg(F.max_by(is_open, order).alias("__open"), F.max(version).alias(version)) \
        .filter(F.col("__open")).drop("__open")
    if already_final is not None:
        prov = prov.join(already_final.select(F.col(key)), key, "left_anti")
    return decide(prov, decisions, cutoff, key=key, version=version)


def decide(prov: DataFrame, decisions: DataFrame, cutoff, *, key: str, version: str,
           carry: Sequence[str] = ()) -> DataFrame:
    """Outcome of provisional entries, one row per key (columns as :func:`finalise`, then ``carry``)."""
    j = prov.join(decisions, prov[key] == decisions["__key"], "left").drop("__key")
    ready = F.col("decided_at").isNotNull() & (F.col("decided_at") <= F.lit(cutoff))
    return j.select(
        F.col(key), F.col(version),
        F.when(ready, F.col("decided_at")).alias("decided_at"),
        F.coalesce(F.col("n_parts"), F.lit(0)).alias("n_parts"),
        F.when(ready, F.lit("final")).otherwise(F.lit("waiting")).alias("outcome"),
        F.when(ready, F.lit(FINAL)).otherwise(F.lit(PROVISIONAL)).alias("new_status"),
        *carry,
    )


def task_outbox(finalised: DataFrame, key: str, kind: str, created_at: str,
                existing: DataFrame | None = None) -> DataFrame:
    """One task per finalised entry: ``task_id = sha2(key '|' kind)`` (T4).

    The id depends only on the entry and the task kind, so a re-run (or a
    replayed micro-batch) produces the same ids and the anti join against
    ``existing`` drops them.
    """
    tasks = finalised.filter(F.col("outcome") == "final").select(
        F.sha2(F.concat_ws("|", F.col(key).cast("string"), F.lit(kind)), 256).alias("task_id"),
        F.col(key), F.lit(kind).alias("kind"), F.col(created_at).alias("created_at"))
    if existing is not None:
        tasks = tasks.join(existing.select("task_id"), "task_id", "left_anti")
    return tasks


def tag_outcome(df: DataFrame, checks: Sequence[tuple[str, Column]], error: str = "error") -> DataFrame:
    """Add ``error``: the names of the failed ``(name, failed_condition)`` checks,
    comma separated, or null when all pass."""
    failed = F.concat_ws(",", *[F.when(cond, F.lit(name)) for name, cond in checks])
    return df.withColumn(error, F.nullif(failed, F.lit("")))


def split_outcome(df: DataFrame, checks: Sequence[tuple[str, Column]], error: str = "error"
                  ) -> tuple[DataFrame, DataFrame]:
    """Split rows by a list of ``(name, failed_condition)`` checks (T5): ``(ok, error)``.

    Both halves come from one projected frame; to write both in one pass use
    :func:`ledgerlight.sources.sinks.write_outcomes` (partitioned by outcome).
    """
    tagged = tag_outcome(df, checks, error)
    ok = tagged.filter(F.col(error).isNull()).drop(error)
    bad = tagged.filter(F.col(error).isNotNull())
    return ok, bad


def _due_at(attempt: str, failed_at: str, backoff: str) -> Column:
    from ..functions.timefn import seconds
    wait_s = F.lit(seconds(backoff)) * F.pow(F.lit(2), F.col(attempt) - 1).cast("bigint")
    return F.timestamp_add("SECOND", wait_s, F.col(failed_at))


def retry_due(dead: DataFrame, now, max_attempts: int, backoff: str,
              attempt: str = "attempt", failed_at: str = "failed_at") -> DataFrame:
    """Dead letters due for another attempt at ``now``.

    A row is due when ``attempt < max_attempts`` and its back-off
    (``backoff * 2^(attempt-1)``) has passed since ``failed_at``; the output
    carries ``next_attempt``. No sleeping on executors: the next run picks up
    whatever is due.
    """
    return (dead.withColumn("due_at", _due_at(attempt, failed_at, backoff))
                .filter((F.col(attempt) < F.lit(max_attempts)) & (F.col("due_at") <= F.lit(now)))
                .withColumn("next_attempt", F.col(attempt) + 1))


def tag_retry(dead: DataFrame, checks: Sequence[tuple[str, Column]], now, max_attempts: int, backoff: str,
              attempt: str = "attempt", failed_at: str = "failed_at", error: str = "error") -> DataFrame:
    """One retry pass over a dead-letter table in one projection (T6): every row, with its ``state``.

    ``recovered``: was due and passes ``checks`` now; ``again``: was due and
    fails (``attempt + 1``, ``failed_at = now``); ``waiting``: not due yet, or
    its failure time is unknown; ``parked``: no attempt left, or their number
    is unknown. ``first_error`` keeps the error it came with.
    """
    tagged = tag_outcome(dead.withColumnRenamed(error, "first_error"), checks, error)
    due = F.coalesce(_due_at(attempt, failed_at, backoff) <= F.lit(now), F.lit(False))
    left = F.coalesce(F.col(attempt) < F.lit(max_attempts), F.lit(False))
    state = F.when(~left, "parked").when(~due, "waiting").when(F.col(error).isNull(), "recovered").otherwise("again")
    tagged = tagged.withColumn("state", state)
    again = F.col("state") == "again"
    return tagged.withColumn(attempt, F.when(again, F.col(attempt) + 1).otherwise(F.col(attempt))) \
        .withColumn(failed_at, F.when(again, F.lit(now)).otherwise(F.col(failed_at)))


def retry_round(dead: DataFrame, checks: Sequence[tuple[str, Column]], now, max_attempts: int, backoff: str,
                attempt: str = "attempt", failed_at: str = "failed_at", error: str = "error"
                ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three tables of :func:`tag_retry`: ``(recovered, dead_next, parked)``.

    Rows that fail again carry their new error, rows not due and parked ones
    the old; every row is in exactly one of the three, nulls included.
    """
    cols = dead.columns
    done = tag_retry(dead, checks, now, max_attempts, backoff, attempt, failed_at, error)
    old = done.withColumn(error, F.when(F.col("state") == "again", F.col(error)).otherwise(F.col("first_error")))
    recovered = done.filter("state = 'recovered'").select(*(c for c in cols if c != error))
    return recovered, old.filter("state in ('again', 'waiting')").select(*cols), old.filter("state = 'parked'").select(*cols)
