"""Journal queries: latest version, lookup, finalise, outbox, dead letters, retries,
run counters (W4 J3 T3 T4 T5 T6 S8).

Stand-in journal: one ``orders`` row per entry, ``'P'`` = provisional; an
entry's decision is ready when its last line item has shipped by the cutoff.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.timefn import ntz_literal
from ..operators import documents, journal
from ..schemas import CORRUPT
from ..functions import decode as D
from . import standins
from .catalog import register, table

CUTOFF = "1998-01-01 00:00:00"
TASK_KIND = "journal-finalised"
MAX_ATTEMPTS, BACKOFF = 3, "30d"


@register("latest_per_key", "W4", """
SELECT user_id, event_id, ts, event_type, value
FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def q_latest_per_key(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type", "value")
    return journal.latest_per_key(ev, "user_id", ["ts", "event_id"])


@register("enrich_left", "J3", """
SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, c.c_name, c.c_nationkey, c.c_mktsegment
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey""")
def q_enrich_left(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return journal.enrich_left(o, table(spark, sf_dir, "customer"), "o_custkey", "c_custkey",
                               ["c_name", "c_nationkey", "c_mktsegment"])


SQL_FINALISE = f"""
WITH latest AS (SELECT o_orderkey, o_orderstatus, o_orderdate FROM orders
                QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY o_orderdate DESC) = 1),
l AS (SELECT l_orderkey, max(l_shipdate) AS d, count(*) AS n FROM lineitem GROUP BY l_orderkey),
fin AS (
  SELECT p.o_orderkey, p.o_orderdate,
         CASE WHEN l.d <= TIMESTAMP '{CUTOFF}' THEN l.d END AS decided_at,
         COALESCE(l.n, 0) AS n_parts,
         CASE WHEN l.d <= TIMESTAMP '{CUTOFF}' THEN 'final' ELSE 'waiting' END AS outcome,
         CASE WHEN l.d <= TIMESTAMP '{CUTOFF}' THEN 'F' ELSE 'P' END AS new_status
  FROM latest p LEFT JOIN l ON p.o_orderkey = l.l_orderkey
  WHERE p.o_orderstatus = 'P')"""


def _finalised(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    dec = journal.decisions_from_lines(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_shipdate")
    return journal.finalise(o, dec, ntz_literal(CUTOFF), key="o_orderkey", status="o_orderstatus",
                            version="o_orderdate")


@register("finalise", "T3 W4", SQL_FINALISE + " SELECT * FROM fin")
def q_finalise(spark, sf_dir):
    return _finalised(spark, sf_dir)


@register("task_outbox", "T4", SQL_FINALISE + f"""
SELECT sha256(CAST(o_orderkey AS VARCHAR) || '|' || '{TASK_KIND}') AS task_id, o_orderkey,
       '{TASK_KIND}' AS kind, decided_at AS created_at
FROM fin WHERE outcome = 'final'""")
def q_task_outbox(spark, sf_dir):
    return journal.task_outbox(_finalised(spark, sf_dir), "o_orderkey", TASK_KIND, "decided_at")


SQL_DEAD = f"""
WITH l AS (SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(20,2))) AS s, count(*) AS n
           FROM lineitem GROUP BY l_orderkey),
c AS (SELECT o.*, l.s, l.n, o_orderkey % {standins.CUT_OFF[0]} = {standins.CUT_OFF[1]} AS cut_off,
             o_orderkey % {standins.BAD_RATE[0]} = {standins.BAD_RATE[1]} AS bad_rate
      FROM orders o LEFT JOIN l ON o.o_orderkey = l.l_orderkey),
dl AS (
  SELECT o_orderkey,
         NULLIF(concat_ws(',', CASE WHEN cut_off OR bad_rate THEN 'corrupt' END,
                               CASE WHEN s IS NULL AND NOT cut_off THEN 'bad_amount' END,
                               CASE WHEN n IS NULL AND NOT cut_off THEN 'no_periods' END), '') AS error,
         CAST(1 + o_custkey % {MAX_ATTEMPTS} AS INTEGER) AS attempt, o_orderdate AS failed_at
  FROM c)"""
_SQL_DUE = f"failed_at + INTERVAL (30 * 86400 * pow(2, attempt - 1)) SECOND"


CHECKS = [("corrupt", lambda: F.col("doc")[CORRUPT].isNotNull()),
          ("bad_amount", lambda: D.decimal_is_bad(F.col("doc.grunnlagResultat.avkortet"))),
          ("no_periods", lambda: F.coalesce(F.size("doc.grunnlagResultat.grunnlagInntektsPerioder") == 0, F.lit(False)))]


def _tagged(spark, sf_dir):
    """Every document, all fields checked, in one tagged pass; the attempts made so far are a stand-in (1 to the most)."""
    docs = documents.decode_documents(standins.payload_table(spark, sf_dir))
    attempt = (F.lit(1) + F.col("o_custkey") % MAX_ATTEMPTS).cast("int")
    return journal.tag_outcome(docs, [(n, c()) for n, c in CHECKS]).select(
        "o_orderkey", "error", attempt.alias("attempt"), F.col("o_orderdate").alias("failed_at"), "payload")


#: a further stand-in for bad input: these entries' number of children is a word
BAD_CHILDREN = (83, 5)


def _is(case):
    return f"o_orderkey % {case[0]} = {case[1]}"


@register("dead_letter", "T5 X3 S3 X1", f"""
WITH l AS (SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(20,2))) AS s, count(*) AS n
           FROM lineitem GROUP BY l_orderkey),
c AS (SELECT o.*, l.s, l.n, {_is(standins.CUT_OFF)} AS cut_off, {_is(standins.BAD_RATE)} AS bad_rate, {_is(BAD_CHILDREN)} AS bad_children
      FROM orders o LEFT JOIN l ON o.o_orderkey = l.l_orderkey),
dl AS (
  SELECT o_orderkey,
         NULLIF(concat_ws(',', CASE WHEN cut_off THEN 'unreadable' END,
                               CASE WHEN NOT cut_off AND (bad_rate OR bad_children) THEN 'wrong_fields' END,
                               CASE WHEN s IS NULL AND NOT cut_off THEN 'bad_amount' END,
                               CASE WHEN n IS NULL AND NOT cut_off THEN 'no_periods' END), '') AS error,
         CASE WHEN cut_off THEN '' ELSE concat_ws(',', CASE WHEN bad_children THEN 'faktum.antallBarn' END,
                                                       CASE WHEN bad_rate THEN 'satsResultat.dagsats' END) END AS wrong_fields,
         CASE WHEN NOT cut_off THEN 5 * CAST(floor(o_totalprice / {float(standins.WORKDAYS)}) AS INTEGER) END AS ukesats,
         CAST(1 + o_custkey % {MAX_ATTEMPTS} AS INTEGER) AS attempt, o_orderdate AS failed_at
  FROM c)
SELECT *, CASE WHEN error IS NULL THEN 'ok' ELSE 'dead' END AS outcome FROM dl""")
def q_dead_letter(spark, sf_dir):
    """Outcome of every document, the wrong fields by name, and a value from a branch that survives them."""
    rows = standins.payload_table(spark, sf_dir)
    text = F.when(F.expr(_is(BAD_CHILDREN)), F.regexp_replace("payload", '"antallBarn":[0-9]+', '"antallBarn":"two"')) \
        .otherwise(F.col("payload"))
    docs = documents.decode_fields(rows.withColumn("payload", text))
    checks = [("unreadable", F.col("unreadable")), ("wrong_fields", F.size("wrong_fields") > 0), *((n, c()) for n, c in CHECKS[1:])]
    attempt = (F.lit(1) + F.col("o_custkey") % MAX_ATTEMPTS).cast("int")
    tagged = journal.tag_outcome(docs, checks)
    return tagged.select("o_orderkey", "error", F.array_join("wrong_fields", ",").alias("wrong_fields"),
                         F.col("doc.satsResultat.ukesats").alias("ukesats"), attempt.alias("attempt"),
                         F.col("o_orderdate").alias("failed_at"), F.when(F.col("error").isNull(), "ok").otherwise("dead").alias("outcome"))


@register("retry_due", "T6", SQL_DEAD + f"""
SELECT *, {_SQL_DUE} AS due_at, attempt + 1 AS next_attempt
FROM dl
WHERE error IS NOT NULL AND attempt < {MAX_ATTEMPTS} AND {_SQL_DUE} <= TIMESTAMP '{CUTOFF}'""")
def q_retry_due(spark, sf_dir):
    dead = _tagged(spark, sf_dir).where("error is not null").drop("payload")
    return journal.retry_due(dead, ntz_literal(CUTOFF), MAX_ATTEMPTS, BACKOFF)


@register("retry_round", "T6 T5", SQL_DEAD + f"""
SELECT o_orderkey, state, CASE WHEN state = 'recovered' THEN NULL ELSE error END AS error,
       CASE WHEN state = 'again' THEN attempt + 1 ELSE attempt END AS attempt,
       CASE WHEN state = 'again' THEN TIMESTAMP '{CUTOFF}' ELSE failed_at END AS failed_at
FROM (SELECT *, CASE WHEN attempt >= {MAX_ATTEMPTS} THEN 'parked' WHEN {_SQL_DUE} > TIMESTAMP '{CUTOFF}' THEN 'waiting'
                     WHEN error LIKE '%corrupt%' THEN 'again' ELSE 'recovered' END AS state
      FROM dl WHERE error IS NOT NULL)""")
def q_retry_round(spark, sf_dir):
    """A round after the amount and period checks were lifted: only texts that cannot be read fail again."""
    dead = documents.decode_documents(_tagged(spark, sf_dir).where("error is not null"))
    done = journal.tag_retry(dead, [("corrupt", F.col("doc")[CORRUPT].isNotNull())], ntz_literal(CUTOFF), MAX_ATTEMPTS, BACKOFF)
    cause = F.when(F.col("state") == "recovered", None).otherwise(F.col("first_error"))
    return done.select("o_orderkey", "state", cause.alias("error"), "attempt", "failed_at")


# All dead letters retried until each is recovered or parked. A letter recovers once what it lacked has come: stand-in,
# a missing amount or list is there (o_custkey % 5) * 60 days after 1999-01-01; a text that cannot be read never mends.
RETRY_START = "1999-01-01 00:00:00"
MENDS_AFTER = "(o_custkey % 5) * 60"


def _sql_rounds() -> str:
    now = [f"(TIMESTAMP '{RETRY_START}' + INTERVAL {30 * (2 ** k - 1)} DAY)" for k in range(1, MAX_ATTEMPTS + 1)]
    parts = [f"""r0 AS (SELECT dl.o_orderkey, error, attempt, failed_at, {MENDS_AFTER} AS mends FROM dl JOIN orders USING (o_orderkey)
              WHERE error IS NOT NULL)"""]
    for k, t in enumerate(now, 1):
        ok = f"error NOT LIKE '%corrupt%' AND {t} >= TIMESTAMP '{RETRY_START}' + to_days(CAST(mends AS INTEGER))"
        parts.append(f"""s{k} AS (SELECT *, CASE WHEN attempt >= {MAX_ATTEMPTS} THEN 'parked' WHEN {_SQL_DUE} > {t} THEN 'waiting'
                 WHEN {ok} THEN 'recovered' ELSE 'again' END AS state FROM r{k - 1})""")
        parts.append(f"""r{k} AS (SELECT o_orderkey, error, CASE WHEN state = 'again' THEN attempt + 1 ELSE attempt END AS attempt,
                 CASE WHEN state = 'again' THEN {t} ELSE failed_at END AS failed_at, mends FROM s{k} WHERE state IN ('again', 'waiting'))""")
    log = " UNION ALL ".join(f"""SELECT CAST({k} AS INTEGER) AS round, o_orderkey, state,
              CASE WHEN state = 'again' THEN attempt + 1 ELSE attempt END AS attempt FROM s{k}""" for k in range(1, MAX_ATTEMPTS + 1))
    return SQL_DEAD + ", " + ", ".join(parts) + " " + log


@register("retry_rounds", "T6 T5", _sql_rounds())
def q_retry_rounds(spark, sf_dir):
    """Every round's log: each letter until it is recovered or parked."""
    from ..session import scratch_path
    from ..streaming import retries

    dead = _tagged(spark, sf_dir).where("error is not null").drop("payload") \
        .join(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), "o_orderkey")

    def checks(now):
        there = F.timestamp_add("DAY", F.expr(MENDS_AFTER), ntz_literal(RETRY_START)) <= now
        return [("corrupt", F.col("first_error").contains("corrupt")), ("missing", ~there)]

    times = [F.timestamp_add("DAY", F.lit(30 * (2 ** k - 1)), ntz_literal(RETRY_START)) for k in range(1, MAX_ATTEMPTS + 1)]
    log = retries.run_retry_rounds(dead, scratch_path(spark, "retries", "rounds"), checks, times, MAX_ATTEMPTS, BACKOFF, key="o_orderkey")
    return log.select("round", "o_orderkey", "state", "attempt")


@register("observe_counts", "S8", SQL_FINALISE + """
SELECT count(*) AS "rows", count(*) FILTER (outcome = 'final') AS final, count(*) FILTER (outcome = 'waiting') AS waiting
FROM fin""")
def q_observe_counts(spark, sf_dir):
    """The counters of a finalising run, read back from its observation after the run."""
    from ..sources.sinks import observe_run

    df, seen = observe_run(_finalised(spark, sf_dir), "finalise",
                           final=F.col("outcome") == "final", waiting=F.col("outcome") == "waiting")
    df.write.format("noop").mode("overwrite").save()
    counts = seen.get
    return spark.createDataFrame([(counts["rows"], counts["final"], counts["waiting"])], "rows long, final long, waiting long")
