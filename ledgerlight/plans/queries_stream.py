"""Streaming queries (T1 T2 S1 + T3): the stream forms must equal their batch forms,
so they share the batch oracles.

Each query runs its stream to the end of the (bounded) input with an
``availableNow`` trigger, under a fresh folder below the session's
``spark.checkpoint.dir``, then returns the stream's result table.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.timefn import as_instant, ntz_literal
from ..operators import journal, series
from ..schemas import EVENTS_SCHEMA, ORDERS_SCHEMA
from ..session import scratch_path
from ..sources.sinks import read_files, run_to_files
from ..sources.streams import decode_records, dedup_records, file_stream, replay, time_slice
from ..streaming import alerts as salerts
from ..streaming import counters as scounters
from ..streaming import journal as sjournal
from ..streaming import logs as slogs
from ..streaming import rules as srules
from ..streaming import windows as swindows
from . import queries_alerts as qa
from . import queries_journal as qj
from . import queries_logs as ql
from . import rules, standins
from .catalog import register, table

#: watermark delay: the bounded test stream arrives in order
DELAY = "1h"


#: micro-batches of the queries that replay a table in slices
SLICES = 3


def _event_slices(spark, sf_dir, name, df):
    """``df`` written slice by slice in order of event time: ``(folder, slice numbers as they are written)``."""
    folder = scratch_path(spark, "streams", name + "_in")
    return folder, replay(df, folder, SLICES, time_slice(df, "ts", SLICES))


@register("stream_error_ratio", "T1 A3 F4 F3", qa.SQL_ERROR_COUNTS + " SELECT * FROM ratio")
def q_stream_error_ratio(spark, sf_dir):
    """Error share over sliding windows, one micro-batch per third of the time span."""
    events = table(spark, sf_dir, "events")
    folder, slices = _event_slices(spark, sf_dir, "windows", events)
    root = scratch_path(spark, "streams", "windows")
    aggs = {"errors": F.count_if(F.col("log_level") == "Error"), "total": F.count(F.lit(1))}
    for _ in slices:
        msgs = standins.log_messages(file_stream(spark, folder, events.schema))
        swindows.run_window_stream(spark, msgs, root, qa.KEYS, window=qa.WINDOW, step=qa.STEP, aggs=aggs)
    schema = swindows.window_deltas(standins.log_messages(events), qa.KEYS, qa.WINDOW, qa.STEP, aggs).schema
    ticks = swindows.current_windows(spark, root, qa.KEYS, list(aggs), schema)
    return salerts.error_ratio_from_ticks(ticks, qa.THRESHOLD)


@register("stream_counter_rate", "A2 W2 T1 S4 S1", qa.SQL_SAMPLES + qa.sql_tick_increase(3) + """
SELECT log_app, log_namespace, log_level, tick, increase / 10800.0 AS rate FROM tinc""")
def q_stream_counter_rate(spark, sf_dir):
    """The counter's rate from a stream of long samples, carried over three micro-batches by series fingerprint."""
    samples = standins.metric_samples(table(spark, sf_dir, "events")).filter(F.col("metric") == standins.COUNTER_NAME)
    folder, slices = _event_slices(spark, sf_dir, "samples", samples)
    root = scratch_path(spark, "streams", "rate")
    for _ in slices:
        live = series.with_series(file_stream(spark, folder, samples.schema))
        inc = scounters.run_counter_stream(spark, live, root, ["series"], window=qa.WINDOW, step=qa.STEP, delay=DELAY)
    dictionary = series.series_dictionary(spark.read.schema(samples.schema).parquet(folder))
    return series.with_labels(inc, dictionary, qa.CKEYS) \
        .select(*qa.CKEYS, "tick", (F.col("increase") / F.lit(10800.0)).alias("rate"))


@register("stream_sustained_for", "T2 W3", qa.SQL_SUSTAINED)
def q_stream_sustained_for(spark, sf_dir):
    events = file_stream(spark, sf_dir, EVENTS_SCHEMA, glob="events.parquet", max_files_per_trigger=1)
    msgs = standins.log_messages(events)
    panes = salerts.error_panes(msgs, qa.KEYS, qa.STEP, DELAY, F.col("log_level") == "Error")
    fired = salerts.run_alert_stream(spark, panes, scratch_path(spark, "streams", "sustained"), qa.KEYS,
                                     window=qa.WINDOW, step=qa.STEP, delay=DELAY, threshold=qa.THRESHOLD,
                                     hold=qa.HOLD)
    return fired.select(*qa.KEYS, "start", "fires_at", "error_pct")


@register("stream_finalise", "S1 T3 T4", qj.SQL_FINALISE + " SELECT * FROM fin")
def q_stream_finalise(spark, sf_dir):
    entries = file_stream(spark, sf_dir, ORDERS_SCHEMA, glob="orders.parquet", max_files_per_trigger=1)
    dec = journal.decisions_from_lines(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_shipdate")
    root = scratch_path(spark, "streams", "finalise")
    sjournal.run_finalise_stream(spark, entries, dec, ntz_literal(qj.CUTOFF), root, root + "/checkpoint",
                                 key="o_orderkey", status="o_orderstatus", version="o_orderdate",
                                 task_kind=qj.TASK_KIND)
    out_schema = journal.finalise(spark.createDataFrame([], ORDERS_SCHEMA), dec, ntz_literal(qj.CUTOFF),
                                  key="o_orderkey", status="o_orderstatus", version="o_orderdate").schema
    return sjournal.finalised_state(spark, root, "o_orderkey", schema=out_schema)


# Records that arrive in any order: every order twice, once provisional and once with its own status, a version that
# is a day older, equal (the second version column decides) or a day newer, dealt over three micro-batches.

SQL_RECORDS = f"""
WITH rec AS (SELECT o_orderkey, 'P' AS status, o_orderdate AS version, 0 AS seq, o_orderkey % 3 AS slice FROM orders
             UNION ALL
             SELECT o_orderkey, o_orderstatus, o_orderdate + to_days(CAST(o_custkey % 3 AS INTEGER) - 1), 1, (o_orderkey // 3) % 3 FROM orders),
l AS (SELECT l_orderkey, max(l_shipdate) AS d, count(*) AS n FROM lineitem GROUP BY l_orderkey)"""
SQL_NEWEST = SQL_RECORDS + f""",
newest AS (SELECT * FROM rec QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY version DESC, seq DESC) = 1),
fin AS (SELECT p.o_orderkey, p.version, CASE WHEN l.d <= TIMESTAMP '{qj.CUTOFF}' THEN l.d END AS decided_at,
               COALESCE(l.n, 0) AS n_parts, CASE WHEN l.d <= TIMESTAMP '{qj.CUTOFF}' THEN 'final' ELSE 'waiting' END AS outcome,
               CASE WHEN l.d <= TIMESTAMP '{qj.CUTOFF}' THEN 'F' ELSE 'P' END AS new_status
        FROM newest p LEFT JOIN l ON p.o_orderkey = l.l_orderkey WHERE p.status = 'P')"""


def journal_records(orders):
    key, days = F.col("o_orderkey"), F.col("o_custkey") % 3 - 1
    first = orders.select("o_orderkey", F.lit("P").alias("status"), F.col("o_orderdate").alias("version"),
                          F.lit(0).alias("seq"), (key % 3).alias("slice"))
    own = orders.select("o_orderkey", F.col("o_orderstatus").alias("status"),
                        F.timestamp_add("DAY", days, F.col("o_orderdate")).alias("version"), F.lit(1).alias("seq"),
                        (F.floor(key / 3) % 3).alias("slice"))
    return first.unionByName(own)


def _finalised_records(spark, sf_dir):
    """The finalising stream over the records, a micro-batch per slice; returns its root and the outcomes' schema."""
    records = journal_records(table(spark, sf_dir, "orders"))
    dec = journal.decisions_from_lines(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_shipdate")
    folder, root = scratch_path(spark, "streams", "records_in"), scratch_path(spark, "streams", "records")
    summed = scratch_path(spark, "streams", "decisions")    # summed up once, not by every micro-batch
    dec.write.parquet(summed)
    dec = spark.read.schema(dec.schema).parquet(summed)
    kw = dict(key="o_orderkey", status="status", version="version", tie="seq")
    for _ in replay(records, folder, SLICES, F.col("slice")):
        sjournal.run_finalise_stream(spark, file_stream(spark, folder, records.schema), dec, ntz_literal(qj.CUTOFF), root,
                                     root + "/checkpoint", task_kind=qj.TASK_KIND, **kw)
    return root, journal.finalise(records.limit(0), dec, ntz_literal(qj.CUTOFF), **kw).schema


@register("stream_finalise_versions", "T3 W4 S1", SQL_NEWEST + " SELECT * FROM fin")
def q_stream_finalise_versions(spark, sf_dir):
    root, schema = _finalised_records(spark, sf_dir)
    return sjournal.finalised_state(spark, root, "o_orderkey", schema)


@register("stream_counters", "S8", SQL_RECORDS + f""",
b AS (SELECT unnest([0, 1, 2]) AS batch),
upto AS (SELECT b.batch, r.*, max(CASE WHEN r.slice = b.batch THEN 1 ELSE 0 END) OVER (PARTITION BY b.batch, o_orderkey) AS touched
         FROM rec r JOIN b ON r.slice <= b.batch),
newest AS (SELECT * FROM upto QUALIFY row_number() OVER (PARTITION BY batch, o_orderkey ORDER BY version DESC, seq DESC) = 1),
out AS (SELECT batch, CASE WHEN status <> 'P' THEN 'closed' WHEN l.d <= TIMESTAMP '{qj.CUTOFF}' THEN 'final' ELSE 'waiting' END AS outcome
        FROM newest LEFT JOIN l ON l_orderkey = o_orderkey WHERE touched = 1),
read AS (SELECT slice AS batch, count(*) AS "rows", count(*) FILTER (status = 'P') AS provisional FROM rec GROUP BY slice)
SELECT CAST(b.batch AS INTEGER) AS batch, coalesce(any_value("rows"), 0) AS "rows", coalesce(any_value(provisional), 0) AS provisional,
       count(*) FILTER (outcome = 'final') AS final, count(*) FILTER (outcome = 'waiting') AS waiting,
       count(*) FILTER (outcome = 'closed') AS closed
FROM b LEFT JOIN read ON read.batch = b.batch LEFT JOIN out ON out.batch = b.batch GROUP BY b.batch""")
def q_stream_counters(spark, sf_dir):
    """Counters of every micro-batch of the finalising stream: rows read, and what became of the keys they touched."""
    root, _ = _finalised_records(spark, sf_dir)
    return sjournal.stream_counters(spark, root)


# An entry's task is issued when it first becomes final, and is not taken back when a newer record closes it.
@register("stream_task_outbox", "T4", SQL_RECORDS + f""",
b AS (SELECT unnest([0, 1, 2]) AS batch),
newest AS (SELECT b.batch, r.* FROM rec r JOIN b ON r.slice <= b.batch
           QUALIFY row_number() OVER (PARTITION BY b.batch, o_orderkey ORDER BY version DESC, seq DESC) = 1)
SELECT DISTINCT sha256(CAST(o_orderkey AS VARCHAR) || '|' || '{qj.TASK_KIND}') AS task_id, o_orderkey,
       '{qj.TASK_KIND}' AS kind, l.d AS created_at
FROM newest JOIN l ON l_orderkey = o_orderkey WHERE status = 'P' AND l.d <= TIMESTAMP '{qj.CUTOFF}'""")
def q_stream_task_outbox(spark, sf_dir):
    root, _ = _finalised_records(spark, sf_dir)
    return sjournal.issued_tasks(spark, root)


@register("stream_log_to_json", "S5 S6 J2 F5 X2 (stream)", ql.SQL_ROUTE + ql.SQL_LOG_JSON)
def q_stream_log_to_json(spark, sf_dir):
    events = file_stream(spark, sf_dir, EVENTS_SCHEMA, glob="events.parquet", max_files_per_trigger=1)
    root = scratch_path(spark, "streams", "logs")
    msgs = standins.log_messages(events)
    slogs.run_routing_stream(msgs, root + "/out", root + "/checkpoint")
    return slogs.read_routed(spark, root + "/out", msgs).select("event_id", "sink", "value")


@register("stream_alerts_all", "U1 T1 T2 W3 X10 S7 (stream)", qa.SQL_ALERTS)
def q_stream_alerts_all(spark, sf_dir):
    events = file_stream(spark, sf_dir, EVENTS_SCHEMA, glob="events.parquet", max_files_per_trigger=1)
    fired = srules.run_rule_stream(spark, standins.log_messages(events), scratch_path(spark, "streams", "rules"),
                                   qa._rule_params(), delay=DELAY, step=qa.STEP)
    return fired.select(*rules.ALERT_COLUMNS)


# Kafka-shaped records: an order per record, tombstones and cut-off texts among them, delivered in time order in three
# slices; every slice repeats part of its own records and of the end of the one before.
TOMBSTONE, CUT = (11, 4), (13, 6)
RECORD_DDL = "key bigint, status string"


def kafka_records(orders, *more):
    key = F.col("o_orderkey")
    text = F.to_json(F.struct(key.alias("key"), F.col("o_orderstatus").alias("status")))
    value = F.when(key % TOMBSTONE[0] == TOMBSTONE[1], None).when(key % CUT[0] == CUT[1], F.substring(text, 1, 9)).otherwise(text)
    return orders.select(
        key.cast("string").cast("binary").alias("key"), value.cast("binary").alias("value"), F.lit("journal").alias("topic"),
        (key % 4).cast("int").alias("partition"), F.floor(key / 4).alias("offset"), as_instant("o_orderdate").alias("timestamp"), *more)


@register("stream_records", "S1 S3 T3", f"""
SELECT 'journal' AS topic, CAST(o_orderkey % 4 AS INTEGER) AS "partition", o_orderkey // 4 AS "offset",
       CAST(o_orderkey AS VARCHAR) AS record_key,
       CASE WHEN o_orderkey % {TOMBSTONE[0]} = {TOMBSTONE[1]} THEN 'tombstone'
            WHEN o_orderkey % {CUT[0]} = {CUT[1]} THEN 'unreadable' ELSE 'value' END AS kind,
       CASE WHEN o_orderkey % {TOMBSTONE[0]} <> {TOMBSTONE[1]} AND o_orderkey % {CUT[0]} <> {CUT[1]} THEN o_orderkey END AS "key",
       CASE WHEN o_orderkey % {TOMBSTONE[0]} <> {TOMBSTONE[1]} AND o_orderkey % {CUT[0]} <> {CUT[1]} THEN o_orderstatus END AS status
FROM orders""")
def q_stream_records(spark, sf_dir):
    """Every record once, decoded, however often it was delivered."""
    orders = table(spark, sf_dir, "orders")
    dealt = kafka_records(orders, time_slice(orders, "o_orderdate", SLICES).alias("slice"))
    twice = dealt.filter(F.col("offset") % 5 == 0)
    next_slice = F.least(F.col("slice") + 1, F.lit(SLICES - 1))
    later = dealt.filter(F.col("offset") % 7 == 0).withColumn("slice", next_slice)
    folder, out = scratch_path(spark, "streams", "kafka_in"), scratch_path(spark, "streams", "kafka")
    sent = dealt.unionByName(twice).unionByName(later)
    for _ in replay(sent, folder, SLICES, F.col("slice")):
        records = dedup_records(file_stream(spark, folder, sent.schema).drop("slice"), "1d")
        run_to_files(decode_records(records, RECORD_DDL), out, out + "_checkpoint")
    return read_files(spark, out, decode_records(kafka_records(orders), RECORD_DDL).schema).drop("timestamp")
