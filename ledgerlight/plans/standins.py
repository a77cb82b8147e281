"""Stand-in inputs derived from the driver tables.

The alert rules read log-message counters and gauges; the journal plans read
provisional entries. None of those exist as tables here, so they are derived
from ``events`` and ``orders``/``lineitem`` by Spark itself and grow with them:

=================  =====================================================
log message        one ``events`` row; ``event_type`` gives the level,
                   ``user_id % 3`` the app, ``user_id % 5`` the namespace,
                   ``event_id`` picks a logger name
message counter    running hourly count per (app, namespace, level),
                   restarted each UTC day -> resets occur
gauges             hourly counts per (app, namespace): ERROR messages for
                   unavailable replicas, WARN messages for self-test status
journal entry      one ``orders`` row (``'P'`` = provisional)
=================  =====================================================

The same definitions exist in SQL (:data:`SQL_LOG_MESSAGES`, ...) for the
DuckDB oracle, generated from the same constants.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import MIN_PERIOD_DDL, PERIOD_DDL

from ..functions.timefn import seconds
from ..operators import metrics
from ..operators.routing import DEFAULT_ROUTES

N_APPS = 3
N_NAMESPACES = 5

# Stand-in level per event type (our choice; any event type not listed is INFO).
EVENT_LEVEL = {"error": "ERROR", "signup": "WARN", "purchase": "INFO", "click": "DEBUG", "view": "TRACE"}

#: job label of the replica gauge; one namespace reports from another job so
#: the two-label matcher has something to reject.
SERVICE_JOB = "kubernetes-service-endpoints"
OTHER_JOB = "kube-state-metrics"
OTHER_JOB_NAMESPACE = "ns-4"


def standin_loggers() -> list[str]:
    """Logger names used by the stand-in messages, built from the routing table:
    each configured logger, a child of it, a sibling sharing its prefix (which
    must *not* match), plus two names only the root covers."""
    names = []
    for route in DEFAULT_ROUTES:
        if route.logger:
            names += [route.logger, route.logger + ".child", route.logger + "X"]
    return names + ["app.web", "app.web.http"]


def app_name(i: int) -> str:
    return f"app-{i}"


def log_messages(events: DataFrame) -> DataFrame:
    """events -> (event_id, ts, log_app, log_namespace, logger, level, log_level, message)."""
    level_map = F.create_map(*[F.lit(x) for kv in EVENT_LEVEL.items() for x in kv])
    loggers = F.array(*[F.lit(n) for n in standin_loggers()])
    level = F.coalesce(F.element_at(level_map, F.col("event_type")), F.lit("INFO"))
    return events.select(
        "event_id", "ts",
        F.concat(F.lit("app-"), (F.col("user_id") % N_APPS).cast("string")).alias("log_app"),
        F.concat(F.lit("ns-"), (F.col("user_id") % N_NAMESPACES).cast("string")).alias("log_namespace"),
        F.element_at(loggers, (F.col("event_id") % len(standin_loggers()) + 1).cast("int")).alias("logger"),
        level.alias("level"),
        F.initcap(level).alias("log_level"),
        F.concat_ws(" ", F.col("event_type"), F.col("props")).alias("message"),
    )


#: step of the stand-in metric samples (one scrape per hour)
PANE = "1h"


def message_panes(msgs: DataFrame, step: str = PANE) -> DataFrame:
    """The one aggregation of the raw messages: counts per ``step`` pane and
    (log_app, log_namespace, log_level) -> (..., pane_end, n). Every metric
    stand-in below is derived from this small table, so a plan that needs
    several of them scans the messages once."""
    return metrics.pane_counts(msgs, ["log_app", "log_namespace", "log_level"], step, {"n": F.count(F.lit(1))})


def app_panes(panes: DataFrame) -> DataFrame:
    """Hourly (log_app, log_namespace, pane_end, total, errors, warns)."""
    n = F.col("n")
    return panes.groupBy("log_app", "log_namespace", "pane_end").agg(
        F.sum(n).alias("total"),
        F.sum(F.when(F.col("log_level") == "Error", n).otherwise(0)).alias("errors"),
        F.sum(F.when(F.col("log_level") == "Warn", n).otherwise(0)).alias("warns"))


def message_counter(panes: DataFrame, step: str = PANE) -> DataFrame:
    """``logd_messages_total``: (log_app, log_namespace, log_level, ts, value).

    A sample at the end of every pane with messages; the value counts the
    messages since the start of that UTC day, so it drops back at midnight.
    The running sum is partitioned by (series, day): at most a day's panes each.
    """
    keys = ["log_app", "log_namespace", "log_level"]
    start = F.timestamp_add("SECOND", F.lit(-seconds(step)), F.col("pane_end"))
    day = Window.partitionBy(*keys, F.to_date(start)).orderBy("pane_end") \
        .rowsBetween(Window.unboundedPreceding, 0)
    return panes.select(*keys, F.col("pane_end").alias("ts"), F.sum("n").over(day).cast("double").alias("value"))


def replica_gauge(apps: DataFrame) -> DataFrame:
    """``kube_deployment_status_replicas_unavailable``: (deployment, namespace, job, ts, value)
    = ERROR messages of the hour."""
    return apps.select(
        F.col("log_app").alias("deployment"), F.col("log_namespace").alias("namespace"),
        F.when(F.col("log_namespace") == OTHER_JOB_NAMESPACE, F.lit(OTHER_JOB))
         .otherwise(F.lit(SERVICE_JOB)).alias("job"),
        F.col("pane_end").alias("ts"), F.col("errors").cast("double").alias("value"))


def selftest_gauge(apps: DataFrame) -> DataFrame:
    """``selftests_aggregate_result_status``: (app, kubernetes_namespace, ts, value)
    = WARN messages of the hour."""
    return apps.select(F.col("log_app").alias("app"), F.col("log_namespace").alias("kubernetes_namespace"),
                       F.col("pane_end").alias("ts"), F.col("warns").cast("double").alias("value"))


#: metric names of the sample table
COUNTER_NAME, REPLICAS_NAME, SELFTEST_NAME = ("logd_messages_total", "kube_deployment_status_replicas_unavailable",
                                              "selftests_aggregate_result_status")
#: series of this namespace carry one label more, others an empty one, to which a label set is indifferent
EXTRA_LABEL, EXTRA_NAMESPACE = ("zone", "north"), "ns-1"


def metric_samples(events: DataFrame) -> DataFrame:
    """The three metrics as one long sample table ``(metric, labels, ts, value)``, each with its own label set.

    All samples come from one pane table, read three times.
    """
    panes = message_panes(log_messages(events))
    apps = app_panes(panes)
    extra = [F.lit(EXTRA_LABEL[0]), None]

    def long(df: DataFrame, name: str, labels: list[str], namespace: str) -> DataFrame:
        pairs = [x for c in labels for x in (F.lit(c), F.col(c))]
        extra[1] = F.when(F.col(namespace) == EXTRA_NAMESPACE, F.lit(EXTRA_LABEL[1])).otherwise(F.lit(""))
        return df.select(F.lit(name).alias("metric"), F.create_map(*extra, *pairs).alias("labels"), "ts", "value")

    return long(message_counter(panes), COUNTER_NAME, ["log_app", "log_namespace", "log_level"], "log_namespace") \
        .unionByName(long(replica_gauge(apps), REPLICAS_NAME, ["deployment", "namespace", "job"], "namespace")) \
        .unionByName(long(selftest_gauge(apps), SELFTEST_NAME, ["app", "kubernetes_namespace"], "kubernetes_namespace"))


# ---------------------------------------------------------------- SQL forms (oracle)

def sql_log_messages(events: str = "events") -> str:
    level_case = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in EVENT_LEVEL.items())
    names = standin_loggers()
    logger_list = ", ".join(f"'{n}'" for n in names)
    return f"""
      SELECT event_id, ts,
             'app-' || CAST(user_id % {N_APPS} AS VARCHAR) AS log_app,
             'ns-' || CAST(user_id % {N_NAMESPACES} AS VARCHAR) AS log_namespace,
             ([{logger_list}])[CAST(event_id % {len(names)} AS INTEGER) + 1] AS logger,
             COALESCE(CASE event_type {level_case} END, 'INFO') AS level,
             upper(substr(COALESCE(CASE event_type {level_case} END, 'INFO'), 1, 1))
               || lower(substr(COALESCE(CASE event_type {level_case} END, 'INFO'), 2)) AS log_level,
             concat_ws(' ', event_type, props) AS message
      FROM {events}"""


def sql_message_counter() -> str:
    return f"""
      SELECT log_app, log_namespace, log_level, ts,
             CAST(SUM(n) OVER (PARTITION BY log_app, log_namespace, log_level, CAST(h AS DATE)
                               ORDER BY h ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS value
      FROM (SELECT log_app, log_namespace, log_level, date_trunc('hour', ts) AS h,
                   date_trunc('hour', ts) + INTERVAL 1 HOUR AS ts, count(*) AS n
            FROM msgs GROUP BY ALL)"""


def sql_replica_gauge() -> str:
    return f"""
      SELECT log_app AS deployment, log_namespace AS namespace,
             CASE WHEN log_namespace = '{OTHER_JOB_NAMESPACE}' THEN '{OTHER_JOB}' ELSE '{SERVICE_JOB}' END AS job,
             date_trunc('hour', ts) + INTERVAL 1 HOUR AS ts,
             CAST(count(*) FILTER (WHERE level = 'ERROR') AS DOUBLE) AS value
      FROM msgs GROUP BY log_app, log_namespace, date_trunc('hour', ts)"""


def sql_selftest_gauge() -> str:
    return """
      SELECT log_app AS app, log_namespace AS kubernetes_namespace,
             date_trunc('hour', ts) + INTERVAL 1 HOUR AS ts,
             CAST(count(*) FILTER (WHERE level = 'WARN') AS DOUBLE) AS value
      FROM msgs GROUP BY log_app, log_namespace, date_trunc('hour', ts)"""


# ---------------------------------------------------------------- rule-evaluation documents

# Rule identifiers and the rule name of the sample document.
RULE_IDS = {"grunnlag": "Grunnlag.v1", "minsteinntekt": "Minsteinntekt.v1",
            "periode": "Periode.v1", "sats": "Sats.v1"}
BEREGNINGSREGEL = "ArbeidsinntektSiste12"
#: stand-in values of our own: income limit for the minimum-income result,
#: the text of an unknown income, working days per year for the daily rate
MIN_INCOME = 150000
UNKNOWN_INCOME = "n/a"
WORKDAYS = 260


#: line numbers per period document: a fixed layout that never looks at how many lines an entry has
LINES_PER_DOCUMENT = 16
#: stand-ins for bad input: these entries' texts are cut off, or carry a daily rate that is no number
CUT_OFF, BAD_RATE = (97, 13), (89, 7)


def _is(case: tuple[int, int]):
    return F.col("o_orderkey") % case[0] == case[1]


#: rows a task makes documents of
ROWS_PER_TASK = 200_000


def _parts(df: DataFrame) -> int:
    """Partitions to deal ``df`` over: by its rows, and no fewer than there are cores."""
    return max(df.sparkSession.sparkContext.defaultParallelism, df.count() // ROWS_PER_TASK)


def period_documents(lineitem: DataFrame) -> DataFrame:
    """Income periods as JSON documents, from ``lineitem`` alone: one per (order, line number div 16).

    The layout is fixed by the line's own key, so a list holds at most
    :data:`LINES_PER_DOCUMENT` lines however many an order has, and an order's
    lines spread over as many groups; nothing is joined, ranked or counted.

    Output: (l_orderkey, part, payload).
    """
    from ..functions.decode import ulid_head, ulid_with_parts, year_month
    from ..functions.timefn import epoch_millis

    price = F.col("l_extendedprice").cast("decimal(20,2)")
    period = F.struct(
        F.col("l_linenumber").alias("periode"), price.cast("string").alias("inntekt"),
        F.struct(year_month("l_shipdate").alias("sisteMåned"),
                 year_month(F.add_months(F.to_date("l_shipdate"), F.col("l_linenumber").cast("int") - 12)).alias("førsteMåned")
                 ).alias("inntektsPeriode"),
        (F.col("l_returnflag") == "R").alias("inneholderFangstOgFisk"),
        (price * F.lit(0.5).cast("decimal(3,2)")).cast("decimal(20,2)").cast("string").alias("andel"),
    )
    part = F.floor(F.col("l_linenumber") / LINES_PER_DOCUMENT).cast("bigint").alias("part")
    used = ("l_orderkey", "l_linenumber", "l_extendedprice", "l_shipdate", "l_returnflag")
    # dealt out before the texts are made: neither that work nor the rows on their way depend on the files' row groups
    dealt = lineitem.select(*used, part).repartition(_parts(lineitem), "l_orderkey", "part")
    g = dealt.groupBy("l_orderkey", "part").agg(
        F.sort_array(F.collect_list(period)).alias("perioder"), F.min("l_shipdate").alias("first"))
    head = ulid_head(epoch_millis("first"))
    fields = ("inntekt", "periode", "inntektsPeriode", "inneholderFangstOgFisk")

    def listed(*names):
        return F.transform("perioder", lambda x: F.struct(*(x[n].alias(n) for n in names)))

    doc = F.struct(
        ulid_with_parts(head, F.col("l_orderkey") * F.lit(10), F.col("part") + F.lit(1)).alias("id"),
        F.struct(F.col("l_orderkey").alias("vedtakId")).alias("faktum"),
        F.struct(listed(*fields).alias("grunnlagInntektsPerioder")).alias("grunnlagResultat"),
        F.struct(listed("andel", *fields).alias("minsteinntektInntektsPerioder")).alias("minsteinntektResultat"))
    return g.select("l_orderkey", "part", F.to_json(doc).alias("payload"))


def header_documents(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """JSON documents shaped like the sample rule-evaluation document, one per order.

    The income is the sum over *all* lines of the order, and so is what is
    decided on it: lines are summed per order (partial aggregation), and the
    totals join the orders on a key that is unique on both sides, so no
    order's lines ever meet in a task. The period lists travel in
    :func:`period_documents`; a header has an empty list only if its order has
    no line, and then the income text ``n/a`` -- the input the decoders must
    flag. Some texts are cut off or hold a wrong type, see :data:`CUT_OFF`.

    Output: (o_orderkey, o_custkey, o_orderstatus, o_orderdate, payload).
    """
    from ..functions.decode import ulid_head, ulid_with_parts
    from ..functions.timefn import epoch_millis

    totals = lineitem.groupBy("l_orderkey").agg(F.sum(F.col("l_extendedprice").cast("decimal(20,2)")).alias("sum_inntekt"))
    # dealt out first: a few row groups would make all texts in as many tasks
    orders = orders.repartition(_parts(orders), "o_orderkey")
    o = orders.join(totals, orders.o_orderkey == totals.l_orderkey, "left")
    # every id of a document has the same time part: compute it once per row
    o = o.withColumn("__head", ulid_head(epoch_millis("o_orderdate")))
    key, ts, head, part = F.col("o_orderkey"), F.col("o_orderdate"), F.col("__head"), F.lit(0)
    income = F.col("sum_inntekt").cast("decimal(20,2)").cast("string")
    income_txt = F.coalesce(income, F.lit(UNKNOWN_INCOME))

    def periods(ddl):
        return F.when(F.col("l_orderkey").isNull(), F.array().cast(f"array<{ddl}>"))

    meets = F.col("sum_inntekt") >= F.lit(MIN_INCOME)
    dagsats = F.floor(F.col("o_totalprice") / F.lit(float(WORKDAYS))).cast("int")

    def uid(k: int):
        return ulid_with_parts(head, key * F.lit(10) + F.lit(k), part)

    doc = F.struct(
        uid(0).alias("id"),
        ulid_with_parts(head, F.col("o_custkey"), F.lit(0)).alias("behovId"),
        F.struct(F.lpad(F.col("o_custkey").cast("string"), 13, "0").alias("aktorId"),
                 key.alias("vedtakId"),
                 F.to_date(ts).alias("beregningsdato"),
                 uid(1).alias("inntektsId"),
                 (F.col("o_orderpriority") == "1-URGENT").alias("inntektAvvik"),
                 (F.col("o_orderstatus") == "F").alias("inntektManueltRedigert"),
                 (F.col("o_custkey") % 4).cast("int").alias("antallBarn")).alias("faktum"),
        F.struct(income_txt.alias("avkortet"), income_txt.alias("uavkortet"),
                 uid(2).alias("sporingsId"), F.lit(False).alias("harAvkortet"),
                 uid(3).alias("subsumsjonsId"), F.lit(BEREGNINGSREGEL).alias("beregningsregel"),
                 F.lit(RULE_IDS["grunnlag"]).alias("regelIdentifikator"),
                 periods(PERIOD_DDL).alias("grunnlagInntektsPerioder")).alias("grunnlagResultat"),
        F.struct(uid(4).alias("sporingsId"), uid(5).alias("subsumsjonsId"),
                 F.lit(RULE_IDS["minsteinntekt"]).alias("regelIdentifikator"),
                 meets.alias("oppfyllerMinsteinntekt"),
                 periods(MIN_PERIOD_DDL).alias("minsteinntektInntektsPerioder")).alias("minsteinntektResultat"),
        F.struct(uid(6).alias("sporingsId"), uid(7).alias("subsumsjonsId"),
                 F.when(meets, F.lit(52)).otherwise(F.lit(26)).alias("periodeAntallUker"),
                 F.lit(RULE_IDS["periode"]).alias("regelIdentifikator")).alias("periodeResultat"),
        F.struct(dagsats.alias("dagsats"), (dagsats * 5).alias("ukesats"),
                 uid(8).alias("sporingsId"), uid(9).alias("subsumsjonsId"),
                 F.lit(RULE_IDS["sats"]).alias("regelIdentifikator"),
                 F.lit(False).alias("benyttet90ProsentRegel")).alias("satsResultat"),
    )
    text = F.to_json(doc)
    text = F.when(_is(CUT_OFF), F.substring(text, 1, 200)) \
        .when(_is(BAD_RATE), F.regexp_replace(text, '"dagsats":-?[0-9]+', '"dagsats":"abc"')).otherwise(text)
    return o.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", text.alias("payload"))


def sql_ulid(ms_sql: str, seed_sql: str) -> str:
    """DuckDB text of a ULID: 10 base-32 digits of the ms time, 16 of the seed."""
    alpha = "0123456789ABCDEFGHJKMNPQRSTVWXYZ"
    head = (f"array_to_string(list_transform(range(9, -1, -1), "
            f"lambda i: substr('{alpha}', CAST((({ms_sql}) >> (5 * i)) & 31 AS INTEGER) + 1, 1)), '')")
    tail = (f"array_to_string(list_transform(range(12, -1, -1), "
            f"lambda i: substr('{alpha}', CAST((({seed_sql}) >> (5 * i)) & 31 AS INTEGER) + 1, 1)), '')")
    return f"({head} || '000' || {tail})"


def sql_ulid_parts(ms_sql: str, hi_sql: str, lo_sql: str) -> str:
    """DuckDB text of a ULID with a two-number tail (see ``ulid_with_parts``)."""
    alpha = "0123456789ABCDEFGHJKMNPQRSTVWXYZ"

    def digits(v: str, n: int) -> str:
        return (f"array_to_string(list_transform(range({n - 1}, -1, -1), "
                f"lambda i: substr('{alpha}', CAST((({v}) >> (5 * i)) & 31 AS INTEGER) + 1, 1)), '')")
    return f"({digits(ms_sql, 10)} || {digits(hi_sql, 9)} || {digits(lo_sql, 7)})"


def sql_ulid_decode(u_sql: str) -> str:
    """DuckDB: ms time of a ULID (first 10 characters)."""
    alpha = "0123456789ABCDEFGHJKMNPQRSTVWXYZ"
    return (f"CAST(list_sum(list_transform(range(10), lambda i: CAST(strpos('{alpha}', "
            f"substr(translate(upper({u_sql}), 'ILO', '110'), i + 1, 1)) - 1 AS BIGINT) << (5 * (9 - i)))) AS BIGINT)")


_PAYLOAD_TABLES: dict[tuple[str, str, str], str] = {}


def payload_table(spark, sf_dir: str, kind: str = "headers") -> DataFrame:
    """The journal payload table: :func:`header_documents` or :func:`period_documents` (``kind="periods"``).

    In production this is the pipeline's input (JSON records landed from the
    stream). Here it is derived once per Spark application and scale factor and
    written as Parquet below ``spark.checkpoint.dir``; every decoding query then
    reads it and does its own parsing.
    """
    from ..session import scratch_path
    from ..sources.tables import read_table

    key = (spark.sparkContext.applicationId, sf_dir, kind)
    path = _PAYLOAD_TABLES.get(key)
    if path is None:
        path = scratch_path(spark, "standins", kind)
        lineitem = read_table(spark, sf_dir, "lineitem")
        docs = period_documents(lineitem) if kind == "periods" else header_documents(read_table(spark, sf_dir, "orders"), lineitem)
        docs.write.mode("overwrite").option("compression", "zstd").parquet(path)
        _PAYLOAD_TABLES[key] = path
    return spark.read.parquet(path)
