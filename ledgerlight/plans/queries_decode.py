"""Decoding queries: JSON, decimals, months, ULIDs, nested documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import decode as D
from ..functions.timefn import epoch_millis, from_epoch_micros
from ..operators import documents
from ..schemas import CORRUPT, PROPS_DDL, period_lists_ddl
from . import standins
from .catalog import register, table


@register("parse_json", "S3 X1", """
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k, NOT json_valid(props) AS bad
FROM events""")
def q_parse_json(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    p = ev.select("event_id", D.parse_json("props", PROPS_DDL).alias("p"))
    return p.select("event_id", F.col("p.k").alias("k"), F.col("p")[CORRUPT].isNotNull().alias("bad"))


@register("ulid_time", "X7", f"""
SELECT event_id, ulid, make_timestamp({standins.sql_ulid_decode('ulid')} * 1000) AS decoded,
       make_timestamp({standins.sql_ulid_decode('ulid')} * 1000) = date_trunc('millisecond', ts) AS ok
FROM (SELECT event_id, ts, {standins.sql_ulid('(epoch_us(ts) // 1000)', 'event_id')} AS ulid FROM events)""")
def q_ulid_time(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    u = ev.select("event_id", "ts", D.ulid_of_time("ts", F.col("event_id")).alias("ulid"))
    u = u.withColumn("decoded", D.ulid_time("ulid"))
    return u.select("event_id", "ulid", "decoded",
                    (F.col("decoded") == from_epoch_micros(epoch_millis("ts") * F.lit(1000))).alias("ok"))


@register("year_month", "X4 X5", """
SELECT o_orderkey,
       strftime(o_orderdate - INTERVAL 11 MONTH, '%Y-%m') AS ym_first,
       strftime(o_orderdate, '%Y-%m') AS ym_last,
       CAST(date_trunc('month', o_orderdate - INTERVAL 11 MONTH) AS DATE) AS fra,
       last_day(o_orderdate) AS til,
       CAST(12 AS INTEGER) AS n_maaneder
FROM orders""")
def q_year_month(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    ym = o.select("o_orderkey",
                  D.year_month(F.add_months(F.to_date("o_orderdate"), -11)).alias("ym_first"),
                  D.year_month("o_orderdate").alias("ym_last"))
    return ym.select("*", D.month_start("ym_first").alias("fra"), D.month_end("ym_last").alias("til"),
                     D.months_inclusive("ym_first", "ym_last").alias("n_maaneder"))


def _docs(spark, sf_dir, kind="headers"):
    return documents.decode_documents(standins.payload_table(spark, sf_dir, kind))


# One header per order; its income is the sum over all lines. Orders whose text is cut off decode to nulls.
SQL_DOC_BASE = f"""
WITH l AS (SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(20,2))) AS s, count(*) AS n FROM lineitem GROUP BY l_orderkey),
d AS (SELECT o.*, l.s, l.n, o_orderkey % {standins.CUT_OFF[0]} = {standins.CUT_OFF[1]} AS cut_off,
             o_orderkey % {standins.BAD_RATE[0]} = {standins.BAD_RATE[1]}
             AND o_orderkey % {standins.CUT_OFF[0]} <> {standins.CUT_OFF[1]} AS bad_rate
      FROM orders o LEFT JOIN l ON o.o_orderkey = l.l_orderkey)"""

_DAGSATS = f"CAST(floor(o_totalprice / {float(standins.WORKDAYS)}) AS INTEGER)"
_INCOME = "CAST(CAST(s AS DECIMAL(20,2)) AS VARCHAR)"


def _sql_uid(k: int) -> str:
    return standins.sql_ulid_parts("(epoch_us(o_orderdate) // 1000)", f"o_orderkey * 10 + {k}", "0")


_FLAT = {
    "id": _sql_uid(0),
    "behov_id": standins.sql_ulid_parts("(epoch_us(o_orderdate) // 1000)", "o_custkey", "0"),
    "created_at": "make_timestamp((epoch_us(o_orderdate) // 1000) * 1000)",
    "aktor_id": "lpad(CAST(o_custkey AS VARCHAR), 13, '0')",
    "vedtak_id": "o_orderkey",
    "beregningsdato": "CAST(o_orderdate AS DATE)",
    "inntekts_id": _sql_uid(1),
    "inntekt_avvik": "o_orderpriority = '1-URGENT'",
    "inntekt_manuelt_redigert": "o_orderstatus = 'F'",
    "antall_barn": "CAST(o_custkey % 4 AS INTEGER)",
    "avkortet_raw": f"COALESCE({_INCOME}, '{standins.UNKNOWN_INCOME}')",
    "avkortet": "CAST(s AS DECIMAL(20,2))",
    "uavkortet": "CAST(s AS DECIMAL(20,2))",
    "har_avkortet": "false",
    "beregningsregel": f"'{standins.BEREGNINGSREGEL}'",
    "oppfyller_minsteinntekt": f"s >= {standins.MIN_INCOME}",
    "periode_antall_uker": f"CASE WHEN s >= {standins.MIN_INCOME} THEN 52 ELSE 26 END",
    "dagsats": f"CASE WHEN NOT bad_rate THEN {_DAGSATS} END",
    "ukesats": f"5 * {_DAGSATS}",
    "benyttet_90_prosent_regel": "false",
    **{f"{name}_{col}": value for name, k in (("grunnlag", 2), ("minsteinntekt", 4), ("periode", 6), ("sats", 8))
       for col, value in (("sporings_id", _sql_uid(k)), ("subsumsjons_id", _sql_uid(k + 1)),
                          ("regel", f"'{name.capitalize()}'"), ("versjon", "'v1'"))},
    "n_perioder": "CASE WHEN n IS NULL THEN 0 END",
}


@register("flatten_doc", "F6 X6 X7 X9 X3 S3", SQL_DOC_BASE + "\nSELECT " + ",\n       ".join(
    f"CASE WHEN NOT cut_off THEN {sql} END AS {col}" for col, sql in _FLAT.items()) + ",\n       cut_off OR bad_rate AS corrupt\nFROM d")
def q_flatten_doc(spark, sf_dir):
    return documents.flatten_document(_docs(spark, sf_dir))


@register("decimal_parse", "X3", SQL_DOC_BASE + f"""
SELECT CASE WHEN NOT cut_off THEN o_orderkey END AS vedtak_id,
       CASE WHEN NOT cut_off THEN COALESCE({_INCOME}, '{standins.UNKNOWN_INCOME}') END AS avkortet_raw,
       CASE WHEN NOT cut_off THEN CAST(s AS DECIMAL(20,2)) END AS avkortet,
       s IS NULL AND NOT cut_off AS avkortet_bad
FROM d""")
def q_decimal_parse(spark, sf_dir):
    d = _docs(spark, sf_dir)
    raw = F.col("doc.grunnlagResultat.avkortet")
    return d.select(F.col("doc.faktum.vedtakId").alias("vedtak_id"), raw.alias("avkortet_raw"),
                    D.decimal_or_null(raw).alias("avkortet"), D.decimal_is_bad(raw).alias("avkortet_bad"))


def _sql_periods(share: str) -> str:
    """Every line, and one row of nulls for an order whose readable header says it has none."""
    return f"""
SELECT coalesce(l.l_orderkey, o.o_orderkey) AS vedtak_id,
       l.l_linenumber AS periode,
       CAST(CAST(l.l_extendedprice AS DECIMAL(20,2)) AS VARCHAR) AS inntekt_raw,
       CAST(l.l_extendedprice AS DECIMAL(20,2)) AS inntekt,{share}
       CAST(date_trunc('month', l.l_shipdate + to_months(CAST(l.l_linenumber - 12 AS INTEGER))) AS DATE) AS fra,
       last_day(l.l_shipdate) AS til,
       CAST(13 - l.l_linenumber AS INTEGER) AS n_maaneder,
       l.l_returnflag = 'R' AS fangst_og_fisk
FROM orders o FULL JOIN lineitem l ON o.o_orderkey = l.l_orderkey
WHERE l.l_orderkey IS NOT NULL OR o.o_orderkey % {standins.CUT_OFF[0]} <> {standins.CUT_OFF[1]}"""


def _periods(spark, sf_dir, field):
    """Periods of the period documents, and a row of nulls for each header that says it has none."""
    first = "grunnlagResultat.grunnlagInntektsPerioder"

    def docs(kind, *lists):     # only what is read of a document is typed
        return standins.payload_table(spark, sf_dir, kind).select(D.parse_json("payload", period_lists_ddl(*lists)).alias("doc"))

    no_lines = docs("headers", first, field).where(F.size(F.col(f"doc.{first}")) == 0)
    return documents.explode_periods(docs("periods", field), field=field) \
        .unionByName(documents.explode_periods(no_lines, field=field))


@register("explode_periods", "X8 X4 X5 X3", _sql_periods(""))
def q_explode_periods(spark, sf_dir):
    return _periods(spark, sf_dir, "grunnlagResultat.grunnlagInntektsPerioder")


@register("explode_min_periods", "X8 X3", _sql_periods("""
       CAST(CAST(CAST(l.l_extendedprice AS DECIMAL(20,2)) * 0.50 AS DECIMAL(20,2)) AS VARCHAR) AS andel_raw,
       CAST(CAST(l.l_extendedprice AS DECIMAL(20,2)) * 0.50 AS DECIMAL(20,2)) AS andel,"""))
def q_explode_min_periods(spark, sf_dir):
    return _periods(spark, sf_dir, "minsteinntektResultat.minsteinntektInntektsPerioder")
