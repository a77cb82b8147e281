"""Explicit schemas, kept in one place (never inferred on a stream).

The rule-evaluation document follows the one sample document of the
reference: every field nullable, decimals carried as JSON strings (kept raw,
decoded with ``try_cast``), months as ``yyyy-MM`` strings, ids as ULIDs.
Non-ASCII field names are back-quoted in DDL.
"""

from __future__ import annotations

from pyspark.sql import types as T

#: the column that keeps unparsable text (PERMISSIVE parsing)
CORRUPT = "_corrupt_record"

PERIOD_DDL = ("struct<inntekt: string, periode: int, "
              "inntektsPeriode: struct<`sisteMåned`: string, `førsteMåned`: string>, "
              "inneholderFangstOgFisk: boolean>")
MIN_PERIOD_DDL = ("struct<andel: string, inntekt: string, periode: int, "
                  "inntektsPeriode: struct<`sisteMåned`: string, `førsteMåned`: string>, "
                  "inneholderFangstOgFisk: boolean>")

#: top-level fields of the document, in document order
DOCUMENT_FIELDS = {
    "id": "string",
    "behovId": "string",
    "faktum": ("struct<aktorId: string, vedtakId: bigint, beregningsdato: date, inntektsId: string, "
               "inntektAvvik: boolean, inntektManueltRedigert: boolean, antallBarn: int>"),
    "grunnlagResultat": ("struct<avkortet: string, uavkortet: string, sporingsId: string, harAvkortet: boolean, "
                         "subsumsjonsId: string, beregningsregel: string, regelIdentifikator: string, "
                         f"grunnlagInntektsPerioder: array<{PERIOD_DDL}>>"),
    "minsteinntektResultat": ("struct<sporingsId: string, subsumsjonsId: string, regelIdentifikator: string, "
                              "oppfyllerMinsteinntekt: boolean, "
                              f"minsteinntektInntektsPerioder: array<{MIN_PERIOD_DDL}>>"),
    "periodeResultat": ("struct<sporingsId: string, subsumsjonsId: string, periodeAntallUker: int, "
                        "regelIdentifikator: string>"),
    "satsResultat": ("struct<dagsats: int, ukesats: int, sporingsId: string, subsumsjonsId: string, "
                     "regelIdentifikator: string, benyttet90ProsentRegel: boolean>"),
}
DOCUMENT_DDL = ", ".join(f"{k} {v}" for k, v in DOCUMENT_FIELDS.items())


def document_ddl(fields=None, corrupt: bool = True) -> str:
    """DDL of the document restricted to some top-level ``fields`` (all by default).

    Parsing only what a plan reads saves most of the JSON work; fields left
    out are not type-checked.
    """
    keep = [f for f in DOCUMENT_FIELDS if fields is None or f in fields]
    unknown = set(fields or ()) - set(DOCUMENT_FIELDS)
    if unknown:
        raise ValueError(f"unknown document fields: {sorted(unknown)}")
    ddl = ", ".join(f"{k} {DOCUMENT_FIELDS[k]}" for k in keep)
    return ddl + (f", {CORRUPT} string" if corrupt else "")


DOCUMENT_DDL_PERMISSIVE = document_ddl()

#: the two lists of income periods, by path
PERIOD_LISTS = {"grunnlagResultat.grunnlagInntektsPerioder": PERIOD_DDL,
                "minsteinntektResultat.minsteinntektInntektsPerioder": MIN_PERIOD_DDL}


def period_lists_ddl(*lists: str) -> str:
    """DDL of the document restricted to its ``vedtakId`` and some of :data:`PERIOD_LISTS`."""
    parts = (path.split(".") + [PERIOD_LISTS[path]] for path in PERIOD_LISTS if path in lists)
    return "faktum struct<vedtakId: bigint>, " + "".join(f"{part} struct<{name}: array<{ddl}>>, " for part, name, ddl in parts) \
        + f"{CORRUPT} string"


#: the small JSON object in ``events.props``
PROPS_DDL = f"k int, {CORRUPT} string"

#: journal entry as JSON (generic stand-in: the record schema of the stream is absent)
JOURNAL_DDL = f"key bigint, status string, version timestamp_ntz, payload string, {CORRUPT} string"

#: long metric samples (FIXTURES 2): one row per (metric, label set, time)
SAMPLES_SCHEMA = T.StructType([
    T.StructField("metric", T.StringType()),
    T.StructField("labels", T.MapType(T.StringType(), T.StringType())),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("value", T.DoubleType()),
])

EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])

ORDERS_SCHEMA = T.StructType([
    T.StructField("o_orderkey", T.LongType()),
    T.StructField("o_custkey", T.LongType()),
    T.StructField("o_orderstatus", T.StringType()),
    T.StructField("o_totalprice", T.DoubleType()),
    T.StructField("o_orderdate", T.TimestampNTZType()),
    T.StructField("o_orderpriority", T.StringType()),
])
