"""Rule-evaluation documents: decode, flatten, explode.

``decode_documents`` parses the JSON text once with the explicit schema
(PERMISSIVE: unparsable text stays in ``_corrupt_record``), after which every
operator is a projection over nested fields -- Parquet-style nested column
pruning applies when the parsed frame is cached or written.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import decode as D
from ..schemas import CORRUPT, DOCUMENT_DDL, DOCUMENT_DDL_PERMISSIVE, document_ddl


def decode_documents(df: DataFrame, text: str = "payload", out: str = "doc",
                     fields: tuple[str, ...] | None = None) -> DataFrame:
    """JSON text -> struct column ``doc``.

    ``fields`` restricts parsing to those top-level fields (Spark does not
    prune a ``from_json`` schema that carries a corrupt-record column).
    """
    ddl = DOCUMENT_DDL_PERMISSIVE if fields is None else document_ddl(fields)
    return df.withColumn(out, D.parse_json(text, ddl))


def decode_fields(df: DataFrame, text: str = "payload", out: str = "doc", wrong: str = "wrong_fields",
                  unreadable: str = "unreadable", ddl: str = DOCUMENT_DDL) -> DataFrame:
    """JSON text -> struct column ``doc`` with the fields of a wrong type by name.

    A field of the wrong type is null and its path is listed in ``wrong``,
    while all others keep their values: a number must be a whole number that
    fits, a flag a boolean, a date a ``yyyy-MM-dd`` string; a text takes any
    value. ``null`` and a missing field are both null and never wrong. Fields
    of list entries are listed once, as ``path[].field``. ``unreadable`` marks
    texts that are no JSON (cut off, or with a key twice): nothing is listed
    for them. A null text is a null document.

    All texts are parsed once with the schema. Only those the parser flags are
    parsed again, to a VARIANT, and a field that is there but was not typed is
    a wrong one.
    """
    keep = [F.col(c) for c in df.columns]
    parsed = D.parse_json(text, f"{ddl}, {CORRUPT} string")
    stages: list[tuple[str, Column]] = [("__doc", parsed), ("__v1", F.when(F.col("__doc")[CORRUPT].isNotNull(), F.try_parse_json(text)))]

    def stage(expr: Callable[[Column | None], Column]) -> _Accessor:
        name = f"__v{len(stages)}"
        stages.append((name, expr(None)))
        return lambda _: F.col(name)

    bad = _wrong(lambda _: F.col("__v1"), lambda _: F.col("__doc"), T.StructType.fromDDL(ddl), "", stage, stages)(None)
    for k, (name, expr) in enumerate(stages):       # a projection each: what an object holds is taken from it once
        df = df.select(*keep, *(F.col(n) for n, _ in stages[:k]), expr.alias(name))
    flags = F.array(*(c for c in bad if not isinstance(c, _Entries)))
    entries = [c.column for c in bad if isinstance(c, _Entries)]
    none = F.array().cast("array<string>")
    listed = F.when(F.col("__v1").isNull(), none).otherwise(F.array_distinct(F.array_compact(F.concat(flags, *entries))))
    return df.select(*keep, F.col("__doc").alias(out), listed.alias(wrong),
                     F.coalesce(F.col("__doc")[CORRUPT].isNotNull() & F.col("__v1").isNull(), F.lit(False)).alias(unreadable))


#: a column; of an entry of a list by its index
_Accessor = Callable[[Column | None], Column]


@dataclass(frozen=True)
class _Entries:
    """Wrong fields of the entries of a list, as an array column."""
    column: Column


def _wrong(at: _Accessor, typed: _Accessor, kind: T.DataType, label: str, stage, stages) -> Callable:
    """What is there in a variant and missing in its typed form: a list of label columns, null where all is well."""
    def lost(i):
        return F.when(at(i).isNotNull() & ~F.is_variant_null(at(i)) & typed(i).isNull(), label or "$")

    if isinstance(kind, T.StructType):
        fields = ", ".join(f"`{f.name}`: variant" for f in kind)
        held = stage(lambda i: F.try_variant_get(at(i), "$", f"struct<{fields}>"))

        def not_an_object(i):       # the parser gives a struct of nulls for some of these
            return F.when(at(i).isNotNull() & ~F.is_variant_null(at(i)) & held(i).isNull(), label or "$")

        parts = [_wrong(lambda i, n=f.name: held(i)[n], lambda i, n=f.name: typed(i)[n], f.dataType,
                        f"{label}.{f.name}" if label else f.name, stage, stages)
                 for f in kind if not isinstance(f.dataType, T.StringType)]
        return lambda i: [not_an_object(i), *(c for p in parts for c in p(i))]
    if isinstance(kind, T.ArrayType):
        items = stage(lambda i: F.try_variant_get(at(i), "$", "array<variant>"))

        def by_entry(expr):
            name = f"__v{len(stages)}"
            stages.append((name, F.transform(items(None), lambda e, i: expr(i))))
            return lambda i: F.get(F.col(name), i)

        inner = _wrong(lambda i: F.get(items(None), i), lambda i: F.get(typed(None), i), kind.elementType, label + "[]", by_entry, stages)
        each = F.flatten(F.transform(items(None), lambda e, i: F.array(*inner(i))))
        return lambda _: [F.when(at(None).isNotNull() & ~F.is_variant_null(at(None)) & items(None).isNull(), label),
                          _Entries(F.coalesce(each, F.array().cast("array<string>")))]
    return lambda i: [lost(i)]


def flatten_document(df: DataFrame, doc: str = "doc", keep: tuple[str, ...] = ()) -> DataFrame:
    """One flat row per document."""
    d = F.col(doc)
    g, m, p, s, f = (d[x] for x in ("grunnlagResultat", "minsteinntektResultat",
                                     "periodeResultat", "satsResultat", "faktum"))
    return df.select(
        *keep,
        d["id"].alias("id"),
        d["behovId"].alias("behov_id"),
        D.ulid_time(d["id"]).alias("created_at"),
        f["aktorId"].alias("aktor_id"),
        f["vedtakId"].alias("vedtak_id"),
        f["beregningsdato"].alias("beregningsdato"),
        f["inntektsId"].alias("inntekts_id"),
        f["inntektAvvik"].alias("inntekt_avvik"),
        f["inntektManueltRedigert"].alias("inntekt_manuelt_redigert"),
        f["antallBarn"].alias("antall_barn"),
        g["avkortet"].alias("avkortet_raw"),
        D.decimal_or_null(g["avkortet"]).alias("avkortet"),
        D.decimal_or_null(g["uavkortet"]).alias("uavkortet"),
        g["harAvkortet"].alias("har_avkortet"),
        g["beregningsregel"].alias("beregningsregel"),
        m["oppfyllerMinsteinntekt"].alias("oppfyller_minsteinntekt"),
        p["periodeAntallUker"].alias("periode_antall_uker"),
        s["dagsats"].alias("dagsats"),
        s["ukesats"].alias("ukesats"),
        s["benyttet90ProsentRegel"].alias("benyttet_90_prosent_regel"),
        *(c for name, part in (("grunnlag", g), ("minsteinntekt", m), ("periode", p), ("sats", s)) for c in (
            part["sporingsId"].alias(f"{name}_sporings_id"),
            part["subsumsjonsId"].alias(f"{name}_subsumsjons_id"),
            D.rule_name(part["regelIdentifikator"]).alias(f"{name}_regel"),
            D.rule_version(part["regelIdentifikator"]).alias(f"{name}_versjon"))),
        F.size(g["grunnlagInntektsPerioder"]).alias("n_perioder"),
        d[CORRUPT].isNotNull().alias("corrupt"),
    )


def explode_periods(df: DataFrame, doc: str = "doc", key: str = "vedtak_id",
                    field: str = "grunnlagResultat.grunnlagInntektsPerioder") -> DataFrame:
    """Array of income periods -> one row each (X8), documents with an empty
    list kept as one row of nulls (``inline_outer``); months decoded (X4, X5).
    A list whose periods have a share (``andel``) gives it as text and decimal."""
    arr = F.col(doc)
    for part in field.split("."):
        arr = arr[part]
    base = df.select(F.col(doc)["faktum"]["vedtakId"].alias(key), F.inline_outer(arr))
    ip = F.col("inntektsPeriode")
    first, last = ip["førsteMåned"], ip["sisteMåned"]
    share = [F.col("andel").alias("andel_raw"), D.decimal_or_null("andel").alias("andel")] if "andel" in base.columns else []
    return base.select(
        key, "periode",
        F.col("inntekt").alias("inntekt_raw"),
        D.decimal_or_null("inntekt").alias("inntekt"),
        *share,
        D.month_start(first).alias("fra"),
        D.month_end(last).alias("til"),
        D.months_inclusive(first, last).alias("n_maaneder"),
        F.col("inneholderFangstOgFisk").alias("fangst_og_fisk"),
    )
