"""Decoders (X1, X3-X9) and the rule-document pipeline on a literal document of the same shape."""

from __future__ import annotations

import datetime as dt
import json
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerlight.functions import decode as D
from ledgerlight.functions.templates import render, template_parts
from ledgerlight.operators import documents

CROCKFORD = "0123456789ABCDEFGHJKMNPQRSTVWXYZ"


def py_ulid_ms(u: str) -> int:
    """Independent decoder for the test: base-32 digits, most significant first."""
    v = 0
    for ch in u[:10].upper().replace("I", "1").replace("L", "1").replace("O", "0"):
        v = v * 32 + CROCKFORD.index(ch)
    return v


def py_ulid(ms: int, seed: int) -> str:
    def b32(n, width):
        s = ""
        while n:
            s = CROCKFORD[n % 32] + s
            n //= 32
        return s.rjust(width, "0")
    return b32(ms, 10) + b32(seed, 16)


def period(income, no, last, first):
    return {"inntekt": income, "periode": no,
            "inntektsPeriode": {"sisteMåned": last, "førsteMåned": first}, "inneholderFangstOgFisk": False}


ID = py_ulid(1_600_000_000_123, 42)
DOC = {
    "id": ID, "behovId": py_ulid(1_600_000_000_000, 7),
    "faktum": {"aktorId": "0012345678901", "vedtakId": 987, "beregningsdato": "2020-09-13",
               "inntektsId": py_ulid(1_600_000_000_001, 1), "inntektAvvik": True,
               "inntektManueltRedigert": False, "antallBarn": 2},
    "grunnlagResultat": {"avkortet": "1234.5", "uavkortet": "99999999999999999999999", "sporingsId": ID,
                         "harAvkortet": True, "subsumsjonsId": ID, "beregningsregel": "Regel",
                         "regelIdentifikator": "Grunnlag.v2",
                         "grunnlagInntektsPerioder": [period("1000", 1, "2020-08", "2019-09"),
                                                      period("abc", 2, "2019-08", "2018-09")]},
    "minsteinntektResultat": {"sporingsId": ID, "subsumsjonsId": ID, "regelIdentifikator": "Minsteinntekt",
                              "oppfyllerMinsteinntekt": True, "minsteinntektInntektsPerioder": []},
    "periodeResultat": {"sporingsId": ID, "subsumsjonsId": ID, "periodeAntallUker": 26,
                        "regelIdentifikator": "Periode.v1"},
    "satsResultat": {"dagsats": 100, "ukesats": 500, "sporingsId": ID, "subsumsjonsId": ID,
                     "regelIdentifikator": "Sats.v3", "benyttet90ProsentRegel": False},
}


def docs(spark):
    rows = [(1, json.dumps(DOC, ensure_ascii=False)), (2, "{not json"),
            (3, json.dumps({"id": ID, "grunnlagResultat": {"grunnlagInntektsPerioder": []}}))]
    return documents.decode_documents(spark.createDataFrame(rows, "n int, payload string"))


def test_flatten_document(spark):
    got = {r.n: r for r in documents.flatten_document(docs(spark), keep=("n",)).collect()}
    a = got[1]
    assert a.aktor_id == "0012345678901"                       # leading zero kept
    assert a.vedtak_id == 987 and a.antall_barn == 2
    assert a.beregningsdato == dt.date(2020, 9, 13)
    assert a.avkortet == Decimal("1234.50") and a.avkortet_raw == "1234.5"
    assert (a.grunnlag_regel, a.grunnlag_versjon, a.sats_regel, a.sats_versjon) == ("Grunnlag", "v2", "Sats", "v3")
    assert a.created_at == dt.datetime(2020, 9, 13, 12, 26, 40, 123000)
    assert a.n_perioder == 2 and a.corrupt is False
    assert got[2].corrupt is True and got[2].vedtak_id is None   # bad text kept, not lost
    assert got[3].corrupt is False and got[3].n_perioder == 0


def test_explode_periods_keeps_empty_lists(spark):
    out = documents.explode_periods(docs(spark)).collect()
    rows = sorted((r.vedtak_id or 0, r.periode or 0, r.inntekt, r.fra, r.til, r.n_maaneder) for r in out)
    assert (987, 1, Decimal("1000.00"), dt.date(2019, 9, 1), dt.date(2020, 8, 31), 12) in rows
    assert (987, 2, None, dt.date(2018, 9, 1), dt.date(2019, 8, 31), 12) in rows   # bad income -> null
    assert len(out) == 4            # two periods, one corrupt doc, one doc with an empty list


def test_decimal_flags_bad_and_overflowing_text(spark):
    df = spark.createDataFrame([("150000",), ("1e3",), ("12,5",), ("",), (None,), ("99999999999999999999999",)], "t string")
    got = [(r.d, r.bad) for r in df.select(D.decimal_or_null("t").alias("d"), D.decimal_is_bad("t").alias("bad")).collect()]
    assert got == [(Decimal("150000.00"), False), (Decimal("1000.00"), False), (None, True), (None, True),
                   (None, False), (None, True)]


def test_months(spark):
    df = spark.createDataFrame([("2018-05", "2019-04"), ("2019-02", "2019-02"), ("2019-13", "2019-01")], "a string, b string")
    got = [(r.s, r.e, r.n) for r in df.select(D.month_start("a").alias("s"), D.month_end("b").alias("e"),
                                              D.months_inclusive("a", "b").alias("n")).collect()]
    assert got == [(dt.date(2018, 5, 1), dt.date(2019, 4, 30), 12), (dt.date(2019, 2, 1), dt.date(2019, 2, 28), 1),
                   (None, dt.date(2019, 1, 31), None)]


def test_ulid_round_trip_and_independent_decode(spark):
    stamps = [dt.datetime(2019, 5, 22, 14, 1, 12, 909000), dt.datetime(1999, 12, 31, 23, 59, 59, 999999),
              dt.datetime(2030, 1, 1)]
    df = spark.createDataFrame([(t, i) for i, t in enumerate(stamps)], "t timestamp, i long") \
        .withColumn("t", F.col("t").cast("timestamp_ntz"))
    out = df.select("t", "i", D.ulid_of_time("t", F.col("i")).alias("u")).withColumn("back", D.ulid_time("u")).collect()
    for r in out:
        ms = (int((r.t - dt.datetime(1970, 1, 1)) / dt.timedelta(microseconds=1))) // 1000
        assert r.u == py_ulid(ms, r.i) and len(r.u) == 26
        assert py_ulid_ms(r.u) == ms
        assert r.back == dt.datetime(1970, 1, 1) + dt.timedelta(milliseconds=ms)
    lower = spark.createDataFrame([(ID.lower().replace("1", "l"),)], "u string").select(D.ulid_millis("u")).first()[0]
    assert lower == 1_600_000_000_123


def test_parse_json_permissive(spark):
    from ledgerlight.schemas import PROPS_DDL
    df = spark.createDataFrame([('{"k": 5}',), ("{k:",), ('{"k": "x"}',)], "p string")
    got = [(r.v.k, r.v._corrupt_record is not None) for r in df.select(D.parse_json("p", PROPS_DDL).alias("v")).collect()]
    assert got[0] == (5, False) and got[1] == (None, True)


def test_templates(spark):
    t = "Sjekk \\{{ $labels.app }} i {{$labels.ns}}!"
    assert template_parts(t) == [("text", "Sjekk "), ("label", "app"), ("text", " i "), ("label", "ns"), ("text", "!")]
    df = spark.createDataFrame([("a", "n"), ("b", None)], "app string, ns string")
    assert [r.x for r in df.select(render(t).alias("x")).collect()] == ["Sjekk a i n!", "Sjekk b i !"]
    assert df.select(render(None).alias("x")).first().x is None


def test_entry_totals_and_bounded_period_lists(spark):
    """1, 16, 17 and 100,000 lines per entry: the true sum and decision, lists of at most 16."""
    from ledgerlight.plans import standins
    counts = {1: 1, 2: 16, 3: 17, 4: 100_000, 5: 0}
    line = "l_orderkey long, l_linenumber int, l_extendedprice double, l_shipdate timestamp_ntz, l_returnflag string"
    li = spark.createDataFrame([], line)
    for k, n in counts.items():
        li = li.union(spark.range(n).selectExpr(f"{k}L", "cast(id + 1 as int)", "9000D", "timestamp_ntz'1996-05-05 00:00:00'", "'R'"))
    o = spark.range(1, 6).selectExpr("id as o_orderkey", "id as o_custkey", "'P' as o_orderstatus", "26000D as o_totalprice",
                                     "timestamp_ntz'1996-01-01 00:00:00' as o_orderdate", "'1-URGENT' as o_orderpriority")
    flat = documents.flatten_document(documents.decode_documents(standins.header_documents(o, li)), keep=("o_orderkey",))
    got = {r.o_orderkey: (r.avkortet, r.oppfyller_minsteinntekt, r.periode_antall_uker) for r in flat.collect()}
    assert got == {1: (9000, False, 26), 2: (144000, False, 26), 3: (153000, True, 52), 4: (900_000_000, True, 52),
                   5: (None, None, 26)}
    docs = documents.decode_documents(standins.period_documents(li))
    assert docs.select(F.max(F.size("doc.grunnlagResultat.grunnlagInntektsPerioder"))).first()[0] <= 16
    assert documents.explode_periods(docs).count() == li.count()
    assert docs.select("doc.id").distinct().count() == docs.count()          # ids stay unique
    shares = documents.explode_periods(docs, field="minsteinntektResultat.minsteinntektInntektsPerioder")
    assert shares.select("andel").distinct().collect()[0][0] == Decimal("4500.00")


def test_iso_date(spark):
    df = spark.createDataFrame([("2019-05-08",), ("2019-02-30",), ("08.05.2019",)], "t string")
    assert [r.d for r in df.select(D.iso_date("t").alias("d")).collect()] == [dt.date(2019, 5, 8), None, None]


def test_documents_are_made_by_all_cores_whatever_the_row_groups(spark, tmp_path):
    """One file with one row group each: the texts are still made in as many tasks as there are cores."""
    from ledgerlight.plans import standins
    spark.range(500).selectExpr("id div 4 as l_orderkey", "id % 4 as l_linenumber", "1.0D * id as l_extendedprice",
                                "timestamp_ntz'2024-02-03 00:00:00' as l_shipdate", "'R' as l_returnflag") \
        .coalesce(1).write.parquet(f"{tmp_path}/lineitem")
    li = spark.read.parquet(f"{tmp_path}/lineitem")
    cores = spark.sparkContext.defaultParallelism
    assert cores > 1 and li.rdd.getNumPartitions() == 1
    docs = standins.period_documents(li)
    assert docs.rdd.getNumPartitions() >= cores and docs.count() == 125


def test_period_lists_are_read_without_typing_the_rest(spark):
    """A narrow parse gives the periods of a document as the whole schema does, broken texts included."""
    from ledgerlight.functions import decode as D
    from ledgerlight.schemas import DOCUMENT_DDL_PERMISSIVE, PERIOD_LISTS, period_lists_ddl
    line = '{"inntekt":"12.50","periode":3,"inntektsPeriode":{"sisteMåned":"2024-02","førsteMåned":"2023-03"},"inneholderFangstOgFisk":true}'
    texts = ['{"id":"a","faktum":{"aktorId":"x","vedtakId":7},"grunnlagResultat":{"avkortet":"1","grunnlagInntektsPerioder":[%s,%s]},'
             '"minsteinntektResultat":{"minsteinntektInntektsPerioder":[{"andel":"1.00","inntekt":"2"}]}}' % (line, line),
             '{"faktum":{"vedtakId":8},"grunnlagResultat":{"grunnlagInntektsPerioder":[]},"satsResultat":{"dagsats":"abc"}}',
             '{"faktum":{"vedtakId":"nine"},"grunnlagResultat":{"grunnlagInntektsPerioder":[%s]}}' % line,
             '{"faktum":{"vedtakId":10},"grunnlagResultat":{"grunnlagInn', "", "[]", "null", None]
    df = spark.createDataFrame([(t,) for t in texts], "payload string")
    for path in PERIOD_LISTS:
        got, want = (documents.explode_periods(df.select(D.parse_json("payload", ddl).alias("doc")), field=path).collect()
                     for ddl in (period_lists_ddl(path), DOCUMENT_DDL_PERMISSIVE))
        assert sorted(map(repr, got)) == sorted(map(repr, want)) and len(got) >= 8
