"""Scalar decoders (X1, X3-X7, X9): plain Spark expressions, no UDFs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import CORRUPT
from .timefn import epoch_millis, from_epoch_micros


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ------------------------------------------------------------------ X1 JSON

def parse_json(text: Column | str, ddl: str) -> Column:
    """JSON text -> struct (PERMISSIVE). Bad text keeps its raw form in
    ``_corrupt_record`` when the schema has that field; nothing is lost."""
    opts = {"mode": "PERMISSIVE"}
    if CORRUPT in ddl:
        opts["columnNameOfCorruptRecord"] = CORRUPT
    return F.from_json(_c(text), ddl, opts)


# ------------------------------------------------------------------ X3 decimals

def decimal_or_null(text: Column | str, precision: int = 20, scale: int = 2) -> Column:
    """Decimal carried as a string -> ``DECIMAL(p, s)``; bad or out-of-range input -> null."""
    return _c(text).try_cast(f"decimal({precision},{scale})")


def decimal_is_bad(text: Column | str, precision: int = 20, scale: int = 2) -> Column:
    """True where the text is present but does not decode (the error flag)."""
    t = _c(text)
    return t.isNotNull() & decimal_or_null(t, precision, scale).isNull()


# ------------------------------------------------------------------ X4 X5 X6 months and dates

def month_start(ym: Column | str) -> Column:
    """``yyyy-MM`` -> first day of that month (``DATE``); bad text -> null."""
    return F.try_to_timestamp(_c(ym), F.lit("yyyy-MM")).cast("date")


def month_end(ym: Column | str) -> Column:
    """``yyyy-MM`` -> last day of that month (inclusive end of a span)."""
    return F.last_day(month_start(ym))


def months_inclusive(first_ym: Column | str, last_ym: Column | str) -> Column:
    """Number of months in the inclusive span ``first .. last`` (``2018-05..2019-04`` -> 12)."""
    a, b = month_start(first_ym), month_start(last_ym)
    return ((F.year(b) * 12 + F.month(b)) - (F.year(a) * 12 + F.month(a)) + 1).cast("int")


def iso_date(text: Column | str) -> Column:
    return F.try_to_timestamp(_c(text), F.lit("yyyy-MM-dd")).cast("date")


def year_month(ts: Column | str) -> Column:
    """Date or timestamp -> ``yyyy-MM`` (no session zone involved)."""
    from .timefn import year_month_text
    return year_month_text(_c(ts))


# ------------------------------------------------------------------ X7 ULID

# The Crockford base-32 alphabet of ULIDs, and the letters of
# Spark's base-32 digits (0-9A-V) that differ from it, in order.
CROCKFORD = "0123456789ABCDEFGHJKMNPQRSTVWXYZ"
_CONV_LETTERS = "IJKLMNOPQRSTUV"
_CROCK_LETTERS = "JKMNPQRSTVWXYZ"


def ulid_millis(ulid: Column | str) -> Column:
    """The 48-bit creation time (ms since epoch) in the first 10 characters.

    Decoding reads I and L as 1 and O as 0, as the alphabet prescribes.
    """
    head = F.upper(F.substring(_c(ulid), 1, 10))
    head = F.translate(head, "ILO", "110")
    digits = F.translate(head, _CROCK_LETTERS, _CONV_LETTERS)
    return F.conv(digits, 32, 10).try_cast("bigint")


def ulid_time(ulid: Column | str) -> Column:
    """ULID -> creation time as wall-clock UTC ``TIMESTAMP_NTZ`` (ms precision)."""
    return from_epoch_micros(ulid_millis(ulid) * F.lit(1000))


def _base32(n: Column, width: int) -> Column:
    return F.lpad(F.translate(F.conv(n.cast("string"), 10, 32), _CONV_LETTERS, _CROCK_LETTERS), width, "0")


def ulid_head(millis: Column) -> Column:
    """The 10-character time part of a ULID."""
    return _base32(millis, 10)


def ulid_with_head(head: Column, seed: Column) -> Column:
    """A ULID from a precomputed time part; the 80-bit tail is the non-negative
    ``seed`` in base 32. (Real ULIDs carry random bits there; a deterministic
    tail keeps re-runs identical.) Several ids of one row share one head."""
    return F.concat(head, _base32(seed, 16))


def ulid_with_parts(head: Column, hi: Column, lo: Column) -> Column:
    """A ULID whose 80-bit tail is two non-negative numbers: ``hi`` (< 2^45,
    9 digits) and ``lo`` (< 2^35, 7 digits)."""
    return F.concat(head, _base32(hi, 9), _base32(lo, 7))


def ulid_encode(millis: Column, seed: Column) -> Column:
    """A ULID with the given ms time and tail ``seed``."""
    return ulid_with_head(ulid_head(millis), seed)


def ulid_of_time(ts: Column | str, seed: Column) -> Column:
    return ulid_encode(epoch_millis(ts), seed)


# ------------------------------------------------------------------ X9 versioned rule names

def rule_name(identifier: Column | str) -> Column:
    """``Grunnlag.v1`` -> ``Grunnlag``."""
    return F.split_part(_c(identifier), F.lit("."), F.lit(1))


def rule_version(identifier: Column | str) -> Column:
    """``Grunnlag.v1`` -> ``v1`` (empty when there is no version)."""
    return F.split_part(_c(identifier), F.lit("."), F.lit(2))
