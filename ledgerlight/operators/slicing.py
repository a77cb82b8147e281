"""Split long series into time slices so one hot series never lands in one task.

A range-framed window over ``(series) ORDER BY t`` only ever looks a bounded
distance back (``lookback``). We therefore partition by ``(series, slice)``
where ``slice = floor(t / slice_len)`` and copy the rows of the last
``lookback`` before each slice start into that slice as well. Each row is
computed in exactly one slice (its own, ``__own``); the copies only feed the
frames of owned rows. Results are exact, and a series holding a third of all
rows is spread over ``span / slice_len`` tasks instead of one.

Extra rows: ``lookback / slice_len`` of the input (about 1/``factor``).

Slices of a fixed length do not help a series that is dense within one of
them. :func:`add_density_slices` cuts by counted rows instead: a histogram of
each series over short buckets gives cut points such that a slice holds about
``rows_per_slice`` rows of its own, whatever the time they span. That costs a
second pass over the keys and times; a slice still copies the look-back, so it
is made no smaller than the rows of one frame.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICE = "__slice"
OWN = "__own"


def slice_length_us(lookback_us: int, factor: int = 16, minimum_us: int = 86_400_000_000) -> int:
    """A slice long enough that copies stay a small share of rows."""
    return max(int(lookback_us) * factor, minimum_us)


def add_time_slices(df: DataFrame, t_us: str, lookback_us: int, slice_us: int) -> DataFrame:
    """Add ``__slice`` (partition key part) and ``__own`` (row belongs to that slice).

    A row at ``t`` is also copied into every later slice whose start lies in
    ``(t, t + lookback]``, so each owned row sees its whole frame.
    """
    if lookback_us < 0 or slice_us <= 0:
        raise ValueError("lookback must be >= 0 and slice length > 0")
    own = floor_div(f"`{t_us}`", slice_us)
    # later slices whose start lies within the lookback of t get a copy
    last = floor_div(f"(`{t_us}` + {int(lookback_us)})", slice_us)
    return (df.withColumn("__own_slice", own)
              .withColumn(SLICE, F.explode(F.sequence(own, last)))
              .withColumn(OWN, F.col(SLICE) == F.col("__own_slice"))
              .drop("__own_slice"))


#: buckets of the histogram per look-back: a copy reaches at most one bucket too far
BUCKETS = 8


def add_density_slices(df: DataFrame, series: Sequence[str], t_us: str, lookback_us: int, rows_per_slice: int) -> DataFrame:
    """As :func:`add_time_slices`, with cut points from the counted density of each series.

    A bucket is an eighth of the look-back. A slice is a run of buckets of one
    series with about ``rows_per_slice`` rows, or, where the look-back holds
    more than that, with about as many rows as the look-back. So slices are
    numbered without gaps and a row is copied into the next one or two of
    them, however dense the series. Rows meet
    the slices of their bucket by an equi join with the histogram, which has a
    row per series and bucket that occurs: broadcast if its measured size
    allows, otherwise a join that AQE splits where a bucket is hot.
    """
    if lookback_us < 0 or rows_per_slice <= 0:
        raise ValueError("lookback must be >= 0 and rows per slice > 0")
    width = max(1, int(lookback_us) // BUCKETS)
    keys = list(series)
    bucketed = df.withColumn("__bucket", floor_div(f"`{t_us}`", width))
    counts = bucketed.groupBy(*keys, "__bucket").agg(F.count(F.lit(1)).alias("__n"))
    by_time = Window.partitionBy(*keys).orderBy("__bucket")
    reach = -(-int(lookback_us) // width) + 1
    # at most 1 a bucket, so no slice number is left out
    share = F.col("__n") / F.greatest(F.lit(int(rows_per_slice)), F.sum("__n").over(by_time.rangeBetween(-reach, 0)))
    before = F.coalesce(F.sum("__share").over(by_time.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    cut = counts.withColumn("__share", share).withColumn(SLICE, F.floor(before)).drop("__share")
    cut = cut.withColumn("__last", F.max(SLICE).over(by_time.rangeBetween(0, reach)))
    cut = cut.select(*(F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)), F.col("__bucket").alias("__b"),
                     F.col(SLICE).alias("__own_slice"), "__last")
    same = bucketed["__bucket"] == cut["__b"]
    for i, k in enumerate(keys):
        same = same & bucketed[k].eqNullSafe(cut[f"__k{i}"])
    out = bucketed.join(cut, same).withColumn(SLICE, F.explode(F.sequence("__own_slice", "__last")))
    return out.withColumn(OWN, F.col(SLICE) == F.col("__own_slice")) \
        .drop("__bucket", "__b", "__own_slice", "__last", *(f"__k{i}" for i in range(len(keys))))


def add_slices(df: DataFrame, series: Sequence[str], t_us: str, lookback_us: int, *, slice_seconds: int | None = None,
               rows_per_slice: int | None = None) -> DataFrame:
    """Slices by counted rows if ``rows_per_slice`` is given, else of a fixed length."""
    if rows_per_slice:
        return add_density_slices(df, series, t_us, lookback_us, rows_per_slice)
    return add_time_slices(df, t_us, lookback_us, slice_seconds * 1_000_000 if slice_seconds else slice_length_us(lookback_us))


def floor_div(expr_sql: str, d: int) -> Column:
    """Exact integer floor division (no double rounding)."""
    return F.expr(f"({expr_sql} - pmod({expr_sql}, {int(d)})) div {int(d)}")


def keep_owned(df: DataFrame) -> DataFrame:
    return df.filter(F.col(OWN)).drop(SLICE, OWN)


def sliced_partition(*keys: str | Column) -> list:
    return [*keys, F.col(SLICE)]
