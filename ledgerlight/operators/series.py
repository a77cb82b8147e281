"""Series identity of dynamic label sets: one long per series, labels in a dictionary.

Samples of one table carry different label sets, so a series has no fixed list
of key columns. Its identity is a fingerprint: a 64-bit hash of the metric name
and the label entries, sorted by name. As with any label set, an empty or null
value is the same as no label, and the order of a map does not matter. Every
aggregate and window then groups by one long; the label maps are kept once per
series in a dictionary and join back when a result needs them.

Two series share a fingerprint with probability ``n**2 / 2**65`` (for a
million series about 3e-8); :func:`collisions` finds such pairs exactly.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import metrics


def canonical_labels(labels: Column | str) -> Column:
    """Label entries that have a value, sorted by name."""
    m = F.col(labels) if isinstance(labels, str) else labels
    entries = F.coalesce(F.map_entries(m), F.array().cast("array<struct<key: string, value: string>>"))
    return F.array_sort(F.filter(entries, lambda e: F.coalesce(e["value"], F.lit("")) != ""))


def fingerprint(metric: Column | str, labels: Column | str) -> Column:
    name = F.col(metric) if isinstance(metric, str) else metric
    return F.xxhash64(F.coalesce(name, F.lit("")), canonical_labels(labels))


def with_series(samples: DataFrame, *, metric: str = "metric", labels: str = "labels", out: str = "series") -> DataFrame:
    """Samples with their series as one long in place of metric and labels."""
    keep = [c for c in samples.columns if c not in (metric, labels)]
    return samples.select(fingerprint(metric, labels).alias(out), *keep)


def series_dictionary(samples: DataFrame, *, metric: str = "metric", labels: str = "labels", out: str = "series") -> DataFrame:
    """``(series, metric, labels)``, a row per series; partial aggregation leaves one row per series and task to shuffle."""
    entries = canonical_labels(labels)
    named = samples.select(fingerprint(metric, labels).alias(out), metric, F.to_json(entries).alias("__text"))
    # the least of equal texts: any copy is the same, and a string keeps the row deterministic
    one = named.groupBy(out).agg(F.min(metric).alias(metric), F.min("__text").alias("__text"))
    parsed = F.from_json("__text", "array<struct<key: string, value: string>>")
    return one.select(out, metric, F.map_from_entries(parsed).alias(labels))


def collisions(samples: DataFrame, *, metric: str = "metric", labels: str = "labels") -> DataFrame:
    """Fingerprints that stand for more than one series (expected: none)."""
    named = samples.select(fingerprint(metric, labels).alias("series"),
                           F.to_json(F.struct(F.col(metric), canonical_labels(labels).alias("labels"))).alias("__text"))
    return named.groupBy("series").agg(F.min("__text").alias("a"), F.max("__text").alias("b")).filter("a != b")


def match_series(dictionary: DataFrame, metric_name: str, matchers: Mapping[str, str] | None = None, *,
                 metric: str = "metric", labels: str = "labels") -> DataFrame:
    """Dictionary rows of ``metric{l1="v1", ...}``; an empty value matches series without the label."""
    found = metrics.match_labels(dictionary, {metric: metric_name})
    for name, value in (matchers or {}).items():
        found = found.filter(F.coalesce(F.element_at(labels, F.lit(name)), F.lit("")) == F.lit(value))
    return found


def with_labels(df: DataFrame, dictionary: DataFrame, names: Sequence[str], *, series: str = "series",
                labels: str = "labels") -> DataFrame:
    """Join label columns back on the series; rows of series that are not in the dictionary drop out.

    A series without one of the labels has null there. The join is left to
    the measured size of the dictionary.
    """
    wanted = dictionary.select(series, *(F.element_at(labels, F.lit(n)).alias(n) for n in names))
    return df.join(wanted, series)
