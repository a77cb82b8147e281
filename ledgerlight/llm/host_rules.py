"""Quality rules by host: count rule failures per host, shrink the rates, join the verdict back.

Four rules look at a whole text (:data:`RULES`). A host's failure rate of a
rule says little when the host has few documents, so each rule's rates over
all hosts give a beta prior by the method of moments, and a host is judged by
its posterior mean ``(failures + alpha) / (documents + alpha + beta)``. A host
with any posterior mean above ``host_limit`` is rejected with all its
documents; a document is kept if its host is not and it passes the base rules.

Defined results: a null or empty text has no words, so it fails ``short``; a
null host is one host of its own; repeated rows count as often as they occur;
an empty table gives an empty table. Columns of the input other than the ones
named are not looked at, so extra columns may have any name.
"""

from __future__ import annotations

from collections import Counter
from itertools import chain

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .common import broadcast_if_small, materialise, with_rest

MIN_WORDS = 50          # fewer words: too short
REPEAT_PCT = 50         # more than this share of words in repeated windows
SYMBOL_PCT = 30         # more symbols than this per 100 words
DUP_LINE_PCT = 50       # more than this share of lines equal to an earlier one
HOST_LIMIT = 0.8
STRENGTH = (1.0, 1e6)   # bounds of alpha + beta; the upper one stands for "all hosts alike"

METRICS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
BASE_RULES = ("short", "repeats")
RULES = (*BASE_RULES, "symbols", "dup_lines")


def text_metrics(text: str | None) -> tuple[int, ...]:
    """The counts of :data:`METRICS` for one whole text."""
    if not text:
        return (0,) * len(METRICS)
    words = text.encode().split()       # bytes split at exactly space and TAB..CR
    blanks = sum(map(text.count, " \t\n\x0b\x0c\r"))
    symbols = sum(map(text.count, "#*$%&|<>"))
    lines = [x for x in text.split("\n") if x.strip(" \t\x0b\x0c\r")]
    covered = 0
    if len(words) > 3:
        windows = list(zip(words, words[1:], words[2:]))
        seen = Counter(windows)
        if len(seen) < len(windows):
            until = 0       # positions below are counted
            for i, w in enumerate(windows):
                if seen[w] > 1:
                    covered += i + 3 - max(i, until)
                    until = i + 3
    return (len(words), len(text) - blanks, symbols, len(lines), len(lines) - len(set(lines)), covered)


def _metrics(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([text_metrics(t) for t in texts], columns=METRICS, dtype="int64")


def _metrics_column(text: str) -> F.Column:
    return pandas_udf(_metrics, ", ".join(f"{m} long" for m in METRICS))(F.col(text))


def _failures(c=F.col) -> dict[str, F.Column]:
    return {
        "short": c("n_words") < MIN_WORDS,
        "repeats": 100 * c("n_repeat_words") > REPEAT_PCT * c("n_words"),
        "symbols": 100 * c("n_symbols") > SYMBOL_PCT * c("n_words"),
        "dup_lines": 100 * c("n_dup_lines") > DUP_LINE_PCT * c("n_lines"),
    }


def host_rates(measured: DataFrame, host: str = "host") -> DataFrame:
    """Per host: documents, failures per rule and shrunk rates ``rate_<rule>``.

    ``measured`` has the host column and a boolean column per rule. The
    prior is two sums per rule over the host table, read back as one row.
    """
    hosts = measured.groupBy(host).agg(F.count("*").alias("n_docs"),
                                       *(F.count_if(F.col(r)).alias(f"n_{r}") for r in RULES))
    rate = {r: F.col(f"n_{r}") / F.col("n_docs") for r in RULES}
    moments = hosts.agg(*chain.from_iterable((F.avg(rate[r]), F.var_pop(rate[r])) for r in RULES)).first()
    for i, r in enumerate(RULES):
        mean, var = moments[2 * i], moments[2 * i + 1]
        mean, var = mean or 0.0, var or 0.0
        strength = STRENGTH[1] if var <= 0 else min(max(mean * (1 - mean) / var - 1, STRENGTH[0]), STRENGTH[1])
        hosts = hosts.withColumn(f"rate_{r}", (F.col(f"n_{r}") + mean * strength) / (F.col("n_docs") + strength))
    return hosts


def measure(docs: DataFrame, host: str, text: str, *key: F.Column) -> DataFrame:
    """Host, counts and failed rules of every document, written once to the shared folder (no texts)."""
    m = _metrics_column(text)
    counts = materialise(docs.select(*key, F.col(host).alias("host"), m.alias("m"))
                         .select(*(c for c in ("key",) if key), "host", *(F.col(f"m.{c}") for c in METRICS)), "quality")
    return counts.select("*", *(v.alias(r) for r, v in _failures().items()))


def rejected_hosts(measured: DataFrame, host_limit: float = HOST_LIMIT) -> DataFrame:
    """``(bad_host)``: hosts with any shrunk rate above the limit, each once."""
    worst = F.greatest(*(F.col(f"rate_{r}") for r in RULES))
    return host_rates(measured).where(worst > host_limit).select(F.col("host").alias("bad_host"))


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source",
          host_limit: float = HOST_LIMIT) -> DataFrame:
    """One row per document: ``key``, :data:`METRICS`, rule failures, ``host_rejected``, ``kept``.

    Texts are read once; the narrow counts are written to the shared folder
    and both the host aggregate and the join back read those. The join's
    right side holds rejected hosts only; its left side may have a host with
    a third of all rows, which AQE may split in a left outer join.
    """
    measured = measure(docs, host, text, F.col(key).alias("key"))
    bad = rejected_hosts(measured, host_limit).withColumn("bad", F.lit(True))
    base_failed = F.col("short") | F.col("repeats")
    return measured.join(bad, F.col("host").eqNullSafe(F.col("bad_host")), "left").select(
        F.col("key").alias(key), *METRICS, *RULES, base_failed.alias("base_failed"),
        F.coalesce("bad", F.lit(False)).alias("host_rejected"),
        (~base_failed & F.col("bad").isNull()).alias("kept"))


def keep_documents(docs: DataFrame, text: str = "text", host: str = "source", host_limit: float = HOST_LIMIT) -> DataFrame:
    """The rows of ``docs`` that :func:`judge` keeps, all columns.

    Texts are measured a second time rather than joined to their verdicts, so
    no text is shuffled.
    """
    # written and measured first: left to the planner, the texts are shuffled before the list turns out to be short
    rejected = materialise(rejected_hosts(measure(docs.select(text, host), host, text), host_limit)
                           .withColumnRenamed("bad_host", "__bad_host"), "hosts")
    bad = broadcast_if_small(rejected, F.coalesce(F.octet_length(F.col("__bad_host").cast("string")), F.lit(0)))
    fails = _failures(lambda c: F.col(f"__m.{c}"))

    def kept(rows: DataFrame) -> DataFrame:
        judged = rows.withColumn("__m", _metrics_column(text)).where(~(fails["short"] | fails["repeats"]))
        return judged.join(bad, F.col(host).eqNullSafe(F.col("__bad_host")), "left_anti")

    return with_rest(docs, [text, host], kept)
