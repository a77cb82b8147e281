"""Bounded retry to the end: rounds over a keyed attempts table.

Round ``n`` reads the letters that round ``n - 1`` left open and writes, under
its own number and with overwrite, a log row for each of them and the letters
still open. The number of attempts is part of a letter's row and is advanced
from the previous round's table only, so a round that runs again, after a
failure or by mistake, writes the same rows and advances nothing twice. Rounds
that are complete are not run again on the same root. Rounds end when no
letter is open; with ``max_attempts`` attempts, and times at which every
back-off has passed, that is after at most ``max_attempts`` rounds.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import journal
from ..sources.sinks import path_exists, read_batches, write_batch


def run_retry_rounds(dead: DataFrame, root: str, checks: Callable[[Column], Sequence[tuple[str, Column]]],
                     times: Sequence[Column], max_attempts: int, backoff: str, *, key: str, attempt: str = "attempt",
                     failed_at: str = "failed_at", error: str = "error") -> DataFrame:
    """Retry ``dead`` letters at ``times``, one round each, until none is open; returns the log of all rounds.

    ``checks(now)`` are the ``(name, failed)`` checks of a round; they may read
    the letter's columns and the error it came with (``first_error``). The log
    has ``round``, ``key``, ``state`` (``recovered``, ``again``, ``waiting``,
    ``parked``), the attempts made, the time of the last failure and its error.
    ``key`` is unique among the letters. Letters left open when ``times`` run
    out are those whose last log row is ``again`` or ``waiting``.
    """
    spark = dead.sparkSession
    open_root, log_root = os.path.join(root, "open"), os.path.join(root, "log")
    letters = dead
    for n, now in enumerate(times, 1):
        if not path_exists(spark, os.path.join(open_root, f"batch={n}", "_SUCCESS")):
            done = journal.tag_retry(letters, checks(now), now, max_attempts, backoff, attempt, failed_at, error)
            kept = F.when(F.col("state") == "again", F.col(error)).otherwise(F.col("first_error"))
            last = F.when(F.col("state") == "recovered", None).otherwise(kept)
            write_batch(done.select(key, "state", attempt, failed_at, last.alias(error)), log_root, n)
            left = done.filter("state in ('again', 'waiting')").withColumn(error, kept).select(*dead.columns)
            write_batch(left, open_root, n)         # last: its marker says that the round is complete
        letters = spark.read.schema(dead.schema).parquet(os.path.join(open_root, f"batch={n}"))
        if letters.isEmpty():
            break
    log = read_batches(spark, log_root)
    return log.select(F.col("batch").cast("int").alias("round"), key, "state", attempt, failed_at, error)


def outcome(log: DataFrame, key: str) -> DataFrame:
    """The last state of every letter, and the round it came in."""
    return journal.latest_per_key(log, key, "round")
