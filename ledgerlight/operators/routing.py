"""Log routing by logger name and level.

A routing table is a handful of entries ``(logger, level, additive, sinks)``
with ``logger = ''`` for the root. For an event of logger ``L`` at level ``v``:

1. the *nearest* configured ancestor of ``L`` that sets a level decides the
   effective level (``p`` is an ancestor when ``L == p`` or ``L`` starts with
   ``p + '.'``; the root is everybody's ancestor). ``tjenestekallX`` is not a
   child of ``tjenestekall``;
2. the event passes when ``v >= effective level``;
3. it reaches the sinks of the nearest ancestor and of every ancestor above
   it, up to and including the first non-additive one.

The table is tiny and known on the driver, so it is resolved there once per
configured logger and compiled into one ``CASE`` over ``startswith`` tests,
longest name first. The events are never joined or shuffled: routing is a
narrow, codegen-friendly projection followed by ``explode`` of the sink list.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.levels import level_ordinal, ordinal_of


@dataclass(frozen=True)
class Route:
    logger: str                      # '' is the root logger
    level: str | None = None         # None inherits from the parent
    additive: bool = True
    sinks: tuple[str, ...] = ()


# The shape of the logging configuration -- a library logger
# turned up to DEBUG without sinks of its own (its name here is ours), the
# service-call logger that writes only to the restricted sink, and the root.
DEFAULT_ROUTES: tuple[Route, ...] = (
    Route("lib.stream", level="DEBUG"),
    Route("tjenestekall", level="DEBUG", additive=False, sinks=("secureLog",)),
    Route("", level="INFO", sinks=("STDOUT_JSON",)),
)


def _is_ancestor(parent: str, child: str) -> bool:
    return parent == "" or child == parent or child.startswith(parent + ".")


def resolve(routes: Sequence[Route]) -> list[tuple[str, int, tuple[str, ...]]]:
    """Per configured logger (longest first): (name, effective level ordinal, sinks)."""
    names = {r.logger for r in routes}
    if "" not in names:
        routes = [*routes, Route("", level="DEBUG")]   # the library's default root
    by_name = {r.logger: r for r in routes}
    out = []
    for name in sorted(by_name, key=len, reverse=True):
        chain = sorted((r for r in routes if _is_ancestor(r.logger, name)),
                       key=lambda r: len(r.logger), reverse=True)
        level = next((r.level for r in chain if r.level is not None), "DEBUG")
        sinks: list[str] = []
        for r in chain:
            sinks += [s for s in r.sinks if s not in sinks]
            if not r.additive:
                break
        out.append((name, ordinal_of(level), tuple(sinks)))
    return out


def _matches(logger: Column, name: str) -> Column:
    if name == "":
        return F.lit(True)
    return (logger == F.lit(name)) | logger.startswith(F.lit(name + "."))


def route_logs(events: DataFrame, routes: Sequence[Route] = DEFAULT_ROUTES,
               logger: str = "logger", level: str = "level", sink: str = "sink") -> DataFrame:
    """One row per (event, sink) the event reaches; events below their level vanish.

    An event whose level is null or unknown is not known to be below: it
    passes (its record's ``level_value`` is null, so it can be told apart).
    """
    lg = F.col(logger)
    resolved = resolve(routes)
    level_case = sinks_case = None
    for name, rank, sinks in resolved:                       # longest first
        cond = _matches(lg, name)
        sink_arr = F.array(*[F.lit(s) for s in sinks]) if sinks else F.array().cast("array<string>")
        level_case = F.when(cond, F.lit(rank)) if level_case is None else level_case.when(cond, F.lit(rank))
        sinks_case = F.when(cond, sink_arr) if sinks_case is None else sinks_case.when(cond, sink_arr)
    passed = events.filter(F.coalesce(level_ordinal(level) >= level_case, F.lit(True)))
    return passed.withColumn(sink, F.explode(sinks_case))


def log_records(df: DataFrame, ts: str = "ts", message: str = "message", logger: str = "logger",
                level: str = "level", out: str = "value") -> DataFrame:
    """One structured JSON log line per row (X2, S5), in the encoder's layout:
    ``@timestamp`` (ISO-8601, milliseconds, UTC offset), ``@version``,
    ``message``, ``logger_name``, ``level``, ``level_value``.

    ``ts`` is a wall-clock UTC ``TIMESTAMP_NTZ``; formatting it does not go
    through the session zone.
    """
    from ..functions.levels import level_value
    from ..functions.timefn import iso_millis_utc
    stamp = iso_millis_utc(ts)
    rec = F.struct(stamp.alias("@timestamp"), F.lit("1").alias("@version"), F.col(message).alias("message"),
                   F.col(logger).alias("logger_name"), F.col(level).alias("level"),
                   level_value(level).alias("level_value"))
    keep = [c for c in df.columns if c not in (ts, message, logger, level)]
    return df.select(*keep, F.to_json(rec).alias(out))

