"""Log level names and their order (X11)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The level names in order, lowest first (OFF disables a logger,
# ALL enables everything).
LEVEL_ORDINAL = {"ALL": 0, "TRACE": 1, "DEBUG": 2, "INFO": 3, "WARN": 4, "ERROR": 5, "OFF": 6}


# The numeric level of each name as written by the JSON log encoder.
LEVEL_VALUE = {"TRACE": 5000, "DEBUG": 10000, "INFO": 20000, "WARN": 30000, "ERROR": 40000}


def level_value(level: Column | str) -> Column:
    """Level name -> the encoder's numeric ``level_value``; unknown -> null."""
    c = F.col(level) if isinstance(level, str) else level
    pairs = []
    for name, v in LEVEL_VALUE.items():
        pairs += [F.lit(name), F.lit(v)]
    return F.element_at(F.create_map(*pairs), F.upper(F.trim(c)))


def level_ordinal(level: Column | str) -> Column:
    """Level name -> ordinal through a literal map (no join, no UDF); unknown -> null."""
    c = F.col(level) if isinstance(level, str) else level
    pairs = []
    for name, rank in LEVEL_ORDINAL.items():
        pairs += [F.lit(name), F.lit(rank)]
    return F.element_at(F.create_map(*pairs), F.upper(F.trim(c)))


def ordinal_of(name: str) -> int:
    return LEVEL_ORDINAL[name.strip().upper()]
