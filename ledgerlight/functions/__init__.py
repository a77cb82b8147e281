"""Column expressions: ``timefn`` (zone-free time), ``decode`` (JSON, decimals,
months, ULIDs, rule names), ``levels`` (log levels) and ``templates`` (alert texts)."""
