"""Plans over the driver tables: ``standins`` (derived inputs), ``rules`` (the
alert rule set), ``catalog`` (the query registry) and the ``queries_*`` modules
that register each query with its DuckDB oracle."""
