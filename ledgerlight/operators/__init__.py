"""DataFrame operators: ``metrics`` (matchers, thresholds, windows, counters),
``holds`` (held conditions), ``slicing`` (hot-series time slices), ``routing``
(log routing and JSON records), ``documents`` (rule documents) and ``journal``
(finalisation, outbox, dead letters, retries)."""
