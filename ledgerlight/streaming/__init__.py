"""Structured Streaming forms: ``alerts`` (watermarked windows and the
incremental core), ``rules`` (the rule set on a stream), ``journal``
(finalisation through ``foreachBatch``), ``logs`` (routing to the file sink) and
``ledger`` (compacted key/row ledgers for long-running streams)."""
