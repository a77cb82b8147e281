"""Inputs and outputs: ``tables`` (batch readers), ``streams`` (file and Kafka
stream sources) and ``sinks`` (routed logs, alerts, idempotent batch tables,
outcome tables, run counters)."""
