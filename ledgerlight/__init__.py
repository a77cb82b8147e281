"""ledgerlight: DataFrame and Structured Streaming operators for event pipelines.

Every operator is a lazy ``DataFrame -> DataFrame`` function built from Spark's
own expressions (no Python UDFs in any hot path), so Catalyst keeps predicate
pushdown, column pruning, partial aggregation and whole-stage codegen.

Layout
------
``functions``  column expressions (time, decoding, levels, templates)
``sources``    table readers, file/Kafka stream sources, sinks
``operators``  metrics, held conditions, log routing, documents, journal
``plans``      stand-in inputs, alert rules, the query registry
``streaming``  Structured Streaming forms of the alert and journal plans
"""

__version__ = "0.1.0"
