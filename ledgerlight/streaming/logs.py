"""Log routing on a stream.

Routing is a narrow projection (no join, no shuffle, no state), so the batch
operator runs on a stream unchanged. The records go to Spark's file sink,
which is exactly-once through its own commit log, one folder per sink
(``sink=<name>``), so the restricted sink stays a separate path.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..operators import routing


def run_routing_stream(messages: DataFrame, out_root: str, checkpoint: str,
                       routes: Sequence[routing.Route] = routing.DEFAULT_ROUTES,
                       keep: Sequence[str] = ("event_id",), fmt: str = "parquet",
                       timeout_s: float | None = None):
    """Route a stream of (ts, logger, level, message, keep...) and write the JSON
    records per sink. ``fmt="text"`` writes bare JSON lines (then ``keep`` must be empty)."""
    routed = routing.route_logs(messages.select(*keep, "ts", "logger", "level", "message"), routes)
    records = routing.log_records(routed)
    q = (records.writeStream.format(fmt).partitionBy("sink")
         .option("path", out_root).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination(timeout_s)
    return q


def read_routed(spark, out_root: str, messages: DataFrame, keep: Sequence[str] = ("event_id",)) -> DataFrame:
    """What :func:`run_routing_stream` wrote; empty (same schema) when no data ever arrived."""
    from ..sources.sinks import path_exists
    if not path_exists(spark, f"{out_root}/sink=*"):
        routed = routing.log_records(routing.route_logs(
            messages.select(*keep, "ts", "logger", "level", "message"), routing.DEFAULT_ROUTES))
        return spark.createDataFrame([], routed.schema)
    return spark.read.parquet(out_root)
