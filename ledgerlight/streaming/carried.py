"""What a stream carries from one micro-batch to the next, as a small table per batch id.

Batch ``N`` reads the folder of batch ``N - 1`` and writes its own with
overwrite. So a batch reads what is still open (waiting entries, unclosed
samples, running totals), not the stream's history, and a replayed batch
finds exactly what its first run found. Every batch must record, also when it
has no rows: a missing folder is an error, not "nothing carried". Batch ids
restart with a new checkpoint, so a new checkpoint starts from nothing.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from ..sources.sinks import write_batch


class Carried:
    def __init__(self, spark: SparkSession, root: str, schema):
        self.spark, self.root, self.schema = spark, root, schema

    def before(self, batch_id: int) -> DataFrame:
        """The rows batch ``batch_id - 1`` recorded; none before the first batch."""
        if batch_id <= 0:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(os.path.join(self.root, f"batch={batch_id - 1}"))

    def record(self, rows: DataFrame, batch_id: int) -> None:
        write_batch(rows, self.root, batch_id)


def last_batch(spark: SparkSession, root: str) -> int | None:
    """The number of the last batch recorded under ``root``, from the folder names."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(os.path.join(root, "batch=*"))
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
    numbers = [int(f.getPath().getName().split("=")[1]) for f in found]
    return max(numbers, default=None)
