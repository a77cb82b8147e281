"""Key ledger for long-running streams: "which keys are already done?" in O(K) folders.

Each micro-batch writes its new keys under ``root/batch=<id>`` (overwrite, so
a replay rewrites its own folder). Every ``compact_every`` batches the keys
so far are compacted into ``root/snapshot/upto=<id>``. A batch ``N`` then reads
the snapshot below it plus at most ``compact_every`` recent batch folders,
addressed by explicit paths -- no listing of the stream's whole history, and
the same inputs on every replay of ``N`` (only folders ``< N`` are read).
Batch ids restart with a new checkpoint, so a new checkpoint needs a new root.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..sources.sinks import write_batch


class KeyLedger:
    def __init__(self, spark: SparkSession, root: str, key: Sequence[str] | str, compact_every: int = 20):
        self.spark, self.root = spark, root
        self.key = [key] if isinstance(key, str) else list(key)
        self.k = max(1, int(compact_every))

    def _snapshot_before(self, batch_id: int) -> int | None:
        s = (batch_id // self.k) * self.k - 1
        return s if s >= 0 else None

    def _read(self, paths: list[str]) -> DataFrame | None:
        """Keys of folders that must all be there: a missing one fails the batch rather than pass for "no keys"."""
        return self.spark.read.parquet(*paths).select(*self.key) if paths else None

    def keys_before(self, batch_id: int) -> DataFrame | None:
        """All keys recorded by batches ``< batch_id`` (distinct not guaranteed)."""
        snap = self._snapshot_before(batch_id)
        parts = []
        if snap is not None:
            parts.append(os.path.join(self.root, "snapshot", f"upto={snap}"))
        start = (snap + 1) if snap is not None else 0
        # every batch writes its folder (possibly holding no rows), so the paths exist
        recent = [os.path.join(self.root, f"batch={i}") for i in range(start, batch_id)]
        frames = [f for f in (self._read(parts), self._read(recent)) if f is not None]
        if not frames:
            return None
        out = frames[0]
        for f in frames[1:]:
            out = out.unionByName(f)
        return out

    def record(self, keys: DataFrame, batch_id: int) -> None:
        """Write this batch's keys; at a compaction point also write the snapshot."""
        write_batch(keys.select(*self.key), self.root, batch_id)
        if batch_id % self.k == self.k - 1:
            # previous snapshot + the batches after it + this batch
            frames = [f for f in (self.keys_before(batch_id),
                                  self._read([os.path.join(self.root, f"batch={batch_id}")])) if f is not None]
            if frames:
                upto = frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])
                upto.distinct().write.mode("overwrite").parquet(
                    os.path.join(self.root, "snapshot", f"upto={batch_id}"))


class RowLedger(KeyLedger):
    """Latest row per key across micro-batches, with pruned periodic snapshots.

    ``rows_before(N)`` = latest version per key among the snapshot below ``N``
    and the (at most ``compact_every``) batch folders after it. A snapshot
    keeps only rows that satisfy ``retain`` at the time it is written (for
    example ticks not yet beyond the look-back of closed windows), so it stays
    as small as the live state instead of growing with the stream's history.
    """

    def versions_before(self, batch_id: int) -> DataFrame | None:
        """Every stored version (snapshot rows and recent batches) below ``batch_id``,
        with its ``batch``; for aggregates that do not need the latest version."""
        return self._versions(batch_id)

    def _versions(self, batch_id: int) -> DataFrame | None:
        from pyspark.sql import functions as F
        snap = self._snapshot_before(batch_id)
        frames = []
        if snap is not None:
            frames.append(self.spark.read.parquet(os.path.join(self.root, "snapshot", f"upto={snap}")))
        start = (snap + 1) if snap is not None else 0
        recent = [os.path.join(self.root, f"batch={i}") for i in range(start, batch_id)]
        if recent:
            frames.append(self.spark.read.option("basePath", self.root).parquet(*recent)
                          .withColumn("batch", F.col("batch").cast("bigint")))
        if not frames:
            return None
        out = frames[0]
        for f in frames[1:]:
            out = out.unionByName(f)
        return out

    def rows_before(self, batch_id: int, where=None) -> DataFrame | None:
        from ..operators.journal import latest_per_key
        v = self._versions(batch_id)
        if v is None:
            return None
        if where is not None:
            v = v.filter(where)
        return latest_per_key(v, self.key, "batch").drop("batch")

    def record(self, rows: DataFrame, batch_id: int, retain=None) -> None:
        from pyspark.sql import functions as F
        write_batch(rows, self.root, batch_id)
        if batch_id % self.k == self.k - 1:
            v = self._versions_upto(batch_id)
            if v is None:
                return
            from ..operators.journal import latest_per_key
            snap = latest_per_key(v, self.key, "batch").drop("batch")
            if retain is not None:
                snap = snap.filter(retain)
            snap.withColumn("batch", F.lit(batch_id).cast("bigint")).write.mode("overwrite") \
                .parquet(os.path.join(self.root, "snapshot", f"upto={batch_id}"))

    def _versions_upto(self, batch_id: int) -> DataFrame | None:
        """Versions of batches <= batch_id from the previous snapshot on."""
        from pyspark.sql import functions as F
        before = self._versions(batch_id)
        cur = self.spark.read.option("basePath", self.root).parquet(
            os.path.join(self.root, f"batch={batch_id}")).withColumn("batch", F.col("batch").cast("bigint"))
        return cur if before is None else before.unionByName(cur)
