"""Session construction and the shared scratch location.

On a cluster ``spark.checkpoint.dir`` names a shared folder (HDFS/S3/...);
everything we materialise (stream checkpoints, idempotent sink tables,
lineage cuts) lives below it. Only when the setting is absent -- local runs
and tests -- do we pick a private folder ourselves.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale. AQE re-plans joins and partition counts from
# runtime sizes; skew-join splits a hot key's partition; the broadcast
# threshold is the size check behind every automatic broadcast.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.parquet.aggregatePushdown": "true",
    # streaming window state off the JVM heap, with incremental checkpoints
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "ledgerlight", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SCALE_CONF)
    # results do not depend on the zone (see functions.timefn); UTC only keeps logs readable
    if extra and "spark.sql.session.timeZone" in extra:
        conf.pop("spark.sql.session.timeZone")
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    Only a local-mode session (tests, a laptop) without the setting gets a
    private temporary folder; on a cluster a machine-local folder would not be
    visible to the executors, so an unset setting is an error there.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster (HDFS, S3, ...)")
        # spark.checkpoint.dir is a core setting and cannot change at run time;
        # the context's checkpoint folder can
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="run-", dir="/tmp"))
        return spark.sparkContext.getCheckpointDir()
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A fresh location under the shared checkpoint folder, scheme included."""
    base = ensure_checkpoint_dir(spark)
    # a bare local path in local mode, where every reader shares this machine's files
    if spark.sparkContext.master.startswith("local[") and base.startswith("file:"):
        base = base[len("file:"):]
    leaf = list(parts)
    if unique:
        leaf.append(uuid.uuid4().hex[:12])
    return os.path.join(base, "ledgerlight", *leaf)
