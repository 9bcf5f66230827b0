"""Session settings and the shared scratch folder."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # word-count state grows with the vocabulary: keep it off the JVM heap
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

# Below this many bytes per core a scan is spread over the cores before regex work.
SMALL_TASK_BYTES = 8 << 20
MIN_TASK_BYTES = 256 << 10


def session(app: str = "newsloom", **conf: str) -> SparkSession:
    """A session with the settings the operators are tuned for; keyword arguments win."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def state_session(spark: SparkSession) -> SparkSession:
    """A session beside `spark`, on the same cluster and with its time zone and shuffle partitions, that
    keeps the state of streams in RocksDB, as `streaming.live_counts` needs."""
    made = spark.newSession()
    for key in ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions"):
        made.conf.set(key, spark.conf.get(key))
    for key, value in SETTINGS.items():
        if key.startswith("spark.sql.streaming."):
            made.conf.set(key, value)
    return made


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder under the cluster's shared folder (`spark.checkpoint.dir`).

    Without the setting only a local session gets a temporary folder: on a cluster the
    executors could not see it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="newsloom-")
    return f"{base.rstrip('/')}/newsloom/{name}-{uuid.uuid4().hex}"


def spread(df: DataFrame) -> DataFrame:
    """Spread a small scan over all cores; leave a large one as its files split it.

    A small file is one scan task, so all tokenizing would run on one core. The shuffle
    is only added where the whole input is small beside the cluster.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    if size >= cores * SMALL_TASK_BYTES:
        return df
    tasks = min(cores, math.ceil(size / MIN_TASK_BYTES))
    return df.repartition(tasks, *df.columns) if tasks > 1 else df
