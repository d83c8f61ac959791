"""Session helpers: the shared scratch folder and a local session for tests and bench.

Operators never create or configure a session; they use the caller's.  Files that
must outlive one task (stream checkpoints, published results, lineage cuts) go under
the folder the cluster names in ``spark.checkpoint.dir``.  Only when that is unset
(a bare local session, as in tests) do we pick a folder of our own.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; a local one only if none is set.

    Spark core settings cannot change at run time, so the fallback goes through the
    SparkContext's checkpoint directory (which later calls then find).
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        try:
            context = spark.sparkContext
        except Exception:  # noqa: BLE001 - a Spark Connect session has no SparkContext
            context = None
        root = context.getCheckpointDir() if context is not None else None
        if not root:
            if context is None:
                raise RuntimeError("set spark.checkpoint.dir: the server's folders are not known to a Spark Connect client")
            if not str(getattr(context, "master", "local")).startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            context.setCheckpointDir(tempfile.mkdtemp(prefix="autopulse-"))
            root = context.getCheckpointDir()
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared scratch root (not created); deleted when the driver ends."""
    path = f"{scratch_root(spark)}/autopulse/{name}-{uuid.uuid4().hex[:12]}"
    jvm = getattr(spark, "_jvm", None)
    if jvm is not None:  # a Spark Connect client has no file system of its own
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)
    return path


def scratch_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet under the scratch root and read back: later uses don't run it again.

    Unlike a cached frame it survives lost executors, and values that a second run would
    change are fixed.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "autopulse", driver_memory: str = "8g") -> SparkSession:
    """A local session for tests and the bench (never used by operators)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.streaming.forceDeleteTempCheckpointLocation", "true")
    )
    if os.environ.get("AUTOPULSE_EVENT_LOG"):
        builder = builder.config("spark.eventLog.enabled", "true").config(
            "spark.eventLog.dir", os.environ["AUTOPULSE_EVENT_LOG"])
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    scratch_root(spark)
    return spark


def cluster_settings(input_bytes: int, split_bytes: int = 512 << 20, shuffle_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a large run, sized from the input volume (apply them when building the session).

    Scan splits of ``split_bytes``; about one shuffle partition per ``shuffle_bytes`` of
    input as the upper bound that AQE coalesces down from; skew splitting on.
    """
    shuffle_partitions = max(200, -(-input_bytes // shuffle_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(split_bytes),
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(shuffle_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
