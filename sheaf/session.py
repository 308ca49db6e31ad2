"""Spark session settings shared by jobs, tests and the bench.

Only runtime SQL settings are applied to a session that already exists, so a
cluster's own configuration (executor sizing, checkpoint folder, shuffle
service) is never overridden.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: UTC wall clock (the pipelines speak UTC only),
# adaptive execution for runtime re-planning (partition coalescing, skew-join
# splitting, broadcast conversion once real sizes are known) and Arrow for the
# few pandas hooks.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to ``spark`` (idempotent)."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def get_session(master: str | None = None, app: str = "sheaf",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session. ``master`` is only for local runs and tests."""
    builder = (SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false"))
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared folder named by ``spark.checkpoint.dir``.

    A cluster names that folder (a distributed file system path); it is read
    from the session and never replaced. Only when it is unset, as in local
    tests, a folder of our own is set.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a Spark Connect session has no SparkContext
        current = spark.conf.get("spark.checkpoint.dir", None) or fallback
        if not current:
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share") from None
        return current
    current = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not current:
        current = fallback or os.environ.get("SHEAF_CHECKPOINT_DIR")
        if not current:
            if sc.master != "local" and not sc.master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
            current = "/tmp/sheaf-checkpoints"
        sc.setCheckpointDir(current)
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


def default_parallelism(spark: SparkSession) -> int:
    """Cores of the cluster (or the shuffle partition setting without a SparkContext)."""
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:  # noqa: BLE001
        return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path inside the shared checkpoint folder.

    Used for staged tables and stream checkpoints, so that every executor and
    a restarted driver see the same files.
    """
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/sheaf-{name}-{uuid.uuid4().hex}"


def staged(df, name: str):
    """``df`` written to the shared folder and read back: computed once, and its size is known to the planner."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a folder that this library wrote, on whatever file system it is."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def mean_file_size(spark: SparkSession, paths: list[str]) -> float:
    """Bytes of a file under ``paths`` on average, on whatever file system they are."""
    conf, path = spark.sparkContext._jsc.hadoopConfiguration(), spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    found = [path(p).getFileSystem(conf).getContentSummary(path(p)) for p in paths]
    return sum(x.getLength() for x in found) / max(1, sum(x.getFileCount() for x in found))
