"""Session construction and the few cluster-level settings the operators rely on.

The library never hard-codes storage locations: lineage is cut with reliable
checkpoints written under the folder the cluster names in ``spark.checkpoint.dir``.
A local folder is only chosen when the session runs in local mode and names none
(tests, laptops).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings every job of the library assumes (AQE re-plans joins and splits skewed
# partitions at run time; the session time zone pins timestamp text).
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "valuescope",
                  shuffle_partitions: int | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    """Create (or fetch) a session with the library defaults applied."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder of the session.

    Uses the folder already set on the context or named by ``spark.checkpoint.dir``.
    Only a local-mode session without either gets a fresh temporary folder; a
    cluster session without one is an error, because a machine-local folder would
    not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a folder on shared storage")
    folder = tempfile.mkdtemp(prefix="valuescope-ckpt-")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def pin(df: DataFrame) -> DataFrame:
    """Materialise ``df`` under the shared checkpoint folder and cut its lineage.

    Used where later stages must see exactly the same rows (range bounds are
    sampled and ordinals come from ``monotonically_increasing_id``, so a
    recomputation could change them) and where a side is read more than once.
    The rows are written as compressed parquet in the shared folder and read back
    (columnar, much smaller than serialized checkpoint blocks); column names that
    parquet cannot store fall back to a reliable RDD checkpoint. Nothing depends on
    the physical partitions of the result.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "pin")
    try:
        df.write.mode("errorifexists").parquet(path)
    except Exception as err:  # noqa: BLE001 - names parquet rejects
        if "INVALID_COLUMN_NAME" not in str(err) and "invalid character" not in str(err).lower():
            raise
        return df.checkpoint(eager=True)
    return spark.read.parquet(path)


def unpin(df: DataFrame) -> None:
    """Delete the files of a pinned table that nothing reads any more.

    Intermediate tables of many rounds would otherwise all stay until the job ends.
    """
    sc = df.sparkSession.sparkContext
    for folder in {name.rpartition("/")[0] for name in df.inputFiles()}:
        if "/valuescope-pin-" in folder:
            path = sc._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    token = os.urandom(6).hex()
    return f"{base.rstrip('/')}/valuescope-{name}-{token}"


def release_scratch(spark: SparkSession) -> int:
    """Delete this application's pinned and scratch tables; returns how many.

    Call once the results that read them are written: every ``pin`` and
    ``scratch_path`` lives under the application's own checkpoint subfolder.
    """
    sc = spark.sparkContext
    base = sc.getCheckpointDir()
    if not base:
        return 0
    jvm = sc._jvm
    root = jvm.org.apache.hadoop.fs.Path(base)
    fs = root.getFileSystem(sc._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return 0
    removed = 0
    for status in fs.listStatus(root):
        if status.getPath().getName().startswith("valuescope-"):
            fs.delete(status.getPath(), True)
            removed += 1
    return removed
