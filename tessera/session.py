"""Session helpers.

The library never creates its own cluster settings behind the user's back: it reads what the session already has and
only fills in the few values an operator needs when they are unset (local runs and tests).
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every operator of this package relies on or benefits from.  They are applied only by ``build_session``
# (our own entry points) and by ``ensure_defaults`` for the two keys whose absence would change results.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # Checkpoint files of intermediates are deleted once their data is no longer referenced.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tessera", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the package defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_defaults(spark)
    return spark


def ensure_defaults(spark: SparkSession) -> None:
    """Set the result-affecting defaults on a session we did not build (for example the driver's)."""
    spark.conf.set("spark.sql.mapKeyDedupPolicy", "LAST_WIN")
    if spark.conf.get("spark.sql.session.timeZone", None) is None:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and intermediate tables.

    On a cluster this is ``spark.checkpoint.dir`` (a shared file system path set by whoever runs the cluster); without
    it a non-local session is an error.  A local session without it gets a private folder, registered on the session.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getCheckpointDir()
    if not path:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise RuntimeError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
        path = tempfile.mkdtemp(prefix="tessera-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", path)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the checkpoint folder for a written intermediate table."""
    import uuid

    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df):
    """Cut lineage with a reliable checkpoint (in the shared checkpoint folder), computing the input once.

    Spark writes a reliable checkpoint with a second job after the action that triggers it; without a cache that
    job computes the whole input again.  The input is persisted while the checkpoint is written and released
    afterwards (the result reads the checkpoint files)."""
    from pyspark import StorageLevel

    checkpoint_dir(df.sparkSession)
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return df.checkpoint(eager=True)
    finally:
        df.unpersist()


def written(df, name: str = "table"):
    """Cut lineage with a table written once below the checkpoint folder and read back (the input is computed once,
    and a lost executor does not repeat it).  The folder is cleared by whoever set ``spark.checkpoint.dir``."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
