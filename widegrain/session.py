"""Session helpers: building a local session for tests/bench and resolving the
shared checkpoint folder the cluster names in ``spark.checkpoint.dir``."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

_CKPT_KEY = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "widegrain") -> SparkSession:
    """A local session for tests and the bench (UI off, AQE on, UTC)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is; if it is unset there, we refuse to guess (a machine-local folder would
    not survive the loss of an executor). Only in local mode (tests, local
    runs) do we set a fresh scratch folder of our own when it is unset.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get(_CKPT_KEY, None)
    if not current:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...) for this cluster")
        current = tempfile.mkdtemp(prefix="widegrain-ckpt-")
        spark.conf.set(_CKPT_KEY, current)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
