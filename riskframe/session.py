"""Session helpers: one place for the conf the operators rely on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, app: str = "riskframe",
              shuffle_partitions: int | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE on and a UTC clock.

    On a cluster the caller's master and conf win; these are defaults only.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (b.config("spark.ui.enabled", "false")
          .config("spark.ui.showConsoleProgress", "false")
          .config("spark.sql.session.timeZone", "UTC")
          .config("spark.sql.adaptive.enabled", "true")
          .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
          .config("spark.sql.adaptive.skewJoin.enabled", "true")
          .config("spark.sql.execution.arrow.pyspark.enabled", "true")
          # one BLAS thread per Python worker: Spark already runs a worker per core
          .config("spark.executorEnv.OMP_NUM_THREADS", "1")
          .config("spark.executorEnv.OPENBLAS_NUM_THREADS", "1")
          .config("spark.executorEnv.MKL_NUM_THREADS", "1"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if master and master.startswith("local"):
        # local mode: the driver JVM is the only executor
        b = b.config("spark.driver.memory", os.environ.get("RISKFRAME_DRIVER_MEMORY", "8g"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder named by the cluster.

    Reads ``spark.checkpoint.dir`` (or the context's current one). Only in
    local mode, where no shared folder exists, a private one is created.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(HDFS/S3/ABFS) before running rank-based operators")
    local_dir = tempfile.mkdtemp(prefix="riskframe-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(local_dir)
    return sc.getCheckpointDir()


def written(df: DataFrame, tag: str) -> DataFrame:
    """``df`` as a Parquet table in the shared checkpoint folder: later passes
    scan plain columns, pruned, and nothing upstream is computed again."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/riskframe-{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
