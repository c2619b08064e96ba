"""Session helpers.

Library functions never create sessions; they take the one they are given.
``local_session`` is for tests, the bench and smoke runs only.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "prismtab") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("PRISMTAB_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # driver-side: skip per-call Python call-site capture (error context only);
        # plan construction of the grid searches issues thousands of column calls
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        # whole-stage methods above 8000 bytes are never JIT-compiled by HotSpot
        # (they run interpreted); past this size Spark uses split per-operator
        # code instead.  Recommended on clusters too (wide feature projections).
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        # remove checkpoint files once their DataFrames are garbage collected
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only if none is configured.

    On a cluster ``spark.checkpoint.dir`` names a shared folder (HDFS/S3/...);
    we read it from the session.  Only when it is unset (local tests) do we
    point it at a fresh scratch folder; on a cluster without it this is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="prismtab-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def cut_lineage(df):
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def store(df):
    """``df`` as a Parquet table of the shared checkpoint folder: read column by column, survives executor loss.

    The table stays until the folder is cleared."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
