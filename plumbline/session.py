"""Session construction and lineage cutting.

On a cluster the session is created by the platform; ``get_session`` is for
tests, the bench and local runs.  ``checkpoint_dir`` reads the shared folder
the cluster names in ``spark.checkpoint.dir`` and only falls back to a fresh
scratch folder when nothing is configured (tests, local runs).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def get_session(master: str | None = None, partitions: int | None = None,
                app: str = "plumbline") -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    partitions = partitions or int(os.environ.get("PLUMBLINE_PARTITIONS", "8"))
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("PLUMBLINE_DRIVER_MEM", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder; set a scratch one only when unset.

    Reads ``spark.checkpoint.dir`` (the folder the cluster names) and the
    context's current setting; only when neither is set and Spark runs in one
    process (tests, local runs) is a fresh scratch folder created.  On a
    cluster a missing setting is an error.
    """
    conf = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - remote sessions expose no SparkContext
        return conf
    current = sc.getCheckpointDir()
    if current:
        return current
    if not conf:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf = tempfile.mkdtemp(prefix="plumbline-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf)
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
