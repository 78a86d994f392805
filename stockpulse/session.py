"""Spark session helpers.

``get_spark`` builds a session tuned for the engine's plans; on a cluster
pass the already-running session instead and only ``ensure_checkpoint_dir``
is applied (it never overrides a cluster-provided ``spark.checkpoint.dir``).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Session settings the plans rely on (all public Spark SQL confs).
ENGINE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # let a panel hash-partitioned by (item_id, store_id) join the weekly
    # price table on (item_id, store_id, wm_yr_wk) without re-shuffling the
    # panel: only the (7x smaller) price side is exchanged.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # a stage that is partitioned by split (three values) is written without
    # a sort of its whole rows: a task keeps a writer open for each split.
    "spark.sql.maxConcurrentOutputFileWriters": "4",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "stockpulse") -> SparkSession:
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    b = (SparkSession.builder.master(master).appName(app_name)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8)))
    for k, v in ENGINE_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_engine_conf(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL confs to an existing session (idempotent)."""
    for k, v in ENGINE_CONF.items():
        if spark.conf.isModifiable(k):
            spark.conf.set(k, v)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint directory named by the session.

    A cluster names a shared folder in ``spark.checkpoint.dir``; it is used
    as is.  Only when unset (local tests) a fresh scratch folder is created.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="stockpulse-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    sc.setCheckpointDir(d)
    return d
