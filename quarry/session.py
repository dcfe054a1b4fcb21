"""Spark session helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "quarry",
                  extra: dict | None = None) -> SparkSession:
    """Session tuned for the library: AQE on (coalesce + skew join), UTC, Arrow, no UI."""
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.driver.memory", "16g"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's checkpoint directory; set a scratch one only when none is configured.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as is. Only a
    session without it (unit tests on one machine) gets a fresh scratch directory.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="quarry-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def stage_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for a written stage table."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "stages", name)


def staged(df, name: str):
    """``df`` written once into a fresh folder under the shared checkpoint folder, and read from there."""
    path = stage_path(df.sparkSession, f"{name}-{uuid.uuid4().hex[:12]}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_lineage(df):
    """Reliable checkpoint into the session's checkpoint directory (``spark.checkpoint.dir``),
    so a lost executor never forces recomputation of the whole history."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
