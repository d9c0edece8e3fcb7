"""Session defaults and the shared-folder checkpoint used to cut lineage."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(app: str = "clauseworks", cpus: int | None = None, **conf: str) -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    n = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    builder = SparkSession.builder.master(f"local[{n}]").appName(app)
    settings = {"spark.sql.shuffle.partitions": str(n), "spark.driver.memory": "8g"} | DEFAULTS | conf
    return builder.config(map=settings).getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` to the reliable checkpoint folder and read it from there.

    The folder is the one in ``spark.checkpoint.dir``; only where that is unset
    (tests, a laptop) and the master is local a temporary folder is used; on a
    cluster that is an error. Unlike a local checkpoint the files survive the loss
    of an executor.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared and not re.match(r"local(?:\[|$)", sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="clauseworks-checkpoint-"))
    return df.checkpoint(eager=True)
