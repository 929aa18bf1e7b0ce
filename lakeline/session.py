"""Sessions, and the shared folder that jobs may write intermediate tables to."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "lakeline", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the engine relies on: UTC, ANSI, AQE, last-wins map keys."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    base = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    for k, v in (base | conf).items():
        b = b.config(k, v)
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` where the cluster names one.

    Only where that setting is missing and all executors are on this machine (tests) is a folder of it used.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        own = tempfile.mkdtemp(prefix="lakeline-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        sc.setCheckpointDir(f"file://{own}")
    return sc._jsc.sc().getCheckpointDir().get().rstrip("/")


_SCRATCH: list[str] = []


def scratch(spark: SparkSession, name: str) -> str:
    """A new, unused folder for one run of one operator inside the shared folder."""
    path = f"{shared_dir(spark)}/lakeline-{name}-{uuid.uuid4().hex}"
    _SCRATCH.append(path)
    return path


def clean(spark: SparkSession) -> None:
    """Delete the intermediate tables this process wrote; results that still read them must have been written."""
    from lakeline.sources import fs

    while _SCRATCH:
        fs.remove(spark, _SCRATCH.pop())


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write to the shared folder and read back; survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One table of a data folder; date-times without a zone are read as they are."""
    return spark.read.parquet(os.path.join(root, f"{name}.parquet"))
