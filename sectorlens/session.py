"""Session settings the jobs rely on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Bars and news are kept as UTC instants; text without a zone means UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder every executor can reach.

    The cluster names its shared folder in ``spark.checkpoint.dir``. Only a local
    session, whose tasks share the driver's disk, may leave it unset; a cluster
    without it is an error, since executors could not see each other's files.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="sectorlens-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def pinned(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the reliable checkpoint folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_dir(df.sparkSession, "checkpoint"))
    return df.checkpoint(eager=True)
