"""Intermediate tables in the folder the cluster shares.

Some operators look at one intermediate result several times (rank selection, dense keys).
They write it once, as Parquet, below ``spark.checkpoint.dir``: later passes read only the
columns they need, and a lost executor costs a re-read instead of the whole lineage.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder; a temporary one only for local masters without any."""
    folder = spark.conf.get(SETTING, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {SETTING} to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="mercato-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path; everything one application writes lies below one folder."""
    app = spark.sparkContext.applicationId
    return f"{shared_folder(spark).rstrip('/')}/mercato/{app}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return the table read back."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
