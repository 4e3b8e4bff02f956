"""Cutting lineage with tables in the shared folder, which survive the loss of executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster; a temporary one only for a local master."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not folder:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="tagloom-")
        sc.setCheckpointDir(folder)
    return folder.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """Write the rows once and go on from the written table.

    Unlike a checkpoint the table has real sizes (a join sees whether a side is small),
    reads only the columns in use, and carries no constraints of the plan behind it, which
    in a loop grow with every round.
    """
    path = f"{checkpoint_dir(df.sparkSession)}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

