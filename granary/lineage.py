"""Cutting lineage in the folder that all executors share, so that a lost executor costs no recomputation."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which all executors see. Only where it is unset and the master local (tests) is one made."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if folder is None:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="granary-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder, with its lineage cut there."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
