"""Session settings that the engine relies on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[*]", app: str = "riskloom", **more: str) -> SparkSession:
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
    } | more
    return SparkSession.builder.master(master).appName(app).config(map=conf).getOrCreate()


def settled(df: DataFrame) -> DataFrame:
    """The rows written to the folder of spark.checkpoint.dir and read from there, without their lineage.

    They are written by columns, so that a later pass reads those that it needs. Only on a local master without that setting is the folder a temporary one.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="riskloom-")
        context.setCheckpointDir(folder)
    path = f"{context.getCheckpointDir().rstrip('/')}/settled-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
