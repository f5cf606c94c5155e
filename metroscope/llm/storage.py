"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_folder


DROP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staged(df: DataFrame, label: str, drop: bool = False) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back: cuts lineage, survives lost executors.

    With ``drop`` the shuffle files of the write go as soon as it has ended, not when the driver happens to collect its garbage.
    """
    path = scratch_folder(df.sparkSession, label)
    conf = df.sparkSession.conf
    before = conf.get(DROP, None)
    if drop:
        conf.set(DROP, "true")
    try:
        df.write.parquet(path)
    finally:
        if drop:
            conf.unset(DROP) if before is None else conf.set(DROP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def labels(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/labels.parquet")
