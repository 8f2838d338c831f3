"""Cutting lineage: intermediate tables in the session's shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.session import scratch_dir


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the folder that ``spark.checkpoint.dir`` names, and read it from there.

    The files outlive executors, so nothing before them is ever computed a second time.
    """
    spark, path = df.sparkSession, scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
