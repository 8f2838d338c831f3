"""Counts of a stored table kept per bucket, so that a check reads only what has changed since the last one.

``stats/<time column>/_bucket=b/`` holds one row about a bucket of the base. Every step that changes a bucket's rows
deletes its row in the same swap, so a row that is there is right, and a missing one is counted anew. A key belongs to one
bucket, so keys and duplicates of buckets add up to those of the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.names import BUCKET, IS_DELETED
from tidemark.sources import state
from tidemark.sources.state import StateTable
from tidemark.sources.swap import numbers_in


def _counts(rows: DataFrame, table: StateTable, time_col: str | None) -> DataFrame:
    newest = (F.max(time_col) if time_col else F.max(F.lit(None).cast("timestamp"))).alias("newest")
    live = ~F.col(IS_DELETED) if IS_DELETED in rows.columns else F.lit(True)
    n_live = F.count_if(F.coalesce(live, F.lit(True)))
    per_key = rows.groupBy(BUCKET, *table.keys).agg(F.count(F.lit(1)).alias("__n"), n_live.alias("__live"), newest)
    keyed = F.lit(True)
    for key in table.keys:
        keyed = keyed & F.col(key).isNotNull()
    return per_key.groupBy(BUCKET).agg(
        F.sum("__n").alias("n_rows"),
        F.sum("__live").alias("n_live"),
        F.count_if(keyed).alias("n_keys"),
        F.coalesce(F.sum(F.when(~keyed, F.col("__n"))), F.lit(0).cast("long")).alias("n_null_keys"),
        F.count_if(keyed & (F.col("__n") > 1)).alias("n_duplicate_keys"),
        F.max("newest").alias("newest"),
    )


def stats_schema(spark: SparkSession, table: StateTable, time_col: str | None = None) -> T.StructType:
    """Columns of :func:`bucket_statistics`."""
    kind = state.base_schema(spark, table)[time_col].dataType if time_col else T.TimestampType()
    counts = ("n_rows", "n_live", "n_keys", "n_null_keys", "n_duplicate_keys")
    fields = [T.StructField(c, T.LongType()) for c in counts]
    return T.StructType([*fields, T.StructField("newest", kind), T.StructField(BUCKET, T.IntegerType())])


def refresh_statistics(spark: SparkSession, table: StateTable, time_col: str | None = None) -> list[int]:
    """Count the buckets that have changed since they were last counted; returns them.

    Reads the keys and the time of these buckets only. Dies without harm: a bucket's row is there or not.
    """
    schema = stats_schema(spark, table, time_col)
    path = table.stats_of(time_col)
    stale = sorted(set(numbers_in(spark, table.base_path, BUCKET)) - set(numbers_in(spark, path, BUCKET)))
    if stale:
        rows = _counts(state.read_state(spark, table, "base", buckets=stale), table, time_col)
        writer = rows.select(schema.names).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(BUCKET).parquet(path)
    return stale


def bucket_statistics(spark: SparkSession, table: StateTable, time_col: str | None = None) -> DataFrame:
    """Per bucket of the base: rows, live rows (not deleted softly), keys, rows without a key, keys found twice, newest time.

    Changes that are logged and not folded are not in it. An empty table has no rows.
    """
    refresh_statistics(spark, table, time_col)
    schema = stats_schema(spark, table, time_col)
    if not numbers_in(spark, table.stats_of(time_col), BUCKET):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(table.stats_of(time_col))


def table_statistics(spark: SparkSession, table: StateTable, time_col: str | None = None) -> DataFrame:
    """One row: the sums of :func:`bucket_statistics` and the newest time."""
    rows = bucket_statistics(spark, table, time_col)
    sums = [F.coalesce(F.sum(c), F.lit(0).cast("long")).alias(c) for c in rows.columns if c.startswith("n_")]
    return rows.agg(*sums, F.max("newest").alias("newest"))
