"""Change logs on storage, read as a batch or as a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.functions.buckets import rebalance_by_bucket, select_buckets, with_bucket
from tidemark.names import BUCKET, COLLECTION_ORDER, OP, TOTAL_ORDER, TXN_ID
from tidemark.sources.swap import get_marker, names_in, set_marker

META_FIELDS = (
    T.StructField(OP, T.StringType()),
    T.StructField(TXN_ID, T.StringType()),
    T.StructField(TOTAL_ORDER, T.LongType()),
    T.StructField(COLLECTION_ORDER, T.LongType()),
)


def change_schema(business: T.StructType) -> T.StructType:
    """Flat change rows of a table: its columns, the metadata, and the bucket last."""
    fields = [f for f in business.fields if f.name != BUCKET]
    return T.StructType([*fields, *META_FIELDS, T.StructField(BUCKET, T.IntegerType())])


def write_changes(
    changes: DataFrame,
    path: str,
    keys: Sequence[str],
    buckets: int,
    bucket_fn: str = "xxhash64",
    mode: str = "append",
    max_rows_per_file: int | None = None,
) -> None:
    """Add flat changes to a change log laid out by bucket.

    ``max_rows_per_file`` is declared by the first write of a log, holds for all later ones, and is what
    a reader's ``max_rows_per_trigger`` counts with. It can be stated, not be given to a log that has files.
    """
    spark = changes.sparkSession
    rows = with_bucket(changes.drop(BUCKET), keys, buckets, bucket_fn)
    fresh = mode == "overwrite" or not names_in(spark, path)
    declared = max_rows_per_file if fresh else rows_per_file(spark, path)
    if declared is not None and declared <= 0:
        raise ValueError("max_rows_per_file must be positive")
    if max_rows_per_file not in (None, declared):
        raise ValueError(f"the files of {path} are declared to have up to {declared} rows, not {max_rows_per_file}")
    if declared is not None and mode != "overwrite" and fresh:
        set_marker(spark, _declared(path), declared)  # before any file, so that no file is without
    writer = rebalance_by_bucket(rows).write.mode(mode).partitionBy(BUCKET)
    writer.option("maxRecordsPerFile", declared or 0).parquet(path)
    if declared is not None and mode == "overwrite":
        set_marker(spark, _declared(path), declared)  # after the old log is gone


def _declared(path: str) -> str:
    # File sources leave out names that begin so.
    return f"{path.rstrip('/')}/_rows_per_file"


def rows_per_file(spark: SparkSession, path: str) -> int | None:
    """How many rows a file of a log has at most, if that is declared."""
    return get_marker(spark, _declared(path))


def read_changes(
    spark: SparkSession,
    path: str,
    business: T.StructType,
    stream: bool = False,
    buckets: Sequence[int] | str | None = None,
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: str | None = None,
    max_rows_per_trigger: int | None = None,
) -> DataFrame:
    """Flat changes of a log directory.

    Streamed, the log files are the offsets: a batch that is run again reads the same
    files, so nothing is lost or read twice. The limits bound a micro-batch. That of rows
    needs a log that declares the rows of its files (:func:`write_changes`): a batch takes as
    many files as have no more rows if all are full, so it can be smaller where they are not.
    """
    if stream and max_rows_per_trigger is not None:
        declared = rows_per_file(spark, path)
        if declared is None:
            raise ValueError(f"{path} does not declare max_rows_per_file: limit its batches by files or bytes")
        if max_rows_per_trigger < declared:
            raise ValueError(f"a batch has at least one file, and the files of {path} have up to {declared} rows")
        max_files_per_trigger = min(max_files_per_trigger or 2**31 - 1, max_rows_per_trigger // declared)
    reader = (spark.readStream if stream else spark.read).schema(change_schema(business))
    if stream and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if stream and max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    return select_buckets(reader.parquet(path), buckets)
