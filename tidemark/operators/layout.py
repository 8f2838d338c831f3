"""File layout of a stored table: compaction, Z-order, and what the files look like."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.buckets import parse_ranges, rebalance_by_bucket, select_buckets
from tidemark.functions.quantiles import ordinal, running_total, with_rank
from tidemark.functions.zorder import interleave
from tidemark.names import BUCKET
from tidemark.sources.swap import finish, replace

_Z = "__z"
_TIE = "__tie"


def cluster_columns(df: DataFrame, columns: str | Sequence[str]) -> list[str]:
    """The columns to cluster by, given as names or as one comma-separated text, as the table spells them."""
    listed = columns.split(",") if isinstance(columns, str) else columns
    spelled = {name.lower(): name for name in df.columns}
    wanted = [name.strip().lower() for name in listed if name.strip()]
    if absent := [name for name in wanted if name not in spelled]:
        raise ValueError(f"cannot cluster by {', '.join(absent)}: the table has {', '.join(df.columns)}")
    if not wanted:
        raise ValueError("clustering takes one column or more")
    return [spelled[name] for name in wanted]


def with_zvalue(df: DataFrame, columns: Sequence[str], bits: int = 8) -> DataFrame:
    """Add the Z-value of the columns' quantile ranks as ``__z``."""
    columns = cluster_columns(df, columns)
    if bits * len(columns) > 63:
        raise ValueError(f"{bits} bits of {len(columns)} columns do not fit a number of 63 bits")
    ranks, ranked = [f"__r_{c}" for c in columns], df
    for column, name in zip(columns, ranks):
        ranked = with_rank(ranked, column, 1 << bits, name)
    return ranked.select(*df.columns, interleave([F.col(r) for r in ranks], bits).alias(_Z))


def _stored(spark: SparkSession, path: str, schema: T.StructType | None) -> DataFrame:
    """A table by path. Without a schema the files' schemas are merged: they may differ after an evolution."""
    reader = spark.read.schema(schema) if schema is not None else spark.read.option("mergeSchema", "true")
    return reader.parquet(path)


def bucket_files(spark: SparkSession, path: str, buckets: Sequence[int] | str | None = None) -> dict[int, list[int]]:
    """File sizes by bucket, by listing the directories of the chosen buckets (all when none is listed)."""
    finish(spark, path)
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    chosen = parse_ranges(buckets) if isinstance(buckets, str) else list(buckets or [])
    out = {}
    for directory in files.listStatus(root):
        name, _, number = directory.getPath().getName().partition("=")
        if name == BUCKET and (not chosen or int(number) in chosen):
            inside = [f for f in files.listStatus(directory.getPath()) if not f.getPath().getName().startswith(("_", "."))]
            out[int(number)] = [f.getLen() for f in inside]
    return out


def advisory_bytes(spark: SparkSession) -> int:
    """``spark.sql.adaptive.advisoryPartitionSizeInBytes`` as a number."""
    text = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64MB")
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(text)


_RESULT = "rewritten_buckets int, files_before long, bytes_before long, files_after long, bytes_after long"


def _result(spark: SparkSession, rewritten: int, before: dict[int, list[int]], after: dict[int, list[int]]) -> DataFrame:
    counts = [x for sizes in (before, after) for x in (sum(map(len, sizes.values())), sum(map(sum, sizes.values())))]
    return spark.createDataFrame([(rewritten, *counts)], _RESULT)


def compact(
    spark: SparkSession,
    path: str,
    buckets: Sequence[int] | str | None = None,
    schema: T.StructType | None = None,
    small_bytes: int | None = None,
) -> DataFrame:
    """Bring the files of buckets near the advisory size; rows stay the same.

    Only buckets with two files or more below ``small_bytes`` are rewritten; without it, an eighth
    of ``spark.sql.adaptive.advisoryPartitionSizeInBytes``, which is the target. Small buckets get
    one file, large ones several, with no bucket tied to a single task. Returns one row:
    ``rewritten_buckets``, and files and bytes of the chosen buckets before and after.
    """
    small = advisory_bytes(spark) // 8 if small_bytes is None else small_bytes
    before = bucket_files(spark, path, buckets)
    poor = sorted(b for b, sizes in before.items() if sum(size < small for size in sizes) > 1)
    if poor:
        replace(spark, path, rebalance_by_bucket(select_buckets(_stored(spark, path, schema), poor)), poor)
    return _result(spark, len(poor), before, bucket_files(spark, path, buckets))


def rank_bits(files: int, columns: int) -> int:
    """Bits of a column's rank for a table cut into so many files: 64 Z-values a file, 8 bits at least."""
    wanted = max(8, math.ceil(math.log2(64 * max(1, files)) / columns))
    if wanted * columns > 63:
        raise ValueError(f"{columns} columns need {wanted} bits each, more than 63: cluster by fewer, or give bits")
    return wanted


def zorder(
    spark: SparkSession,
    path: str,
    columns: str | Sequence[str],
    buckets: Sequence[int] | str | None = None,
    bits: int | None = None,
    files: int | None = None,
    compact_first: bool = False,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Rewrite buckets so that rows close in ``columns`` share files.

    Rows are range-partitioned by bucket and Z-value; one column needs no ranks and is its own. A row
    number of the scan ends the range key, so that even equal rows can be spread over several files.
    Nothing the driver holds grows with the files or rows. ``files`` follows from
    the stored bytes and the advisory size (but is at least one a bucket), ``bits`` from
    ``files``, if not given. Returns the row of :func:`compact`.
    """
    if compact_first:
        compact(spark, path, buckets, schema)
    before = bucket_files(spark, path, buckets)
    stored = select_buckets(_stored(spark, path, schema), buckets)
    if files is None:
        files = max(1, len(before), -(-sum(map(sum, before.values())) // advisory_bytes(spark)))
    spelled = cluster_columns(stored, columns)
    if len(spelled) == 1:
        keyed = stored.withColumn(_Z, ordinal(stored, spelled[0]))
    else:
        keyed = with_zvalue(stored, spelled, bits or rank_bits(files, len(spelled)))
    keyed = keyed.withColumn(_TIE, F.monotonically_increasing_id())
    order = [BUCKET, _Z, _TIE]
    ordered = keyed.repartitionByRange(files, *order).sortWithinPartitions(*order).drop(_Z, _TIE)
    replace(spark, path, ordered, sorted(before))
    return _result(spark, len(before), before, bucket_files(spark, path, buckets))


def layout_stats(
    spark: SparkSession, path: str, columns: Sequence[str] = (), schema: T.StructType | None = None
) -> DataFrame:
    """One row per data file: bucket, bytes, rows, and the value range of some columns."""
    files = _stored(spark, path, schema).select(
        "*", F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("file_bytes")
    )
    by = [BUCKET] if BUCKET in files.columns else []
    ranges = [f(c).alias(f"{n}_{c}") for c in columns for n, f in (("min", F.min), ("max", F.max))]
    return files.groupBy(*by, "file_path", "file_bytes").agg(F.count(F.lit(1)).alias("row_count"), *ranges)


def clustering_depth(
    spark: SparkSession, path: str, columns: str | Sequence[str], schema: T.StructType | None = None
) -> DataFrame:
    """How many files a value of a column may be in, by the files' value ranges: one row per column.

    ``files`` with a value, ``mean_depth`` (files whose range holds the smallest value of a file, on
    average over the files: 1 if no ranges overlap), ``max_depth``, and ``mean_read`` (files a lookup of a
    row's value has to read, on average over the rows, taking a file's rows to be at the ends of
    its range). Ranges are opened and closed in the order of their ends, by ranges of that order.
    """
    files = layout_stats(spark, path, names := cluster_columns(_stored(spark, path, schema), columns), schema)
    out = None
    for name in names:
        held = files.where(F.col(f"min_{name}").isNotNull())
        one = F.lit(1).cast("long")
        opened = held.select(F.col(f"min_{name}").alias("v"), F.lit(0).alias("closes"), one.alias("n"), "row_count")
        closed = held.select(F.col(f"max_{name}").alias("v"), F.lit(1).alias("closes"), (-one).alias("n"), "row_count")
        swept, _ = running_total(opened.unionByName(closed), ["v", "closes"], "n")
        opens, depth = F.col("closes") == 0, F.col("__before") + F.greatest("n", F.lit(0))
        # Ranges that open at one value hold it together: the deepest of them counts for all.
        at = swept.withColumn("depth", depth).groupBy("v", "closes").agg(
            F.max("depth").alias("depth"), F.count(F.lit(1)).alias("ends"), F.sum("row_count").alias("ended")
        )
        read = F.sum(F.col("depth") * F.col("ended")) / F.sum("ended")
        row = at.agg(
            F.coalesce(F.sum(F.when(opens, F.col("ends"))), F.lit(0)).alias("files"),
            (F.sum(F.when(opens, F.col("depth") * F.col("ends"))) / F.sum(F.when(opens, F.col("ends")))).alias("mean_depth"),
            F.max("depth").alias("max_depth"),
            read.alias("mean_read"),
        ).select(F.lit(name).alias("column_name"), "*")
        out = row if out is None else out.unionByName(row)
    return out
