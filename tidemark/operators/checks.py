"""Counts, key checks, freshness and previews."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from tidemark.names import BUCKET


def table_stats(tables: dict[str, DataFrame], distinct: Sequence[str] = ()) -> DataFrame:
    """Row count of every table, and of the distinct values of some columns; one row each."""
    parts = []
    for name, df in tables.items():
        counts = [F.count(F.lit(1)).alias("row_count")]
        counts += [F.count_distinct(F.col(c)).alias(f"distinct_{c}") for c in distinct]
        parts.append(df.agg(*counts).select(F.lit(name).alias("table_name"), "*"))
    return reduce(DataFrame.unionByName, parts)


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Number of distinct value combinations, one row.

    Two steps (distinct, then count) so that no single task sees all the values.
    """
    return df.select(*columns).distinct().agg(F.count(F.lit(1)).alias("distinct_count"))


def check_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: ``row_count``, ``distinct_pk_count``, ``duplicate_keys``, ``is_unique``."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("row_count"),
        F.count(F.lit(1)).alias("distinct_pk_count"),
        F.count(F.when(F.col("n") > 1, 1)).alias("duplicate_keys"),
    ).withColumn("is_unique", F.col("row_count") == F.col("distinct_pk_count"))


def require_unique(report: Row, keys: Sequence[str]) -> None:
    """Raise if a :func:`check_keys` row found a key more than once."""
    if not report["is_unique"]:
        raise ValueError(
            f"key ({', '.join(keys)}) is not unique: {report['row_count']} rows, "
            f"{report['distinct_pk_count']} distinct keys"
        )


def assert_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise if a key occurs more than once."""
    require_unique(check_keys(df, keys).first(), keys)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with the number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).where(F.col("row_count") > 1)


def touched_buckets(changes: DataFrame) -> DataFrame:
    """Buckets a batch has rows in."""
    return changes.select(BUCKET).distinct()


def bucket_stats(df: DataFrame) -> DataFrame:
    """Rows per bucket, and their ratio to the mean as ``skew``."""
    counts = df.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("row_count"))
    # One row per bucket is left here, so the unpartitioned window is small by design.
    mean = F.avg("row_count").over(Window.partitionBy(F.lit(1)))
    return counts.withColumn("skew", F.round(F.col("row_count") / mean, 4))


def freshness(df: DataFrame, ts: str, by: Sequence[str] = ()) -> DataFrame:
    """Newest event time, overall or per group, as ``max_ts``."""
    return df.groupBy(*by).agg(F.max(ts).alias("max_ts"))


def freshness_lag(df: DataFrame, ts: str, by: Sequence[str], visible_at=None) -> DataFrame:
    """How far each group is behind, in seconds: ``visible_at`` (default: newest event of all) minus its newest."""
    newest = df.select(F.max(ts)).scalar() if visible_at is None else visible_at
    groups = freshness(df, ts, by)
    lag = (F.unix_micros(newest.cast("timestamp")) - F.unix_micros(F.col("max_ts").cast("timestamp"))) / 1e6
    return groups.withColumn("lag_seconds", lag)


def check_counts(source: dict[str, DataFrame], loaded: dict[str, DataFrame]) -> DataFrame:
    """Source and loaded row counts side by side, with ``matches``."""
    left = table_stats(source).withColumnRenamed("row_count", "source_rows")
    right = table_stats(loaded).withColumnRenamed("row_count", "loaded_rows")
    joined = left.join(right, "table_name", "full_outer")
    return joined.withColumn("matches", F.col("source_rows").eqNullSafe(F.col("loaded_rows")))


def preview(df: DataFrame, order_by: Sequence[str], n: int = 20) -> DataFrame:
    """First ``n`` rows by ``order_by``; planned as a top-n, not a sort."""
    return df.orderBy(*order_by).limit(n)


def print_preview(df: DataFrame, order_by: Sequence[str], n: int = 20) -> None:
    """Print the schema, the row count and the first rows, untruncated."""
    df.printSchema()
    print(f"row_count={df.count()}")
    preview(df, order_by, n).show(n, truncate=False)


_HASH = "__key_hash"


def key_sketches(rows: DataFrame, keys: Sequence[str], by: Sequence[str] = (BUCKET,), share: float = 0.01) -> DataFrame:
    """A sketch of the most frequent keys per bucket (or other columns): ``by``, ``n_rows``, ``sketch``.

    Sketches of a bucket over several batches can be stored and given to :func:`heavy_keys` together. A
    sketch has ``8 / share`` counters at most, whatever the number of keys, so that no key with that share is missed.
    """
    hashed = rows.select(*by, F.xxhash64(*keys).alias(_HASH))
    sketch = F.expr(f"approx_top_k_accumulate({_HASH}, {_tracked(share)})")
    return hashed.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), sketch.alias("sketch"))


def _tracked(share: float) -> int:
    if not 0 < share <= 1:
        raise ValueError("share must be above 0 and at most 1")
    return math.ceil(8 / share)


def heavy_keys(
    rows: DataFrame,
    keys: Sequence[str],
    share: float = 0.01,
    bucket: str = BUCKET,
    sketches: DataFrame | None = None,
) -> DataFrame:
    """Keys that hold at least ``share`` of the rows of their bucket: keys, bucket, ``row_count``, ``share``.

    Sketches (those given, else made of ``rows``) are merged per bucket and name candidates; only rows of candidates
    are counted, exactly. So no shuffle carries all keys: sketches and counts of candidates are made before it. The bucket must
    follow from the key, NULL is a key like others, and the sketches must have been made of just these rows.
    """
    tracked = _tracked(share)
    sketches = key_sketches(rows, keys, [bucket], share) if sketches is None else sketches
    merged = sketches.groupBy(bucket).agg(
        F.sum("n_rows").alias("__all"), F.expr(f"approx_top_k_combine(sketch, {tracked})").alias("__sketch")
    )
    likely = merged.select(
        F.col(bucket).alias("__bucket"), "__all",
        F.explode(F.expr(f"approx_top_k_estimate(__sketch, {tracked})")).alias("__item"),
    )
    # Estimates are never too small, and too large by less than half a share: at most 2 / share candidates are left.
    likely = likely.where(F.col("__item.count") / F.col("__all") >= share)
    likely = likely.select("__bucket", "__all", F.col("__item.item").alias("__candidate"))
    match = (F.xxhash64(*keys) == F.col("__candidate")) & F.col(bucket).eqNullSafe(F.col("__bucket"))
    counted = rows.join(likely, match).groupBy(*keys, bucket, "__all").agg(F.count(F.lit(1)).alias("row_count"))
    part = F.col("row_count") / F.col("__all")
    return counted.where(part >= share).select(*keys, bucket, "row_count", part.alias("share"))
