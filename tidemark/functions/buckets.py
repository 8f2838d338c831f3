"""Key buckets: unit of table partitioning, pruning and read parallelism."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.keybytes import field, key_bytes, require_not_null
from tidemark.names import BUCKET

# Every entry maps named key columns to a bigint/int hash as SQL text, so that the same
# text serves the Column API and the registered SQL function.
HASHES: dict[str, Callable[[Sequence[str]], str]] = {
    "xxhash64": lambda cols: f"xxhash64({', '.join(cols)})",
    "murmur3": lambda cols: f"hash({', '.join(cols)})",
    # First 32 bits of the md5 of the keys as text: any other engine can recompute it.
    "md5": lambda cols: (
        "cast(conv(substr(md5(concat_ws('|', "
        + ", ".join(f"cast({c} as string)" for c in cols)
        + ")), 1, 8), 16, 10) as bigint)"
    ),
    # NULL-tolerant text hash, for tables keyed by columns that may be NULL.
    "spark_hash": lambda cols: "hash(" + ", ".join(f"coalesce(cast({c} as string), '')" for c in cols) + ")",
}


def quote(name: str) -> str:
    """Identifier quoted for SQL text."""
    return "`" + name.replace("`", "``") + "`"


def _hashed(column: str, kind: str) -> str:
    """SQL text of what is hashed for a column: a point in time counts by its number, whose text no time zone changes."""
    return f"unix_micros({column})" if kind.strip().lower() == "timestamp" else column


def bucket_sql(columns: Sequence[str], n: int, bucket_fn: str) -> str:
    """SQL text of the bucket of already quoted columns; always in ``0 .. n-1``."""
    if bucket_fn not in HASHES:
        raise ValueError(f"bucket_fn must be one of {', '.join(HASHES)}, key_bytes; got {bucket_fn!r}")
    return f"cast(pmod({HASHES[bucket_fn](columns)}, {int(n)}) as int)"


def bucket_column(df: DataFrame, keys: Sequence[str], n: int, bucket_fn: str = "xxhash64") -> Column:
    """Bucket of a row. NULL keys are an error except under ``spark_hash``."""
    names = [field(df.schema, k).name for k in keys]
    if bucket_fn == "key_bytes":
        return F.pmod(F.xxhash64(key_bytes(df, names)), F.lit(int(n))).cast("int")
    columns = [_hashed(quote(c), field(df.schema, c).dataType.simpleString()) for c in names]
    bucket = F.expr(bucket_sql(columns, n, bucket_fn))
    if bucket_fn == "spark_hash":
        return bucket
    for name in names:
        if field(df.schema, name).nullable:
            bucket = require_not_null(F.col(quote(name)), name, bucket)
    return bucket


def with_bucket(df: DataFrame, keys: Sequence[str], n: int, bucket_fn: str = "xxhash64") -> DataFrame:
    """Add ``_bucket``. ``n <= 0`` leaves the frame unchanged (``spark_hash`` counts as one bucket)."""
    if not keys:
        raise ValueError("at least one key column is required")
    if n <= 0 and bucket_fn != "spark_hash":
        return df
    return df.withColumn(BUCKET, bucket_column(df, keys, max(1, n), bucket_fn))


def register_bucket_function(
    spark: SparkSession, name: str, key_types: dict[str, str], n: int, bucket_fn: str = "xxhash64"
) -> None:
    """Make the bucket callable from SQL text as ``name(key, ...)``.

    A SQL function, not a UDF: Catalyst inlines its body, so it stays in generated code.
    """
    arguments = ", ".join(f"{quote(k)} {t}" for k, t in key_types.items())
    body = bucket_sql([_hashed(quote(k), t) for k, t in key_types.items()], max(1, n), bucket_fn)
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {quote(name)}({arguments}) RETURNS INT RETURN {body}")


def rebalance_by_bucket(df: DataFrame) -> DataFrame:
    """Co-locate rows by bucket before a partitioned write.

    AQE sizes the result: a bucket holding a large share of the rows is split over several
    tasks, small buckets share one. A plain ``repartition(n, bucket)`` could do neither.
    """
    return df.hint("rebalance", F.col(BUCKET))


def parse_ranges(text: str | None) -> list[int]:
    """``"0-3,8"`` to ``[0, 1, 2, 3, 8]``; malformed ranges are an error."""
    chosen: dict[int, None] = {}
    for part in (text or "").split(","):
        part = part.strip()
        if not part:
            continue
        bounds = [b.strip() for b in part.split("-")]
        if len(bounds) > 2 or not all(b.isdigit() for b in bounds):
            raise ValueError(f"{part!r} is neither a bucket number nor low-high")
        low, high = int(bounds[0]), int(bounds[-1])
        if high < low:
            raise ValueError(f"{part!r} is neither a bucket number nor low-high")
        chosen.update(dict.fromkeys(range(low, high + 1)))
    return list(chosen)


def select_buckets(df: DataFrame, buckets: Sequence[int] | str | None) -> DataFrame:
    """Keep the listed buckets (all when none is listed); prunes partitions of a stored table."""
    chosen = parse_ranges(buckets) if isinstance(buckets, str) else list(buckets or [])
    return df.where(F.col(BUCKET).isin(chosen)) if chosen else df
