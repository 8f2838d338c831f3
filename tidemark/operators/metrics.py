"""Job-metrics tables: counter rates, latest samples, and sums over jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.quantiles import cut_points, rank_column

BITS_PER_BYTE = 8
SECTOR_BYTES = 512
# Rows a time range aims at.
CHUNK_ROWS = 5_000_000


def with_previous(
    samples: DataFrame,
    by: Sequence[str],
    ts: str,
    columns: Sequence[str],
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Add ``prev_<column>`` and ``prev_<ts>`` of the preceding sample of the same group.

    A group may hold much of the table, so it is not windowed as a whole. Time is cut into
    ranges of about ``chunk_rows`` samples (of all groups); ``lag`` runs per group and
    range, and the first sample of a range takes its predecessor from a window over one row
    per group and range. Counting costs one pass when this is called, and the cut points of
    several ranges another one over ``ts``.
    """
    carried = [ts, *columns]
    # A struct is never NULL and equal to one with the same NULLs: joined with a plain "=", it keeps the
    # windows' partitioning, so the samples are shuffled once.
    group = F.struct(*by)
    chunks = max(1, -(-samples.count() // chunk_rows))
    cuts = cut_points(samples, [ts], chunks, accuracy=max(10_000, 10 * chunks))[1][ts] if chunks > 1 else []
    chunked = samples.withColumn("__group", group)
    chunked = chunked.withColumn("__chunk", rank_column(samples, ts, cuts))
    # Equal times are put in order by the carried columns, here and in the last sample of a range.
    inside = Window.partitionBy("__group", "__chunk").orderBy(ts, *[c for c in columns if c != ts])
    lagged = chunked.select(
        "*", *[F.lag(c).over(inside).alias(f"__in_{c}") for c in carried], F.row_number().over(inside).alias("__rn")
    )
    if chunks == 1:
        return lagged.select(*samples.columns, *[F.col(f"__in_{c}").alias(f"prev_{c}") for c in carried])
    lasts = chunked.groupBy("__group", "__chunk").agg(F.max(F.struct(*carried)).alias("__last"))
    across = Window.partitionBy("__group").orderBy("__chunk")
    before = lasts.select("__group", "__chunk", F.lag("__last").over(across).alias("__before"))
    joined = lagged.alias("l").join(
        before.alias("b"),
        [F.col(f"l.{c}") == F.col(f"b.{c}") for c in ("__group", "__chunk")],
        "left_outer",
    )
    first = F.col("__rn") == 1
    return joined.select(
        *[F.col(f"l.{c}") for c in samples.columns],
        *[
            F.when(first, F.col(f"__before.{c}")).otherwise(F.col(f"__in_{c}")).alias(f"prev_{c}")
            for c in carried
        ],
    )


def _megabits(current: str, interval: Column, unit_bytes: int) -> Column:
    moved = F.greatest(F.col(current) - F.col(f"prev_{current}"), F.lit(0)) * unit_bytes * BITS_PER_BYTE
    rate = F.when(interval > 0, moved / (interval * 1_000_000.0)).otherwise(F.lit(0.0))
    return F.round(F.coalesce(rate, F.lit(0.0)), 2)


def counter_rates(
    samples: DataFrame,
    by: Sequence[str],
    ts: str,
    byte_counters: Sequence[str] = (),
    sector_counters: Sequence[str] = (),
    interval_seconds: float | None = None,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Megabits per second between consecutive samples as ``<counter>_mbps``.

    A counter that went backwards, and the first sample of a group, give 0. The interval
    is the time between the samples unless one is given.
    """
    counters = [*byte_counters, *sector_counters]
    previous = with_previous(samples, by, ts, counters, chunk_rows)
    if interval_seconds is not None:
        interval = F.lit(float(interval_seconds))
    else:
        micros = F.unix_micros(F.col(ts).cast("timestamp")) - F.unix_micros(F.col(f"prev_{ts}").cast("timestamp"))
        interval = micros / 1e6
    rates = [_megabits(c, interval, 1).alias(f"{c}_mbps") for c in byte_counters]
    rates += [_megabits(c, interval, SECTOR_BYTES).alias(f"{c}_mbps") for c in sector_counters]
    return previous.select(*samples.columns, *rates)


def parse_measure(text: Column) -> Column:
    """``"12.5%"``, ``"3GiB"`` or ``"512MiB"`` as a number; memory comes out in MiB."""
    number = F.regexp_extract(text, r"^\s*([0-9.]+)", 1).try_cast("double")
    return F.when(F.endswith(F.trim(text), F.lit("GiB")), number * 1024).otherwise(number)


def metrics_summary(samples: DataFrame, ts: str, measures: Sequence[str]) -> DataFrame:
    """Every measure summed over all jobs, per sample time."""
    return samples.groupBy(ts).agg(
        F.count(F.lit(1)).alias("jobs"), *[F.sum(m).alias(f"total_{m}") for m in measures]
    )
