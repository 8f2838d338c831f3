"""Cut points of a column, the rank of a value among them, and ranks of all values without cut points."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.keybytes import ntz_micros
from tidemark.session import scratch_dir


def ordinal(df: DataFrame, column: str) -> Column:
    """What is compared with the column's cut points: a number that sorts like it, or the whole text."""
    kind, value = df.schema[column].dataType.typeName(), F.col(column)
    if kind == "timestamp":
        return F.unix_micros(value)
    if kind == "timestamp_ntz":
        return ntz_micros(value)
    if kind == "date":
        return F.unix_date(value).cast("bigint")
    if kind == "boolean":
        return value.cast("int").cast("bigint")
    return value


def _is_text(df: DataFrame, column: str) -> bool:
    return df.schema[column].dataType.typeName() in ("string", "varchar", "char", "binary")


def text_cuts(df: DataFrame, column: str, parts: int) -> list:
    """Up to ``parts - 1`` values that cut the column's distinct whole values into ranges of about equal number.

    They are the smallest values of a range partitioning. Values are made distinct first, with
    partial results before the shuffle, so a frequent one fills no task. The driver gets one
    value per range.
    """
    values = df.select(F.col(column).alias("v")).where(F.col("v").isNotNull()).distinct()
    ranges = values.repartitionByRange(parts, "v").groupBy(F.spark_partition_id()).agg(F.min("v").alias("v"))
    return sorted(r["v"] for r in ranges.collect())[1:]


def cut_points(
    df: DataFrame, columns: Sequence[str], parts: int, accuracy: int = 10_000
) -> tuple[int, dict[str, list]]:
    """Row count, and up to ``parts - 1`` distinct cut points per column: one pass, and one more per text column.

    The sketches merge map-side and the result has a fixed size, whatever the table holds.
    """
    fractions = [i / parts for i in range(1, parts)]
    sketched = [c for c in columns if not _is_text(df, c)]
    sketches = [
        F.percentile_approx(ordinal(df, c), fractions, accuracy).alias(f"q{i}") for i, c in enumerate(sketched)
    ]
    row = df.agg(F.count(F.lit(1)).alias("n"), *sketches).first()
    cuts = {c: sorted(set(row[f"q{i}"] or [])) for i, c in enumerate(sketched)}
    return row["n"], cuts | {c: text_cuts(df, c, parts) for c in columns if _is_text(df, c)}


def rank_column(df: DataFrame, column: str, cuts: list) -> Column:
    """How many cut points are at or below the value (NULL lowest), by binary search."""
    if not cuts:
        return F.lit(0)
    value, points = ordinal(df, column), F.lit(cuts)
    steps = F.lit([1 << bit for bit in range(len(cuts).bit_length() - 1, -1, -1)])

    def narrow(rank: Column, step: Column) -> Column:
        return F.when(value >= F.try_element_at(points, rank + step), rank + step).otherwise(rank)

    return F.aggregate(steps, F.lit(0), narrow)


def running_total(rows: DataFrame, order_by: Sequence[str], value: str) -> tuple[DataFrame, int]:
    """Add ``__before``, the sum of ``value`` (long) over the rows before each one in the order, and return the sum of all.

    Rows are ordered by ranges, which are stored; each is summed by itself, and then raised by the sum of
    the ranges before it. The driver gets one number per range, and a range has one task whatever the
    number of rows. Rows equal in the order should not be more than a task holds.
    """
    spark, path = rows.sparkSession, scratch_dir(rows.sparkSession, "ranges")
    ranged = rows.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    ranged = ranged.withColumn("__range", F.spark_partition_id())
    ranged.write.parquet(path)
    ranged = spark.read.schema(ranged.schema).parquet(path)
    sums, total = [], 0
    for at, n in sorted(map(tuple, ranged.groupBy("__range").agg(F.sum(value)).collect())):
        sums.append((at, total))
        total += n
    ahead = spark.createDataFrame(sums, "__range int, __ahead long")
    within = Window.partitionBy("__range").orderBy(*order_by).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(value).over(within), F.lit(0)) + F.col("__ahead")
    summed = ranged.join(F.broadcast(ahead), "__range").withColumn("__before", before)
    return summed.drop("__range", "__ahead"), total


def with_rank(df: DataFrame, column: str, parts: int, name: str) -> DataFrame:
    """Add the share of rows with a smaller value, in whole ``parts``: 0 for the lowest and for NULL, below ``parts`` for all.

    Values are counted with partial results before the shuffle, ranked by ranges, and joined back: equal
    values get one rank, a frequent value is one row of the ranks, and AQE splits its rows in the join.
    """
    keyed = df.withColumn("__v", ordinal(df, column))
    counts = keyed.where(F.col("__v").isNotNull()).groupBy("__v").agg(F.count(F.lit(1)).alias("__n"))
    summed, total = running_total(counts, ["__v"], "__n")
    rank = F.expr(f"cast(cast(__before as decimal(38, 0)) * {parts} div {max(total, 1)} as bigint)")
    ranks = summed.select("__v", rank.alias(name))
    return keyed.join(ranks, "__v", "left").withColumn(name, F.coalesce(name, F.lit(0))).drop("__v")
