"""One row per key: the fold every merge starts from."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.names import DEFAULT_ORDER

_RANK = "__rank"


def _orderable(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _orderable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_orderable(f.dataType) for f in kind.fields)
    return not isinstance(kind, (T.MapType, T.VariantType))


def ranking(changes: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> list[str]:
    """The columns that put the changes of a key in order: ``order_by``, then the others by name."""
    used = {c.lower() for c in (*keys, *order_by)}
    ties = sorted(f.name for f in changes.schema.fields if f.name.lower() not in used and _orderable(f.dataType))
    return [*order_by, *ties]


def fold_latest(
    changes: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] = DEFAULT_ORDER,
    descending: bool = True,
) -> DataFrame:
    """Keep the latest row of each key by ``order_by``, NULLs last.

    Rows equal on ``order_by`` are told apart by their other columns in name order, so a
    re-run picks the same row. The rank filter becomes a group limit that runs before the
    shuffle too: at most one row per key and map task is exchanged, however hot the key.
    """
    order = ranking(changes, keys, order_by)
    ranked = [F.col(c).desc_nulls_last() if descending else F.col(c).asc_nulls_last() for c in order]
    window = Window.partitionBy(*keys).orderBy(*ranked)
    return changes.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) == 1).drop(_RANK)


def one_per_key(rows: DataFrame, keys: Sequence[str], rank_by: Sequence[str]) -> DataFrame:
    """One row per key, the lowest by ``rank_by`` (for example a random or hashed rank)."""
    return fold_latest(rows, keys, rank_by, descending=False)


def latest_status(samples: DataFrame, job: str | Sequence[str], ts: str) -> DataFrame:
    """Last sample of every job."""
    return fold_latest(samples, [job] if isinstance(job, str) else list(job), [ts])
