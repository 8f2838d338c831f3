"""State in files bucketed and sorted by key, merged without moving it.

The base is written by Spark's bucketed writer, one sorted file a bucket, so a scan of it already has the
partitioning that a join by key asks for: a merge shuffles the changes and never the state, however
large both are. Snapshot and fold are one full outer join; folding writes every bucket from the task
that merged it. Keys are unique in the base and in the folded changes, so no task gets more than its
bucket.

``base/v=n/`` is a version of the base, ``log-m/_batch_id=n/`` a batch since version m was made anew, and the
marker ``current`` says which version, log and batches count. A write that dies leaves a version that
nothing refers to.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.buckets import quote
from tidemark.names import BATCH_ID, DEFAULT_ORDER, DELETE, DELETE_MODES, DELETED_AT, IS_DELETED, META, OP, OPS, one_of
from tidemark.operators.fold import fold_latest
from tidemark.operators.merge import with_delete_flags
from tidemark.sources.changes import META_FIELDS
from tidemark.sources.swap import delete_path, get_marker, numbers_in, path_exists, set_marker

_HERE, _CHANGED = "__here", "__changed"


@dataclass(frozen=True)
class BucketedTable:
    """Where a bucketed table is stored and how changes are applied; the fields mean what they do in ``StateTable``.

    ``buckets`` is the number of tasks of a merge: choose it so that a bucket of the full table fits a task.
    """

    path: str
    keys: tuple[str, ...]
    buckets: int = 16
    delete_mode: str = "hard"
    order_by: tuple[str, ...] = DEFAULT_ORDER
    guard_col: str | None = None

    def __post_init__(self) -> None:
        object.__setattr__(self, "keys", tuple(self.keys))
        object.__setattr__(self, "order_by", tuple(self.order_by))
        one_of("delete_mode", self.delete_mode, DELETE_MODES)
        if self.buckets <= 0:
            raise ValueError("a bucketed table needs at least one bucket")

    @property
    def current_path(self) -> str:
        return f"{self.path.rstrip('/')}/current"

    def version_path(self, version: int) -> str:
        return f"{self.path.rstrip('/')}/base/v={version}"


def _current(spark: SparkSession, table: BucketedTable) -> dict:
    now = get_marker(spark, table.current_path)
    if now is None:
        raise ValueError(f"no bucketed table at {table.path}")
    if (now["keys"], now["buckets"]) != (list(table.keys), table.buckets):
        raise ValueError(f"the table at {table.path} has keys {now['keys']} in {now['buckets']} buckets")
    return now


def _with_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys are set; a missing one is an error."""
    for key in keys:
        told = F.raise_error(F.lit(f"key column {key} is NULL")).cast("boolean")
        rows = rows.where(F.when(F.col(quote(key)).isNull(), told).otherwise(F.lit(True)))
    return rows


def _log_path(table: BucketedTable, now: dict) -> str:
    return f"{table.path.rstrip('/')}/{now['log']}"


def _write(spark: SparkSession, table: BucketedTable, rows: DataFrame, version: int, folded: int, log: str) -> None:
    path = table.version_path(version)
    delete_path(spark, path)
    name = f"tidemark_{uuid.uuid4().hex}"
    writer = rows.write.format("parquet").bucketBy(table.buckets, *table.keys).sortBy(*table.keys)
    writer.option("path", path).saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # the files stay, they are not the catalog's
    schema = T.StructType(rows.schema.fields).jsonValue()
    now = {"version": version, "folded": folded, "log": log, "schema": schema}
    set_marker(spark, table.current_path, now | {"keys": list(table.keys), "buckets": table.buckets})


def create_bucketed(spark: SparkSession, rows: DataFrame, table: BucketedTable) -> BucketedTable:
    """Write the first version; a table that is there is replaced, and its log goes.

    Keys must be unique and not NULL: a repeated one is an error.
    """
    if table.delete_mode == "soft":
        rows = with_delete_flags(rows)
    placed = _with_keys(rows, table.keys).repartition(table.buckets, *[F.col(quote(k)) for k in table.keys])
    again = placed.groupBy(*[F.col(quote(k)) for k in table.keys]).count().where(F.col("count") > 1)
    if not again.isEmpty():
        raise ValueError(f"rows of equal {', '.join(table.keys)}: keys of a bucketed table are unique")
    before = get_marker(spark, table.current_path)
    version = before["version"] + 1 if before else 0
    _write(spark, table, placed, version, -1, f"log-{version}")
    if before:
        delete_path(spark, _log_path(table, before))
    _expire(spark, table, version)
    return table


def _expire(spark: SparkSession, table: BucketedTable, version: int) -> None:
    """Delete versions before the last one: readers that began with that one can end."""
    for old in numbers_in(spark, f"{table.path.rstrip('/')}/base", "v"):
        if old < version - 1:
            delete_path(spark, table.version_path(old))


def _base(spark: SparkSession, table: BucketedTable, now: dict) -> DataFrame:
    """The current version with its bucketing, which only a table of the catalog can carry; it is there for a moment."""
    schema = T.StructType.fromJson(now["schema"])
    columns = ", ".join(f"{quote(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    keys, name = ", ".join(map(quote, table.keys)), f"tidemark_{uuid.uuid4().hex}"
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) "
        f"INTO {table.buckets} BUCKETS LOCATION '{table.version_path(now['version'])}'"
    )
    rows = spark.table(name).select("*")
    spark.sql(f"DROP TABLE {name}")
    return rows


def append_bucketed(spark: SparkSession, table: BucketedTable, changes: DataFrame, batch_id: int) -> None:
    """Log a batch of flat changes. Writing the same batch again replaces it."""
    now = _current(spark, table)
    if batch_id <= now["folded"]:
        raise ValueError(f"batch {batch_id} is not after the last one folded, {now['folded']}")
    changes.write.mode("overwrite").parquet(f"{_log_path(table, now)}/{BATCH_ID}={int(batch_id)}")


def _log(spark: SparkSession, table: BucketedTable, now: dict, upto: int | None) -> DataFrame | None:
    if not path_exists(spark, _log_path(table, now)):
        return None
    own = {IS_DELETED, DELETED_AT, *META}
    fields = [f for f in T.StructType.fromJson(now["schema"]).fields if f.name not in own]
    schema = T.StructType([*fields, *META_FIELDS, T.StructField(BATCH_ID, T.IntegerType())])
    log = spark.read.schema(schema).parquet(_log_path(table, now)).where(F.col(BATCH_ID) > now["folded"])
    return log if upto is None else log.where(F.col(BATCH_ID) <= upto)


def merge_in_place(
    base: DataFrame, changes: DataFrame, table: BucketedTable, deleted_at: Column | None = None
) -> DataFrame:
    """Apply flat changes to a bucketed base: one full outer join, for which only the changes are shuffled."""
    keys = table.keys
    placed = _with_keys(changes.where(F.col(OP).isin(*OPS)), keys)
    placed = placed.repartition(table.buckets, *[F.col(quote(k)) for k in keys])
    latest = fold_latest(placed, keys, table.order_by).withColumn(_CHANGED, F.lit(True))
    if table.delete_mode == "ignore":
        latest = latest.where(F.col(OP) != DELETE)
    mine, theirs = (lambda c: F.col(f"s.{quote(c)}")), (lambda c: F.col(f"t.{quote(c)}"))
    match = [theirs(k) == mine(k) for k in keys]
    both = base.withColumn(_HERE, F.lit(True)).alias("t").join(latest.alias("s"), match, "full_outer")

    here, applies = theirs(_HERE).isNotNull(), mine(_CHANGED).isNotNull()
    if table.guard_col is not None:
        guard = table.guard_col
        applies = applies & ~(theirs(guard).isNotNull() & (mine(guard).isNull() | F.coalesce(theirs(guard) > mine(guard), F.lit(False))))
    deleted = applies & (mine(OP) == DELETE)
    new = applies & ~deleted
    soft = table.delete_mode == "soft"
    if soft:
        # A delete that arrives before its insert outranks it later, where there is a guard to tell.
        stays = here | new | (deleted if table.guard_col is not None else F.lit(False))
    else:
        stays = (here & ~applies) | new
    at = F.current_timestamp() if deleted_at is None else deleted_at
    given = {c.lower() for c in latest.columns}
    columns = []
    for field in base.schema.fields:
        name = field.name
        if name.lower() in {k.lower() for k in keys}:
            value = F.coalesce(theirs(name), mine(name))
        elif name == IS_DELETED and soft:
            value = F.when(new, F.lit(False)).when(deleted, F.lit(True)).otherwise(theirs(name))
        elif name == DELETED_AT and soft:
            none = F.lit(None).cast(field.dataType)
            value = F.when(new, none).when(deleted, at.cast(field.dataType)).otherwise(theirs(name))
        else:
            change = mine(name).cast(field.dataType) if name.lower() in given else F.lit(None).cast(field.dataType)
            renewed = new | (deleted & ~here)
            if table.guard_col is not None and name.lower() == table.guard_col.lower():
                renewed = applies
            value = F.when(renewed, change).otherwise(theirs(name))
        columns.append(value.alias(name))
    return both.where(stays).select(*columns)


def read_bucketed(
    spark: SparkSession,
    table: BucketedTable,
    view: str = "snapshot",
    as_of: int | None = None,
    deleted_at: Column | None = None,
) -> DataFrame:
    """The stored version (``base``), or it with the batches logged since, up to ``as_of`` (``snapshot``)."""
    now = _current(spark, table)
    if as_of is not None and as_of < now["folded"]:
        raise ValueError(f"batch {as_of} is already folded into a later base")
    base = _base(spark, table, now)
    log = None if one_of("view", view, ("snapshot", "base")) == "base" else _log(spark, table, now, as_of)
    return base if log is None else merge_in_place(base, log.drop(BATCH_ID), table, deleted_at)


def fold_bucketed(
    spark: SparkSession, table: BucketedTable, upto: int | None = None, deleted_at: Column | None = None
) -> int:
    """Write a new version with the logged batches up to ``upto``; returns the last batch in it.

    Version and batch number change by one marker; the batches and the version before the last go afterwards.
    """
    now = _current(spark, table)
    logged = numbers_in(spark, _log_path(table, now), BATCH_ID)
    batches = [n for n in logged if n > now["folded"] and (upto is None or n <= upto)]
    if not batches:
        return now["folded"]
    last = max(batches)
    merged = read_bucketed(spark, table, as_of=last, deleted_at=deleted_at)
    _write(spark, table, merged, now["version"] + 1, last, now["log"])
    for n in logged:
        if n <= last:
            delete_path(spark, f"{_log_path(table, now)}/{BATCH_ID}={n}")
    _expire(spark, table, now["version"] + 1)
    return last
