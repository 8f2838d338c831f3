"""Stored state: copy-on-write base, merge-on-read log, and views over both.

Layout under ``path``: ``base/_bucket=b/`` holds the folded state, ``log/_batch_id=n/`` one
directory per appended batch and in it one per bucket, ``undo/_batch_id=n/`` what the keys of a
folded batch were before it, ``folded`` the number of the last batch folded into the base, ``history``
that of the first batch to which folds can be undone, ``runs`` which batches were merged into one
directory of the log (that of the last of them), ``imports`` the input files loaded so far, ``batches``
a small file per reported batch, ``schema`` the declared schema of the base, so that no read has to look into data files for it. With the schema
go the table's settings, and opening a table with others is an error: rows would be looked for in the
wrong buckets.

The base, its schema and the folded number change by :mod:`tidemark.sources.swap`: a write that dies
has either not changed the table at all, or is finished by the next one to open it. A batch overwrites
its own log directory.
"""

from __future__ import annotations

import json
import time
from collections.abc import Sequence
from dataclasses import asdict, dataclass
from datetime import datetime, timezone

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.buckets import quote, rebalance_by_bucket, select_buckets, with_bucket
from tidemark.names import (
    BATCH_ID,
    BUCKET,
    DEFAULT_ORDER,
    DELETE,
    DELETE_MODES,
    DELETED_AT,
    IS_DELETED,
    META,
    OP,
    OPS,
    one_of,
)
from tidemark.operators import layout
from tidemark.operators.fold import fold_latest, ranking
from tidemark.operators.merge import (
    MergeCounts,
    apply_folded,
    key_condition,
    merge_changes,
    observed,
    upsert_parts,
    with_delete_flags,
)
from tidemark.sources.catalog import missing_columns, target_schema, validate_schema
from tidemark.sources.changes import META_FIELDS
from tidemark.sources.swap import (
    decide,
    delete_path,
    finish,
    get_marker,
    names_in,
    numbers_in,
    path_exists,
    replace,
    set_marker,
    staging,
)


@dataclass(frozen=True)
class StateTable:
    """Where a table is stored and how its changes are applied.

    ``guard_col`` (a business or metadata column) is kept in the base, and changes older
    than the stored row are ignored; with ``delete_mode="soft"`` deleted keys keep theirs. With ``undo``,
    folding the log keeps what it replaces, for views and rollbacks to batches before the fold.
    """

    path: str
    keys: tuple[str, ...]
    buckets: int = 16
    bucket_fn: str = "xxhash64"
    delete_mode: str = "hard"
    order_by: tuple[str, ...] = DEFAULT_ORDER
    guard_col: str | None = None
    cluster_by: tuple[str, ...] = ()
    undo: bool = False

    def __post_init__(self) -> None:
        object.__setattr__(self, "keys", tuple(self.keys))
        object.__setattr__(self, "cluster_by", tuple(self.cluster_by))
        object.__setattr__(self, "order_by", tuple(self.order_by))
        one_of("delete_mode", self.delete_mode, DELETE_MODES)
        if self.buckets <= 0:
            raise ValueError("a state table needs at least one bucket")

    @property
    def base_path(self) -> str:
        return f"{self.path.rstrip('/')}/base"

    @property
    def log_path(self) -> str:
        return f"{self.path.rstrip('/')}/log"

    @property
    def schema_path(self) -> str:
        return f"{self.path.rstrip('/')}/schema"

    @property
    def folded_path(self) -> str:
        return f"{self.path.rstrip('/')}/folded"

    @property
    def undo_path(self) -> str:
        return f"{self.path.rstrip('/')}/undo"

    @property
    def history_path(self) -> str:
        return f"{self.path.rstrip('/')}/history"

    @property
    def streams_path(self) -> str:
        return f"{self.path.rstrip('/')}/streams"

    @property
    def runs_path(self) -> str:
        return f"{self.path.rstrip('/')}/runs"

    @property
    def imports_path(self) -> str:
        return f"{self.path.rstrip('/')}/imports"

    @property
    def batches_path(self) -> str:
        return f"{self.path.rstrip('/')}/batches"

    @property
    def stats_path(self) -> str:
        return f"{self.path.rstrip('/')}/stats"

    def stats_of(self, time_col: str | None) -> str:
        """Where the counts per bucket are, with the newest value of a column."""
        return f"{self.stats_path}/{f'by={time_col}' if time_col else 'rows'}"

    @property
    def null_keys(self) -> bool:
        """Whether rows without a key have a bucket."""
        return self.bucket_fn == "spark_hash"

    def bucketed(self, rows: DataFrame) -> DataFrame:
        """Rows with their bucket; a bucket that came with the source is recomputed."""
        return with_bucket(rows.drop(BUCKET), self.keys, self.buckets, self.bucket_fn)


def create_state(spark: SparkSession, rows: DataFrame, table: StateTable) -> StateTable:
    """Write the first base. A table that is there is replaced as a whole, with its log, history and streams."""
    rows = table.bucketed(rows)
    if table.delete_mode == "soft":
        rows = with_delete_flags(rows)
    replace_table(spark, table, rebalance_by_bucket(rows))
    return table


def replace_table(
    spark: SparkSession,
    table: StateTable,
    rows: DataFrame,
    max_records_per_file: int = 0,
    markers: dict | None = None,
) -> None:
    """Make bucketed ``rows`` all there is of the table: batches logged before do not apply to them.

    ``markers`` (folder to value) are set with them.
    """
    own = [table.log_path, table.undo_path, table.folded_path, table.history_path, table.streams_path]
    old = [path for path in (*own, table.runs_path, table.imports_path, table.batches_path, table.stats_path) if path not in (markers or {})]
    declared = {table.schema_path: _declaration(table, rows.schema)} | (markers or {})
    replace(spark, table.base_path, rows, None, declared, old, max_records_per_file)


def _data_fields(schema: T.StructType) -> list[T.StructField]:
    return [f for f in schema.fields if f.name != BUCKET]


def _settings(table: StateTable) -> dict:
    own = asdict(table)
    del own["path"], own["cluster_by"], own["undo"]  # none says where a row is
    return json.loads(json.dumps(own))


def _declaration(table: StateTable, schema: T.StructType) -> dict:
    return {"schema": T.StructType(_data_fields(schema)).jsonValue(), "settings": _settings(table)}


def declare_schema(spark: SparkSession, table: StateTable, schema: T.StructType) -> None:
    """Record the base schema (without the bucket, which the directories carry) and the table's settings."""
    set_marker(spark, table.schema_path, _declaration(table, schema))


def is_declared(spark: SparkSession, table: StateTable) -> bool:
    """Whether there is a whole table: its base is put in place at once, and declared with it."""
    finish(spark, table.base_path)
    return get_marker(spark, table.schema_path) is not None and path_exists(spark, table.base_path)


def base_schema(spark: SparkSession, table: StateTable) -> T.StructType:
    """Declared schema of the base, bucket last; fails if the table was made with other settings."""
    finish(spark, table.base_path)
    made = get_marker(spark, table.schema_path)
    if made is None:
        raise ValueError(f"no state at {table.path}")
    asked = _settings(table)
    if other := {name: (value, asked[name]) for name, value in made["settings"].items() if value != asked[name]}:
        told = ", ".join(f"{name} {was!r}, not {now!r}" for name, (was, now) in other.items())
        raise ValueError(f"the table at {table.path} has {told}")
    fields = T.StructType.fromJson(made["schema"]).fields
    return T.StructType([*fields, T.StructField(BUCKET, T.IntegerType())])


def _base(spark: SparkSession, table: StateTable, buckets: Sequence[int] | str | None) -> DataFrame:
    return select_buckets(spark.read.schema(base_schema(spark, table)).parquet(table.base_path), buckets)


def log_schema(spark: SparkSession, table: StateTable) -> T.StructType:
    """Schema of the logged changes: the declared columns, the metadata, bucket and batch."""
    own = {IS_DELETED, DELETED_AT, BUCKET, *META}
    columns = [f for f in base_schema(spark, table).fields if f.name not in own]
    numbers = [T.StructField(BUCKET, T.IntegerType()), T.StructField(BATCH_ID, T.IntegerType())]
    return T.StructType([*columns, *META_FIELDS, *numbers])


def folded_upto(spark: SparkSession, table: StateTable) -> int:
    """Number of the last batch folded into the base; -1 if none."""
    finish(spark, table.base_path)
    return get_marker(spark, table.folded_path, -1)


def logged_batches(spark: SparkSession, table: StateTable) -> list[int]:
    """Numbers of the batches in the log, folded ones included, by the names of their directories."""
    return numbers_in(spark, table.log_path, BATCH_ID)


def undo_batches(spark: SparkSession, table: StateTable) -> list[int]:
    """Numbers of the folded batches that can be undone."""
    return numbers_in(spark, table.undo_path, BATCH_ID)


def expire_log(spark: SparkSession, table: StateTable) -> list[int]:
    """Delete the logged batches that are folded into the base, and return their numbers.

    No view reads them any more, and reads and streams no longer list them. Numbers are not
    given out again: the marker of the last folded batch stays.
    """
    folded = [n for n in logged_batches(spark, table) if n <= folded_upto(spark, table)]
    for n in folded:
        delete_path(spark, f"{table.log_path}/{BATCH_ID}={n}")
    return folded


def expire_undo(spark: SparkSession, table: StateTable, keep: int) -> list[int]:
    """Delete what folds have kept for undoing them, but for the last ``keep`` batches; returns the numbers deleted."""
    had = undo_batches(spark, table)
    gone = had[: max(0, len(had) - keep)]
    if gone:
        set_marker(spark, table.history_path, max(gone))
    for n in gone:
        delete_path(spark, f"{table.undo_path}/{BATCH_ID}={n}")
    return gone


def read_log(
    spark: SparkSession, table: StateTable, as_of: int | None = None, unfolded_only: bool = True
) -> DataFrame | None:
    """Logged changes not yet in the base, up to batch ``as_of``; None when nothing was logged."""
    if not path_exists(spark, table.log_path):
        return None
    log = spark.read.schema(log_schema(spark, table)).parquet(table.log_path)
    if unfolded_only:
        log = log.where(F.col(BATCH_ID) > folded_upto(spark, table))
    return log if as_of is None else log.where(F.col(BATCH_ID) <= as_of)


def read_state(
    spark: SparkSession,
    table: StateTable,
    view: str = "snapshot",
    as_of: int | None = None,
    buckets: Sequence[int] | str | None = None,
    deleted_at: Column | None = None,
) -> DataFrame:
    """State as stored (``base``) or with the logged changes applied (``snapshot``).

    ``as_of`` stops the snapshot after that batch, also before a fold whose batches can be undone. Bucket and batch choices prune files. Only
    the buckets that the log has changes for are merged; the others are read as they are. The
    driver gets the numbers of those buckets.
    """
    view = one_of("view", view, ("snapshot", "base"))
    base = _base(spark, table, buckets)
    if view == "base":
        return base
    if as_of is not None:
        _outside_runs(spark, table, as_of)
    if as_of is not None and as_of < folded_upto(spark, table):
        return _before_folds(spark, table, base, as_of, buckets)
    log = read_log(spark, table, as_of)
    if log is None:
        return base
    log = select_buckets(log, buckets).drop(BATCH_ID)
    touched = sorted(r[0] for r in log.select(BUCKET).distinct().collect())
    if not touched:
        return base
    chosen = F.col(BUCKET).isin(touched)
    merged = _merge(base.where(chosen), log.where(chosen), table, deleted_at)
    if len(touched) == table.buckets:
        return merged
    others = base.where(~chosen)
    return merged.unionByName(with_delete_flags(others) if table.delete_mode == "soft" else others)


def _merge(base: DataFrame, changes: DataFrame, table: StateTable, deleted_at: Column | None) -> DataFrame:
    return merge_changes(
        base,
        changes,
        table.keys,
        delete_mode=table.delete_mode,
        order_by=table.order_by,
        guard_col=table.guard_col,
        deleted_at=deleted_at,
        null_safe=table.null_keys,
    )


_PRESENT = "__present"


def _undo_schema(spark: SparkSession, table: StateTable) -> T.StructType:
    numbers = [T.StructField(_PRESENT, T.BooleanType()), T.StructField(BATCH_ID, T.IntegerType())]
    return T.StructType([*base_schema(spark, table).fields, *numbers])


_ROW, _CHANGE, _THEN, _NOW, _EVENT = "__row", "__change", "__then", "__now", "__event"


def _histories(table: StateTable, base: DataFrame, latest: DataFrame, deleted_at: Column | None) -> DataFrame:
    """For every key of every batch, its rows before that batch; and with no batch, its rows after all of them.

    ``latest`` has the last change of each key and batch. Rows and changes of a key are brought together
    once, in the order of batches: the change that counts before a batch is the greatest of the batches before it,
    applied to the rows as :func:`~tidemark.operators.merge.upsert_parts` does. A key without a row is told by
    one that is not ``__present``. No row of the base is collected; a row is repeated for the batches that leave it.
    """
    keys, soft = list(table.keys), table.delete_mode == "soft"
    if soft:
        base = with_delete_flags(base)
    order = [c for c in ranking(latest.drop(BATCH_ID), keys, table.order_by) if c not in (*keys, BUCKET)]
    carried = [c for c in latest.columns if c not in (*keys, *order, BUCKET, BATCH_ID)]
    own = [c for c in base.columns if c not in (*keys, BUCKET)]
    stored_rows = base.select(*keys, BUCKET, F.lit(None).cast("int").alias(BATCH_ID), F.struct(*map(quote, own)).alias(_ROW))
    changed = latest.select(*keys, BUCKET, BATCH_ID, F.struct(*map(quote, [*order, *carried])).alias(_CHANGE))
    rows = stored_rows.unionByName(changed, allowMissingColumns=True)

    logged, row, then, now = F.col(BATCH_ID).isNotNull(), F.col(_ROW), F.col(_THEN), F.col(_NOW)
    key = Window.partitionBy(*keys)
    # Rows of the base first, then the changes by batch.
    by_batch = key.orderBy(F.col(BATCH_ID).asc_nulls_first())
    greatest = F.max(_CHANGE)
    if carried:  # columns without an order
        greatest = F.max_by(_CHANGE, F.when(logged, F.struct(*[F.col(_CHANGE)[c] for c in order])))
    had = {"__rows": F.count(row).over(key), "__last": F.lead(F.lit(True)).over(by_batch).isNull()}
    if guard := table.guard_col:
        had["__guard"] = F.max(F.col(guard) if guard in keys else row[guard]).over(key)
    rows = rows.withColumns(
        {_THEN: greatest.over(by_batch.rowsBetween(Window.unboundedPreceding, -1)), _NOW: greatest.over(key), **had}
    )

    none, keep_guard = F.lit(False), soft and guard in own

    def guard_of(change: Column) -> Column:
        return F.col(guard) if guard in keys else change[guard]

    def fate(change: Column) -> tuple[Column, Column]:
        """What becomes of the rows of a key, and what is told for the key itself; null for nothing."""
        delete = change[OP] == DELETE
        dropped = change.isNull()
        if guard:
            dropped |= F.col("__guard").isNotNull() & (guard_of(change).isNull() | (F.col("__guard") > guard_of(change)))
        if table.delete_mode == "ignore":
            dropped |= delete
        of_rows = F.when(dropped, "kept").when(delete if soft else none, "flagged")
        empty = F.col("__rows") == 0
        of_key = F.when(~dropped & ~delete, "added").when(~dropped & empty if keep_guard else none, "tombstone")
        return of_rows, of_key.when(empty | of_rows.isNull(), "absent")

    def event(batch: Column, kind: Column, change: Column) -> Column:
        with_guard = [guard_of(change).alias("guard")] if keep_guard else []
        return F.struct(batch.alias("batch"), kind.alias("kind"), *with_guard)

    (rows_then, key_then), (rows_now, key_now), batch = fate(then), fate(now), F.col(BATCH_ID)
    left = F.when(logged & (F.col("__rows") > 0) & rows_then.isNotNull(), event(batch, rows_then, then))
    rows = rows.withColumn("__left", F.collect_list(left).over(key))
    end = F.lit(None).cast("int")
    of_row = F.concat("__left", F.array(event(end, rows_now, now)))
    told = F.when(F.col("__last") & (key_now != "absent"), key_now)
    of_change = F.array(event(batch, key_then, then), event(end, told, now))
    rows = rows.select(
        *keys, BUCKET, _ROW, _THEN, _NOW, F.explode(F.when(logged, of_change).otherwise(of_row)).alias(_EVENT)
    ).where(F.col(_EVENT)["kind"].isNotNull())

    at = F.current_timestamp() if deleted_at is None else deleted_at
    kind, change = F.col(_EVENT)["kind"], F.when(F.col(_EVENT)["batch"].isNull(), now).otherwise(then)
    from_change, dead = kind.isin("added", "tombstone"), kind.isin("flagged", "tombstone")
    of_base = kind.isin("kept", "flagged")
    columns = []
    for f in base.schema.fields:
        if f.name in (*keys, BUCKET):
            columns.append(F.col(f.name))
            continue
        if f.name == IS_DELETED:
            value = F.when(dead, F.lit(True)).when(from_change, F.lit(False))
        elif f.name == DELETED_AT:
            value = F.when(dead, at.cast(f.dataType))
        else:
            if keep_guard and f.name == guard:
                value = F.when(kind == "flagged", F.col(_EVENT)["guard"].cast(f.dataType))
                value = value.when(from_change, change[f.name].cast(f.dataType))
            elif f.name in (*order, *carried):
                value = F.when(from_change, change[f.name].cast(f.dataType))
            else:
                value = F.when(none, F.lit(None).cast(f.dataType))
        columns.append(value.when(of_base, row[f.name]).alias(f.name))
    return rows.select(*columns, (kind != "absent").alias(_PRESENT), F.col(_EVENT)["batch"].alias(BATCH_ID))


def _fold_undoable(
    spark: SparkSession, table: StateTable, log: DataFrame, deleted_at: Column | None, markers: dict
) -> None:
    """Fold changes into the base, after what their batches replace is written.

    If the keys of the log fit a broadcast, only the rows of these keys are looked at for it, and the base is
    written as by any batch. Else one pass over the touched buckets gives both.
    """
    log = log.where(F.col(OP).isin(*OPS))
    sizes = log.groupBy(BUCKET).agg(F.sum(_key_size(log, table.keys))).collect()
    touched = sorted(bucket for bucket, _ in sizes)
    small = sum(size for _, size in sizes) <= broadcast_limit(spark)
    if not touched:
        write_state(spark, table, log.drop(BATCH_ID), deleted_at, markers=markers)
        return
    base = _base(spark, table, touched)
    looked_at = base
    if small:
        changed = F.broadcast(log.select(*table.keys).distinct())
        looked_at = base.alias("t").join(changed.alias("s"), key_condition(table.keys), "left_semi")
    latest = fold_latest(log, [*table.keys, BATCH_ID], table.order_by)
    rows = _histories(table, looked_at, latest, deleted_at).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        undo = rebalance_by_bucket(rows.where(F.col(BATCH_ID).isNotNull()))
        writer = undo.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(BATCH_ID, BUCKET).parquet(table.undo_path)
        if not small:
            after = rows.where(F.col(BATCH_ID).isNull()).select(*base.columns)
            replace_buckets(spark, table, after, touched, markers=markers)
    finally:
        rows.unpersist()
    if small:
        write_state(spark, table, log.drop(BATCH_ID), deleted_at, markers=markers)


def _undone(spark: SparkSession, table: StateTable, as_of: int, buckets: Sequence[int] | str | None) -> DataFrame:
    """Per key that batches after ``as_of`` changed, what it was then: by the first of these batches."""
    if as_of < get_marker(spark, table.history_path, folded_upto(spark, table)):
        raise ValueError(f"batch {as_of} is already folded into a later base, and cannot be undone")
    rows = select_buckets(_undo_after(spark, table, as_of), buckets)
    return fold_latest(rows, table.keys, [BATCH_ID], descending=False)


def _undo_after(spark: SparkSession, table: StateTable, as_of: int) -> DataFrame:
    return spark.read.schema(_undo_schema(spark, table)).parquet(table.undo_path).where(F.col(BATCH_ID) > as_of)


def _before_folds(
    spark: SparkSession, table: StateTable, base: DataFrame, as_of: int, buckets: Sequence[int] | str | None
) -> DataFrame:
    first = _undone(spark, table, as_of, buckets)
    match = [F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}")) for k in table.keys]
    kept = base.alias("t").join(first.select(*table.keys).alias("s"), match, "left_anti")
    return kept.unionByName(first.where(_PRESENT).select(*base.columns))


def rollback(spark: SparkSession, table: StateTable, to_batch: int) -> list[int]:
    """Take back every batch after ``to_batch``, folded or not; returns the buckets rewritten.

    Folded batches must have been folded with ``undo``. The log and the undo rows of the batches go in the
    same step as the base changes, so their numbers are free again. Streams into the table must be
    stopped, and start from a new checkpoint.
    """
    _outside_runs(spark, table, to_batch)
    if folded_upto(spark, table) < to_batch:
        fold_log(spark, table, to_batch)
    runs = {table.runs_path: [run for run in log_runs(spark, table) if run[1] <= to_batch]}
    gone = [f"{table.log_path}/{BATCH_ID}={n}" for n in logged_batches(spark, table) if n > to_batch]
    gone += [f"{table.undo_path}/{BATCH_ID}={n}" for n in undo_batches(spark, table) if n > to_batch]
    if folded_upto(spark, table) <= to_batch:
        staging(spark, table.base_path)
        decide(spark, table.base_path, [], runs, gone)
        return []
    _undone(spark, table, to_batch, None)  # refuses what cannot be undone
    touched = sorted(r[0] for r in _undo_after(spark, table, to_batch).select(BUCKET).distinct().collect())
    rows = _before_folds(spark, table, _base(spark, table, touched), to_batch, touched)
    gone += _stats_about(spark, table, touched)
    replace(spark, table.base_path, rebalance_by_bucket(rows), touched, {table.folded_path: to_batch} | runs, gone)
    return touched


def replace_buckets(
    spark: SparkSession,
    table: StateTable,
    rows: DataFrame,
    touched: Sequence[int],
    placed: bool = False,
    markers: dict | None = None,
) -> None:
    """Make ``rows`` the whole content of the touched buckets; other buckets stay as they are.

    ``placed`` rows are written from the partitions they are in; others are brought
    together by bucket first. ``markers`` change with them.
    """
    rows = rows if placed else rebalance_by_bucket(rows)
    replace(spark, table.base_path, rows, touched, markers, _stats_about(spark, table, touched))


def _stats_about(spark: SparkSession, table: StateTable, touched: Sequence[int]) -> list[str]:
    """What has been counted about some buckets and is wrong once they change."""
    kinds = names_in(spark, table.stats_path)
    return [f"{table.stats_path}/{kind}/{BUCKET}={bucket}" for kind in kinds for bucket in touched]


def broadcast_limit(spark: SparkSession) -> int:
    """``spark.sql.autoBroadcastJoinThreshold`` in bytes; negative when broadcasts are off."""
    text = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760").strip().lower()
    number, unit = text.rstrip("bkmgtp"), text.lstrip("-0123456789")
    return int(number) * {"": 1, "k": 2**10, "m": 2**20, "g": 2**30, "t": 2**40, "p": 2**50}[unit.rstrip("b")]


def _key_size(df: DataFrame, keys: Sequence[str]) -> Column:
    """Bytes a row's keys and operation take in a hash table, generously."""
    size = F.lit(64 + 16 * len(keys)).cast("bigint")
    for key in keys:
        if isinstance(df.schema[key].dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(F.col(key)), F.lit(0))
    return size


def write_state(
    spark: SparkSession,
    table: StateTable,
    changes: DataFrame,
    deleted_at: Column | None = None,
    semantics: str = "upsert",
    insert_mode: str = "append",
    markers: dict | None = None,
    report: tuple[str, int] | None = None,
) -> list[int]:
    """Copy-on-write: apply flat changes to the base, rewriting only the buckets they touch.

    Phased semantics with appended inserts double rows when a batch is applied again. ``markers``
    (folder to value) are set together with the change.

    ``report`` names a run and a batch of it. What the batch did is then stored together with the change, as
    a row of :func:`batch_report`; a batch that has such a row is applied already, and is not applied again.

    Returns those buckets. The folded batch is kept while it is used more than once, and
    measured: if its keys fit a broadcast, the state is neither shuffled to be joined nor to
    be written, and only the new rows move. The driver sees one row per bucket.
    """
    counts = None
    if report is not None:
        if semantics != "upsert":
            raise ValueError("only upserts are reported")
        finish(spark, table.base_path)
        if is_reported(spark, table, *report):
            return []
        counts, started = MergeCounts(), time.time()
    changes = table.bucketed(changes).where(F.col(OP).isin(*OPS))
    folded = fold_latest(changes, table.keys, table.order_by).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        sizes = folded.groupBy(BUCKET).agg(F.sum(_key_size(folded, table.keys)), F.count(F.lit(1))).collect()
        touched = sorted(bucket for bucket, _, _ in sizes)
        if report is not None:
            keys = sum(n for _, _, n in sizes)

            def row() -> dict:
                done = counts.result() if touched else dict.fromkeys(_COUNTED, 0)
                return _report_row(*report, started, changed_keys=keys, touched_buckets=len(touched), **done)

            markers = {**(markers or {}), _report_path(table, *report): row}
        if not touched:
            for folder, value in (markers or {}).items():
                set_marker(spark, folder, value() if callable(value) else value)
            return []
        if semantics != "upsert":
            base = _base(spark, table, touched)
            merged = apply_folded(
                base, folded, table.keys, semantics, table.delete_mode, insert_mode, table.guard_col, deleted_at
            )
            replace_buckets(spark, table, merged, touched, markers=markers)
            return touched
        small = sum(size for _, size, _ in sizes) <= broadcast_limit(spark)
        kept, added = upsert_parts(
            _base(spark, table, touched),
            folded,
            table.keys,
            delete_mode=table.delete_mode,
            guard_col=table.guard_col,
            deleted_at=deleted_at,
            null_safe=table.null_keys,
            small=small,
            counts=counts,
        )
        merged = kept.unionByName(rebalance_by_bucket(added) if small else added)
        replace_buckets(spark, table, merged, touched, placed=small, markers=markers)
        return touched
    finally:
        folded.unpersist()


_COUNTED = ("updated_rows", "deleted_rows", "inserted_rows")
REPORT_SCHEMA = (
    "run string, batch_id bigint, finished timestamp, duration_ms bigint, changes bigint, changed_keys bigint,"
    " touched_buckets bigint, updated_rows bigint, deleted_rows bigint, inserted_rows bigint"
)


def _report_path(table: StateTable, run: str, batch_id: int) -> str:
    return f"{table.batches_path}/{run}/{int(batch_id)}"


def _report_row(run: str, batch_id: int, started: float, **counts: int) -> dict:
    now = datetime.fromtimestamp(time.time(), timezone.utc)
    took = int((time.time() - started) * 1000)
    return {"run": run, "batch_id": int(batch_id), "finished": now.isoformat(), "duration_ms": took, **counts}


def is_reported(spark: SparkSession, table: StateTable, run: str, batch_id: int) -> bool:
    """Whether a batch of a run has been stored and reported."""
    return any(name.endswith(".json") for name in names_in(spark, _report_path(table, run, batch_id)))


def batch_report(spark: SparkSession, table: StateTable) -> DataFrame:
    """One row for every reported batch: of which run, when, how long, and what it did.

    Copy-on-write batches have the keys they change, the buckets, and the rows updated, deleted (flagged,
    in soft mode) and inserted; changes that a guard drops are in none of these. Logged batches have
    ``changes``, the rows logged. What a sink cannot know is NULL. The rows are files of the table: they
    outlive the session, and any number of them is read by tasks.
    """
    finish(spark, table.base_path)
    if not names_in(spark, table.batches_path):
        return spark.createDataFrame([], REPORT_SCHEMA)
    return spark.read.schema(REPORT_SCHEMA).option("recursiveFileLookup", "true").json(table.batches_path)


def append_changes(
    spark: SparkSession,
    table: StateTable,
    changes: DataFrame,
    batch_id: int,
    report: tuple[str, int] | None = None,
    tasks: int | None = None,
) -> None:
    """Merge-on-read: log a batch. Writing the same batch again replaces it, and its row of ``report``.

    With ``tasks``, for a batch known to be small, so many tasks read and write it, each with at most a file
    per bucket: the rows are not shuffled to come together.

    Columns the base does not declare are stored, but not read until it does. A batch that
    :func:`compact_log` has merged with others cannot be replaced any more.
    """
    finish(spark, table.base_path)
    if any(first <= batch_id <= last for first, last in log_runs(spark, table)):
        raise ValueError(f"batch {batch_id} is merged with others and cannot be written again")
    rows, logged, started = table.bucketed(changes), Observation(), time.time()
    rows = rows.coalesce(tasks) if tasks else rebalance_by_bucket(rows)
    if report is not None:
        rows = rows.observe(logged, F.count(F.lit(1)).alias("changes"))
    # The whole batch is replaced, whatever the session's overwrite mode.
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
    writer.partitionBy(BUCKET).parquet(f"{table.log_path}/{BATCH_ID}={int(batch_id)}")
    if report is not None:
        set_marker(spark, _report_path(table, *report), _report_row(*report, started, changes=observed(logged).get("changes", 0)))


def next_batch_id(spark: SparkSession, table: StateTable) -> int:
    """First batch number no logged or folded batch has."""
    return max([folded_upto(spark, table), *logged_batches(spark, table)]) + 1


def log_runs(spark: SparkSession, table: StateTable) -> list[list[int]]:
    """First and last batch of every run that :func:`compact_log` has merged."""
    return get_marker(spark, table.runs_path, [])


def _outside_runs(spark: SparkSession, table: StateTable, batch_id: int) -> None:
    finish(spark, table.base_path)
    for first, last in log_runs(spark, table):
        if first <= batch_id < last:
            raise ValueError(f"batches {first} to {last} are merged: there is no view between them")


def _tier(run: Sequence[Sequence[int]], width: int) -> int:
    """How often the number of batches in a run can be divided by ``width``."""
    size, tier = run[-1][1] - run[0][0] + 1, 0
    while size >= width:
        size, tier = size // width, tier + 1
    return tier


def tiered_runs(pieces: Sequence[Sequence[int]], width: int) -> list[list[Sequence[int]]]:
    """Neighbouring (first, last) pieces put together: fewer than ``width`` runs of a tier, tiers falling from old to new."""
    runs: list[list[Sequence[int]]] = []
    for piece in pieces:
        runs.append([piece])
        while True:
            tiers = [_tier(run, width) for run in runs[-width:]]
            if len(tiers) == width and len(set(tiers)) == 1:
                joined = width
            elif len(tiers) > 1 and tiers[-2] < tiers[-1]:
                joined = 2
            else:
                break
            runs[-joined:] = [[piece for run in runs[-joined:] for piece in run]]
    return runs


def compact_log(spark: SparkSession, table: StateTable, width: int = 4, keep: int = 1) -> list[tuple[int, int]]:
    """Merge logged batches that are not folded yet into runs by size; returns the new runs (first, last batch).

    A run holds the last change per key, so a key changed in many batches is read once. It is a directory of the
    log under its last batch's number, and runs of equal size are merged again when there are ``width`` of them: n batches
    leave fewer than ``width`` directories for each power of ``width`` up to n, and a change is rewritten once per power. The
    newest ``keep`` batches stay, since a stream that restarts writes its last batch again. Views and rollbacks
    between the batches of a run are refused. All runs are written by one job and take their places in one step.

    Columns that the base does not declare are kept. Changes whose operation is unknown are dropped; no view has them.
    """
    if width < 2 or keep < 1:
        raise ValueError("runs are made of two or more pieces, and the newest batch stays")
    done = folded_upto(spark, table)
    known = log_runs(spark, table)
    first = {last: first for first, last in known}
    pieces = [(first.get(n, n), n) for n in logged_batches(spark, table) if n > done][:-keep]
    runs = [run for run in tiered_runs(pieces, width) if len(run) > 1]
    if not runs:
        return []
    new = [(run[0][0], run[-1][1]) for run in runs]
    folder = {n: f"{table.log_path}/{BATCH_ID}={n}" for run in runs for _, n in run}
    staged = staging(spark, table.base_path)
    if filled := [path for path in folder.values() if any("=" in name for name in names_in(spark, path))]:
        log = spark.read.option("basePath", table.log_path).option("mergeSchema", True).parquet(*filled)
        ends = [F.when(F.col(BATCH_ID) <= last, last) for _, last in new]
        log = log.where(F.col(OP).isin(*OPS)).withColumn(BATCH_ID, F.coalesce(*ends))
        latest = fold_latest(log, [*table.keys, BATCH_ID], table.order_by)
        rebalance_by_bucket(latest).write.partitionBy(BATCH_ID, BUCKET).parquet(f"{staged}/log")
    moves = [(f"{staged}/log/{BATCH_ID}={last}", folder[last]) for _, last in new]
    ends = {last for _, last in new}
    gone = [path for n, path in folder.items() if n not in ends]
    # Runs before the oldest view that folds can be undone to are of no use to anyone.
    oldest = get_marker(spark, table.history_path, done) if table.undo else done
    rest = [r for r in known if r[1] not in folder and r[1] > oldest]
    decide(spark, table.base_path, moves, {table.runs_path: sorted([*rest, *map(list, new)])}, gone)
    return new


def stream_offset(spark: SparkSession, table: StateTable, stream_id: str) -> int:
    """What a stream adds to its own batch numbers, fixed the first time it writes here.

    A stream counts from zero again when its checkpoint is new; without an offset its
    batches would replace, or hide behind, those of the stream before it.
    """
    folder = f"{table.streams_path}/{stream_id}"
    offset = get_marker(spark, folder)
    if offset is None:
        offset = next_batch_id(spark, table)
        set_marker(spark, folder, offset)
    return offset


def compact_state(spark: SparkSession, table: StateTable, buckets: Sequence[int] | str | None = None) -> DataFrame:
    """Compact the base, or some of its buckets; see :func:`tidemark.operators.layout.compact`."""
    return layout.compact(spark, table.base_path, buckets, base_schema(spark, table))


def zorder_state(
    spark: SparkSession, table: StateTable, columns: str | Sequence[str] | None = None, **how
) -> DataFrame:
    """Z-order the base, by the table's ``cluster_by`` if no columns are given; see :func:`tidemark.operators.layout.zorder`."""
    columns = columns or table.cluster_by
    if not columns:
        raise ValueError("no columns to cluster by, and the table names none")
    return layout.zorder(spark, table.base_path, columns, schema=base_schema(spark, table), **how)


def fold_log(
    spark: SparkSession, table: StateTable, upto: int | None = None, deleted_at: Column | None = None
) -> int:
    """Apply logged batches up to ``upto`` to the base; returns the last batch folded.

    An ``upto`` between the batches of a run folds up to the run before it. The number changes together with the base. With the table's ``undo``, what the batches replace is
    written first, again by a fold that runs again. :func:`expire_log` then removes the folded batches.
    """
    done = folded_upto(spark, table)
    last = max((n for n in logged_batches(spark, table) if n > done and (upto is None or n <= upto)), default=None)
    if last is None:
        return done
    log = read_log(spark, table, last)
    history = get_marker(spark, table.history_path, done) if table.undo else last
    markers = {table.folded_path: last, table.history_path: history}
    if table.undo:
        _fold_undoable(spark, table, log, deleted_at, markers)
    else:
        write_state(spark, table, log.drop(BATCH_ID), deleted_at, markers=markers)
    return last


def expected_schema(changes: DataFrame, table: StateTable) -> T.StructType:
    """Base schema for flat changes of this table."""
    keep = () if table.guard_col is None else (table.guard_col,)
    return target_schema(table.bucketed(changes).schema, table.delete_mode == "soft", keep)


def ensure_state(
    spark: SparkSession,
    table: StateTable,
    changes: DataFrame,
    auto_create: bool = True,
    evolve: bool = True,
) -> list[str]:
    """Make the base ready for these changes and return the columns added to it.

    No base: create an empty one, or fail without ``auto_create``. Missing columns: declare
    them (rows stored before read NULL), or fail without ``evolve``. A column of another
    type always fails.
    """
    expected = expected_schema(changes, table)
    if not is_declared(spark, table):
        if not auto_create:
            raise ValueError(f"no state at {table.base_path} and auto_create is off")
        fields = T.StructType([*_data_fields(expected), T.StructField(BUCKET, T.IntegerType())])
        replace_table(spark, table, spark.createDataFrame([], fields))
        return []
    actual = base_schema(spark, table)
    added = missing_columns(actual, expected)
    if added and evolve:
        actual = T.StructType(_data_fields(actual) + added + [f for f in actual.fields if f.name == BUCKET])
        declare_schema(spark, table, actual)
    validate_schema(actual, expected)
    return [f.name for f in added]
