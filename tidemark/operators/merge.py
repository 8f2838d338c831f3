"""Applying changes to a state frame.

``upsert`` semantics (the default) make the result depend on the latest change of a key
only. ``phased`` semantics apply a batch as inserts, then updates, then deletes, with
updates of absent keys dropped.

The changes are always the side a join may build, reduced to their keys. They are broadcast
only under ``spark.sql.autoBroadcastJoinThreshold``, by Catalyst's estimate, AQE's measured
size, or a writer's own measurement (``small``); beyond it the join shuffles both sides and
AQE splits hot keys of the state. A full outer join would allow neither.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.buckets import parse_ranges, quote
from tidemark.operators.fold import fold_latest
from tidemark.names import (
    BUCKET,
    DEFAULT_ORDER,
    DELETE,
    DELETE_MODES,
    DELETED_AT,
    INSERT_MODES,
    INSERT_OPS,
    IS_DELETED,
    KEY_SCOPES,
    OP,
    OPS,
    SEMANTICS,
    UPDATE,
    one_of,
)

_HIT = "__hit"
_SRC = "__src"


class Ops(NamedTuple):
    """One batch split by operation."""

    inserts: DataFrame
    updates: DataFrame
    deletes: DataFrame


def split_ops(changes: DataFrame) -> Ops:
    """Inserts (with snapshots), updates and deletes; anything else belongs to none."""
    return Ops(
        changes.where(F.col(OP).isin(*INSERT_OPS)),
        changes.where(F.col(OP) == UPDATE),
        changes.where(F.col(OP) == DELETE),
    )


def key_condition(
    keys: Sequence[str],
    left: str = "t",
    right: str = "s",
    extra: Sequence[str] = (),
    null_safe: bool = True,
) -> Column:
    """``left.k = right.k`` over keys and extra columns, each named once.

    The null-safe form is still planned as an equi-join.
    """
    names = list(dict.fromkeys((*keys, *extra)))
    if not names:
        raise ValueError("at least one key column is required")
    pairs = [(_c(left, n), _c(right, n)) for n in names]
    return reduce(lambda a, b: a & b, [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs])


def _c(side: str, name: str) -> Column:
    return F.col(f"{side}.{quote(name)}")


def _has(df: DataFrame, name: str) -> bool:
    return name.lower() in {c.lower() for c in df.columns}


def with_delete_flags(state: DataFrame) -> DataFrame:
    """Add the soft-delete columns where the state has none yet."""
    if not _has(state, IS_DELETED):
        state = state.withColumn(IS_DELETED, F.lit(False))
    if not _has(state, DELETED_AT):
        state = state.withColumn(DELETED_AT, F.lit(None).cast("timestamp"))
    return state


def align_to_target(rows: DataFrame, target: T.StructType) -> DataFrame:
    """Rows in target column order: live flags, NULL for columns the rows do not have."""
    columns = []
    for f in target.fields:
        if f.name == IS_DELETED:
            value = F.lit(False)
        elif f.name == DELETED_AT:
            value = F.lit(None).cast(f.dataType)
        elif _has(rows, f.name):
            value = F.col(f.name).cast(f.dataType)
        else:
            value = F.lit(None).cast(f.dataType)
        columns.append(value.alias(f.name))
    return rows.select(*columns)


def _narrow(changes: DataFrame, keys: Sequence[str], *more: str) -> DataFrame:
    """Only what a match decision needs, so that the built side of a join stays small."""
    return changes.select(*dict.fromkeys((*keys, *more))).withColumn(_HIT, F.lit(True))


def _left_join(state: DataFrame, source: DataFrame, keys: Sequence[str], null_safe: bool) -> DataFrame:
    return state.alias("t").join(source.alias("s"), key_condition(keys, null_safe=null_safe), "left_outer")


def _without(rows: DataFrame, other: DataFrame, keys: Sequence[str], null_safe: bool) -> DataFrame:
    """Rows whose key is not among those of ``other``."""
    return (
        rows.alias("t")
        .join(_narrow(other, keys).alias("s"), key_condition(keys, null_safe=null_safe), "left_anti")
        .select("t.*")
    )


def _absent(rows: DataFrame, state: DataFrame, keys: Sequence[str], null_safe: bool) -> DataFrame:
    """Rows whose key the state does not hold.

    The matches are found from the state's side, so that its rows are streamed past the
    (small) batch and never have to be built into a hash table.
    """
    present = (
        state.select(*keys)
        .alias("t")
        .join(_narrow(rows, keys).alias("s"), key_condition(keys, null_safe=null_safe), "inner")
        .select(*[_c("s", k).alias(k) for k in keys])
        .distinct()  # a key may fill a large part of an appended state
    )
    return _without(rows, present, keys, null_safe)


def duplicate_source_keys(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that a phase would apply more than once."""
    return changes.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def apply_inserts(
    state: DataFrame, inserts: DataFrame, keys: Sequence[str], mode: str = "append", null_safe: bool = True
) -> DataFrame:
    """Append inserts blindly, or only where the key is absent from the state."""
    if one_of("insert_mode", mode, INSERT_MODES) == "if_absent":
        inserts = _absent(inserts, state, keys, null_safe)
    return state.unionByName(align_to_target(inserts, state.schema))


def apply_updates(
    state: DataFrame, updates: DataFrame, keys: Sequence[str], null_safe: bool = True
) -> DataFrame:
    """Replace matched rows; updates of absent keys are dropped. Source keys must be unique."""
    source = updates.select(F.struct(*updates.columns).alias(_SRC), *keys)
    joined = _left_join(state, source, keys, null_safe)
    return joined.select(*_assign(state, updates, keys, F.col(_SRC).isNotNull()))


def _assign(state: DataFrame, source: DataFrame, keys: Sequence[str], matched: Column) -> list[Column]:
    """Target columns after an update; key columns stay untouched, which keeps the partitioning."""
    lowered = {k.lower() for k in keys}
    columns = []
    for f in state.schema.fields:
        current = _c("t", f.name)
        if f.name.lower() in lowered:
            value = current
        elif f.name == IS_DELETED:
            value = F.when(matched, F.lit(False)).otherwise(current)
        elif f.name == DELETED_AT:
            value = F.when(matched, F.lit(None).cast(f.dataType)).otherwise(current)
        elif _has(source, f.name):
            value = F.when(matched, _c(_SRC, f.name).cast(f.dataType)).otherwise(current)
        else:
            value = current
        columns.append(value.alias(f.name))
    return columns


def apply_deletes(
    state: DataFrame,
    deletes: DataFrame,
    keys: Sequence[str],
    mode: str = "hard",
    deleted_at: Column | None = None,
    null_safe: bool = True,
) -> DataFrame:
    """Remove matched rows (hard), flag them (soft), or leave the state alone (ignore)."""
    mode = one_of("delete_mode", mode, DELETE_MODES)
    if mode == "ignore":
        return state
    if mode == "hard":
        return _without(state, deletes, keys, null_safe)
    state = with_delete_flags(state)
    hit = _c("s", _HIT).isNotNull()
    return _left_join(state, _narrow(deletes, keys).distinct(), keys, null_safe).select(*_flagged(state, hit, deleted_at))


def _flagged(
    state: DataFrame, hit: Column, deleted_at: Column | None, replaced: dict[str, Column] | None = None
) -> list[Column]:
    at = F.current_timestamp() if deleted_at is None else deleted_at
    columns = []
    for f in state.schema.fields:
        value = _c("t", f.name)
        if f.name == IS_DELETED:
            value = F.when(hit, F.lit(True)).otherwise(value)
        elif f.name == DELETED_AT:
            value = F.when(hit, at.cast(f.dataType)).otherwise(value)
        elif replaced and f.name in replaced:
            value = F.when(hit, replaced[f.name]).otherwise(value)
        columns.append(value.alias(f.name))
    return columns


def drop_stale(
    changes: DataFrame, state: DataFrame, keys: Sequence[str], guard_col: str, null_safe: bool = True
) -> DataFrame:
    """Drop changes older than the row they would replace, by ``guard_col`` (NULL is oldest)."""
    mine, theirs = _c("s", guard_col), _c("t", guard_col)
    outdated = theirs.isNotNull() & (mine.isNull() | (theirs > mine))
    stale = (
        state.select(*keys, guard_col)
        .alias("t")
        .join(
            changes.select(*keys, guard_col).alias("s"),
            key_condition(keys, null_safe=null_safe) & outdated,
            "inner",
        )
        .select(*[_c("s", k).alias(k) for k in keys])
        .distinct()
    )
    return _without(changes, stale, keys, null_safe)


class Parts(NamedTuple):
    """A merged state as the rows it keeps and the rows it adds."""

    kept: DataFrame
    added: DataFrame


def observed(counts: Observation) -> dict[str, int]:
    """The counts of a finished action; none of a part that was found empty and left out of the plan."""
    # ``Observation.get`` fails without counts.
    return dict(counts._jo.getAsJava())


class MergeCounts:
    """What an upsert does to the state, counted while the result of :func:`upsert_parts` is written.

    The counts are Spark's observed metrics: no other job and no other join. They are there after the one
    action on the parts. A stage that is run again after the loss of its output counts its rows again.
    """

    def __init__(self) -> None:
        self._hits, self._added = Observation(), Observation()

    def hits(self, joined: DataFrame) -> DataFrame:
        """The state joined with the batch, with the rows that will be replaced or deleted counted."""
        deletes = _c("s", OP) == DELETE
        hit = _c("s", _HIT).isNotNull()
        return joined.observe(
            self._hits,
            F.count_if(hit & ~deletes).alias("updated_rows"),
            F.count_if(hit & deletes).alias("deleted_rows"),
        )

    def added(self, rows: DataFrame) -> DataFrame:
        """The new images, counted."""
        return rows.observe(self._added, F.count(F.lit(1)).alias("live_rows"))

    def result(self) -> dict[str, int]:
        """Rows updated, deleted (or flagged) and inserted."""
        hits, added = observed(self._hits), observed(self._added)
        updated = hits.get("updated_rows", 0)
        return {
            "updated_rows": updated,
            "deleted_rows": hits.get("deleted_rows", 0),
            "inserted_rows": added.get("live_rows", 0) - updated,
        }


def upsert_parts(
    state: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    delete_mode: str = "hard",
    guard_col: str | None = None,
    deleted_at: Column | None = None,
    null_safe: bool = True,
    small: bool = False,
    counts: MergeCounts | None = None,
) -> Parts:
    """Upsert of a folded batch in two parts, for a writer that treats them differently.

    ``small`` says that the caller has measured the batch's keys and they may be broadcast;
    the kept rows then stay in the partitions the state was read in. ``counts`` are taken when
    the parts are written, which must be done by one action.
    """
    if delete_mode == "soft":
        state = with_delete_flags(state)
    if guard_col is not None:
        changes = drop_stale(changes, state, keys, guard_col, null_safe)
    if delete_mode == "ignore":
        changes = changes.where(F.col(OP) != DELETE)
    added = align_to_target(changes.where(F.col(OP) != DELETE), state.schema)
    if counts is not None:
        added = counts.added(added)
    keep_guard = delete_mode == "soft" and guard_col is not None and _has(state, guard_col)
    decisive = _narrow(changes, keys, OP, *([guard_col] if keep_guard else []))
    if small:
        decisive = F.broadcast(decisive)
    if delete_mode != "soft":
        # Hard deletes and replaced rows leave the state the same way.
        if counts is not None:
            joined = counts.hits(_left_join(state, decisive, keys, null_safe))
            return Parts(joined.where(_c("s", _HIT).isNull()).select("t.*"), added)
        match = key_condition(keys, null_safe=null_safe)
        return Parts(state.alias("t").join(decisive.alias("s"), match, "left_anti").select("t.*"), added)

    deleted = _c("s", OP) == DELETE
    replaced = {guard_col: _c("s", guard_col)} if keep_guard else None
    joined = _left_join(state, decisive, keys, null_safe)
    if counts is not None:
        joined = counts.hits(joined)
    kept = joined.where(_c("s", _HIT).isNull() | deleted).select(
        *_flagged(state, F.coalesce(deleted, F.lit(False)), deleted_at, replaced)
    )
    if keep_guard:
        # A delete that arrives before its insert must still outrank it later.
        unseen = _absent(changes.where(F.col(OP) == DELETE), state, keys, null_safe)
        at = F.current_timestamp() if deleted_at is None else deleted_at
        tombstones = (
            align_to_target(unseen, state.schema)
            .withColumn(IS_DELETED, F.lit(True))
            .withColumn(DELETED_AT, at.cast("timestamp"))
        )
        added = added.unionByName(tombstones)
    return Parts(kept, added)


def _phased(
    state: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    delete_mode: str,
    insert_mode: str,
    fold: bool,
    deleted_at: Column | None,
    null_safe: bool,
) -> DataFrame:
    inserts, updates, deletes = split_ops(changes)
    if not fold:
        if not duplicate_source_keys(updates, keys).isEmpty():
            raise ValueError("several updates of one key in a batch: fold the batch first")
        if insert_mode == "if_absent" and not duplicate_source_keys(inserts, keys).isEmpty():
            raise ValueError("several inserts of one key in a batch: fold the batch first")
        state = apply_inserts(state, inserts, keys, insert_mode, null_safe)
        state = apply_updates(state, updates, keys, null_safe)
        return apply_deletes(state, deletes, keys, delete_mode, deleted_at, null_safe)

    # Folded: every key is in one phase only, so updates and deletes share one join.
    routed = changes.where(F.col(OP).isin(UPDATE, DELETE))
    source = routed.select(F.when(F.col(OP) == UPDATE, F.struct(*routed.columns)).alias(_SRC), OP, *keys)
    joined = _left_join(state, source, keys, null_safe)
    deleted = F.coalesce(_c("s", OP) == DELETE, F.lit(False))
    if delete_mode == "hard":
        joined = joined.where(~deleted)
    columns = _assign(state, routed, keys, F.col(_SRC).isNotNull())
    if delete_mode == "soft":
        at = F.current_timestamp() if deleted_at is None else deleted_at
        flags = {IS_DELETED: F.lit(True), DELETED_AT: at.cast("timestamp")}
        columns = [
            F.when(deleted, flags[f.name]).otherwise(c).alias(f.name) if f.name in flags else c
            for f, c in zip(state.schema.fields, columns)
        ]
    updated = joined.select(*columns)
    if insert_mode == "if_absent":
        # Absence is judged against the state before the batch; folded phases share no key.
        inserts = _absent(inserts, state, keys, null_safe)
    return updated.unionByName(align_to_target(inserts, state.schema))


def merge_changes(
    state: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    semantics: str = "upsert",
    delete_mode: str = "hard",
    insert_mode: str = "append",
    fold: bool = True,
    order_by: Sequence[str] = DEFAULT_ORDER,
    guard_col: str | None = None,
    deleted_at: Column | None = None,
    null_safe: bool = True,
) -> DataFrame:
    """State after a batch of flat changes.

    ``upsert``: an insert or update replaces the row of its key or adds it (reviving a
    soft-deleted one), a delete removes, flags or ignores it. ``phased``: see the module
    text; with ``fold=False`` a repeated key in one phase is an error. ``guard_col`` drops
    changes older than the stored row, for batches that arrive out of order.
    """
    if one_of("semantics", semantics, SEMANTICS) == "upsert" and not fold:
        raise ValueError("upsert needs the batch folded to one change per key")
    changes = changes.where(F.col(OP).isin(*OPS))
    if fold:
        changes = fold_latest(changes, keys, order_by)
    return apply_folded(
        state, changes, keys, semantics, delete_mode, insert_mode, guard_col, deleted_at, null_safe, fold
    )


def apply_folded(
    state: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    semantics: str = "upsert",
    delete_mode: str = "hard",
    insert_mode: str = "append",
    guard_col: str | None = None,
    deleted_at: Column | None = None,
    null_safe: bool = True,
    folded: bool = True,
) -> DataFrame:
    """:func:`merge_changes` for a batch that already has one change per key."""
    semantics = one_of("semantics", semantics, SEMANTICS)
    delete_mode = one_of("delete_mode", delete_mode, DELETE_MODES)
    insert_mode = one_of("insert_mode", insert_mode, INSERT_MODES)
    if semantics == "upsert":
        kept, added = upsert_parts(state, changes, keys, delete_mode, guard_col, deleted_at, null_safe)
        return kept.unionByName(added)
    if delete_mode == "soft":
        state = with_delete_flags(state)
    if guard_col is not None:
        changes = drop_stale(changes, state, keys, guard_col, null_safe)
    return _phased(state, changes, keys, delete_mode, insert_mode, folded, deleted_at, null_safe)


def upsert_ordered(
    state: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    guard_col: str,
    key_scope: str = "global",
    partition_cols: Sequence[str] = (),
) -> DataFrame:
    """Upsert plain rows; on a key collision, in the batch or with the state, the greater guard wins.

    The batch wins a tie. ``key_scope="partition"`` makes a key unique per partition value
    only, so the same key may live in several partitions.
    """
    if one_of("key_scope", key_scope, KEY_SCOPES) == "partition":
        if not partition_cols:
            raise ValueError("key_scope 'partition' needs partition_cols")
        keys = list(dict.fromkeys((*partition_cols, *keys)))
    return replace_older(state, fold_latest(batch, keys, [guard_col]), keys, guard_col)


def replace_older(state: DataFrame, latest: DataFrame, keys: Sequence[str], guard_col: str) -> DataFrame:
    """:func:`upsert_ordered` for a batch that already has one row per key."""
    newer = drop_stale(latest, state, keys, guard_col)
    return _without(state, newer, keys, null_safe=True).unionByName(align_to_target(newer, state.schema))


def route_buckets(changes: DataFrame, noop_buckets: str | Sequence[int]) -> tuple[DataFrame, DataFrame]:
    """Split a batch into (rows to merge, rows of the listed buckets to discard)."""
    listed = parse_ranges(noop_buckets) if isinstance(noop_buckets, str) else list(noop_buckets)
    if not listed:
        return changes, changes.where(F.lit(False))
    skipped = F.coalesce(F.col(BUCKET).isin(listed), F.lit(False))
    return changes.where(~skipped), changes.where(skipped)


def merge_metrics(
    state: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] = DEFAULT_ORDER,
    null_safe: bool = True,
) -> DataFrame:
    """One row: what an upsert of the folded batch does to the state."""
    folded = _narrow(fold_latest(changes.where(F.col(OP).isin(*OPS)), keys, order_by), keys, OP)
    matched = (
        state.select(*keys)
        .alias("t")
        .join(folded.alias("s"), key_condition(keys, null_safe=null_safe), "inner")
        .groupBy(*[_c("s", k).alias(k) for k in keys], _c("s", OP).alias(OP))
        .agg(F.count(F.lit(1)).alias("hits"))
        .select(OP, "hits")
    )
    tagged = folded.select(OP, F.lit(0).cast("bigint").alias("hits")).unionByName(matched)
    is_source, is_delete = F.col("hits") == 0, F.col(OP) == DELETE

    def total(condition: Column, value: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, value)), F.lit(0)).cast("bigint")

    one = F.lit(1)
    return tagged.agg(
        total(is_source, one).alias("source_rows"),
        total(~is_source & ~is_delete, F.col("hits")).alias("updated_rows"),
        total(~is_source & is_delete, F.col("hits")).alias("deleted_rows"),
        (total(is_source & ~is_delete, one) - total(~is_source & ~is_delete, one)).alias("inserted_rows"),
    )
