"""Folding and merging on small frames, one case per decided behaviour."""

from datetime import datetime

import pytest
from conftest import DATA_10X, rows
from pyspark.sql import functions as F

from tidemark.names import DELETED_AT, IS_DELETED
from tidemark.operators import fold, merge

CHANGE = "k int, v string, _op string, _txn_id string, _total_order bigint, _collection_order bigint"
AT = datetime(2024, 2, 1)


def state(spark, *pairs):
    return spark.createDataFrame(list(pairs), "k int, v string")


def changes(spark, *items):
    """Items are (key, value, op, total order)."""
    return spark.createDataFrame([(k, v, op, f"t{o}", o, o) for k, v, op, o in items], CHANGE)


def merged(spark, before, items, **how):
    return rows(merge.merge_changes(state(spark, *before), changes(spark, *items), ["k"], **how), "k", "v")


def test_upsert_keeps_insert_then_update(spark):
    assert merged(spark, [], [(1, "a", "INSERT", 1), (1, "b", "UPDATE", 2)]) == [(1, "b")]


def test_phased_loses_insert_then_update(spark):
    items = [(1, "a", "INSERT", 1), (1, "b", "UPDATE", 2)]
    assert merged(spark, [], items, semantics="phased") == []


def test_upsert_insert_of_existing_key_replaces(spark):
    assert merged(spark, [(1, "a")], [(1, "b", "INSERT", 1)]) == [(1, "b")]


def test_phased_insert_modes(spark):
    items = [(1, "b", "INSERT", 1), (2, "c", "SNAPSHOT", 1)]
    assert merged(spark, [(1, "a")], items, semantics="phased") == [(1, "a"), (1, "b"), (2, "c")]
    assert merged(spark, [(1, "a")], items, semantics="phased", insert_mode="if_absent") == [(1, "a"), (2, "c")]


def test_update_of_absent_key(spark):
    assert merged(spark, [], [(1, "a", "UPDATE", 1)], semantics="phased") == []
    assert merged(spark, [], [(1, "a", "UPDATE", 1)]) == [(1, "a")]


def test_delete_then_insert_depends_on_order(spark):
    assert merged(spark, [(1, "a")], [(1, "a", "DELETE", 1), (1, "b", "INSERT", 2)]) == [(1, "b")]
    assert merged(spark, [(1, "a")], [(1, "a", "DELETE", 2), (1, "b", "INSERT", 1)]) == []


def test_unfolded_phases_run_in_order(spark):
    items = [(1, "a", "DELETE", 1), (1, "b", "INSERT", 2)]
    assert merged(spark, [(1, "a")], items, semantics="phased", fold=False) == []


def test_unfolded_duplicate_updates_are_an_error(spark):
    items = [(1, "b", "UPDATE", 1), (1, "c", "UPDATE", 2)]
    with pytest.raises(ValueError, match="fold"):
        merged(spark, [(1, "a")], items, semantics="phased", fold=False)
    with pytest.raises(ValueError, match="folded"):
        merged(spark, [(1, "a")], items, fold=False)


def test_folded_phases_equal_the_three_steps(spark):
    before = [(k, "s") for k in range(6)] + [(3, "twin")]
    items = [(0, "u", "UPDATE", 1), (1, "d", "DELETE", 1), (2, "i", "INSERT", 1), (3, "u", "UPDATE", 1), (9, "n", "INSERT", 1)]
    for insert_mode in ("append", "if_absent"):
        for delete_mode in ("hard", "soft", "ignore"):
            how = {"insert_mode": insert_mode, "delete_mode": delete_mode, "deleted_at": F.lit(AT)}
            once = merge.merge_changes(state(spark, *before), changes(spark, *items), ["k"], "phased", **how)
            steps = merge.merge_changes(
                state(spark, *before), changes(spark, *items), ["k"], "phased", fold=False, **how
            )
            assert rows(once) == rows(steps)


def test_unknown_operation_is_ignored(spark):
    assert merged(spark, [(1, "a")], [(1, "b", "TRUNCATE", 5), (2, "c", None, 1)]) == [(1, "a")]


def test_order_columns_and_nulls_last(spark):
    items = [
        (1, "none", "UPDATE", "z", None, None),
        (1, "old", "UPDATE", "a", 5, 1),
        (1, "collection", "UPDATE", "a", 5, 2),
        (1, "txn", "UPDATE", "b", 5, 2),
    ]
    folded = fold.fold_latest(spark.createDataFrame(items, CHANGE), ["k"])
    assert rows(folded, "v") == [("txn",)]


def test_ties_do_not_depend_on_input_order(spark):
    items = [(1, v, "UPDATE", "t", 1, 1) for v in "cab"]
    for order in (items, items[::-1], items[1:] + items[:1]):
        assert rows(fold.fold_latest(spark.createDataFrame(order, CHANGE).repartition(3), ["k"]), "v") == [("c",)]


def test_null_keys(spark):
    before = [(None, "a"), (1, "b")]
    items = [(None, "n", "UPDATE", 1)]
    assert merged(spark, before, items) == [(1, "b"), (None, "n")]
    assert merged(spark, before, items, semantics="phased", null_safe=False) == [(1, "b"), (None, "a")]


def test_delete_modes(spark):
    before, items = [(1, "a"), (2, "b")], [(1, "x", "DELETE", 1), (7, "y", "DELETE", 1)]
    assert merged(spark, before, items) == [(2, "b")]
    assert merged(spark, before, items, delete_mode="ignore") == before
    soft = merge.merge_changes(
        state(spark, *before), changes(spark, *items), ["k"], delete_mode="soft", deleted_at=F.lit(AT)
    )
    assert rows(soft) == [(1, "a", True, AT), (2, "b", False, None)]
    with pytest.raises(ValueError, match="delete_mode"):
        merged(spark, before, items, delete_mode="purge")


def test_insert_revives_soft_deleted_row(spark):
    how = {"delete_mode": "soft", "deleted_at": F.lit(AT)}
    gone = merge.merge_changes(state(spark, (1, "a")), changes(spark, (1, "a", "DELETE", 1)), ["k"], **how)
    back = merge.merge_changes(gone, changes(spark, (1, "c", "INSERT", 2)), ["k"], **how)
    assert rows(back) == [(1, "c", False, None)]
    appended = merge.merge_changes(gone, changes(spark, (1, "c", "INSERT", 2)), ["k"], "phased", **how)
    assert rows(appended, "k", "v", IS_DELETED) == [(1, "a", True), (1, "c", False)]
    ignored = merge.merge_changes(
        gone, changes(spark, (1, "c", "INSERT", 2)), ["k"], "phased", insert_mode="if_absent", **how
    )
    assert rows(ignored, "k", "v", IS_DELETED) == [(1, "a", True)]


def test_update_resets_delete_flags_in_phases(spark):
    how = {"delete_mode": "soft", "deleted_at": F.lit(AT)}
    gone = merge.merge_changes(state(spark, (1, "a")), changes(spark, (1, "a", "DELETE", 1)), ["k"], **how)
    back = merge.merge_changes(gone, changes(spark, (1, "c", "UPDATE", 2)), ["k"], "phased", **how)
    assert rows(back) == [(1, "c", False, None)]


def guarded(spark, *batches, delete_mode="soft"):
    current = spark.createDataFrame([], "k int, v string, _total_order bigint")
    for batch in batches:
        current = merge.merge_changes(
            current,
            changes(spark, *batch),
            ["k"],
            delete_mode=delete_mode,
            guard_col="_total_order",
            deleted_at=F.lit(AT),
        )
    return current


def test_guard_drops_late_changes(spark):
    late = guarded(spark, [(1, "new", "UPDATE", 9)], [(1, "old", "UPDATE", 3), (2, "b", "INSERT", 1)])
    assert rows(late, "k", "v", "_total_order") == [(1, "new", 9), (2, "b", 1)]
    same = guarded(spark, [(1, "first", "UPDATE", 9)], [(1, "second", "UPDATE", 9)])
    assert rows(same, "v") == [("second",)]
    nothing = guarded(spark, [(1, "known", "UPDATE", 1)], [(1, "unknown", "UPDATE", None)])
    assert rows(nothing, "v") == [("known",)]


def test_guard_keeps_tombstones(spark):
    after_delete = guarded(spark, [(1, "a", "INSERT", 1)], [(1, "a", "DELETE", 5)], [(1, "late", "UPDATE", 3)])
    assert rows(after_delete, "k", "v", IS_DELETED) == [(1, "a", True)]
    before_insert = guarded(spark, [(1, "x", "DELETE", 5)], [(1, "late", "INSERT", 3)])
    assert rows(before_insert, "k", "v", IS_DELETED) == [(1, "x", True)]
    reborn = guarded(spark, [(1, "x", "DELETE", 5)], [(1, "newer", "INSERT", 6)])
    assert rows(reborn, "k", "v", IS_DELETED) == [(1, "newer", False)]


def test_upsert_ordered_scopes(spark):
    made = spark.range(100_000).selectExpr("id div 2500 + 1 as p", "id % 2500 + 1 as k")
    batch = made.select(
        F.col("k").cast("int").alias("id"),
        F.format_string("p%03d", "p").alias("dt"),
        (F.col("k") % 1000 + F.col("p") / 1000).alias("amount"),
        (F.lit(1700000000000) + F.col("p")).alias("ts"),
    )
    whole = merge.upsert_ordered(batch.limit(0), batch, ["id"], "ts")
    assert whole.count() == 2500
    assert rows(whole.select("dt").distinct()) == [("p040",)]
    per_day = merge.upsert_ordered(batch.limit(0), batch, ["id"], "ts", "partition", ["dt"])
    assert (per_day.count(), per_day.select("dt").distinct().count()) == (100_000, 40)
    with pytest.raises(ValueError, match="partition_cols"):
        merge.upsert_ordered(batch.limit(0), batch, ["id"], "ts", "partition")


def test_two_row_fixture(spark):
    columns = (
        "id int, applicantID int, appID int, amount float, status string, ts timestamp, duration int,"
        " contract_timestamp timestamp, delinquency int, freshness_ts timestamp, _bucket int"
    )

    def at(second):
        return datetime(2026, 4, 16, 7, 0, second)

    old = [
        (1, 10, 100, 12.3, "old", at(0), 12, at(0), 0, at(1), 7),
        (2, 20, 200, 22.3, "old", at(2), 24, at(2), 1, at(3), 3),
    ]
    new = [
        (1, 10, 101, 13.3, "new", at(4), 12, at(4), 0, at(5), 7),
        (2, 20, 201, 23.3, "new", at(6), 24, at(6), 1, at(7), 3),
    ]
    target, source = spark.createDataFrame(old, columns), spark.createDataFrame(new, columns)
    assert rows(merge.apply_updates(target, source, ["id", "_bucket"])) == rows(source)


def test_metrics_and_routing(spark):
    items = [(1, "b", "UPDATE", 1), (2, "c", "DELETE", 1), (3, "d", "INSERT", 1), (4, "e", "DELETE", 1)]
    found = merge.merge_metrics(state(spark, (1, "a"), (2, "b")), changes(spark, *items), ["k"]).first()
    assert found.asDict() == {"source_rows": 4, "updated_rows": 1, "deleted_rows": 1, "inserted_rows": 1}
    batch = changes(spark, *items).withColumn("_bucket", F.col("k"))
    kept, skipped = merge.route_buckets(batch, "2-3")
    assert (rows(kept, "k"), rows(skipped, "k")) == ([(1,), (4,)], [(2,), (3,)])
    assert merge.route_buckets(batch, "")[0].count() == 4


def test_target_keeps_its_columns(spark):
    wide = spark.createDataFrame([(1, "a", 5)], "k int, v string, extra int")
    result = merge.merge_changes(wide, changes(spark, (1, "b", "UPDATE", 1), (2, "c", "INSERT", 1)), ["k"])
    assert rows(result) == [(1, "b", None), (2, "c", None)]
    phased = merge.merge_changes(wide, changes(spark, (1, "b", "UPDATE", 1)), ["k"], "phased")
    assert rows(phased) == [(1, "b", 5)]
    assert DELETED_AT not in result.columns


def test_key_condition_names_a_column_once(spark):
    condition = merge.key_condition(["k", "p"], extra=["p"])
    assert str(condition).count("<=>") == 2
    with pytest.raises(ValueError):
        merge.key_condition([])


# Numbers measured independently for this change log on the orders table.
PROBED = """
select o_orderkey k, o_orderstatus st, 'INSERT' _op, o_orderkey*10 ord from {o} where o_orderkey%3=0
union all select o_orderkey,'U','UPDATE',o_orderkey*10+1 from {o} where o_orderkey%6=0 or o_orderkey%3=1
union all select o_orderkey,'V','UPDATE',o_orderkey*10+2 from {o} where o_orderkey%6=1
union all select o_orderkey,o_orderstatus,'DELETE',o_orderkey*10+3 from {o} where o_orderkey%9=2
union all select o_orderkey,'R','INSERT',o_orderkey*10+4 from {o} where o_orderkey%27=2
union all select o_orderkey,'N','UPDATE',null from {o} where o_orderkey%30=4
"""


def test_probed_numbers(spark):
    orders = spark.read.parquet(f"{DATA_10X}/orders.parquet")
    log = spark.sql(PROBED, o=orders)
    base = orders.where("o_orderkey % 3 <> 0").selectExpr("o_orderkey k", "o_orderstatus st")
    result = merge.merge_changes(base, log, ["k"], order_by=["ord"])
    assert log.count() == 17_723
    assert result.agg(F.count("*"), F.sum("k")).first()[:] == (13_889, 104_158_609)
    assert dict(result.groupBy("st").count().collect()) == {
        "F": 1907, "O": 1915, "P": 2011, "R": 556, "U": 5000, "V": 2500,
    }
