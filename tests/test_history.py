"""Swaps that die, history across folds, replaced tables, null keys, and the bucketed layout."""

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.functions import quantiles
from tidemark.functions.buckets import bucket_column
from tidemark.names import BUCKET
from tidemark.operators import layout
from tidemark.sources import bucketed, state, swap
from tidemark.sources.bucketed import BucketedTable
from tidemark.sources.state import StateTable

STATE = "id long, v string, seq long"
CHANGES = f"{STATE}, _op string, _txn_id string, _total_order long, _collection_order long"


def base_of(spark, n=20):
    return spark.createDataFrame([(i, f"v{i}", 0) for i in range(n)], STATE)


def changes_of(spark, listed):
    """(id, op, value, order) as flat changes."""
    return spark.createDataFrame([(i, v, n, op, f"t{n}", n, 0) for i, op, v, n in listed], CHANGES)


def random_batches(seed, n=4, keys=30):
    rng, order, out = random.Random(seed), 0, []
    for b in range(n):
        batch = []
        for _ in range(rng.randint(0, 25)):
            order += 1
            # Some changes come a batch late, behind newer ones of their key.
            batch.append((rng.randrange(keys), rng.choice(["INSERT", "UPDATE", "DELETE"]), f"b{b}n{order}", max(1, order - rng.choice([0, 0, 30]))))
        out.append(batch)
    return out


@pytest.mark.parametrize("delete_mode, guard", [("hard", None), ("soft", None), ("soft", "seq"), ("ignore", None)])
def test_every_batch_can_be_seen_after_folds(spark, folder, delete_mode, guard):
    at = F.lit("2024-01-01 00:00:00").cast("timestamp")
    options = {"delete_mode": delete_mode, "guard_col": guard, "buckets": 4}
    plain, table = (StateTable(f"{folder}/{n}", ("id",), undo=n == "undo", **options) for n in ("plain", "undo"))
    batches = random_batches(3)
    for t in (plain, table):
        state.create_state(spark, base_of(spark), t)
        for n, batch in enumerate(batches):
            state.append_changes(spark, t, changes_of(spark, batch), n)
    # A late change can only be told from the log as a whole, so each fold starts where the last one ended.
    want = [rows(state.read_state(spark, plain, as_of=n, deleted_at=at).drop(BUCKET)) for n in range(len(batches))]
    state.fold_log(spark, table, deleted_at=at)
    state.expire_log(spark, table)
    for n in range(len(batches)):
        got = state.read_state(spark, table, as_of=n, deleted_at=at).drop(BUCKET)
        assert rows(got, *state.read_state(spark, plain, as_of=n).drop(BUCKET).columns) == want[n]
    first = rows(state.read_state(spark, table, as_of=-1).drop(BUCKET).select("id", "v", "seq"))
    assert first == rows(base_of(spark))

    assert state.rollback(spark, table, 2)
    assert rows(state.read_state(spark, table).drop(BUCKET)) == want[2]
    assert state.next_batch_id(spark, table) == 3 and state.undo_batches(spark, table) == [n for n in range(3) if batches[n]]
    state.append_changes(spark, table, changes_of(spark, batches[3]), 3)
    state.fold_log(spark, table, deleted_at=at)
    state.expire_undo(spark, table, keep=1)
    with pytest.raises(ValueError, match="already folded"):
        state.read_state(spark, table, as_of=1)


def test_rollback_without_folds(spark, folder):
    table = StateTable(folder, ("id",), 4)
    state.create_state(spark, base_of(spark), table)
    for n in range(3):
        state.append_changes(spark, table, changes_of(spark, [(n, "UPDATE", f"new{n}", n + 1)]), n)
    state.rollback(spark, table, 0)
    assert state.logged_batches(spark, table) == [0] and state.folded_upto(spark, table) == 0
    assert [r["v"] for r in state.read_state(spark, table).orderBy("id").take(2)] == ["new0", "v1"]
    with pytest.raises(ValueError, match="already folded"):
        state.rollback(spark, table, -1)


@pytest.mark.parametrize("dies_at", [0, 1, 2, 3, 5, 7, 9, 11])
def test_a_write_that_dies_is_finished_or_has_not_begun(spark, folder, monkeypatch, dies_at):
    """Every step of the file system fails once; the table is as before or as after, and the same write again gives the latter."""
    table = StateTable(folder, ("id",), 4)
    state.create_state(spark, base_of(spark), table)
    gone = [(i, "DELETE", None, 1) for i in range(20) if i % 3]
    state.append_changes(spark, table, changes_of(spark, [*gone, (0, "UPDATE", "x", 1), (40, "INSERT", "y", 1)]), 0)
    before, after = rows(state.read_state(spark, table, "base")), rows(state.read_state(spark, table))
    left, real = [dies_at], {n: getattr(swap, n) for n in ("_move", "delete_path", "_write_json")}

    def dying(name):
        def call(*args):
            if left[0] == 0:
                raise OSError("the machine is gone")
            left[0] -= 1
            return real[name](*args)

        return call

    for name in real:
        monkeypatch.setattr(swap, name, dying(name))
    try:
        state.fold_log(spark, table)
        died = False
    except OSError:
        died = True
    monkeypatch.undo()
    seen = rows(state.read_state(spark, table, "base"))
    assert seen in (before, after) and (died or seen == after)
    assert (seen == after) == (state.folded_upto(spark, table) == 0)
    assert rows(state.read_state(spark, table)) == after
    state.fold_log(spark, table)
    assert rows(state.read_state(spark, table, "base")) == after


def test_markers_keep_their_newest_whole_value(spark, folder):
    assert swap.get_marker(spark, f"{folder}/m", 5) == 5
    for value in ({"a": 1}, 7, [1, "é"]):
        swap.set_marker(spark, f"{folder}/m", value)
        open(f"{folder}/m/00000099.json.torn.tmp", "w").close()
        assert swap.get_marker(spark, f"{folder}/m") == value


def test_a_replaced_table_has_no_old_log(spark, folder):
    table = StateTable(folder, ("id",), 4)
    state.create_state(spark, base_of(spark), table)
    state.append_changes(spark, table, changes_of(spark, [(2, "DELETE", None, 1)]), 0)
    state.create_state(spark, base_of(spark, 5), table)
    assert rows(state.read_state(spark, table).drop(BUCKET)) == rows(base_of(spark, 5))
    assert state.next_batch_id(spark, table) == 0


def test_rows_without_a_key_are_one_key(spark, folder):
    table = StateTable(folder, ("id",), 4, "spark_hash")
    state.create_state(spark, spark.createDataFrame([(None, "a", 0), (1, "b", 0)], STATE), table)
    state.write_state(spark, table, changes_of(spark, [(None, "UPDATE", "c", 1)]))
    assert rows(state.read_state(spark, table).drop(BUCKET), "id", "v") == [(1, "b"), (None, "c")]
    state.append_changes(spark, table, changes_of(spark, [(None, "UPDATE", "d", 2)]), 0)
    assert rows(state.read_state(spark, table).drop(BUCKET), "id", "v") == [(1, "b"), (None, "d")]


@pytest.mark.parametrize("bucket_fn", ["md5", "spark_hash", "xxhash64", "key_bytes"])
def test_buckets_do_not_depend_on_the_time_zone(spark, bucket_fn):
    seen = set()
    for zone in ("UTC", "Asia/Tokyo", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        df = spark.range(5).select(F.timestamp_micros(F.col("id") * 10**12).alias("at"))
        seen.add(tuple(r[0] for r in df.select(bucket_column(df, ["at"], 1000, bucket_fn)).collect()))
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert len(seen) == 1


@pytest.mark.parametrize("delete_mode, guard", [("hard", None), ("hard", "seq"), ("soft", None), ("soft", "seq"), ("ignore", None)])
def test_bucketed_merges_give_what_state_tables_give(spark, folder, delete_mode, guard):
    at = F.lit("2024-01-01 00:00:00").cast("timestamp")
    options = {"delete_mode": delete_mode, "guard_col": guard, "buckets": 4}
    one, other = StateTable(f"{folder}/s", ("id",), **options), BucketedTable(f"{folder}/b", ("id",), **options)
    state.create_state(spark, base_of(spark), one)
    bucketed.create_bucketed(spark, base_of(spark), other)
    for n, batch in enumerate(random_batches(8, n=3)):
        state.append_changes(spark, one, changes_of(spark, batch), n)
        bucketed.append_bucketed(spark, other, changes_of(spark, batch), n)
        if n in (1, 4):
            state.fold_log(spark, one, deleted_at=at)
            bucketed.fold_bucketed(spark, other, deleted_at=at)
        want = state.read_state(spark, one, deleted_at=at).drop(BUCKET)
        assert rows(bucketed.read_bucketed(spark, other, deleted_at=at), *want.columns) == rows(want)


def test_bucketed_merge_does_not_move_the_base(spark, folder):
    table = BucketedTable(folder, ("id",), 8)
    bucketed.create_bucketed(spark, base_of(spark, 500), table)
    bucketed.append_bucketed(spark, table, changes_of(spark, [(3, "UPDATE", "x", 1), (900, "INSERT", "y", 1)]), 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = bucketed.read_bucketed(spark, table)._jdf.queryExecution().executedPlan().toString()
        lines = plan.splitlines()
        depth = lambda line: len(line) - len(line.lstrip(" :+-"))
        scan = next(i for i, line in enumerate(lines) if "FileScan parquet" in line and "Bucketed: true" in line)
        above, least = [], depth(lines[scan])
        for line in reversed(lines[:scan]):
            if depth(line) < least:
                above.append(line)
                least = depth(line)
        assert not any("Exchange" in line for line in above) and plan.count("Exchange") == 1
        bucketed.fold_bucketed(spark, table)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    files = bucketed.read_bucketed(spark, table).inputFiles()
    assert len(files) <= 8 and bucketed.read_bucketed(spark, table).count() == 501
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("tidemark_")]


def test_bucketed_tables_refuse_what_they_can_not_hold(spark, folder):
    table = BucketedTable(folder, ("id",), 4)
    twice = base_of(spark).unionByName(base_of(spark, 1))
    with pytest.raises(ValueError, match="unique"):
        bucketed.create_bucketed(spark, twice, table)
    with pytest.raises(Exception, match="NULL"):
        bucketed.create_bucketed(spark, spark.createDataFrame([(None, "a", 0)], STATE), table)
    bucketed.create_bucketed(spark, base_of(spark), table)
    with pytest.raises(ValueError, match="buckets"):
        bucketed.read_bucketed(spark, BucketedTable(folder, ("id",), 5))
    bucketed.append_bucketed(spark, table, changes_of(spark, [(1, "DELETE", None, 1)]), 0)
    assert bucketed.fold_bucketed(spark, table) == bucketed.fold_bucketed(spark, table) == 0
    with pytest.raises(ValueError, match="not after"):
        bucketed.append_bucketed(spark, table, changes_of(spark, []), 0)
    bucketed.create_bucketed(spark, base_of(spark, 3), table)
    assert bucketed.read_bucketed(spark, table).count() == 3


def test_ranks_and_depths_by_ranges(spark, folder):
    made = [(i, (i * 7) % 50 if i % 11 else None, f"{'x' * 40}{i % 90:03d}", float(i % 13)) for i in range(400)]
    df = spark.createDataFrame(made, "id long, n long, s string, d double").repartition(7)
    for column, at in (("n", 1), ("s", 2), ("d", 3)):
        values = sorted(r[at] for r in made if r[at] is not None)
        want = {r[0]: sum(v < r[at] for v in values) * 64 // len(values) if r[at] is not None else 0 for r in made}
        got = {r["id"]: r["rank"] for r in quantiles.with_rank(df, column, 64, "rank").collect()}
        assert got == want
    path = f"{folder}/t"
    bounds = [(0, 10), (5, 20), (10, 12), (30, 40), (30, 30), (41, 50)]
    for low, high in bounds:
        part = spark.createDataFrame([(low,), (high,), (None,)], "v long")
        part.coalesce(1).write.mode("append").parquet(path)
    row = layout.clustering_depth(spark, path, "v").collect()[0]
    depth = lambda p: sum(low <= p <= high for low, high in bounds)
    assert (row["files"], row["max_depth"]) == (6, max(depth(low) for low, _ in bounds))
    assert row["mean_depth"] == pytest.approx(sum(depth(low) for low, _ in bounds) / 6)
    assert row["mean_read"] == pytest.approx(sum(depth(x) for b in bounds for x in b) / 12)


def test_zorder_keeps_no_cut_points(spark, folder):
    """The plan of the rewrite holds no list of values, for one column or several."""
    df = spark.range(5000).selectExpr("id", "id % 77 AS a", "cast(id AS string) AS b", "0 AS _bucket")
    plan = layout.with_zvalue(df, ["a", "b", "id"], 10)._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 20_000
    assert layout.with_zvalue(df, ["a", "b", "id"], 10).select("__z").distinct().count() > 1000


@pytest.mark.parametrize("delete_mode, guard", [("hard", None), ("hard", "seq"), ("soft", None), ("soft", "seq"), ("ignore", None)])
def test_large_folds_move_rows_once_for_base_and_undo(spark, folder, monkeypatch, delete_mode, guard):
    at = F.lit("2024-01-01 00:00:00").cast("timestamp")
    options = {"delete_mode": delete_mode, "guard_col": guard, "buckets": 4, "bucket_fn": "spark_hash"}
    plain, table = (StateTable(f"{folder}/{n}", ("id",), undo=n == "undo", **options) for n in ("plain", "undo"))
    # Keys that repeat, and a row without a key.
    base = base_of(spark).union(spark.createDataFrame([(50, "a", 1), (50, "b", 2), (None, "none", 0)], STATE))
    batches = [[*batch, (None, "UPDATE", f"n{n}", 100 + n)] for n, batch in enumerate(random_batches(5))]
    for t in (plain, table):
        state.create_state(spark, base, t)
        for n, batch in enumerate(batches):
            state.append_changes(spark, t, changes_of(spark, batch), n)
    want = [rows(state.read_state(spark, plain, as_of=n, deleted_at=at).drop(BUCKET)) for n in range(len(batches))]
    plans, rebalance = [], state.rebalance_by_bucket
    monkeypatch.setattr(state, "rebalance_by_bucket", lambda df: plans.append(df._jdf.queryExecution().toString()) or rebalance(df))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # no batch is small
    try:
        state.fold_log(spark, plain, deleted_at=at)
        del plans[:]
        state.fold_log(spark, table, deleted_at=at)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    written = [p[p.index("== Physical Plan ==") :].count("Exchange hashpartitioning") for p in plans]
    # One for the fold of each batch, one for keys; then the base is written from the same rows.
    assert len(written) == 2 and written[0] <= 2
    assert rows(state.read_state(spark, table, "base")) == rows(state.read_state(spark, plain, "base"))
    for n in range(len(batches)):
        assert rows(state.read_state(spark, table, as_of=n, deleted_at=at).drop(BUCKET)) == want[n]
