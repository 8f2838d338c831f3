"""Merged runs of the change log, imports that go on where they died, heavy keys."""

import collections
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import rows
from tests.test_history import base_of, changes_of, random_batches
from tidemark.names import BUCKET
from tidemark.operators import checks
from tidemark.sources import ingest, state, stats, swap
from tidemark.sources.catalog import TableDef, parse_schema
from tidemark.sources.state import StateTable


class Died(Exception):
    pass


def dying(monkeypatch, name, after):
    """Let the step ``name`` of a swap fail when it is done for the ``after``-th time."""
    real, left = getattr(swap, name), [after]

    def step(*args):
        left[0] -= 1
        if left[0] < 0:
            raise Died
        return real(*args)

    monkeypatch.setattr(swap, name, step)


def test_runs_are_few_and_cover_all():
    rng = random.Random(1)
    for width in (2, 3, 4):
        runs = []
        for n in range(300):
            runs.append((n, n))
            if rng.random() < 0.3 or n == 299:
                runs = [(r[0][0], r[-1][1]) for r in state.tiered_runs(runs, width)]
                assert [n for a, b in runs for n in range(a, b + 1)] == list(range(n + 1))
        tiers = [state._tier([r], width) for r in runs]
        assert tiers == sorted(tiers, reverse=True) and max(collections.Counter(tiers).values()) < width


@pytest.mark.parametrize("delete_mode, guard, undo", [("hard", None, False), ("soft", "seq", True)])
def test_merged_log_reads_the_same(spark, folder, delete_mode, guard, undo):
    at = F.lit("2024-01-01 00:00:00").cast("timestamp")
    table = StateTable(f"{folder}/t", ("id",), buckets=4, delete_mode=delete_mode, guard_col=guard, undo=undo)
    state.create_state(spark, base_of(spark), table)
    for n, batch in enumerate([*random_batches(5, 5), []]):
        state.append_changes(spark, table, changes_of(spark, batch).withColumn("later", F.lit(n)), n)
    seen = lambda **how: rows(state.read_state(spark, table, deleted_at=at, **how).drop(BUCKET))
    want, middle = seen(), seen(as_of=3)
    assert state.compact_log(spark, table, width=2) == [(0, 3)]
    assert state.logged_batches(spark, table) == [3, 4, 5]
    assert seen() == want and seen(as_of=3) == middle
    keys = state.read_log(spark, table).where("_batch_id = 3").groupBy("id").count()
    assert keys.where("count > 1").count() == 0
    for refused in (lambda: seen(as_of=1), lambda: state.rollback(spark, table, 2)):
        with pytest.raises(ValueError, match="batches 0 to 3 are merged"):
            refused()
    with pytest.raises(ValueError, match="merged with others"):
        state.append_changes(spark, table, changes_of(spark, []), 2)
    assert state.next_batch_id(spark, table) == 6
    # A column declared later has the values that the merged batches carried.
    declared = state.base_schema(spark, table).add("later", T.IntegerType())
    state.declare_schema(spark, table, declared)
    assert state.read_log(spark, table).where("later is null").count() == 0
    state.fold_log(spark, table, deleted_at=at)
    assert rows(state.read_state(spark, table, "base").drop(BUCKET, "later")) == want
    if undo:
        assert rows(state.read_state(spark, table, as_of=3).drop(BUCKET, "later")) == middle
        state.rollback(spark, table, 3)
        assert rows(state.read_state(spark, table, "base").drop(BUCKET, "later")) == middle
    assert state.compact_log(spark, table) == []


@pytest.mark.parametrize("step, after", [("_write_json", 0), ("_move", 0), ("_move", 1), ("set_marker", 0), ("delete_path", 1), ("delete_path", 3)])
def test_merging_the_log_may_die(spark, folder, monkeypatch, step, after):
    table = StateTable(f"{folder}/t", ("id",), buckets=2)
    state.create_state(spark, base_of(spark), table)
    for n, batch in enumerate(random_batches(8, 4)):
        state.append_changes(spark, table, changes_of(spark, batch), n)
    want = rows(state.read_state(spark, table).drop(BUCKET))
    with monkeypatch.context() as patch:
        dying(patch, step, after)
        with pytest.raises(Died):
            state.compact_log(spark, table, width=3)
    assert rows(state.read_state(spark, table).drop(BUCKET)) == want
    state.compact_log(spark, table, width=3)
    assert rows(state.read_state(spark, table).drop(BUCKET)) == want
    assert state.logged_batches(spark, table) == [2, 3]


def text_files(folder, n=5, per=4):
    os.makedirs(folder)
    for i in range(n):
        with open(f"{folder}/part{i}.csv", "w") as out:
            out.writelines(f"{i * per + j},name{j}\n" for j in range(per))
    return [(i, f"name{i % per}") for i in range(n * per)]


def account():
    return TableDef("t", parse_schema("id:long,name:string"), ("id",), "", ",")


@pytest.mark.parametrize("step, after", [("_write_json", 1), ("_move", 3), ("_move", 7), ("set_marker", 2), ("set_marker", 4)])
def test_imports_go_on_where_they_died(spark, folder, monkeypatch, step, after):
    want = text_files(f"{folder}/text")
    table = StateTable(f"{folder}/t", ("id",), buckets=2)
    with monkeypatch.context() as patch:
        dying(patch, step, after)
        with pytest.raises(Died):
            ingest.import_resumable(spark, f"{folder}/text", account(), table, unit_bytes=1)
    if state.is_declared(spark, table):
        for mode in ("skip", "append", "upsert"):
            with pytest.raises(ValueError, match="not finished"):
                ingest.import_table(spark, f"{folder}/text", account(), table, mode)
    ingest.import_table(spark, f"{folder}/text", account(), table, "resume")
    assert ingest.is_sealed(spark, table)
    assert sorted((r["id"], r["name"]) for r in state.read_state(spark, table).collect()) == want
    assert ingest.import_resumable(spark, f"{folder}/text", account(), table)
    ingest.import_table(spark, f"{folder}/text", account(), table, "skip")
    assert state.read_state(spark, table).count() == len(want)


def test_imports_refuse_changed_files(spark, folder):
    text_files(f"{folder}/text")
    table = StateTable(f"{folder}/t", ("id",), buckets=2, delete_mode="soft")
    assert not ingest.import_resumable(spark, f"{folder}/text", account(), table, unit_bytes=1, max_units=2)
    with pytest.raises(ValueError, match="was begun from"):
        ingest.import_resumable(spark, f"{folder}/text/part0.csv", account(), table)
    with open(f"{folder}/text/part0.csv", "a") as out:
        out.write("99,new\n")
    with pytest.raises(ValueError, match="part0.csv"):
        ingest.import_resumable(spark, f"{folder}/text", account(), table)
    ingest.import_table(spark, f"{folder}/text", account(), table, "overwrite")
    assert state.read_state(spark, table).count() == 21 and ingest.is_sealed(spark, table)
    with pytest.raises(ValueError, match="no files"):
        ingest.import_resumable(spark, f"{folder}/none", account(), StateTable(f"{folder}/u", ("id",)))


def test_heavy_keys(spark):
    """Every key with its share is found among many, also composite and NULL ones, and counted exactly."""
    rng = random.Random(2)
    data = [(rng.choice(["a", None]), 7, 0) for _ in range(900)] + [("b", 1, 1)] * 700 + [("c", i, i % 2) for i in range(30_000)]
    df = spark.createDataFrame(data, f"x string, y long, {BUCKET} int")
    count, total = collections.Counter(data), collections.Counter(d[2] for d in data)
    for share in (0.02, 0.01, 0.2):
        want = {k: n for k, n in count.items() if n / total[k[2]] >= share}
        for sketches in (None, checks.key_sketches(df.withColumn("b", F.col("y") % 5), ["x", "y"], [BUCKET, "b"], share)):
            got = checks.heavy_keys(df, ["x", "y"], share, sketches=sketches).collect()
            assert {(r["x"], r["y"], r[BUCKET]): r["row_count"] for r in got} == want and len(got) == len(want)
    assert checks.heavy_keys(df.limit(0), ["x", "y"]).count() == 0
    with pytest.raises(ValueError, match="share"):
        checks.heavy_keys(df, ["x"], 0)


@pytest.mark.parametrize("delete_mode", ["hard", "soft"])
def test_statistics_count_changed_buckets_only(spark, folder, delete_mode):
    table = StateTable(f"{folder}/t", ("id",), buckets=8, delete_mode=delete_mode, undo=True)
    state.create_state(spark, base_of(spark, 200), table)

    def check(stale):
        """The kept counts, also of the buckets that were not counted again, are those of the whole table."""
        assert stats.refresh_statistics(spark, table, "seq") == stale
        base = state.read_state(spark, table, "base")
        live = F.count_if(~F.col("_is_deleted")) if delete_mode == "soft" else F.count(F.lit(1))
        full = base.agg(F.count(F.lit(1)), live, F.count_distinct("id"), F.lit(0), F.lit(0), F.max("seq"))
        assert rows(stats.table_statistics(spark, table, "seq")) == rows(full)
        return {b: swap.names_in(spark, f"{table.stats_of('seq')}/{BUCKET}={b}") for b in range(8)}

    first = check(list(range(8)))
    touched = state.write_state(spark, table, changes_of(spark, [(1, "DELETE", None, 5), (500, "INSERT", "n", 6)]))
    assert 0 < len(touched) < 8 and all(swap.path_exists(spark, f"{table.stats_of('seq')}/{BUCKET}={b}") != (b in touched) for b in range(8))
    then = check(touched)
    assert all((then[b] != first[b]) == (b in touched) for b in range(8))
    state.append_changes(spark, table, changes_of(spark, [(2, "UPDATE", "u", 7), (3, "DELETE", None, 8)]), 0)
    check([])
    state.fold_log(spark, table)
    check(sorted({r[0] for r in table.bucketed(changes_of(spark, [(2, "", "", 0), (3, "", "", 0)])).select(BUCKET).collect()}))
    state.rollback(spark, table, -1)
    assert stats.refresh_statistics(spark, table, "seq")
    state.compact_state(spark, table)
    check([])
    state.create_state(spark, base_of(spark, 0), table)
    assert rows(stats.table_statistics(spark, table)) == [(0, 0, 0, 0, 0, None)]


def test_statistics_of_doubled_and_missing_keys(spark, folder):
    table = StateTable(f"{folder}/t", ("id",), buckets=2, bucket_fn="spark_hash")
    state.create_state(spark, spark.createDataFrame([(1, "a", 0), (1, "b", 3), (None, "c", 1), (None, "d", 2), (2, "e", None)], "id long, v string, seq long"), table)
    assert rows(stats.table_statistics(spark, table, "seq")) == [(5, 5, 2, 2, 1, 3)]
