"""What batches did, counted while they are written and kept with the table."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators.merge import merge_metrics
from tidemark.plans.options import MergeOptions
from tidemark.sources import state, swap
from tidemark.sources.catalog import parse_schema
from tidemark.sources.changes import write_changes
from tidemark.sources.state import StateTable
from tidemark.streaming import run

BUSINESS = parse_schema("k:int,v:string")
CHANGE = "k int, v string, _op string, _txn_id string, _total_order bigint, _collection_order bigint"
COUNTS = ("changed_keys", "updated_rows", "deleted_rows", "inserted_rows")


def changes(spark, *items):
    return spark.createDataFrame([(k, v, op, f"t{o}", o, o) for k, v, op, o in items], CHANGE)


def base_of(spark, n=20):
    return spark.createDataFrame([(k, "old") for k in range(n)], "k int, v string")


@pytest.mark.parametrize("limit", ["-1", "10m"])
@pytest.mark.parametrize("mode", ["hard", "ignore", "soft"])
def test_counts_are_those_of_a_join(spark, folder, mode, limit):
    draw = random.Random(f"{mode}{limit}")
    table = state.create_state(spark, base_of(spark), StateTable(f"{folder}/t", ("k",), 4, delete_mode=mode))
    expected = []
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        for number in range(3):
            items = [
                (draw.randrange(40), f"b{number}", draw.choice(["INSERT", "UPDATE", "DELETE", "TRUNCATE"]), o)
                for o in range(60)
            ]
            batch = changes(spark, *items)
            now = state.read_state(spark, table, "base").drop("_bucket")
            counted = merge_metrics(now, batch, ["k"]).first().asDict()
            if mode == "ignore":
                counted["deleted_rows"] = 0
            expected.append((number, *[counted[c if c != "changed_keys" else "source_rows"] for c in COUNTS]))
            state.write_state(spark, table, batch, report=("job", number))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert rows(state.batch_report(spark, table), "batch_id", *COUNTS) == expected
    assert rows(state.batch_report(spark.newSession(), table), "batch_id", *COUNTS) == expected


def test_batches_that_change_nothing(spark, folder):
    table = state.create_state(spark, base_of(spark, 0), StateTable(f"{folder}/t", ("k",), 4))
    assert state.batch_report(spark, table).count() == 0
    state.write_state(spark, table, changes(spark), report=("job", 0))
    state.write_state(spark, table, changes(spark, (1, "a", "DELETE", 1)), report=("job", 1))
    state.write_state(spark, table, changes(spark, (1, "a", "INSERT", 2)), report=("job", 2))
    state.write_state(spark, table, changes(spark, (1, "a", "DELETE", 3)), report=("job", 3))
    state.write_state(spark, table, changes(spark, (1, "a", "TRUNCATE", 3)), report=("job", 4))
    assert rows(state.batch_report(spark, table), "batch_id", *COUNTS) == [
        (0, 0, 0, 0, 0), (1, 1, 0, 0, 0), (2, 1, 0, 0, 1), (3, 1, 0, 1, 0), (4, 0, 0, 0, 0),
    ]
    with pytest.raises(ValueError, match="upserts"):
        state.write_state(spark, table, changes(spark), semantics="phased", report=("job", 5))


def test_a_reported_batch_is_applied_once(spark, folder, monkeypatch):
    table = state.create_state(spark, base_of(spark, 2), StateTable(f"{folder}/t", ("k",), 4))
    first = changes(spark, (0, "a", "UPDATE", 1), (5, "n", "INSERT", 1))
    state.write_state(spark, table, first, report=("job", 0))
    state.write_state(spark, table, changes(spark, (0, "b", "UPDATE", 2)), report=("job", 1))
    assert state.write_state(spark, table, first, report=("job", 0)) == []
    assert rows(state.read_state(spark, table), "k", "v") == [(0, "b"), (1, "old"), (5, "n")]
    # A write that dies before it is decided has neither changed nor reported anything.
    with monkeypatch.context() as broken:
        broken.setattr(swap, "_write_json", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            state.write_state(spark, table, changes(spark, (0, "c", "UPDATE", 3)), report=("job", 2))
    assert not state.is_reported(spark, table, "job", 2)
    # One that dies after that is finished by the next, and then counts as applied.
    with monkeypatch.context() as broken:
        broken.setattr(swap, "_move", _fail_after(swap._move, 1))
        with pytest.raises(OSError):
            state.write_state(spark, table, changes(spark, (0, "c", "UPDATE", 3)), report=("job", 2))
    assert state.write_state(spark, table, changes(spark, (0, "c", "UPDATE", 3)), report=("job", 2)) == []
    assert rows(state.read_state(spark, table), "k", "v") == [(0, "c"), (1, "old"), (5, "n")]
    assert rows(state.batch_report(spark, table), "batch_id", *COUNTS) == [(0, 2, 1, 0, 1), (1, 1, 1, 0, 0), (2, 1, 1, 0, 0)]
    # A table made anew has no batches.
    state.create_state(spark, base_of(spark, 2), table)
    assert state.batch_report(spark, table).count() == 0


def _fail_after(move, n):
    calls = []

    def run_it(*arguments):
        calls.append(1)
        if len(calls) > n:
            raise OSError("lost")
        move(*arguments)

    return run_it


@pytest.mark.parametrize("sink", ["mor", "cow"])
def test_stream_batches_are_kept_with_the_table(spark, folder, sink):
    how = {"delete_mode": "soft", "guard_col": "_total_order"} if sink == "cow" else {}
    table, log = StateTable(f"{folder}/t", ("k",), 4, **how), f"{folder}/log"
    write_changes(changes(spark, *[(k, "v", "INSERT", k) for k in range(40)]), log, ["k"], 4)
    options = MergeOptions(
        target=table.path, checkpoint=f"{folder}/cp", sink=sink, trigger="available-now",
        max_files_per_trigger=1, report=True,
    )
    query = run.run_changes(spark, log, BUSINESS, table, options)
    query.awaitTermination()
    report = state.batch_report(spark, table)
    total = "inserted_rows" if sink == "cow" else "changes"
    assert report.agg(F.sum(total), F.count("*"), F.countDistinct("batch_id")).first() == (40, 4, 4)
    assert rows(report.select("run").distinct()) == [(query.id,)]
    assert report.where("duration_ms < 0 or finished is null").count() == 0
    write_changes(changes(spark, (1, "w", "UPDATE", 50), (2, "w", "DELETE", 50)), log, ["k"], 4)
    run.run_changes(spark, log, BUSINESS, table, options).awaitTermination()
    later = state.batch_report(spark, table).where("batch_id >= 4")
    if sink == "cow":
        assert later.agg(F.sum("updated_rows"), F.sum("deleted_rows"), F.sum("inserted_rows")).first() == (1, 1, 0)
    else:
        assert later.agg(F.sum("changes")).first() == (2,)
