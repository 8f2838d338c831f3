"""Streams over change logs, options, and the heartbeat backfill."""

import time

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.plans.jobs import accept, merge_once
from tidemark.plans.options import MergeOptions
from tidemark.sources import state
from tidemark.sources.changes import change_schema, read_changes, write_changes
from tidemark.sources.catalog import parse_schema
from tidemark.sources.state import StateTable
from tidemark.streaming import run

BUSINESS = parse_schema("k:int,v:string")
CHANGE = "k int, v string, _op string, _txn_id string, _total_order bigint, _collection_order bigint"


def changes(spark, *items):
    return spark.createDataFrame([(k, v, op, f"t{o}", o, o) for k, v, op, o in items], CHANGE)


def options(folder, **how):
    how = {"target": f"{folder}/t", "checkpoint": f"{folder}/cp", "trigger": "available-now", **how}
    return MergeOptions(**how)


def test_option_checks(folder):
    for bad in (
        {"sink": "kafka"}, {"trigger": "hourly"}, {"semantics": "merge"}, {"noop_buckets": "3-1"},
        {"sink": "mor", "semantics": "phased"}, {"insert_mode": "blind"},
        {"target": None}, {"checkpoint": None}, {"fold": False},
    ):
        with pytest.raises(ValueError):
            options(folder, **bad)
    assert options(folder, noop_buckets="0-2,5").skipped == (0, 1, 2, 5)
    assert options(folder, sink="noop", target=None).trigger_arguments() == {"availableNow": True}
    assert options(folder, trigger="once").trigger_arguments() == {"availableNow": True}
    late = options(folder, trigger="processing-time", interval="10 seconds")
    assert late.trigger_arguments() == {"processingTime": "10 seconds"}
    assert MergeOptions(target="t", streaming=False).checkpoint is None


def test_change_schema():
    assert change_schema(BUSINESS).names == [
        "k", "v", "_op", "_txn_id", "_total_order", "_collection_order", "_bucket",
    ]


@pytest.mark.parametrize("sink", ["mor", "cow"])
def test_stream_resumes_and_replays(spark, folder, sink):
    how = {"delete_mode": "soft", "guard_col": "_total_order"} if sink == "cow" else {}
    table = StateTable(f"{folder}/t", ("k",), 4, **how)
    log, how = f"{folder}/log", options(folder, sink=sink, max_files_per_trigger=1)

    def live():
        now = state.read_state(spark, table)
        return rows(now.where("not _is_deleted") if sink == "cow" else now, "k", "v")

    def go():
        query = run.run_changes(spark, log, BUSINESS, table, how)
        query.awaitTermination()
        return live()

    write_changes(changes(spark, (1, "a", "INSERT", 1), (2, "b", "INSERT", 1), (3, "c", "INSERT", 1)), log, ["k"], 4)
    assert go() == [(1, "a"), (2, "b"), (3, "c")]
    assert go() == [(1, "a"), (2, "b"), (3, "c")]
    write_changes(changes(spark, (1, "z", "UPDATE", 2), (2, "b", "DELETE", 2)), log, ["k"], 4)
    assert go() == [(1, "z"), (3, "c")]
    # A lost checkpoint re-reads the whole log: nothing is doubled.
    again = run.run_changes(spark, log, BUSINESS, table, options(folder, sink=sink, checkpoint=f"{folder}/cp2"))
    again.awaitTermination()
    assert live() == [(1, "z"), (3, "c")]
    # An older change in a later batch changes nothing, and a deleted key stays deleted.
    write_changes(changes(spark, (1, "old", "UPDATE", 1), (2, "old", "INSERT", 1)), log, ["k"], 4)
    assert go() == [(1, "z"), (3, "c")]


def test_late_change_after_a_hard_delete(spark, folder):
    table, log = StateTable(f"{folder}/t", ("k",), 4), f"{folder}/log"

    def go(checkpoint="cp", *items):
        if items:
            write_changes(changes(spark, *items), log, ["k"], 4)
        run.run_changes(spark, log, BUSINESS, table, options(
            folder, sink="cow", late_seconds=3600, checkpoint=f"{folder}/{checkpoint}"
        )).awaitTermination()
        return rows(state.read_state(spark, table), "k", "v")

    first = [(1, "a", "INSERT", 2), (2, "b", "INSERT", 2), (3, "c", "INSERT", None), (4, None, "INSERT", 2**60 + 1)]
    assert go("cp", *first) == [(1, "a"), (2, "b"), (3, "c"), (4, None)]
    assert go("cp", (1, "a", "DELETE", 5), (9, None, "DELETE", 5), (3, "d", "UPDATE", 1)) == [
        (2, "b"), (3, "d"), (4, None),
    ]
    # Older changes: of a deleted key, of one deleted before it was inserted, of one replaced, by one in 2 ** 60, without order.
    late = [(1, "z", "UPDATE", 4), (9, "z", "INSERT", 4), (2, "z", "UPDATE", 1), (4, "z", "UPDATE", 2**60), (3, "z", "UPDATE", None)]
    assert go("cp", *late) == [(2, "b"), (3, "d"), (4, None)]
    # Other operations neither count nor stand in the way; a newer change brings the key back.
    assert go("cp", (2, "x", "TRUNCATE", 9), (1, "n", "INSERT", 6)) == [(1, "n"), (2, "b"), (3, "d"), (4, None)]
    assert go("cp", (2, "y", "UPDATE", 8)) == [(1, "n"), (2, "y"), (3, "d"), (4, None)]
    assert go("new") == [(1, "n"), (2, "y"), (3, "d"), (4, None)]
    for other, more in ((StateTable(f"{folder}/o", ("k",), 4), {"sink": "mor"}), (
        StateTable(f"{folder}/o", ("k",), 4, delete_mode="soft", guard_col="_total_order"), {"sink": "cow"},
    )):
        with pytest.raises(ValueError, match="late_seconds"):
            run.run_changes(spark, log, BUSINESS, other, options(folder, late_seconds=5, **more))
    with pytest.raises(ValueError, match="positive"):
        options(folder, sink="cow", late_seconds=0)


def test_what_is_remembered_of_late_changes_ends(spark, folder):
    table, log = StateTable(f"{folder}/t", ("k",), 4), f"{folder}/log"
    how = options(folder, sink="cow", late_seconds=1)
    for number in range(3):
        write_changes(changes(spark, (number, "a", "INSERT", 2)), log, ["k"], 4)
        query = run.run_changes(spark, log, BUSINESS, table, how)
        query.awaitTermination()
        time.sleep(4)
    # Two windows of the last key at most, and those of the key before that no batch has taken away yet.
    assert query.recentProgress[-1].stateOperators[0].numRowsTotal <= 4
    assert rows(state.read_state(spark, table), "k") == [(0,), (1,), (2,)]


def test_processing_time_trigger(spark, folder):
    table, log = StateTable(f"{folder}/t", ("k",), 4), f"{folder}/log"
    write_changes(changes(spark, (1, "a", "INSERT", 1)), log, ["k"], 4)
    query = run.run_changes(spark, log, BUSINESS, table, options(folder, trigger="processing-time", interval="1 second"))
    try:
        query.processAllAvailable()
        assert rows(state.read_state(spark, table), "k", "v") == [(1, "a")]
        write_changes(changes(spark, (1, "b", "UPDATE", 2)), log, ["k"], 4)
        query.processAllAvailable()
        assert rows(state.read_state(spark, table), "k", "v") == [(1, "b")]
    finally:
        query.stop()


def test_new_checkpoint_after_folding_loses_nothing(spark, folder):
    """Batch numbers of a new checkpoint start again; they must not hide behind folded ones."""
    table, log = StateTable(f"{folder}/t", ("k",), 4), f"{folder}/log"
    write_changes(changes(spark, (1, "a", "INSERT", 1)), log, ["k"], 4)
    run.run_changes(spark, log, BUSINESS, table, options(folder)).awaitTermination()
    assert state.fold_log(spark, table) == 0
    write_changes(changes(spark, (1, "b", "UPDATE", 2), (2, "n", "INSERT", 1)), log, ["k"], 4)
    for _ in range(2):
        run.run_changes(spark, log, BUSINESS, table, options(folder, checkpoint=f"{folder}/new")).awaitTermination()
        assert rows(state.read_state(spark, table), "k", "v") == [(1, "b"), (2, "n")]
    assert state.next_batch_id(spark, table) == 2


def test_noop_buckets_and_bucket_choice(spark, folder):
    log = f"{folder}/log"
    write_changes(changes(spark, *[(k, "v", "INSERT", k) for k in range(40)]), log, ["k"], 4)
    table = StateTable(f"{folder}/t", ("k",), 4, delete_mode="soft", guard_col="_total_order")
    how = options(folder, sink="cow", noop_buckets="0,1")
    run.run_changes(spark, log, BUSINESS, table, how).awaitTermination()
    assert rows(state.read_state(spark, table).select("_bucket").distinct()) == [(2,), (3,)]
    other = StateTable(f"{folder}/o", ("k",), 4)
    how = options(folder, target=other.path, checkpoint=f"{folder}/cp-o", buckets="3")
    run.run_changes(spark, log, BUSINESS, other, how).awaitTermination()
    assert rows(state.read_state(spark, other).select("_bucket").distinct()) == [(3,)]
    assert rows(read_changes(spark, log, BUSINESS, buckets="3").select("_bucket").distinct()) == [(3,)]


def test_progress_of_more_batches_than_spark_keeps(spark, folder):
    log = f"{folder}/log"
    write_changes(changes(spark, *[(k, "v", "INSERT", k) for k in range(40)]), log, ["k"], 8)
    how = options(folder, sink="noop", target=None, max_files_per_trigger=1)
    batches = run.ProgressLog()
    spark.streams.addListener(batches)
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        query = run.run_changes(spark, log, BUSINESS, StateTable(f"{folder}/t", ("k",), 8), how)
        query.awaitTermination()
        got = run.progress_frame(spark, query, batches)
        assert run.progress_frame(spark, query).count() <= 2
        assert got.agg(F.sum("input_rows"), F.countDistinct("batch_id")).first() == (40, got.count())
        assert got.count() > 2
        batches.forget(query)
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
        spark.streams.removeListener(batches)


def test_other_sinks_and_progress(spark, folder):
    log = f"{folder}/log"
    write_changes(changes(spark, (1, "a", "INSERT", 1), (2, "b", "INSERT", 1)), log, ["k"], 4)
    table = StateTable(f"{folder}/t", ("k",), 4)
    for number, (sink, fold) in enumerate((("noop", True), ("noop", False), ("console", True))):
        how = options(folder, sink=sink, fold=fold, target=None, checkpoint=f"{folder}/cp{number}")
        query = run.run_changes(spark, log, BUSINESS, table, how)
        query.awaitTermination()
        assert run.progress_frame(spark, query).agg(F.sum("input_rows")).first()[0] == 2
    merge_once(spark, changes(spark, (1, "a", "INSERT", 1)), table, MergeOptions(sink="console", streaming=False))
    assert not state.path_exists(spark, table.base_path)


def test_batches_limited_by_rows(spark, folder):
    log, table = f"{folder}/log", StateTable(f"{folder}/t", ("k",), 4)
    many = [(k, "v", "INSERT", k) for k in range(90)]
    write_changes(changes(spark, *many[:50]), log, ["k"], 4, max_rows_per_file=5)
    write_changes(changes(spark, *many[50:]), log, ["k"], 4)  # the log's limit holds for every write
    per_file = read_changes(spark, log, BUSINESS).groupBy(F.input_file_name()).count()
    assert per_file.agg(F.max("count")).first()[0] == 5
    how = options(folder, max_rows_per_trigger=17, report=True)
    run.run_changes(spark, log, BUSINESS, table, how).awaitTermination()
    first = rows(state.batch_report(spark, table), "batch_id", "changes")
    assert sum(n for _, n in first) == 90 and max(n for _, n in first) <= 15
    assert state.read_state(spark, table).count() == 90
    # A batch that is told again reads the same files; the others follow in the same cut.
    again = StateTable(f"{folder}/u", ("k",), 4)
    run.run_changes(spark, log, BUSINESS, again, options(
        folder, target=again.path, checkpoint=f"{folder}/cp2", max_rows_per_trigger=17, report=True
    )).awaitTermination()
    assert rows(state.batch_report(spark, again), "batch_id", "changes") == first
    with pytest.raises(ValueError, match="at least one file"):
        read_changes(spark, log, BUSINESS, stream=True, max_rows_per_trigger=4)
    with pytest.raises(ValueError, match="not 9"):
        write_changes(changes(spark, *many[:1]), log, ["k"], 4, max_rows_per_file=9)
    plain = f"{folder}/plain"
    write_changes(changes(spark, *many), plain, ["k"], 4)
    with pytest.raises(ValueError, match="does not declare"):
        read_changes(spark, plain, BUSINESS, stream=True, max_rows_per_trigger=100)
    with pytest.raises(ValueError, match="declared"):
        write_changes(changes(spark, *many[:1]), plain, ["k"], 4, max_rows_per_file=9)
    with pytest.raises(ValueError, match="positive"):
        write_changes(changes(spark, *many[:1]), f"{folder}/none", ["k"], 4, max_rows_per_file=0)
    write_changes(changes(spark, *many), plain, ["k"], 4, mode="overwrite", max_rows_per_file=9)
    assert read_changes(spark, plain, BUSINESS, stream=True, max_rows_per_trigger=9).isStreaming
    with pytest.raises(ValueError, match="both"):
        options(folder, max_rows_per_trigger=9, max_bytes_per_trigger="1m")


def test_several_tables_in_one_session(spark, folder):
    jobs, tables = {}, {}
    for name in ("first", "second"):
        log = f"{folder}/{name}/log"
        write_changes(changes(spark, (1, name, "INSERT", 1)), log, ["k"], 4)
        tables[name] = StateTable(f"{folder}/{name}/t", ("k",), 4)
        how = options(folder, target=tables[name].path, checkpoint=f"{folder}/{name}/cp")
        jobs[name] = (log, BUSINESS, tables[name], how)
    run.run_all(spark, jobs)
    assert {n: rows(state.read_state(spark, t), "v") for n, t in tables.items()} == {
        "first": [("first",)], "second": [("second",)],
    }


def test_failing_stream_is_reported(spark, folder):
    log = f"{folder}/log"
    write_changes(changes(spark, (1, "a", "INSERT", 1)), log, ["k"], 4)
    table = StateTable(f"{folder}/t", ("k",), 4)
    how = options(folder, auto_create=False)
    with pytest.raises(Exception, match="auto_create"):
        run.run_all(spark, {"only": (log, BUSINESS, table, how)})


def test_acceptance(spark, folder):
    table = StateTable(f"{folder}/t", ("k",), 4)
    how = options(folder, sink="cow", streaming=False)
    batch = changes(spark, (1, "a", "INSERT", 1), (1, "b", "UPDATE", 2), (2, "c", "INSERT", 1))
    assert accept(spark, batch, table, how).first()["is_unique"]
    doubled = spark.createDataFrame([(5, "x"), (5, "y")], "k int, v string")
    state.create_state(spark, doubled, table)
    with pytest.raises(ValueError, match="not unique"):
        accept(spark, batch, table, how)


def test_phased_sink(spark, folder):
    table = state.create_state(
        spark, spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), StateTable(f"{folder}/t", ("k",), 4)
    )
    how = options(folder, sink="cow", streaming=False, semantics="phased", insert_mode="if_absent")
    items = [(1, "x", "INSERT", 1), (2, "b", "DELETE", 1), (3, "c", "INSERT", 1), (4, "d", "UPDATE", 1)]
    merge_once(spark, changes(spark, *items), table, how)
    assert rows(state.read_state(spark, table), "k", "v") == [(1, "a"), (3, "c")]


def account(spark, folder):
    start = spark.range(30).selectExpr("cast(id as int) k", "cast(id as float) balance", "timestamp_seconds(0) stamp")
    return state.create_state(spark, start, StateTable(f"{folder}/t", ("k",), 2))


STEP = {"balance": "balance + 100", "stamp": "current_timestamp()"}


def test_backfill_walks_through_the_bucket(spark, folder):
    table = account(spark, folder)
    size = state.read_state(spark, table, buckets=[1]).count()
    for _ in range(3):
        assert run.backfill_slice(spark, table, 1, STEP, ["stamp", "k"], 4) == 4
    changed = state.read_state(spark, table).where("balance >= 100")
    assert changed.count() == min(12, size) and rows(changed.select("_bucket").distinct()) == [(1,)]
    assert state.read_state(spark, table).count() == 30
    assert run.backfill_slice(spark, StateTable(table.path, ("k",), 2), 7, STEP, ["stamp", "k"], 4) == 0


def test_heartbeat_backfill(spark, folder):
    table = account(spark, folder)
    seen = []
    query = run.run_backfill(
        spark, table, 0, STEP, ["stamp", "k"], 3, f"{folder}/cp", "1 second", 5,
        on_step=lambda batch, count, error: seen.append((count, error)),
    )
    bad = run.run_backfill(
        spark, table, 0, {"balance": "no_such_column"}, ["k"], 3, f"{folder}/cp-bad", "1 second", 5,
        on_step=lambda batch, count, error: seen.append((count, error)),
    )
    try:
        deadline = time.time() + 60
        while time.time() < deadline and not (any(c for c, _ in seen) and any(e for _, e in seen)):
            time.sleep(0.5)
        assert query.isActive and bad.isActive
    finally:
        query.stop()
        bad.stop()
    assert any(count == 3 for count, _ in seen) and any(error is not None for _, error in seen)
    assert state.read_state(spark, table).where("balance >= 100").count() >= 3


def test_streams_refuse_what_replay_would_break(spark, folder):
    plain = StateTable(f"{folder}/t", ("k",), 4)
    for how in ({"sink": "cow"}, {"sink": "cow", "semantics": "phased"}):
        with pytest.raises(ValueError):
            run.run_changes(spark, f"{folder}/log", BUSINESS, plain, options(folder, **how))


def test_limited_batches_are_logged_without_a_shuffle(spark, folder, monkeypatch):
    log, table = f"{folder}/log", StateTable(f"{folder}/t", ("k",), 4)
    write_changes(changes(spark, *[(k, "v", "INSERT", k) for k in range(40)]), log, ["k"], 4, max_rows_per_file=5)
    looked, moved, ensure, rebalance = [], [], run.ensure_state, state.rebalance_by_bucket
    monkeypatch.setattr(run, "ensure_state", lambda *a: looked.append(a) or ensure(*a))
    monkeypatch.setattr(state, "ensure_state", lambda *a: looked.append(a) or ensure(*a))
    monkeypatch.setattr(state, "rebalance_by_bucket", lambda df: moved.append(df) or rebalance(df))
    how = options(folder, max_rows_per_trigger=10, report=True)
    run.run_changes(spark, log, BUSINESS, table, how).awaitTermination()
    assert state.batch_report(spark, table).count() >= 4
    assert len(looked) == 1 and moved == []  # the table is made ready once, not for each batch
    assert rows(state.read_state(spark, table), "k") == [(k,) for k in sorted(range(40), key=str)]


def test_limited_batches_have_few_fixed_costs(spark, folder, monkeypatch):
    log, table = f"{folder}/log", StateTable(f"{folder}/t", ("k",), 4)
    offsets, ways, looked = [], [], []
    offset, merge, way = run.stream_offset, run.merge_once, run.CHECKPOINT_FILES
    monkeypatch.setattr(run, "stream_offset", lambda *a: offsets.append(a) or offset(*a))
    monkeypatch.setattr(run, "merge_once", lambda s, *a, **how: ways.append(s.conf.get(way, None)) or merge(s, *a, **how))
    how = options(folder, max_rows_per_trigger=10, report=True)

    def go(first):
        write_changes(changes(spark, *[(k, "v", "INSERT", k) for k in range(first, first + 40)]), log, ["k"], 4, max_rows_per_file=5)
        ways.clear(), offsets.clear()
        run.run_changes(spark, log, BUSINESS, table, how).awaitTermination()
        assert len(ways) >= 4 and len(offsets) == 1  # looked up once for a stream, not for each batch
        assert rows(state.read_state(spark, table), "k") == [(k,) for k in sorted(range(first + 40), key=str)]
        assert state.batch_report(spark, table).agg(F.sum("changes")).first()[0] == first + 40
        return set(ways)

    assert go(0) == {run.LOCAL_FILES} and spark.conf.get(way, None) is None
    # The checkpoint is gone on with in Spark's usual way, which a session may ask for, and back again.
    usual = run.LOCAL_FILES.replace("FileSystemBased", "FileContextBased")
    spark.conf.set(way, usual)
    try:
        assert go(40) == {usual} and spark.conf.get(way) == usual
    finally:
        spark.conf.unset(way)
    assert go(80) == {run.LOCAL_FILES}
    # A checkpoint elsewhere is left to Spark.
    monkeypatch.setattr(run, "is_local", lambda *a: looked.append(a[1]) or False)
    assert go(120) == {None} and looked == [how.checkpoint]
