"""Random change lists against a plain replay, one change after the other."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators import merge
from tidemark.sources.state import StateTable, append_changes, create_state, fold_log, read_state, write_state

CHANGE = "k int, v string, _op string, _txn_id string, _total_order bigint, _collection_order bigint"
OPS = ["INSERT", "SNAPSHOT", "UPDATE", "DELETE"]


def scenario(seed):
    source = random.Random(seed)
    before = {k: f"s{k}" for k in range(12) if source.random() < 0.6}
    log = []
    for order in range(source.randint(0, 60)):
        # A third of the changes hit one key.
        key = 0 if source.random() < 0.34 else source.randrange(15)
        log.append((key, f"c{order}", source.choice(OPS), f"t{order}", order, 0))
    return before, log


def replay(before, log):
    current = dict(before)
    for key, value, op, *_ in sorted(log, key=lambda c: c[4]):
        if op == "DELETE":
            current.pop(key, None)
        else:
            current[key] = value
    return sorted(current.items())


def frame(spark, items, schema):
    return spark.createDataFrame(items, schema).repartition(3)


def test_upsert_equals_replay(spark):
    for seed in range(8):
        before, log = scenario(seed)
        result = merge.merge_changes(frame(spark, list(before.items()), "k int, v string"), frame(spark, log, CHANGE), ["k"])
        assert rows(result) == sorted(replay(before, log), key=lambda r: str(r[0])), seed


def test_soft_delete_equals_replay_of_live_rows(spark):
    for seed in range(8, 12):
        before, log = scenario(seed)
        result = merge.merge_changes(
            frame(spark, list(before.items()), "k int, v string"), frame(spark, log, CHANGE), ["k"], delete_mode="soft"
        )
        live = result.where(~F.col("_is_deleted")).select("k", "v")
        assert rows(live) == sorted(replay(before, log), key=lambda r: str(r[0])), seed


def test_guarded_batches_in_any_order_equal_replay(spark):
    for seed in range(12, 16):
        before, log = scenario(seed)
        shuffled = random.Random(seed).sample(log, len(log))
        current = frame(spark, [(k, v, -1) for k, v in before.items()], "k int, v string, _total_order bigint")
        for part in (shuffled[::2], shuffled[1::2]):
            current = merge.merge_changes(
                current, frame(spark, part, CHANGE), ["k"], delete_mode="soft", guard_col="_total_order"
            )
        live = current.where(~F.col("_is_deleted")).select("k", "v")
        assert rows(live) == sorted(replay(before, log), key=lambda r: str(r[0])), seed


@pytest.mark.parametrize("limit", ["10MB", "-1"])
def test_stored_state_equals_replay(spark, folder, limit):
    """With the batch's keys broadcast, and with every join and write shuffled."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        stored_equals_replay(spark, folder)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def stored_equals_replay(spark, folder):
    before, log = scenario(99)
    want = sorted(replay(before, log), key=lambda r: str(r[0]))
    start = frame(spark, list(before.items()), "k int, v string")
    cow = create_state(spark, start, StateTable(f"{folder}/cow", ("k",), 4))
    third = len(log) // 3
    for part in (log[:third], log[third:]):
        write_state(spark, cow, frame(spark, part, CHANGE))
    assert rows(read_state(spark, cow, "base"), "k", "v") == want
    mor = create_state(spark, start, StateTable(f"{folder}/mor", ("k",), 4))
    for number, part in enumerate((log[third:], log[:third])):
        append_changes(spark, mor, frame(spark, part, CHANGE), number)
    assert rows(read_state(spark, mor), "k", "v") == want
    fold_log(spark, mor)
    assert rows(read_state(spark, mor, "base"), "k", "v") == want
    assert rows(read_state(spark, mor), "k", "v") == want
