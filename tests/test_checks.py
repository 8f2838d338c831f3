"""Counts, key checks, freshness, job metrics, and the shapes of plans."""

from datetime import datetime, timedelta

import pytest
from conftest import DATA, rows
from pyspark.sql import functions as F

from tidemark.operators import checks, fold, merge, metrics
from tidemark.plans import fixtures

START = datetime(2024, 1, 1)


def test_key_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k int, v string")
    assert checks.check_keys(df, ["k"]).first()[:] == (4, 3, 1, False)
    assert rows(checks.duplicate_keys(df, ["k"])) == [(1, 2)]
    with pytest.raises(ValueError, match="4 rows, 3 distinct"):
        checks.assert_unique(df, ["k"])
    checks.assert_unique(df, ["k", "v"])
    assert checks.check_keys(df.limit(0), ["k"]).first()[:] == (0, 0, 0, True)


def test_counts(spark):
    a, b = spark.range(5), spark.range(3)
    assert rows(checks.table_stats({"a": a, "b": b}, ["id"])) == [("a", 5, 5), ("b", 3, 3)]
    got = checks.check_counts({"a": a, "b": b, "c": b}, {"a": a, "b": a})
    assert rows(got) == [("a", 5, 5, True), ("b", 3, 5, False), ("c", 3, None, False)]
    assert checks.distinct_counts(spark.range(10).selectExpr("id % 4 k"), ["k"]).first()[0] == 4
    stats = checks.bucket_stats(spark.range(9).selectExpr("cast(if(id < 6, 0, 1) as int) _bucket"))
    assert rows(stats) == [(0, 6, 1.3333), (1, 3, 0.6667)]


def test_freshness(spark, capsys):
    df = spark.createDataFrame(
        [("a", START), ("a", START + timedelta(seconds=5)), ("b", START + timedelta(seconds=65))], "g string, ts timestamp"
    )
    assert rows(checks.freshness(df, "ts"), "max_ts") == [(START + timedelta(seconds=65),)]
    assert rows(checks.freshness_lag(df, "ts", ["g"]), "g", "lag_seconds") == [("a", 60.0), ("b", 0.0)]
    seen = F.lit(START + timedelta(seconds=70))
    assert rows(checks.freshness_lag(df, "ts", ["g"], seen), "g", "lag_seconds") == [("a", 65.0), ("b", 5.0)]
    assert [r.g for r in checks.preview(df, ["ts"], 2).collect()] == ["a", "a"]
    checks.print_preview(df, ["ts"], 2)
    shown = capsys.readouterr().out
    assert "row_count=3" in shown and "g: string" in shown


def test_rates(spark):
    samples = [
        ("h", START, 0, 10),
        ("h", START + timedelta(seconds=1), 1_000_000, 10),
        ("h", START + timedelta(seconds=3), 500_000, 5_000),
        ("h", START + timedelta(days=2), 1_000_000_000, 5_000),
        ("g", START, 7, 7),
    ]
    df = spark.createDataFrame(samples, "host string, ts timestamp, rx long, sectors long")
    got = metrics.counter_rates(df, ["host"], "ts", ["rx"], ["sectors"])
    assert rows(got, "host", "rx_mbps", "sectors_mbps") == [
        ("g", 0.0, 0.0),
        ("h", 0.0, 0.0),
        ("h", 0.0, 10.22),
        ("h", 0.05, 0.0),
        ("h", 8.0, 0.0),
    ]
    fixed = metrics.counter_rates(df, ["host"], "ts", ["rx"], interval_seconds=2)
    assert rows(fixed.where("rx = 1000000"), "rx_mbps") == [(4.0,)]
    none = metrics.counter_rates(df, ["host"], "ts", ["rx"], interval_seconds=0)
    assert rows(none.select("rx_mbps").distinct()) == [(0.0,)]


def test_previous_samples_shuffle_the_samples_once(spark):
    made = spark.range(400).selectExpr("if(id % 3 = 0, null, id % 3) as host", "id as ts", "id as c")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = metrics.with_previous(made, ["host"], "ts", ["c"], 50)
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # The samples, their partial last rows, and the few last rows by group and back by range.
    assert plan.count("Exchange hashpartitioning") == 4
    assert out.count() == 400


@pytest.mark.parametrize("chunk_rows", [1, 50, 10**9])
def test_previous_sample_across_chunks_equals_lag(spark, chunk_rows):
    """One host has most of the samples; gaps span several chunks."""
    made = spark.range(600).selectExpr(
        "if(id % 3 = 0, cast(id % 5 as string), 'hot') host",
        "timestamp_seconds(id * id * 37) ts", "id * 11 c",
    )
    got = metrics.with_previous(made, ["host"], "ts", ["c"], chunk_rows)
    plain = made.selectExpr(
        "*", "lag(ts) over (partition by host order by ts) prev_ts", "lag(c) over (partition by host order by ts) prev_c"
    )
    assert rows(got, "host", "ts", "c", "prev_ts", "prev_c") == rows(plain, "host", "ts", "c", "prev_ts", "prev_c")


def test_summary_and_measures(spark):
    df = spark.createDataFrame([("12.5%",), ("3GiB",), ("512MiB",), ("n/a",), (None,)], "t string")
    assert rows(df.select("t", metrics.parse_measure(F.col("t")))) == [
        ("12.5%", 12.5), ("3GiB", 3072.0), ("512MiB", 512.0), ("n/a", None), (None, None),
    ]
    jobs = spark.createDataFrame([(START, 1.5, 10), (START, 2.5, 20)], "ts timestamp, cpu double, heap long")
    assert rows(metrics.metrics_summary(jobs, "ts", ["cpu", "heap"])) == [(START, 2, 4.0, 30)]
    status = spark.createDataFrame([("a", 1, "up"), ("a", 2, "down"), ("b", 1, "up")], "job string, ts int, status string")
    assert rows(fold.latest_status(status, "job", "ts")) == [("a", 2, "down"), ("b", 1, "up")]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return plan(df)


def test_fold_limits_before_the_shuffle(spark):
    text = plan(fold.fold_latest(fixtures.order_changes(spark, DATA), ["o_orderkey"]))
    before_shuffle = text.split("Exchange hashpartitioning", 1)[1]
    assert "row_number(), 1, Partial" in before_shuffle
    assert text.count("Exchange hashpartitioning") == 1


def test_merge_plan(spark):
    base, log = fixtures.order_state(spark, DATA), fixtures.order_changes(spark, DATA)
    small = plan(merge.merge_changes(base, log, ["o_orderkey"]))
    assert "BroadcastHashJoin" in small and "BuildRight" in small
    assert "PushedFilters: [IsNotNull(o_orderdate), LessThan(o_orderdate" in small
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = merge.merge_changes(base, log, ["o_orderkey"])
        text = plan(large)
        assert "Broadcast" not in text and "CartesianProduct" not in text and "LeftAnti" in text
        # The two uses of the folded batch share one shuffle.
        large.collect()
        assert "ReusedExchange" in plan(large)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_key_check_is_partial_first(spark):
    text = plan(checks.check_keys(fixtures.load(spark, DATA, "lineitem"), ["l_orderkey", "l_linenumber"]))
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>" in text
    assert "partial_count" in text.rsplit("Exchange hashpartitioning", 1)[1]
