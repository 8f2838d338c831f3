"""Catalog, import, stored state and layout."""

import os

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import layout
from tidemark.sources import catalog, ingest, state
from tidemark.sources.state import StateTable

CHANGE = "k int, v string, _op string, _txn_id string, _total_order bigint, _collection_order bigint"


def changes(spark, *items):
    return spark.createDataFrame([(k, v, op, f"t{o}", o, o) for k, v, op, o in items], CHANGE)


def test_catalog_lists_and_requires():
    assert catalog.list_tables("hybench") == [
        "customer", "company", "savingaccount", "checkingaccount", "transfer", "checking", "loanapps", "loantrans",
    ]
    assert len(catalog.list_tables("CHBenchmark")) == 12
    history = catalog.require("chbenchmark", "HISTORY")
    assert history.keys == ("h_c_id", "h_c_d_id", "h_c_w_id", "h_d_id", "h_w_id", "h_date")
    assert history.delimiter == "|" and history.precombine == "freshness_ts"
    assert catalog.require("hybench", "transfer").schema["id"].dataType == T.LongType()
    for bad in (("tpcx", "customer"), ("hybench", "warehouse")):
        with pytest.raises(ValueError):
            catalog.require(*bad)


def test_precombine_choice():
    def pick(columns):
        return catalog.table_def("t", "", ",", "id", "", columns).precombine

    assert pick("id:int,ts:timestamp,freshness_ts:timestamp") == "freshness_ts"
    assert pick("id:int,ts:timestamp,last_update_timestamp:timestamp") == "last_update_timestamp"
    assert pick("id:int,TS:timestamp") == "TS"
    assert pick("a:int,id:int") == "id"


def test_parse_schema():
    parsed = catalog.parse_schema("a:int, b : varchar(20), m:decimal(15,2), t:timestamp(3), r:real, n:smallint")
    assert [f.dataType.simpleString() for f in parsed.fields] == [
        "int", "string", "decimal(15,2)", "timestamp", "float", "smallint",
    ]
    assert all(f.nullable for f in parsed.fields)
    for bad in ("", "a", "a:", "a:blob", "a:int,A:int"):
        with pytest.raises(ValueError):
            catalog.parse_schema(bad)


def test_target_and_validation():
    source = catalog.parse_schema("k:int,v:string,_op:string,_total_order:long,_bucket:int")
    assert catalog.target_schema(source).names == ["k", "v", "_bucket"]
    soft = catalog.target_schema(source, True, ["_total_order"])
    assert soft.names == ["k", "v", "_total_order", "_is_deleted", "_deleted_at", "_bucket"]
    have = catalog.parse_schema("K:int,v:string,extra:int")
    catalog.validate_schema(have, catalog.parse_schema("k:int,V:string"))
    with pytest.raises(ValueError, match="lacks"):
        catalog.validate_schema(have, catalog.parse_schema("k:int,w:string"))
    with pytest.raises(ValueError, match="expected bigint"):
        catalog.validate_schema(have, catalog.parse_schema("k:long"))


def test_catalog_table_evolves(spark, folder):
    schema = catalog.parse_schema("k:int,v:string,_bucket:int")
    with pytest.raises(ValueError, match="auto_create"):
        catalog.ensure_table(spark, "evolving", folder + "/t", schema, auto_create=False)
    catalog.ensure_table(spark, "evolving", folder + "/t", schema)
    catalog.ensure_table(spark, "evolving", folder + "/t", schema)
    spark.sql("insert into evolving values (1, 'a', 0)")
    assert catalog.evolve_schema(spark, "evolving", catalog.parse_schema("k:int,w:double")) == ["w"]
    assert catalog.evolve_schema(spark, "evolving", catalog.parse_schema("k:int,w:double")) == []
    assert rows(spark.table("evolving"), "k", "v", "w") == [(1, "a", None)]
    assert "w" in [r.name for r in catalog.describe_tables(spark, ["evolving"]).collect()]
    spark.sql("drop table evolving")


def write_text(folder, name, lines):
    path = os.path.join(folder, name)
    with open(path, "w") as out:
        out.write("\n".join(lines) + "\n")
    return path


ACCOUNT = catalog.require("hybench", "savingaccount")
LINES = [
    "1,10,1.5,0,2024-01-01 00:00:00,2024-01-01 00:00:01",
    "2,20,2.5,,2024-01-01 00:00:00,2024-01-01 00:00:01",
]


def test_csv_scan(spark, folder):
    path = write_text(folder, "savingAccount.csv", LINES)
    got = ingest.scan_csv(spark, path, ACCOUNT)
    assert got.schema == ACCOUNT.schema
    assert rows(got, "accountID", "balance", "Isblocked") == [(1, 1.5, 0), (2, 2.5, None)]
    assert rows(ingest.scan_csv(spark, path, ACCOUNT, raw=True)) == rows(got)
    bad = write_text(folder, "bad.csv", ["x,10,1.5,0,2024-01-01 00:00:00,2024-01-01 00:00:01"])
    for raw in (False, True):
        with pytest.raises(Exception, match="(?i)malformed|cast"):
            ingest.scan_csv(spark, bad, ACCOUNT, raw=raw).collect()


def test_import_modes(spark, folder):
    path = write_text(folder, "savingAccount.csv", LINES)
    target = StateTable(f"{folder}/account", ACCOUNT.keys, 4)
    ingest.import_table(spark, path, ACCOUNT, target)
    newer = write_text(
        folder, "second.csv",
        [
            "1,11,9.5,0,2024-01-02 00:00:00,2024-01-02 00:00:01",
            "2,21,9.5,0,2023-01-02 00:00:00,2023-01-02 00:00:01",
            "3,30,3.5,0,2024-01-02 00:00:00,2024-01-02 00:00:01",
        ],
    )
    ingest.import_table(spark, newer, ACCOUNT, target, mode="skip")
    assert state.read_state(spark, target).count() == 2
    ingest.import_table(spark, newer, ACCOUNT, target, mode="upsert")
    assert rows(state.read_state(spark, target), "accountID", "userID") == [(1, 11), (2, 20), (3, 30)]
    ingest.import_table(spark, newer, ACCOUNT, target, mode="append")
    assert state.read_state(spark, target).count() == 6
    with pytest.raises(ValueError, match="mode"):
        ingest.import_table(spark, newer, ACCOUNT, target, mode="merge")


def test_import_all(spark, folder):
    write_text(folder, "savingAccount.csv", LINES)
    done = ingest.import_all(spark, "hybench", folder, folder + "/lake", ["SavingAccount"], buckets=2)
    assert list(done) == ["savingaccount"]
    assert state.read_state(spark, done["savingaccount"]).count() == 2


def test_max_records_per_file(spark, folder):
    path = write_text(folder, "a.csv", [f"{n},1,1.0,0,2024-01-01 00:00:00,2024-01-01 00:00:00" for n in range(40)])
    target = StateTable(f"{folder}/t", ACCOUNT.keys, 1)
    ingest.import_table(spark, path, ACCOUNT, target, max_records_per_file=10)
    assert layout.layout_stats(spark, target.base_path).agg(F.max("row_count")).first()[0] == 10


def small(spark, folder, name="t", **options):
    start = spark.createDataFrame([(k, f"s{k}") for k in range(20)], "k int, v string")
    return state.create_state(spark, start, StateTable(f"{folder}/{name}", ("k",), 4, **options))


def test_copy_on_write_touches_only_its_buckets(spark, folder):
    table = small(spark, folder)
    before = {r.file_path: r.row_count for r in layout.layout_stats(spark, table.base_path).collect()}
    touched = state.write_state(spark, table, changes(spark, (3, "new", "UPDATE", 1)))
    assert len(touched) == 1
    after = {r.file_path for r in layout.layout_stats(spark, table.base_path).collect()}
    kept = {f for f in before if f"_bucket={touched[0]}/" not in f}
    assert kept == {f for f in after if f"_bucket={touched[0]}/" not in f}
    assert (3, "new") in rows(state.read_state(spark, table), "k", "v")
    assert state.write_state(spark, table, changes(spark).limit(0)) == []


def test_broadcast_limit(spark):
    for text, size in (("10485760b", 10 * 2**20), ("10MB", 10 * 2**20), ("1g", 2**30), ("512", 512), ("-1", -1)):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", text)
        assert state.broadcast_limit(spark) == size
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_small_batch_does_not_move_the_state(spark, folder):
    table = small(spark, folder)
    batch = state.fold_latest(table.bucketed(changes(spark, (3, "new", "UPDATE", 1))), ["k"])
    parts = state.upsert_parts(state.read_state(spark, table, "base"), batch, ["k"], small=True)
    plan = parts.kept._jdf.queryExecution().executedPlan().toString()
    state_side = plan.split("BroadcastExchange")[0]
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in state_side


def test_emptied_bucket_is_cleared(spark, folder):
    table = small(spark, folder)
    base = state.read_state(spark, table, "base")
    bucket = base.first()["_bucket"]
    gone = [r.k for r in base.where(F.col("_bucket") == bucket).collect()]
    state.write_state(spark, table, changes(spark, *[(k, "x", "DELETE", 1) for k in gone]))
    left = state.read_state(spark, table, "base")
    assert left.count() == 20 - len(gone) and left.where(F.col("_bucket") == bucket).isEmpty()
    state.write_state(spark, table, changes(spark, (gone[0], "back", "INSERT", 2)))
    assert state.read_state(spark, table).count() == 21 - len(gone)


def test_copy_on_write_replay_changes_nothing(spark, folder):
    table = small(spark, folder)
    batch = changes(spark, (1, "a", "UPDATE", 1), (2, "b", "DELETE", 1), (77, "n", "INSERT", 1))
    state.write_state(spark, table, batch)
    once = rows(state.read_state(spark, table))
    state.write_state(spark, table, batch)
    assert rows(state.read_state(spark, table)) == once


def test_log_views(spark, folder):
    table = small(spark, folder)
    state.append_changes(spark, table, changes(spark, (1, "one", "UPDATE", 1)), 0)
    state.append_changes(spark, table, changes(spark, (1, "two", "UPDATE", 2)), 1)
    state.append_changes(spark, table, changes(spark, (1, "two", "UPDATE", 2)), 1)
    assert state.read_log(spark, table).count() == 2

    def value(**how):
        return state.read_state(spark, table, **how).where("k = 1").first()["v"]

    assert (value(), value(as_of=0), value(view="base")) == ("two", "one", "s1")
    assert state.fold_log(spark, table, upto=0) == 0
    assert (value(), value(view="base"), value(as_of=0)) == ("two", "one", "one")
    assert state.fold_log(spark, table) == 1 == state.fold_log(spark, table)
    assert value(view="base") == "two"
    with pytest.raises(ValueError, match="already folded"):
        value(as_of=0)


def test_folded_base_ignores_late_changes(spark, folder):
    table = StateTable(f"{folder}/g", ("k",), 4, delete_mode="soft", guard_col="_total_order")
    first = changes(spark, (1, "a", "INSERT", 5), (2, "b", "DELETE", 5))
    state.ensure_state(spark, table, first)
    state.append_changes(spark, table, first, 0)
    state.fold_log(spark, table)
    state.append_changes(spark, table, changes(spark, (1, "late", "UPDATE", 3), (2, "late", "INSERT", 3)), 1)
    assert rows(state.read_state(spark, table), "k", "v", "_is_deleted") == [(1, "a", False), (2, "b", True)]


def test_state_schema_evolves(spark, folder):
    table = small(spark, folder)
    wider = changes(spark, (1, "a", "UPDATE", 1)).withColumn("extra", F.lit(7))
    with pytest.raises(ValueError, match="lacks"):
        state.ensure_state(spark, table, wider, evolve=False)
    assert state.ensure_state(spark, table, wider) == ["extra"]
    state.write_state(spark, table, wider)
    got = dict(rows(state.read_state(spark, table), "k", "extra"))
    assert got[1] == 7 and got[2] is None and len(got) == 20
    with pytest.raises(ValueError, match="expected string"):
        state.ensure_state(spark, table, wider.withColumn("extra", F.lit("text")))
    with pytest.raises(ValueError, match="auto_create"):
        state.ensure_state(spark, StateTable(f"{folder}/none", ("k",)), wider, auto_create=False)


def test_evolved_columns_survive_log_and_layout(spark, folder):
    table = small(spark, folder)
    state.append_changes(spark, table, changes(spark, (1, "plain", "UPDATE", 1)), 0)
    wider = changes(spark, (2, "wide", "UPDATE", 1)).withColumn("extra", F.lit(7))
    state.ensure_state(spark, table, wider)
    state.append_changes(spark, table, wider, 1)
    want = [(1, "plain", None), (2, "wide", 7)]
    picked = F.col("k").isin(1, 2)
    assert rows(state.read_state(spark, table).where(picked), "k", "v", "extra") == want
    state.fold_log(spark, table)
    state.compact_state(spark, table)
    state.zorder_state(spark, table, "k,extra")
    assert rows(state.read_state(spark, table, "base").where(picked), "k", "v", "extra") == want
    layout.compact(spark, table.base_path)
    assert rows(state.read_state(spark, table, "base").where(picked), "k", "v", "extra") == want


def test_bucket_choice_prunes_partitions(spark, folder):
    table = small(spark, folder)
    plan = state.read_state(spark, table, buckets="1-2")._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert filters.startswith("_bucket") and "IN (1,2)" in filters


def test_compaction_and_zorder_keep_rows(spark, folder):
    made = spark.range(4000).selectExpr(
        "id as k", "id % 61 as a", "cast(id % 7 as string) as s", "timestamp_seconds(id) as t",
        "if(id % 50 = 0, null, id * 0.5D) as d",
    )
    table = state.create_state(spark, made.repartition(7), StateTable(f"{folder}/z", ("k",), 2))
    for _ in range(3):
        made.limit(0).withColumn("_bucket", F.lit(0)).write.mode("append").partitionBy("_bucket").parquet(table.base_path)
    want = rows(made)
    layout.compact(spark, table.base_path)
    assert rows(state.read_state(spark, table).drop("_bucket")) == want
    assert layout.layout_stats(spark, table.base_path).count() == 2
    layout.zorder(spark, table.base_path, "a, s, t, d", files=16)
    assert rows(state.read_state(spark, table).drop("_bucket")) == want
    layout.zorder(spark, table.base_path, ["a"], buckets=[0], compact_first=True)
    assert rows(state.read_state(spark, table).drop("_bucket")) == want


def test_zorder_narrows_the_files(spark, folder):
    made = spark.range(20_000).selectExpr("id as k", "pmod(xxhash64(id), 1000) as a", "pmod(xxhash64(id, 1), 1000) as b")
    table = state.create_state(spark, made, StateTable(f"{folder}/n", ("k",), 1))
    layout.zorder(spark, table.base_path, "a,b", files=16)
    files = layout.layout_stats(spark, table.base_path, ["a", "b"])
    assert files.count() == 16
    widths = files.agg(F.avg(F.col("max_a") - F.col("min_a")), F.avg(F.col("max_b") - F.col("min_b"))).first()
    assert max(widths) < 500


def test_zorder_splits_one_hot_value(spark, folder):
    made = spark.range(8000).selectExpr("id as k", "1 as a")
    table = state.create_state(spark, made, StateTable(f"{folder}/h", ("k",), 1))
    layout.zorder(spark, table.base_path, "a", files=8)
    assert layout.layout_stats(spark, table.base_path).agg(F.max("row_count")).first()[0] < 2500


def test_zorder_columns(spark):
    made = spark.range(3).selectExpr("id as a", "id as `b c`")
    assert layout.cluster_columns(made, " A, b c ,") == ["a", "b c"]
    for bad in ("", "a;b", "z", ["a", "z"]):
        with pytest.raises(ValueError):
            layout.cluster_columns(made, bad)
    with pytest.raises(ValueError):
        layout.with_zvalue(made, "a,b c", bits=32)


def test_text_is_ranked_by_its_whole_value(spark):
    made = spark.range(2000).selectExpr("format_string('Customer#%09d', id) as s", "id")
    made = made.unionByName(spark.sql("select cast(null as string) s, -1L id"))
    ranked = layout.with_zvalue(made, ["s"]).orderBy("id").select("__z").collect()
    z = [r[0] for r in ranked]
    assert z == sorted(z) and len(set(z)) > 200 and z[0] == 0
    assert layout.with_zvalue(made.where("id < 0"), ["s"]).select("__z").first()[0] == 0


def test_rank_bits_follow_the_number_of_files():
    assert layout.rank_bits(1, 3) == 8 and layout.rank_bits(1 << 20, 2) == 13
    with pytest.raises(ValueError):
        layout.rank_bits(1, 8)


def test_compaction_takes_only_buckets_with_small_files(spark, folder):
    made = spark.range(100).selectExpr("id as k")
    table = state.create_state(spark, made, StateTable(f"{folder}/c", ("k",), 4))
    more = table.bucketed(spark.range(100, 140).selectExpr("id as k")).where("_bucket = 1").coalesce(1)
    more.write.mode("append").partitionBy("_bucket").parquet(table.base_path)
    first, again = state.compact_state(spark, table).first(), state.compact_state(spark, table).first()
    assert (first.rewritten_buckets, first.files_before - first.files_after) == (1, 1)
    assert (again.rewritten_buckets, again.bytes_after) == (0, again.bytes_before)
    assert state.read_state(spark, table, "base").count() == 100 + more.count()
    with pytest.raises(ValueError, match="cluster"):
        state.zorder_state(spark, table)


def test_a_table_is_opened_with_its_own_settings(spark, folder):
    made = spark.range(50).selectExpr("cast(id as int) as k", "'v' as v")
    table = state.create_state(spark, made, StateTable(f"{folder}/t", ("k",), 4, "md5"))
    batch = changes(spark, (1, "new", "UPDATE", 1))
    for other in (
        StateTable(table.path, ("k",), 4), StateTable(table.path, ("k",), 8, "md5"),
        StateTable(table.path, ("v",), 4, "md5"), StateTable(table.path, ("k",), 4, "md5", "soft"),
    ):
        with pytest.raises(ValueError, match="the table at"):
            state.write_state(spark, other, batch)
        with pytest.raises(ValueError, match="the table at"):
            state.ensure_state(spark, other, batch)
    state.write_state(spark, table, batch)
    assert state.read_state(spark, table).count() == 50
    assert not any(f.metadata for f in state.read_state(spark, table).schema.fields)


def test_the_log_is_pruned_by_bucket_and_expires_after_a_fold(spark, folder):
    made = spark.range(200).selectExpr("cast(id as int) as k", "'v' as v")
    table = state.create_state(spark, made, StateTable(f"{folder}/t", ("k",), 4))
    state.append_changes(spark, table, changes(spark, (1, "a", "UPDATE", 1)), 0)
    state.append_changes(spark, table, changes(spark, (1, "b", "UPDATE", 2), (2, "c", "DELETE", 2)), 1)
    one = state.read_log(spark, table).where("_bucket = 3")
    assert "_bucket" in one._jdf.queryExecution().toString().split("PartitionFilters: [")[1].split("]")[0]
    snapshot = rows(state.read_state(spark, table).drop("_bucket"))
    assert len(snapshot) == 199 and (1, "b") in snapshot
    assert rows(state.read_state(spark, table, as_of=0).where("k < 3").drop("_bucket")) == [(0, "v"), (1, "a"), (2, "v")]
    assert state.fold_log(spark, table, upto=0) == 0
    assert state.expire_log(spark, table) == [0] and state.logged_batches(spark, table) == [1]
    assert rows(state.read_state(spark, table).drop("_bucket")) == snapshot
    assert state.fold_log(spark, table) == 1 and state.expire_log(spark, table) == [1]
    assert state.expire_log(spark, table) == [] and state.next_batch_id(spark, table) == 2
    assert rows(state.read_state(spark, table).drop("_bucket")) == snapshot


def test_append_import_keeps_an_evolved_schema_and_flags(spark, folder):
    from tidemark.sources.catalog import TableDef, parse_schema
    from tidemark.sources.ingest import import_table

    source = TableDef("t", parse_schema("k:int,v:string"), ("k",))
    with open(f"{folder}/t.csv", "w") as file:
        file.write("1,a\n2,b\n")
    with open(f"{folder}/more.csv", "w") as file:
        file.write("3,c\n")
    table = StateTable(f"{folder}/s", ("k",), 4, delete_mode="soft")
    import_table(spark, f"{folder}/t.csv", source, table)
    wider = spark.createDataFrame([(9, "z", "new", "INSERT", "t", 1, 1)],
                                  "k int, v string, w string, _op string, _txn_id string, _total_order long, _collection_order long")
    state.ensure_state(spark, table, wider)
    state.write_state(spark, table, wider)
    import_table(spark, f"{folder}/more.csv", source, table, "append")
    got = rows(state.read_state(spark, table, "base"), "k", "v", "w", "_is_deleted")
    assert got == [(1, "a", None, False), (2, "b", None, False), (3, "c", None, False), (9, "z", "new", False)]


def test_hot_bucket_is_split_on_write(spark, folder):
    """A third and more of the rows share a key; their bucket must not end in one task."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        made = spark.range(0, 60_000, 1, 8).selectExpr(
            "if(id % 2 = 0, 0, id) as k", "sha2(cast(id as string), 256) as v"
        )
        table = state.create_state(spark, made, StateTable(f"{folder}/hot", ("k",), 4))
        files = layout.layout_stats(spark, table.base_path)
        largest = files.groupBy("_bucket").agg(F.sum("row_count").alias("n"), F.max("row_count").alias("m"))
        hot = largest.orderBy(F.desc("n")).first()
        assert hot.n > 30_000 and hot.m < hot.n / 4
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


class Conf(dict):
    """Stand-in for a session's settings; the real ones are fixed once the session runs."""

    @property
    def conf(self):
        return self


def test_scratch_folder(spark):
    from tidemark.session import scratch_dir

    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")
    shared = Conf({"spark.checkpoint.dir": "/shared/place/", "spark.master": "yarn"})
    assert scratch_dir(shared, "x").startswith("/shared/place/tidemark/x-")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(Conf({"spark.master": "yarn"}), "x")
