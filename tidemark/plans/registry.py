"""The checked queries: each operator on the driver's tables, next to the same result in plain SQL.

Queries that store something write below the session's shared scratch folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.buckets import (
    register_bucket_function,
    select_buckets,
    with_bucket,
)
from tidemark.functions.keybytes import key_bytes
from tidemark.functions.zorder import interleave
from tidemark.names import BATCH_ID, BUCKET, COLLECTION_ORDER, DELETED_AT, META, OP
from tidemark.operators import checks, decode, fold, layout, merge, metrics
from tidemark.plans import fixtures
from tidemark.plans.fixtures import CHANGES_SQL, EVENT_CHANGES_SQL, ORDER_COLUMNS, STATE_SQL, TABLES, load
from tidemark.plans.jobs import accept
from tidemark.plans.options import MergeOptions
from tidemark.session import scratch_dir
from tidemark.sources import bucketed, ingest, state as stored, stats
from tidemark.sources.catalog import TableDef, register_table
from tidemark.sources.changes import read_changes, write_changes
from tidemark.sources.state import StateTable
from tidemark.streaming import run as streams

Query = Callable[[SparkSession, str], DataFrame]

KEY = ["o_orderkey"]
COLS = ", ".join(ORDER_COLUMNS)
BATCH_TIME = "2024-02-01 00:00:00"

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def checked(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``, with the SQL that must give the same rows."""

    def add(query: Query) -> Query:
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = sql
        return query

    return add


# --- SQL fragments ---------------------------------------------------------------------


def ranked(source: str, keys: str, order: str) -> str:
    return (
        f"select * exclude (rn) from (select *, row_number() over (partition by {keys} order by {order}) as rn"
        f" from {source}) as r where rn = 1"
    )


def desc(*columns: str) -> str:
    return ", ".join(f"{c} desc nulls last" for c in columns)


CHANGE_ORDER = desc(
    "_total_order", "_collection_order", "_txn_id",
    "_op", "o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus", "o_totalprice",
)
WITH = f"with s as ({STATE_SQL}), c as ({CHANGES_SQL}), f as materialized ({ranked('c', 'o_orderkey', CHANGE_ORDER)})"
UPSERT_SQL = f"""{WITH}
select {COLS} from s where not exists (select 1 from f where f.o_orderkey = s.o_orderkey)
union all select {COLS} from f where _op <> 'DELETE'"""

MD5_BUCKET = "cast(('0x' || substr(md5({text}), 1, 8))::bigint % 16 as integer)"


def md5_bucket(*keys: str) -> str:
    return MD5_BUCKET.format(text="concat_ws('|', " + ", ".join(f"cast({k} as varchar)" for k in keys) + ")")


def _updated(alias_when: str, columns: tuple[str, ...] = ORDER_COLUMNS) -> str:
    parts = ["s.o_orderkey"]
    parts += [f"case when {alias_when} then f.{c} else s.{c} end as {c}" for c in columns if c != "o_orderkey"]
    return ", ".join(parts)


# --- merge -----------------------------------------------------------------------------


def _state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.order_state(spark, sf_dir)


def _changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.order_changes(spark, sf_dir)


def _folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fold.fold_latest(_changes(spark, sf_dir), KEY)


def _batch_time():
    return F.lit(BATCH_TIME).cast("timestamp")


def _time_as_text(df: DataFrame) -> DataFrame:
    return df.withColumn(DELETED_AT, F.col(DELETED_AT).cast("string"))


@checked("fold_latest", f"{WITH} select * from f")
def _(spark, sf_dir):
    return _folded(spark, sf_dir)


@checked("merge_upsert", UPSERT_SQL)
def merge_upsert(spark, sf_dir):
    return merge.merge_changes(_state(spark, sf_dir), _changes(spark, sf_dir), KEY)


@checked(
    "merge_phased",
    f"""{WITH}
select {_updated("f._op = 'UPDATE'")} from s left join f on s.o_orderkey = f.o_orderkey
where coalesce(f._op, '') <> 'DELETE'
union all select {COLS} from f where _op in ('INSERT', 'SNAPSHOT')""",
)
def _(spark, sf_dir):
    return merge.merge_changes(_state(spark, sf_dir), _changes(spark, sf_dir), KEY, semantics="phased")


@checked(
    "merge_phased_if_absent",
    f"""{WITH}
select {_updated("f._op = 'UPDATE'")} from s left join f on s.o_orderkey = f.o_orderkey
where coalesce(f._op, '') <> 'DELETE'
union all select {COLS} from f
where _op in ('INSERT', 'SNAPSHOT') and o_orderkey not in (select o_orderkey from s)""",
)
def _(spark, sf_dir):
    return merge.merge_changes(
        _state(spark, sf_dir), _changes(spark, sf_dir), KEY, semantics="phased", insert_mode="if_absent"
    )


@checked(
    "merge_insert_append",
    f"{WITH} select {COLS} from s union all select {COLS} from f where _op in ('INSERT', 'SNAPSHOT')",
)
def _(spark, sf_dir):
    inserts = merge.split_ops(_folded(spark, sf_dir)).inserts
    return merge.apply_inserts(_state(spark, sf_dir), inserts, KEY, "append")


@checked(
    "merge_insert_absent",
    f"""{WITH} select {COLS} from s union all select {COLS} from f
where _op in ('INSERT', 'SNAPSHOT') and o_orderkey not in (select o_orderkey from s)""",
)
def _(spark, sf_dir):
    inserts = merge.split_ops(_folded(spark, sf_dir)).inserts
    return merge.apply_inserts(_state(spark, sf_dir), inserts, KEY, "if_absent")


@checked(
    "merge_update",
    f"""{WITH} select {_updated("f.o_orderkey is not null")}
from s left join (select * from f where _op = 'UPDATE') as f on s.o_orderkey = f.o_orderkey""",
)
def _(spark, sf_dir):
    return merge.apply_updates(_state(spark, sf_dir), merge.split_ops(_folded(spark, sf_dir)).updates, KEY)


@checked(
    "merge_hard_delete",
    f"{WITH} select {COLS} from s where o_orderkey not in (select o_orderkey from f where _op = 'DELETE')",
)
def _(spark, sf_dir):
    return merge.apply_deletes(_state(spark, sf_dir), merge.split_ops(_folded(spark, sf_dir)).deletes, KEY)


FLAGS_SQL = "{hit} as _is_deleted, case when {hit} then '" + BATCH_TIME + "' end as _deleted_at"


@checked(
    "merge_soft_delete",
    f"""{WITH} select s.*, {FLAGS_SQL.format(hit='d.o_orderkey is not null')}
from s left join (select o_orderkey from f where _op = 'DELETE') as d on s.o_orderkey = d.o_orderkey""",
)
def _(spark, sf_dir):
    deletes = merge.split_ops(_folded(spark, sf_dir)).deletes
    return _time_as_text(merge.apply_deletes(_state(spark, sf_dir), deletes, KEY, "soft", _batch_time()))


SOFT_UPSERT_SQL = f"""{WITH}
select s.*, {FLAGS_SQL.format(hit="(f._op is not null)")}
from s left join f on s.o_orderkey = f.o_orderkey where f._op is null or f._op = 'DELETE'
union all select {COLS}, false, null from f where _op <> 'DELETE'"""


@checked("merge_soft_upsert", SOFT_UPSERT_SQL)
def _(spark, sf_dir):
    return _time_as_text(
        merge.merge_changes(
            _state(spark, sf_dir), _changes(spark, sf_dir), KEY, delete_mode="soft", deleted_at=_batch_time()
        )
    )


@checked(
    "merge_ignore_delete",
    f"""{WITH}
select {COLS} from s where not exists (select 1 from f where f.o_orderkey = s.o_orderkey and f._op <> 'DELETE')
union all select {COLS} from f where _op <> 'DELETE'""",
)
def _(spark, sf_dir):
    return merge.merge_changes(_state(spark, sf_dir), _changes(spark, sf_dir), KEY, delete_mode="ignore")


@checked(
    "merge_metrics",
    f"""{WITH}
select count(*) as source_rows,
       count(*) filter (where _op <> 'DELETE' and o_orderkey in (select o_orderkey from s)) as updated_rows,
       count(*) filter (where _op = 'DELETE' and o_orderkey in (select o_orderkey from s)) as deleted_rows,
       count(*) filter (where _op <> 'DELETE' and o_orderkey not in (select o_orderkey from s)) as inserted_rows
from f""",
)
def _(spark, sf_dir):
    return merge.merge_metrics(_state(spark, sf_dir), _changes(spark, sf_dir), KEY)


@checked(
    "split_ops_counts",
    f"""with c as ({CHANGES_SQL})
select case _op when 'UPDATE' then 'updates' when 'DELETE' then 'deletes' else 'inserts' end as phase,
       count(*) as row_count from c group by 1""",
)
def _(spark, sf_dir):
    phases = merge.split_ops(_changes(spark, sf_dir))._asdict()
    counts = [
        df.groupBy(F.lit(name).alias("phase")).agg(F.count(F.lit(1)).alias("row_count"))
        for name, df in phases.items()
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@checked("merge_empty_batch", STATE_SQL)
def _(spark, sf_dir):
    """A batch without rows changes nothing."""
    return merge.merge_changes(_state(spark, sf_dir), _changes(spark, sf_dir).where(F.lit(False)), KEY)


@checked("business_columns", f"with c as ({CHANGES_SQL}) select {COLS} from c")
def _(spark, sf_dir):
    return decode.business_columns(_changes(spark, sf_dir))


@checked(
    "route_noop_buckets",
    f"""with c as ({CHANGES_SQL}), b as (select {md5_bucket('o_orderkey')} as _bucket from c)
select _bucket, case when _bucket in (0, 1, 2, 3, 8) then 'noop' else 'merge' end as route,
       count(*) as row_count from b group by 1, 2""",
)
def _(spark, sf_dir):
    merged, skipped = merge.route_buckets(with_bucket(_changes(spark, sf_dir), KEY, 16, "md5"), "0-3,8")
    parts = [
        df.groupBy(BUCKET).agg(F.first(F.lit(name)).alias("route"), F.count(F.lit(1)).alias("row_count"))
        for name, df in (("merge", merged), ("noop", skipped))
    ]
    return parts[0].unionByName(parts[1])


@checked(
    "update_invariants",
    f"""{WITH}, u as (select {_updated("f.o_orderkey is not null")}
from s left join (select * from f where _op = 'UPDATE') as f on s.o_orderkey = f.o_orderkey)
select 'before' as table_name, count(*) as row_count, count(distinct o_orderkey) as distinct_o_orderkey from s
union all select 'after', count(*), count(distinct o_orderkey) from u""",
)
def _(spark, sf_dir):
    before = _state(spark, sf_dir)
    after = merge.apply_updates(before, merge.split_ops(_folded(spark, sf_dir)).updates, KEY)
    return checks.table_stats({"before": before, "after": after}, ["o_orderkey"])


LINE_REST = (
    "l_discount", "l_extendedprice", "l_linestatus", "l_partkey", "l_quantity", "l_returnflag", "l_shipdate",
    "l_suppkey", "l_tax",
)


@checked(
    "one_per_key",
    ranked(
        "lineitem",
        "l_orderkey, l_linenumber",
        ", ".join(f"{c} asc nulls last" for c in ("l_shipdate", "l_partkey", *[
            c for c in LINE_REST if c not in ("l_shipdate", "l_partkey")
        ])),
    ),
)
def _(spark, sf_dir):
    return fold.one_per_key(load(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey"])


def _scope_sql(keys: str) -> str:
    rest = [c for c in sorted((*LINE_REST, "l_linenumber")) if c != "l_shipdate" and c not in keys]
    order = desc("l_shipdate", *rest)
    first = keys.split(", ")
    same = " and ".join(f"a.{k} = b.{k}" for k in first)
    return f"""with a as ({ranked("(select * from lineitem where l_linestatus = 'O')", keys, order)}),
b as ({ranked("(select * from lineitem where l_linestatus = 'F')", keys, order)})
select a.* from a left join b on {same} where b.l_orderkey is null or a.l_shipdate > b.l_shipdate
union all select b.* from b left join a on {same} where a.l_orderkey is null or b.l_shipdate >= a.l_shipdate"""


def _scoped(spark, sf_dir, scope: str) -> DataFrame:
    lines = load(spark, sf_dir, "lineitem")
    parts = ["l_returnflag"] if scope == "partition" else []
    keys = [*parts, "l_orderkey"]
    first = fold.fold_latest(lines.where(F.col("l_linestatus") == "O"), keys, ["l_shipdate"])
    second = lines.where(F.col("l_linestatus") == "F")
    return merge.upsert_ordered(first, second, ["l_orderkey"], "l_shipdate", scope, parts)


@checked("key_scope_global", _scope_sql("l_orderkey"))
def _(spark, sf_dir):
    return _scoped(spark, sf_dir, "global")


@checked("key_scope_partition", _scope_sql("l_returnflag, l_orderkey"))
def _(spark, sf_dir):
    return _scoped(spark, sf_dir, "partition")


EVENT_COLS = "event_id, ts, user_id, event_type, value, props"


@checked("upsert_precombine", ranked("events", "user_id", desc("ts")))
def _(spark, sf_dir):
    events = load(spark, sf_dir, "events")
    early = F.col("event_type").isin("click", "view")
    first = fold.fold_latest(events.where(early), ["user_id"], ["ts"])
    return merge.upsert_ordered(first, events.where(~early), ["user_id"], "ts")


@checked(
    "late_change_ignored",
    f"""with c as ({EVENT_CHANGES_SQL}),
a as ({ranked("(select * from c where event_type in ('click', 'purchase', 'signup'))", "user_id", desc("ts", "event_id"))}),
b as ({ranked("(select * from c where event_type in ('error', 'view'))", "user_id", desc("ts", "event_id"))}),
j as (select a.user_id as ak, b.user_id as bk, coalesce(a.user_id, b.user_id) as user_id, a.ts as ats, b.ts as bts,
             a.event_id as ae, a.event_type as atype, a.value as av, b.event_id as be, b.event_type as btype,
             b.value as bv, b._op as bop, b.user_id is not null and (a.user_id is null or b.ts >= a.ts) as won
      from a full join b on a.user_id = b.user_id)
select user_id,
       case when won and (bop <> 'DELETE' or ak is null) then be else ae end as event_id,
       case when won and (bop <> 'DELETE' or ak is null) then btype else atype end as event_type,
       case when won and (bop <> 'DELETE' or ak is null) then bv else av end as value,
       case when won then bts else ats end as ts,
       won and bop = 'DELETE' as _is_deleted,
       case when won and bop = 'DELETE' then '{BATCH_TIME}' end as _deleted_at
from j""",
)
def _(spark, sf_dir):
    changes = fixtures.event_changes(spark, sf_dir)
    late = F.col("event_type").isin("error", "view")
    how = {
        "delete_mode": "soft",
        "guard_col": "ts",
        "order_by": ["ts", "event_id"],
        "deleted_at": _batch_time(),
    }
    empty = changes.drop(*META).limit(0)
    state = merge.merge_changes(empty, changes.where(~late), ["user_id"], **how)
    return _time_as_text(merge.merge_changes(state, changes.where(late), ["user_id"], **how))


# --- decode and buckets ----------------------------------------------------------------


def _records(spark, sf_dir) -> DataFrame:
    """Change rows as records; some lack the image their operation asks for."""
    c = _changes(spark, sf_dir)
    old = [F.lit("B").alias(n) if n == "o_orderstatus" else F.col(n) for n in ORDER_COLUMNS]
    return c.select(
        F.col(OP).alias("op"),
        F.when(F.col(OP).isin("UPDATE", "DELETE"), F.struct(*old)).alias("before"),
        F.when((F.col(OP) != "DELETE") & (F.col("o_orderstatus") != "F"), F.struct(*ORDER_COLUMNS)).alias("after"),
        F.when(
            F.col("_total_order").isNotNull(),
            F.struct(
                F.col("_txn_id").alias("id"),
                F.col("_total_order").alias("total_order"),
                F.col("_collection_order").alias("collection_order"),
            ),
        ).alias("txn"),
    )


IMAGE_SQL = f"""with c as ({CHANGES_SQL}),
i as (select o_orderkey, o_custkey,
             case when _op = 'DELETE' or (_op = 'UPDATE' and o_orderstatus = 'F') then 'B' else o_orderstatus end
               as o_orderstatus,
             o_totalprice, o_orderdate, o_orderpriority, _op,
             case when _total_order is not null then _txn_id end as _txn_id, _total_order,
             case when _total_order is not null then _collection_order end as _collection_order
      from c where _op in ('UPDATE', 'DELETE') or o_orderstatus <> 'F')"""


@checked(
    "image_select",
    f"{IMAGE_SQL} select _op as op, o_orderstatus, count(*) as row_count from i group by 1, 2",
)
def _(spark, sf_dir):
    chosen = decode.select_image(_records(spark, sf_dir))
    return chosen.groupBy("op", F.col("image.o_orderstatus").alias("o_orderstatus")).agg(
        F.count(F.lit(1)).alias("row_count")
    )


@checked("flatten_changes", f"{IMAGE_SQL} select *, {md5_bucket('o_orderkey')} as _bucket from i")
def _(spark, sf_dir):
    return decode.flatten_changes(_records(spark, sf_dir), KEY, 16, "md5")


@checked("wire_roundtrip", "select *, 'SNAPSHOT' as _op from lineitem")
def _(spark, sf_dir):
    lines = load(spark, sf_dir, "lineitem")
    records = decode.encode_image(lines, lines.schema, "after").select(
        F.lit("SNAPSHOT").alias("op"),
        F.lit(None).cast("array<binary>").alias("before"),
        "after",
        F.lit(None).cast("struct<id:string,total_order:bigint,collection_order:bigint>").alias("txn"),
    )
    return decode.decode_changes(records, lines.schema).drop("_txn_id", "_total_order", "_collection_order")


@checked(
    "key_bytes_hex",
    """select l_orderkey, l_linenumber, l_returnflag,
       upper(printf('%016x', l_orderkey)) || upper(printf('%08x', l_linenumber)) || hex(l_returnflag) as key_hex
from lineitem""",
)
def _(spark, sf_dir):
    keys = ["l_orderkey", "l_linenumber", "l_returnflag"]
    lines = load(spark, sf_dir, "lineitem")
    return lines.select(*keys, F.hex(key_bytes(lines, keys)).alias("key_hex"))


@checked(
    "bucket_md5",
    f"select l_orderkey, l_linenumber, {md5_bucket('l_orderkey', 'l_linenumber')} as _bucket from lineitem",
)
def _(spark, sf_dir):
    lines = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return with_bucket(lines, ["l_orderkey", "l_linenumber"], 16, "md5")


@checked("bucket_sql_function", f"select o_orderkey, {md5_bucket('o_orderkey')} as bucket from orders")
def _(spark, sf_dir):
    register_bucket_function(spark, "tidemark_bucket", {"o_orderkey": "bigint"}, 16, "md5")
    return spark.sql(
        "select o_orderkey, tidemark_bucket(o_orderkey) as bucket from {orders}",
        orders=load(spark, sf_dir, "orders"),
    )


@checked(
    "bucket_invariants",
    """select fn as bucket_fn, cast(n as bigint) as total_rows, cast(0 as bigint) as out_of_range,
       cast(0 as bigint) as keys_in_many_buckets
from (select unnest(['xxhash64', 'murmur3', 'md5', 'spark_hash', 'key_bytes']) as fn) as fns,
     (select count(*) as n from lineitem) as counted""",
)
def _(spark, sf_dir):
    lines = load(spark, sf_dir, "lineitem")
    keys = ["l_orderkey", "l_linenumber"]
    parts = None
    for fn in ("xxhash64", "murmur3", "md5", "spark_hash", "key_bytes"):
        per_key = (
            with_bucket(lines, keys, 16, fn)
            .groupBy(*keys)
            .agg(
                F.count(F.lit(1)).alias("n"),
                F.count(F.when(~F.col(BUCKET).between(0, 15), 1)).alias("bad"),
                (F.min(BUCKET) != F.max(BUCKET)).alias("many"),
            )
        )
        part = per_key.agg(
            F.first(F.lit(fn)).alias("bucket_fn"),
            F.sum("n").alias("total_rows"),
            F.sum("bad").alias("out_of_range"),
            F.count(F.when(F.col("many"), 1)).alias("keys_in_many_buckets"),
        )
        parts = part if parts is None else parts.unionByName(part)
    return parts


@checked(
    "bucket_stats",
    f"""with b as (select {md5_bucket('o_orderkey')} as _bucket, count(*) as row_count from orders group by 1)
select _bucket, row_count, round(row_count / (select avg(row_count) from b), 4) as skew from b""",
)
def _(spark, sf_dir):
    return checks.bucket_stats(with_bucket(load(spark, sf_dir, "orders"), KEY, 16, "md5"))


@checked(
    "bucket_heavy_keys",
    f"""with b as (select l_suppkey, {md5_bucket('l_suppkey')} as _bucket, count(*) as row_count from lineitem group by 1, 2),
s as (select *, row_count / cast(sum(row_count) over (partition by _bucket) as bigint) as share from b)
select * from s where share >= 0.15""",
)
def _(spark, sf_dir):
    """Suppliers that hold much of their bucket, from sketches that were made per line number."""
    rows = with_bucket(load(spark, sf_dir, "lineitem"), ["l_suppkey"], 16, "md5")
    sketches = checks.key_sketches(rows, ["l_suppkey"], [BUCKET, "l_linenumber"], 0.15)
    return checks.heavy_keys(rows, ["l_suppkey"], 0.15, sketches=sketches)


@checked(
    "touched_buckets", f"with c as ({CHANGES_SQL}) select distinct {md5_bucket('o_orderkey')} as _bucket from c"
)
def _(spark, sf_dir):
    return checks.touched_buckets(with_bucket(_changes(spark, sf_dir), KEY, 16, "md5"))


@checked(
    "bucket_prune",
    f"""select * from (select *, {md5_bucket('o_orderkey')} as _bucket from orders) as b
where _bucket in (0, 1, 2, 3, 8)""",
)
def _(spark, sf_dir):
    table = _new_table(spark, "prune")
    stored.create_state(spark, load(spark, sf_dir, "orders"), table)
    return select_buckets(stored.read_state(spark, table, "base"), "0-3,8")


# --- import ----------------------------------------------------------------------------


def _new_table(spark, label: str, keys=("o_orderkey",), **options) -> StateTable:
    return StateTable(scratch_dir(spark, label), tuple(keys), 16, "md5", **options)


def _as_csv(spark, rows: DataFrame, delimiter: str = ",") -> str:
    path = scratch_dir(spark, "csv")
    rows.write.option("delimiter", delimiter).csv(path)
    return path


def _def(rows: DataFrame, keys: tuple[str, ...], delimiter: str = ",") -> TableDef:
    return TableDef("loaded", rows.schema, keys, "", delimiter)


@checked("csv_import", "select * from customer")
def _(spark, sf_dir):
    rows = load(spark, sf_dir, "customer")
    return ingest.scan_csv(spark, _as_csv(spark, rows), _def(rows, ("c_custkey",)))


@checked("csv_raw_cast", "select * from orders")
def _(spark, sf_dir):
    rows = load(spark, sf_dir, "orders")
    return ingest.scan_csv(spark, _as_csv(spark, rows, "|"), _def(rows, ("o_orderkey",), "|"), raw=True)


@checked("import_bucketed", f"select *, {md5_bucket('o_orderkey')} as _bucket from orders")
def _(spark, sf_dir):
    rows = load(spark, sf_dir, "orders")
    table = _new_table(spark, "import")
    ingest.import_table(spark, _as_csv(spark, rows), _def(rows, ("o_orderkey",)), table)
    return stored.read_state(spark, table, "base")


VERSIONS_SQL = """select l_orderkey as id, l_partkey as part, l_extendedprice as price, l_linenumber as line,
l_linestatus as status, l_shipdate as ts from lineitem"""
VERSION_ORDER = desc("ts", "line", "part", "price", "status")


@checked(
    "import_upsert",
    f"""with v as ({VERSIONS_SQL}),
a as ({ranked("(select * from v where status = 'O')", "id", VERSION_ORDER)}),
b as ({ranked("(select * from v where status = 'F')", "id", VERSION_ORDER)})
select a.* from a left join b on a.id = b.id where b.id is null or a.ts > b.ts
union all select b.* from b left join a on a.id = b.id where a.id is null or b.ts >= a.ts""",
)
def _(spark, sf_dir):
    versions = spark.sql(
        VERSIONS_SQL.replace("from lineitem", "from {lineitem}"), lineitem=load(spark, sf_dir, "lineitem")
    )
    table = _new_table(spark, "reload", ["id"])
    shape = _def(versions, ("id",))
    first = fold.fold_latest(versions.where(F.col("status") == "O"), ["id"], ["ts"])
    ingest.import_table(spark, _as_csv(spark, first), shape, table)
    second = versions.where(F.col("status") == "F")
    ingest.import_table(spark, _as_csv(spark, second), shape, table, mode="upsert")
    return stored.read_state(spark, table, "base").drop(BUCKET)


IMPORTED = {"region": "r_regionkey", "nation": "n_nationkey", "customer": "c_custkey", "supplier": "s_suppkey"}


@checked(
    "import_counts",
    " union all ".join(
        f"select '{t}' as table_name, count(*) as source_rows, count(*) as loaded_rows, true as matches from {t}"
        for t in IMPORTED
    ),
)
def _(spark, sf_dir):
    source, loaded = {}, {}
    for name, key in IMPORTED.items():
        rows = load(spark, sf_dir, name)
        table = _new_table(spark, f"count-{name}", [key])
        ingest.import_table(spark, _as_csv(spark, rows), _def(rows, (key,)), table)
        source[name], loaded[name] = rows, stored.read_state(spark, table, "base")
    return checks.check_counts(source, loaded)


@checked("import_soft", "select c_nationkey, count(*) as live_rows from customer group by 1")
def _(spark, sf_dir):
    """Imported rows of a soft-delete table are live: their flag is never NULL."""
    rows = load(spark, sf_dir, "customer")
    table = _new_table(spark, "import-soft", ["c_custkey"], delete_mode="soft")
    ingest.import_table(spark, _as_csv(spark, rows), _def(rows, ("c_custkey",)), table)
    live = stored.read_state(spark, table, "base").where(~F.col("_is_deleted"))
    return live.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("live_rows"))


@checked(
    "import_append_evolved",
    """select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment,
       case when c_mktsegment = 'BUILDING' then 'kept' end as note from customer""",
)
def _(spark, sf_dir):
    """Appending to a table with a column more than the text file leaves that column in place, NULL in new rows."""
    rows = load(spark, sf_dir, "customer")
    building = F.col("c_mktsegment") == "BUILDING"
    table = _new_table(spark, "import-evolved", ["c_custkey"])
    stored.create_state(spark, rows.where(building).withColumn("note", F.lit("kept")), table)
    rest = rows.where(~building | building.isNull())
    ingest.import_table(spark, _as_csv(spark, rest), _def(rows, ("c_custkey",)), table, mode="append")
    return stored.read_state(spark, table, "base").drop(BUCKET)


@checked("import_resumed", "select * from customer")
def _(spark, sf_dir):
    """A load file by file that stops after two of them and goes on."""
    rows = load(spark, sf_dir, "customer")
    table, text = _new_table(spark, "import-resumed", ["c_custkey"]), _as_csv(spark, rows.repartition(5))
    for units in (2, None):
        ingest.import_resumable(spark, text, _def(rows, ("c_custkey",)), table, unit_bytes=1, max_units=units)
    return stored.read_state(spark, table, "base").drop(BUCKET)


# --- stored state ----------------------------------------------------------------------


@checked("cow_state", UPSERT_SQL)
def _(spark, sf_dir):
    table = _new_table(spark, "cow")
    stored.create_state(spark, _state(spark, sf_dir), table)
    stored.write_state(spark, table, _changes(spark, sf_dir))
    return stored.read_state(spark, table, "base").drop(BUCKET)


@checked("cow_soft_state", SOFT_UPSERT_SQL)
def _(spark, sf_dir):
    table = _new_table(spark, "cow-soft", delete_mode="soft")
    stored.create_state(spark, _state(spark, sf_dir), table)
    stored.write_state(spark, table, _changes(spark, sf_dir), _batch_time())
    return _time_as_text(stored.read_state(spark, table, "base").drop(BUCKET))


@checked(
    "batch_report",
    f"""{WITH}
select cast(0 as bigint) as batch_id, count(*) as changed_keys,
       count(*) filter (where _op <> 'DELETE' and o_orderkey in (select o_orderkey from s)) as updated_rows,
       count(*) filter (where _op = 'DELETE' and o_orderkey in (select o_orderkey from s)) as deleted_rows,
       count(*) filter (where _op <> 'DELETE' and o_orderkey not in (select o_orderkey from s)) as inserted_rows
from f
union all
select 1, count(*), count(*) filter (where _op <> 'DELETE'), 0, 0 from f""",
)
def _(spark, sf_dir):
    """All changes as a batch, once more as the same batch, which does nothing, and as the next one."""
    table = _new_table(spark, "reported")
    stored.create_state(spark, _state(spark, sf_dir), table)
    for batch_id in (0, 0, 1):
        stored.write_state(spark, table, _changes(spark, sf_dir), report=("job", batch_id))
    report = stored.batch_report(spark, table)
    return report.select("batch_id", "changed_keys", "updated_rows", "deleted_rows", "inserted_rows")


def _batches(spark, sf_dir) -> list[DataFrame]:
    """The changes of orders in four batches, cut across the order of changes."""
    changes, lines = _changes(spark, sf_dir), F.col(COLLECTION_ORDER)
    return [changes.where(lines == n if n < 3 else lines >= 3) for n in range(4)]


def _logged(spark, sf_dir, label: str, **options) -> StateTable:
    """Orders with their changes logged in four batches."""
    table = _new_table(spark, label, **options)
    stored.create_state(spark, _state(spark, sf_dir), table)
    for batch_id, part in enumerate(_batches(spark, sf_dir)):
        stored.append_changes(spark, table, part, batch_id)
    return table


@checked("mor_snapshot", UPSERT_SQL)
def _(spark, sf_dir):
    return stored.read_state(spark, _logged(spark, sf_dir, "mor")).drop(BUCKET)


@checked("mor_base", STATE_SQL)
def _(spark, sf_dir):
    return stored.read_state(spark, _logged(spark, sf_dir, "mor-base"), "base").drop(BUCKET)


@checked(
    "bucket_statistics",
    f"""select {md5_bucket('o_orderkey')} as _bucket, count(*) as n_rows, count(*) as n_live, count(distinct o_orderkey) as n_keys,
cast(0 as bigint) as n_null_keys, cast(0 as bigint) as n_duplicate_keys, max(o_orderdate) as newest
from ({UPSERT_SQL}) as u group by 1""",
)
def _(spark, sf_dir):
    """Counts kept per bucket, made before and brought up to date after a write and a fold."""
    table = _new_table(spark, "statistics")
    stored.create_state(spark, _state(spark, sf_dir), table)
    stats.refresh_statistics(spark, table, "o_orderdate")
    few = F.col("o_orderkey") < 100
    stored.write_state(spark, table, _changes(spark, sf_dir).where(few))
    stats.refresh_statistics(spark, table, "o_orderdate")
    stored.append_changes(spark, table, _changes(spark, sf_dir).where(~few), 0)
    stored.fold_log(spark, table)
    return stats.bucket_statistics(spark, table, "o_orderdate")


@checked("log_compacted", UPSERT_SQL)
def _(spark, sf_dir):
    """The older batches of the log merged into one directory."""
    table = _logged(spark, sf_dir, "log-compacted")
    stored.compact_log(spark, table, width=3)
    return stored.read_state(spark, table).drop(BUCKET)


@checked("mor_fold", UPSERT_SQL)
def _(spark, sf_dir):
    table = _logged(spark, sf_dir, "mor-fold")
    stored.fold_log(spark, table)
    return stored.read_state(spark, table, "base").drop(BUCKET)


AS_OF_SQL = f"""with s as ({STATE_SQL}), c as (select * from ({CHANGES_SQL}) as a where _collection_order <= 1),
f as materialized ({ranked('c', 'o_orderkey', CHANGE_ORDER)})
select {COLS} from s where not exists (select 1 from f where f.o_orderkey = s.o_orderkey)
union all select {COLS} from f where _op <> 'DELETE'"""


@checked("state_as_of_folded", AS_OF_SQL)
def _(spark, sf_dir):
    table = _logged(spark, sf_dir, "as-of-folded", undo=True)
    stored.fold_log(spark, table, 2)
    stored.fold_log(spark, table)
    stored.expire_log(spark, table)
    return stored.read_state(spark, table, as_of=1).drop(BUCKET)


@checked("state_rollback", AS_OF_SQL)
def _(spark, sf_dir):
    table = _logged(spark, sf_dir, "rollback", undo=True)
    stored.fold_log(spark, table)
    stored.expire_log(spark, table)
    stored.rollback(spark, table, 1)
    return stored.read_state(spark, table, "base").drop(BUCKET)


def _bucketed(spark, sf_dir) -> bucketed.BucketedTable:
    table = bucketed.BucketedTable(scratch_dir(spark, "bucketed"), ("o_orderkey",), 16)
    bucketed.create_bucketed(spark, _state(spark, sf_dir), table)
    for batch_id, part in enumerate(_batches(spark, sf_dir)):
        bucketed.append_bucketed(spark, table, part, batch_id)
    return table


@checked("merge_bucketed_layout", UPSERT_SQL)
def _(spark, sf_dir):
    return bucketed.read_bucketed(spark, _bucketed(spark, sf_dir))


@checked("fold_bucketed_layout", UPSERT_SQL)
def _(spark, sf_dir):
    table = _bucketed(spark, sf_dir)
    bucketed.fold_bucketed(spark, table)
    return bucketed.read_bucketed(spark, table, "base")


@checked("recreate_over_log", STATE_SQL)
def _(spark, sf_dir):
    table = _logged(spark, sf_dir, "recreate")
    stored.create_state(spark, _state(spark, sf_dir), table)
    return stored.read_state(spark, table).drop(BUCKET)


OTHER_COLS = ", ".join(ORDER_COLUMNS[1:])


@checked(
    "cow_null_key",
    f"""with m as (select min(o_orderkey) as k from orders), s as (
    select nullif(o_orderkey, k) as o_orderkey, {OTHER_COLS} from ({STATE_SQL}) as a, m
), c as (
    select nullif(o_orderkey, k) as o_orderkey, {OTHER_COLS}, _op, _txn_id, _total_order, _collection_order
    from ({CHANGES_SQL}) as a, m
), f as materialized ({ranked('c', 'o_orderkey', CHANGE_ORDER)})
select {COLS} from s where not exists (select 1 from f where f.o_orderkey is not distinct from s.o_orderkey)
union all select {COLS} from f where _op <> 'DELETE'""",
)
def _(spark, sf_dir):
    table = StateTable(scratch_dir(spark, "null-key"), ("o_orderkey",), 16, "spark_hash")
    first = load(spark, sf_dir, "orders").agg(F.min("o_orderkey")).first()[0]
    key = F.when(F.col("o_orderkey") != first, F.col("o_orderkey"))
    stored.create_state(spark, _state(spark, sf_dir).withColumn("o_orderkey", key), table)
    logged, written = _changes(spark, sf_dir).withColumn("o_orderkey", key), F.col(COLLECTION_ORDER) <= 1
    stored.append_changes(spark, table, logged, 0)
    stored.write_state(spark, table, logged.where(written))
    return stored.read_state(spark, table).drop(BUCKET)


@checked("state_as_of", AS_OF_SQL)
def _(spark, sf_dir):
    return stored.read_state(spark, _logged(spark, sf_dir, "as-of"), as_of=1).drop(BUCKET)


@checked(
    "schema_evolve",
    f"""{WITH}
select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, null as o_orderpriority
from s where not exists (select 1 from f where f.o_orderkey = s.o_orderkey)
union all select {COLS} from f where _op <> 'DELETE'""",
)
def _(spark, sf_dir):
    table = _new_table(spark, "evolve")
    stored.create_state(spark, _state(spark, sf_dir).drop("o_orderpriority"), table)
    changes = _changes(spark, sf_dir)
    stored.ensure_state(spark, table, changes)
    stored.write_state(spark, table, changes)
    return stored.read_state(spark, table, "base").drop(BUCKET)


@checked(
    "catalog_table",
    f"select {md5_bucket('o_orderkey')} as _bucket, count(*) as row_count from orders group by 1",
)
def _(spark, sf_dir):
    table = _new_table(spark, "catalog")
    stored.create_state(spark, load(spark, sf_dir, "orders"), table)
    name = "tidemark_" + table.path.rsplit("-", 1)[-1]
    registered = register_table(spark, name, table.base_path, schema=stored.base_schema(spark, table))
    return registered.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("row_count"))


@checked(
    "acceptance",
    f"""with m as ({UPSERT_SQL})
select count(*) as row_count, count(distinct o_orderkey) as distinct_pk_count, cast(0 as bigint) as duplicate_keys,
       true as is_unique from m""",
)
def _(spark, sf_dir):
    table = _new_table(spark, "accept")
    stored.create_state(spark, _state(spark, sf_dir), table)
    options = MergeOptions(target=table.path, sink="cow", streaming=False)
    return accept(spark, _changes(spark, sf_dir), table, options)


@checked("compact_preserves", "select * from orders")
def _(spark, sf_dir):
    table = _new_table(spark, "compact")
    stored.create_state(spark, load(spark, sf_dir, "orders"), table)
    stored.compact_state(spark, table)
    return stored.read_state(spark, table, "base").drop(BUCKET)


@checked("zorder_preserves", "select * from lineitem")
def _(spark, sf_dir):
    table = _new_table(spark, "zorder", ["l_orderkey"])
    stored.create_state(spark, load(spark, sf_dir, "lineitem"), table)
    stored.zorder_state(spark, table, "l_partkey,l_suppkey,l_shipdate")
    return stored.read_state(spark, table, "base").drop(BUCKET)


@checked("compact_result", "select 16 as rewritten_buckets, true as fewer_files, count(*) as row_count from orders")
def _(spark, sf_dir):
    """Two loads leave two files in a bucket or more; compaction reports what it has rewritten."""
    table = _new_table(spark, "compacted")
    orders = load(spark, sf_dir, "orders")
    stored.create_state(spark, orders.where("o_orderkey % 2 = 0"), table)
    odd = table.bucketed(orders.where("o_orderkey % 2 = 1"))
    odd.write.mode("append").partitionBy(BUCKET).parquet(table.base_path)
    done = stored.compact_state(spark, table)
    rows = stored.read_state(spark, table, "base").agg(F.count(F.lit(1)).alias("row_count"))
    fewer = (F.col("files_after") < F.col("files_before")).alias("fewer_files")
    # One row each.
    return done.select("rewritten_buckets", fewer, F.lit(rows.first()[0]).alias("row_count"))


@checked(
    "zorder_result",
    f"select count(distinct {md5_bucket('l_orderkey')}) as rewritten_buckets, true as has_files, true as has_bytes from lineitem",
)
def _(spark, sf_dir):
    """The table's own cluster columns, and what the rewrite reports."""
    table = StateTable(scratch_dir(spark, "clustered"), ("l_orderkey",), 16, "md5", cluster_by=("l_partkey", "l_shipdate"))
    stored.create_state(spark, load(spark, sf_dir, "lineitem"), table)
    done = stored.zorder_state(spark, table)
    return done.select(
        F.col("rewritten_buckets").cast("long").alias("rewritten_buckets"),
        (F.col("files_after") >= F.col("rewritten_buckets")).alias("has_files"),
        (F.col("bytes_after") > 0).alias("has_bytes"),
    )


@checked("zorder_text", "select count(*) as row_count, cast(0 as bigint) as inversions, true as separated from customer")
def _(spark, sf_dir):
    """Names with a long common start still get many Z-values, in their order."""
    customer = load(spark, sf_dir, "customer")
    ranked = layout.with_zvalue(customer, ["c_name"]).groupBy("__z").agg(
        F.min("c_name").alias("low"), F.max("c_name").alias("high"), F.count(F.lit(1)).alias("n")
    )
    # One row per Z-value, of which there are 256 at most.
    before = F.lag("high").over(Window.orderBy("__z"))
    return ranked.withColumn("wrong", before >= F.col("low")).agg(
        F.sum("n").alias("row_count"),
        F.count(F.when(F.col("wrong"), 1)).alias("inversions"),
        (F.count(F.lit(1)) >= F.least(F.lit(100), F.sum("n") / 4)).alias("separated"),
    )


@checked(
    "log_expired",
    f"{UPSERT_SQL}",
)
def _(spark, sf_dir):
    """Two logged batches, the first folded and expired: the snapshot is that of the whole log."""
    table = _new_table(spark, "expired")
    stored.create_state(spark, _state(spark, sf_dir), table)
    changes = _changes(spark, sf_dir)
    late = F.col("o_orderkey") % 3 == 0
    stored.append_changes(spark, table, changes.where(~late), 0)
    stored.append_changes(spark, table, changes.where(late), 1)
    stored.fold_log(spark, table, upto=0)
    stored.expire_log(spark, table)
    return stored.read_state(spark, table).drop(BUCKET)


@checked(
    "zorder_value",
    "select o_orderkey, o_custkey, cast("
    + " + ".join(
        f"((o_custkey >> {i} & 1) << {2 * i + 1}) + ((o_orderkey >> {i} & 1) << {2 * i})" for i in range(24)
    )
    + " as bigint) as z from orders",
)
def _(spark, sf_dir):
    orders = load(spark, sf_dir, "orders")
    z = interleave([F.col("o_custkey"), F.col("o_orderkey")], 24)
    return orders.select("o_orderkey", "o_custkey", z.alias("z"))


@checked(
    "clustering_depth",
    """select column_name, 64 as wanted_files, true as clustered, true as bounded
from (values ('l_partkey'), ('l_shipdate')) as t(column_name)""",
)
def _(spark, sf_dir):
    """Ranges of two columns over 64 files: after Z-ordering a value is in fewer of them."""
    table = _new_table(spark, "depth", ["l_orderkey"])
    stored.create_state(spark, load(spark, sf_dir, "lineitem"), table)
    names = ["l_partkey", "l_shipdate"]
    stored.zorder_state(spark, table, ["l_orderkey"], files=64)
    # Results are a row a column, and the files they tell of are replaced below.
    before = layout.clustering_depth(spark, table.base_path, names).collect()
    stored.zorder_state(spark, table, names, files=64)
    was = spark.createDataFrame([(r["column_name"], r["mean_depth"]) for r in before], "column_name string, was double")
    after = layout.clustering_depth(spark, table.base_path, names).join(F.broadcast(was), "column_name")
    return after.select(
        "column_name",
        F.lit(64).alias("wanted_files"),
        (F.col("mean_depth") < F.col("was")).alias("clustered"),
        F.col("mean_depth").between(1, F.col("files")).alias("bounded"),
    )


@checked(
    "layout_stats",
    f"""select {md5_bucket('o_orderkey')} as _bucket, count(*) as row_count, min(o_orderkey) as min_key,
       max(o_orderkey) as max_key, true as has_bytes from orders group by 1""",
)
def _(spark, sf_dir):
    table = _new_table(spark, "layout")
    stored.create_state(spark, load(spark, sf_dir, "orders"), table)
    files = layout.layout_stats(spark, table.base_path, ["o_orderkey"])
    return files.groupBy(BUCKET).agg(
        F.sum("row_count").alias("row_count"),
        F.min("min_o_orderkey").alias("min_key"),
        F.max("max_o_orderkey").alias("max_key"),
        (F.min("file_bytes") > 0).alias("has_bytes"),
    )


# --- streams ---------------------------------------------------------------------------


def _streamed(spark, sf_dir, sink: str, runs: int, **table_options) -> StateTable:
    state = _state(spark, sf_dir)
    table = _new_table(spark, f"stream-{sink}", **table_options)
    stored.create_state(spark, state, table)
    log = scratch_dir(spark, "log")
    write_changes(_changes(spark, sf_dir), log, KEY, 16, "md5")
    options = MergeOptions(
        target=table.path,
        checkpoint=scratch_dir(spark, "checkpoint"),
        sink=sink,
        trigger="available-now",
        max_files_per_trigger=6,
    )
    for _ in range(runs):
        streams.run_changes(spark, log, state.schema, table, options).awaitTermination()
    return table


@checked("stream_upsert", UPSERT_SQL)
def _(spark, sf_dir):
    return stored.read_state(spark, _streamed(spark, sf_dir, "mor", 1)).drop(BUCKET)


@checked("stream_replay", UPSERT_SQL)
def _(spark, sf_dir):
    """The stream is run twice, and its first logged batch is applied again by hand."""
    table = _streamed(spark, sf_dir, "mor", 2)
    log = stored.read_log(spark, table)
    again = log.where(F.col(BATCH_ID) == 0).drop(BATCH_ID)
    stored.append_changes(spark, table, again, 10_000)
    return stored.read_state(spark, table).drop(BUCKET)


@checked(
    "stream_cow",
    f"""with c as ({EVENT_CHANGES_SQL}), f as materialized ({ranked("c", "user_id", desc("event_id"))})
select user_id, event_id, event_type, value, ts from f where _op <> 'DELETE'""",
)
def _(spark, sf_dir):
    """Copy-on-write from a stream whose batches are not in order: every file is a batch of some buckets' changes."""
    changes = fixtures.event_changes(spark, sf_dir)
    table = _new_table(
        spark, "stream-cow", ["user_id"], delete_mode="soft", guard_col="_total_order", order_by=("_total_order",)
    )
    log = scratch_dir(spark, "log")
    late = F.col("event_type").isin("error", "view")
    for part in (changes.where(late), changes.where(~late)):
        write_changes(part, log, ["user_id"], 16, "md5")
    options = MergeOptions(
        target=table.path, checkpoint=scratch_dir(spark, "checkpoint"), sink="cow", trigger="available-now",
        max_files_per_trigger=8,
    )
    business = changes.drop(*META).schema
    streams.run_changes(spark, log, business, table, options).awaitTermination()
    live = stored.read_state(spark, table, "base").where(~F.col("_is_deleted"))
    return live.select("user_id", "event_id", "event_type", "value", "ts")


@checked(
    "stream_cow_hard",
    f"""with c as ({EVENT_CHANGES_SQL}), f as materialized ({ranked("c", "user_id", desc("event_id"))})
select user_id, event_id, event_type, value, ts from f where _op <> 'DELETE'""",
)
def _(spark, sf_dir):
    """As above, with rows that are really deleted: what is late is told by the stream's own state."""
    changes = fixtures.event_changes(spark, sf_dir)
    table = _new_table(spark, "stream-hard", ["user_id"], order_by=("_total_order",))
    log = scratch_dir(spark, "log")
    late = F.col("event_type").isin("error", "view")
    for part in (changes.where(late), changes.where(~late)):
        write_changes(part, log, ["user_id"], 16, "md5")
    options = MergeOptions(
        target=table.path, checkpoint=scratch_dir(spark, "checkpoint"), sink="cow", trigger="available-now",
        max_files_per_trigger=8, late_seconds=7 * 24 * 3600,
    )
    streams.run_changes(spark, log, changes.drop(*META).schema, table, options).awaitTermination()
    return stored.read_state(spark, table, "base").select("user_id", "event_id", "event_type", "value", "ts")


@checked(
    "stream_all",
    f"""select 'orders' as table_name, count(*) as row_count from ({UPSERT_SQL}) as o
union all select 'users', count(*) from (
    with c as ({EVENT_CHANGES_SQL}), f as materialized ({ranked("c", "user_id", desc("event_id"))})
    select * from f where _op <> 'DELETE') as u""",
)
def _(spark, sf_dir):
    """Two tables fed by two streams of one session: merge-on-read and guarded copy-on-write."""
    orders, events = _state(spark, sf_dir), fixtures.event_changes(spark, sf_dir)
    tables = {
        "orders": _new_table(spark, "all-orders"),
        "users": _new_table(
            spark, "all-users", ["user_id"], delete_mode="soft", guard_col="_total_order", order_by=("_total_order",)
        ),
    }
    stored.create_state(spark, orders, tables["orders"])
    jobs = {}
    for name, changes, sink in (("orders", _changes(spark, sf_dir), "mor"), ("users", events, "cow")):
        log = scratch_dir(spark, "log")
        write_changes(changes, log, list(tables[name].keys), 16, "md5")
        options = MergeOptions(
            target=tables[name].path, checkpoint=scratch_dir(spark, "checkpoint"), sink=sink, trigger="available-now"
        )
        jobs[name] = (log, changes.drop(*META).schema, tables[name], options)
    streams.run_all(spark, jobs)
    live = {
        "orders": stored.read_state(spark, tables["orders"]),
        "users": stored.read_state(spark, tables["users"], "base").where(~F.col("_is_deleted")),
    }
    counts = [df.agg(F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("row_count")) for n, df in live.items()]
    return counts[0].unionByName(counts[1])


@checked("stream_progress", f"with c as ({CHANGES_SQL}) select count(*) as input_rows, true as batches_complete from c")
def _(spark, sf_dir):
    """Every input row is in one of the reported batches, whose numbers have no gap."""
    log = scratch_dir(spark, "log")
    write_changes(_changes(spark, sf_dir), log, KEY, 16, "md5")
    options = MergeOptions(
        checkpoint=scratch_dir(spark, "checkpoint"), sink="noop", trigger="available-now", max_files_per_trigger=4
    )
    table = _new_table(spark, "progress")
    batches = streams.ProgressLog()
    spark.streams.addListener(batches)
    try:
        query = streams.run_changes(spark, log, _state(spark, sf_dir).schema, table, options)
        query.awaitTermination()
        frame = streams.progress_frame(spark, query, batches)
    finally:
        spark.streams.removeListener(batches)
    complete = F.countDistinct("batch_id") == F.max("batch_id") + 1
    return frame.agg(F.sum("input_rows").alias("input_rows"), complete.alias("batches_complete"))


@checked(
    "stream_row_limit",
    f"""with c as ({CHANGES_SQL})
select count(*) as logged_rows, true as within_limit, true as several_batches from c""",
)
def _(spark, sf_dir):
    """No batch has more rows than its limit, by the report of the batches that the table keeps."""
    log, table = scratch_dir(spark, "log"), _new_table(spark, "row-limit")
    state, limit = _state(spark, sf_dir), 32_000
    write_changes(_changes(spark, sf_dir), log, KEY, 16, "md5", max_rows_per_file=4_000)
    options = MergeOptions(
        target=table.path, checkpoint=scratch_dir(spark, "checkpoint"), trigger="available-now",
        max_rows_per_trigger=limit, report=True,
    )
    streams.run_changes(spark, log, state.schema, table, options).awaitTermination()
    rows = F.sum("changes")
    return stored.batch_report(spark, table).agg(
        rows.alias("logged_rows"),
        (F.max("changes") <= limit).alias("within_limit"),
        (F.count(F.lit(1)) >= F.ceil(rows / limit)).alias("several_batches"),
    )


@checked("read_change_log", f"with c as ({CHANGES_SQL}) select _op, count(*) as row_count from c group by 1")
def _(spark, sf_dir):
    log = scratch_dir(spark, "log")
    write_changes(_changes(spark, sf_dir), log, KEY, 16, "md5")
    changes = read_changes(spark, log, _state(spark, sf_dir).schema)
    return changes.groupBy(OP).agg(F.count(F.lit(1)).alias("row_count"))


@checked(
    "backfill_once",
    f"""with b as (select *, {md5_bucket('c_custkey')} as bucket from customer),
t as (select c_custkey from b where bucket = 5 order by c_custkey limit 20)
select c_custkey, c_name, c_nationkey, case when c_custkey in (select c_custkey from t) then c_acctbal + 1.5
       else c_acctbal end as c_acctbal, c_mktsegment from customer""",
)
def _(spark, sf_dir):
    table = _new_table(spark, "backfill", ["c_custkey"])
    stored.create_state(spark, load(spark, sf_dir, "customer"), table)
    streams.backfill_slice(spark, table, 5, {"c_acctbal": "c_acctbal + 1.5D"}, ["c_custkey"], 20)
    return stored.read_state(spark, table, "base").drop(BUCKET)


# --- checks ----------------------------------------------------------------------------


def _check_sql(table: str, keys: str) -> str:
    return f"""with k as (select {keys}, count(*) as n from {table} group by {keys})
select cast(sum(n) as bigint) as row_count, count(*) as distinct_pk_count,
       count(*) filter (where n > 1) as duplicate_keys, sum(n) = count(*) as is_unique from k"""


@checked("pk_check_ok", _check_sql("orders", "o_orderkey"))
def _(spark, sf_dir):
    return checks.check_keys(load(spark, sf_dir, "orders"), KEY)


@checked("pk_check_dups", _check_sql("lineitem", "l_orderkey, l_linenumber"))
def _(spark, sf_dir):
    return checks.check_keys(load(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@checked(
    "pk_duplicates",
    """select l_orderkey, l_linenumber, count(*) as row_count from lineitem
group by l_orderkey, l_linenumber having count(*) > 1""",
)
def _(spark, sf_dir):
    return checks.duplicate_keys(load(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@checked(
    "table_counts",
    " union all ".join(f"select '{t}' as table_name, count(*) as row_count from {t}" for t in TABLES),
)
def _(spark, sf_dir):
    return checks.table_stats({t: load(spark, sf_dir, t) for t in TABLES})


@checked("distinct_partitions", "select count(distinct event_type) as distinct_count from events")
def _(spark, sf_dir):
    return checks.distinct_counts(load(spark, sf_dir, "events"), ["event_type"])


@checked("preview_topn", "select * from customer order by c_custkey limit 3")
def _(spark, sf_dir):
    return checks.preview(load(spark, sf_dir, "customer"), ["c_custkey"], 3)


@checked("freshness_max", "select event_type, max(ts) as max_ts from events group by 1")
def _(spark, sf_dir):
    return checks.freshness(load(spark, sf_dir, "events"), "ts", ["event_type"])


@checked(
    "freshness_lag",
    """select user_id, max(ts) as max_ts,
       (epoch_us((select max(ts) from events)) - epoch_us(max(ts))) / 1e6 as lag_seconds from events group by 1""",
)
def _(spark, sf_dir):
    return checks.freshness_lag(load(spark, sf_dir, "events"), "ts", ["user_id"])


# --- job metrics -----------------------------------------------------------------------

SAMPLES_SQL = """select event_id, user_id, ts, event_id * 1000000000 as rx_bytes,
cast(round(value * 1000000) as bigint) as read_sectors from events"""


@checked(
    "counter_rates",
    f"""with m as ({SAMPLES_SQL}), d as (
select *, (epoch_us(ts) - epoch_us(lag(ts) over w)) / 1e6 as secs,
       greatest(rx_bytes - lag(rx_bytes) over w, 0) as rx,
       greatest(read_sectors - lag(read_sectors) over w, 0) as sectors
from m window w as (partition by user_id order by ts))
select event_id, user_id, ts, rx_bytes, read_sectors,
       case when secs is null then 0.0 else round(rx * 8 / (secs * 1000000.0), 2) end as rx_bytes_mbps,
       case when secs is null then 0.0 else round(sectors * 512 * 8 / (secs * 1000000.0), 2) end
         as read_sectors_mbps
from d""",
)
def _(spark, sf_dir):
    samples = spark.sql(SAMPLES_SQL.replace("from events", "from {events}"), events=load(spark, sf_dir, "events"))
    return metrics.counter_rates(samples, ["user_id"], "ts", ["rx_bytes"], ["read_sectors"], chunk_rows=2000)


@checked("latest_status", ranked("events", "event_type", desc("ts", "event_id")))
def _(spark, sf_dir):
    return fold.latest_status(load(spark, sf_dir, "events"), "event_type", "ts")


@checked(
    "metrics_summary",
    """select date_trunc('hour', ts) as sampled, count(*) as jobs,
       cast(sum(cast(round(value * 100) as bigint)) as bigint) as total_cpu,
       cast(sum(user_id) as bigint) as total_heap from events group by 1""",
)
def _(spark, sf_dir):
    samples = load(spark, sf_dir, "events").select(
        F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz").alias("sampled"),
        F.round(F.col("value") * 100).cast("bigint").alias("cpu"),
        F.col("user_id").alias("heap"),
    )
    return metrics.metrics_summary(samples, "sampled", ["cpu", "heap"])
