"""Change data derived from the star-schema tables.

The text runs unchanged in Spark and in other SQL engines, and uses every row of the
tables it names: orders dated before 1998 are the state, later orders arrive as inserts,
and every line item is a change of its order. Line items without tax carry no order number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

ORDER_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")

STATE_SQL = """
select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
from orders where o_orderdate < timestamp '1998-01-01 00:00:00'"""


def day_number(column: str) -> str:
    """Sortable number of a day, in SQL any engine reads."""
    return (
        f"cast(extract(year from {column}) * 10000 + extract(month from {column}) * 100"
        f" + extract(day from {column}) as bigint)"
    )


CHANGES_SQL = f"""
select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
       'INSERT' as _op, concat('order-', cast(o_orderkey as varchar(20))) as _txn_id,
       {day_number('o_orderdate')} as _total_order, cast(0 as bigint) as _collection_order
from orders where o_orderdate >= timestamp '1998-01-01 00:00:00'
union all
select l_orderkey, l_partkey, l_linestatus, l_extendedprice, l_shipdate, concat(l_returnflag, l_linestatus),
       case when l_returnflag = 'R' then 'DELETE'
            when l_returnflag = 'A' then 'UPDATE'
            when l_linestatus = 'F' then 'SNAPSHOT'
            else 'UPDATE' end,
       concat('line-', cast(l_suppkey as varchar(20))),
       case when l_tax = 0 then null else {day_number('l_shipdate')} end,
       cast(l_linenumber as bigint)
from lineitem"""

# Events as changes of their user's last activity.
EVENT_CHANGES_SQL = """
select user_id, event_id, event_type, value, ts,
       case event_type when 'error' then 'DELETE' when 'signup' then 'INSERT' else 'UPDATE' end as _op,
       cast(event_id as varchar(20)) as _txn_id,
       event_id as _total_order, cast(0 as bigint) as _collection_order
from events"""


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _with_tables(spark: SparkSession, sf_dir: str, text: str, *tables: str) -> DataFrame:
    for table in tables:
        text = text.replace(f"from {table}", "from {" + table + "}")
    return spark.sql(text, **{t: load(spark, sf_dir, t) for t in tables})


def order_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_tables(spark, sf_dir, STATE_SQL, "orders")


def order_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_tables(spark, sf_dir, CHANGES_SQL, "orders", "lineitem")


def event_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_tables(spark, sf_dir, EVENT_CHANGES_SQL, "events")
