"""Declared tables, target schemas, and catalog registration.

Schemas are always declared, never inferred.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.functions.buckets import quote
from tidemark.functions.keybytes import field
from tidemark.names import BUCKET, DELETED_AT, IS_DELETED, META

# First of these a table has is the column that orders versions of a row.
PRECOMBINE_COLUMNS = ("freshness_ts", "last_update_timestamp", "ts")


@dataclass(frozen=True)
class TableDef:
    """One source table: schema, primary key, and how its text file is written."""

    name: str
    schema: T.StructType
    keys: tuple[str, ...]
    file: str = ""
    delimiter: str = ","
    cluster_by: tuple[str, ...] = ()

    @property
    def precombine(self) -> str:
        names = {n.lower(): n for n in self.schema.fieldNames()}
        return next((names[c] for c in PRECOMBINE_COLUMNS if c in names), self.keys[0])


# The accepted type names. Text lengths and timestamp precisions are dropped.
TYPE_NAMES = {
    "tinyint": T.ByteType(),
    "smallint": T.ShortType(),
    "int": T.IntegerType(),
    "integer": T.IntegerType(),
    "long": T.LongType(),
    "bigint": T.LongType(),
    "float": T.FloatType(),
    "real": T.FloatType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "char": T.StringType(),
    "varchar": T.StringType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "boolean": T.BooleanType(),
    "binary": T.BinaryType(),
    "varbinary": T.BinaryType(),
}
_TYPE_TEXT = re.compile(r"([a-z_]+)\s*(?:\(\s*(\d+)\s*(?:,\s*(\d+)\s*)?\))?")


def column_type(text: str) -> T.DataType:
    """``"int"``, ``"varchar(20)"``, ``"decimal(15,2)"`` to a type; needs no session."""
    match = _TYPE_TEXT.fullmatch(text.strip().lower())
    name = match.group(1) if match else None
    if name == "decimal":
        return T.DecimalType(int(match.group(2) or 10), int(match.group(3) or 0))
    if name not in TYPE_NAMES:
        raise ValueError(f"unsupported type: {text.strip()!r}")
    return TYPE_NAMES[name]


def parse_schema(text: str) -> T.StructType:
    """``"a:int,b:string"`` to a schema; every column is nullable, every name unique."""
    schema = T.StructType()
    seen: set[str] = set()
    depth, start, parts = 0, 0, []
    for position, char in enumerate(text):
        depth += (char == "(") - (char == ")")
        if char == "," and depth == 0:
            parts.append(text[start:position])
            start = position + 1
    parts.append(text[start:])
    for part in (p.strip() for p in parts):
        if not part:
            continue
        name, found, kind = part.partition(":")
        name = name.strip()
        if not found or not name or not kind.strip():
            raise ValueError(f"expected name:type, got {part!r}")
        if name.lower() in seen:
            raise ValueError(f"duplicate column {name!r}")
        seen.add(name.lower())
        schema.add(name, column_type(kind), True)
    if not schema.fields:
        raise ValueError("a schema needs at least one column")
    return schema


def table_def(
    name: str, file: str, delimiter: str, keys: str, cluster_by: str, schema: str
) -> TableDef:
    """A definition from its text form; key and clustering columns must exist."""
    parsed = parse_schema(schema)

    def names(text: str) -> tuple[str, ...]:
        return tuple(field(parsed, c.strip()).name for c in text.split(",") if c.strip())

    if not names(keys):
        raise ValueError(f"table {name} has no primary key")
    return TableDef(name, parsed, names(keys), file, delimiter, names(cluster_by))


# The declared tables of the two public benchmarks, as
# (table, file, delimiter, primary key, clustering columns, columns), in their usual order.
HYBENCH = (
    ("customer", "customer.csv", ",", "custID", "custID,companyID,last_update_timestamp",
     "custID:int,companyID:int,gender:string,name:string,age:int,phone:string,province:string,city:string,"
     "loan_balance:float,saving_credit:int,checking_credit:int,loan_credit:int,Isblocked:int,created_date:date,"
     "last_update_timestamp:timestamp,freshness_ts:timestamp"),
    ("company", "company.csv", ",", "companyID", "companyID,last_update_timestamp",
     "companyID:int,name:string,category:string,staff_size:int,loan_balance:float,phone:string,province:string,"
     "city:string,saving_credit:int,checking_credit:int,loan_credit:int,Isblocked:int,created_date:date,"
     "last_update_timestamp:timestamp,freshness_ts:timestamp"),
    ("savingaccount", "savingAccount.csv", ",", "accountID", "accountID,userID,ts",
     "accountID:int,userID:int,balance:float,Isblocked:int,ts:timestamp,freshness_ts:timestamp"),
    ("checkingaccount", "checkingAccount.csv", ",", "accountID", "accountID,userID,ts",
     "accountID:int,userID:int,balance:float,Isblocked:int,ts:timestamp,freshness_ts:timestamp"),
    ("transfer", "transfer.csv", ",", "id", "id,sourceID,targetID,ts",
     "id:long,sourceID:int,targetID:int,amount:float,type:string,ts:timestamp,freshness_ts:timestamp"),
    ("checking", "checking.csv", ",", "id", "id,sourceID,targetID,ts",
     "id:int,sourceID:int,targetID:int,amount:float,type:string,ts:timestamp,freshness_ts:timestamp"),
    ("loanapps", "loanApps.csv", ",", "id", "id,applicantID,ts",
     "id:int,applicantID:int,amount:float,duration:int,status:string,ts:timestamp,freshness_ts:timestamp"),
    ("loantrans", "loanTrans.csv", ",", "id", "id,applicantID,appID,ts",
     "id:int,applicantID:int,appID:int,amount:float,status:string,ts:timestamp,duration:int,"
     "contract_timestamp:timestamp,delinquency:int,freshness_ts:timestamp"),
)
CHBENCHMARK = (
    ("warehouse", "WAREHOUSE.tbl", "|", "w_id", "w_id",
     "w_id:int,w_name:string,w_street_1:string,w_street_2:string,w_city:string,w_state:string,w_zip:string,"
     "w_tax:float,w_ytd:float,freshness_ts:timestamp"),
    ("district", "DISTRICT.tbl", "|", "d_w_id,d_id", "d_w_id,d_id",
     "d_id:int,d_w_id:int,d_name:string,d_street_1:string,d_street_2:string,d_city:string,d_state:string,"
     "d_zip:string,d_tax:float,d_ytd:float,d_next_o_id:int,freshness_ts:timestamp"),
    ("customer", "CUSTOMER.tbl", "|", "c_w_id,c_d_id,c_id", "c_w_id,c_d_id,c_id,c_last",
     "c_id:int,c_d_id:int,c_w_id:int,c_first:string,c_middle:string,c_last:string,c_street_1:string,"
     "c_street_2:string,c_city:string,c_state:string,c_zip:string,c_phone:string,c_since:timestamp,c_credit:string,"
     "c_credit_lim:float,c_discount:float,c_balance:float,c_ytd_payment:float,c_payment_cnt:int,"
     "c_delivery_cnt:int,c_data:string,c_n_nationkey:int,freshness_ts:timestamp"),
    ("history", "HISTORY.tbl", "|", "h_c_id,h_c_d_id,h_c_w_id,h_d_id,h_w_id,h_date",
     "h_c_w_id,h_c_d_id,h_c_id,h_w_id,h_d_id",
     "h_c_id:int,h_c_d_id:int,h_c_w_id:int,h_d_id:int,h_w_id:int,h_date:timestamp,h_amount:float,h_data:string,"
     "freshness_ts:timestamp"),
    ("neworder", "NEWORDER.tbl", "|", "no_w_id,no_d_id,no_o_id", "no_w_id,no_d_id,no_o_id",
     "no_o_id:int,no_d_id:int,no_w_id:int,freshness_ts:timestamp"),
    ("order", "ORDER.tbl", "|", "o_w_id,o_d_id,o_id", "o_w_id,o_d_id,o_id,o_c_id,o_carrier_id",
     "o_id:int,o_d_id:int,o_w_id:int,o_c_id:int,o_entry_d:timestamp,o_carrier_id:int,o_ol_cnt:int,o_all_local:int,"
     "freshness_ts:timestamp"),
    ("orderline", "ORDERLINE.tbl", "|", "ol_w_id,ol_d_id,ol_o_id,ol_number", "ol_w_id,ol_d_id,ol_o_id,ol_i_id",
     "ol_o_id:int,ol_d_id:int,ol_w_id:int,ol_number:int,ol_i_id:int,ol_supply_w_id:int,ol_delivery_d:timestamp,"
     "ol_quantity:int,ol_amount:float,ol_dist_info:string,freshness_ts:timestamp"),
    ("item", "ITEM.tbl", "|", "i_id", "i_id,i_im_id",
     "i_id:int,i_im_id:int,i_name:string,i_price:float,i_data:string,freshness_ts:timestamp"),
    ("stock", "STOCK.tbl", "|", "s_w_id,s_i_id", "s_w_id,s_i_id,s_quantity,s_su_suppkey",
     "s_i_id:int,s_w_id:int,s_quantity:int,s_dist_01:string,s_dist_02:string,s_dist_03:string,s_dist_04:string,"
     "s_dist_05:string,s_dist_06:string,s_dist_07:string,s_dist_08:string,s_dist_09:string,s_dist_10:string,"
     "s_ytd:int,s_order_cnt:int,s_remote_cnt:int,s_data:string,s_su_suppkey:int,freshness_ts:timestamp"),
    ("nation", "NATION.tbl", "|", "n_nationkey", "n_nationkey,n_regionkey",
     "n_nationkey:int,n_name:string,n_regionkey:int,n_comment:string,freshness_ts:timestamp"),
    ("supplier", "SUPPLIER.tbl", "|", "su_suppkey", "su_suppkey,su_nationkey",
     "su_suppkey:int,su_name:string,su_address:string,su_nationkey:int,su_phone:string,su_acctbal:float,"
     "su_comment:string,freshness_ts:timestamp"),
    ("region", "REGION.tbl", "|", "r_regionkey", "r_regionkey",
     "r_regionkey:int,r_name:string,r_comment:string,freshness_ts:timestamp"),
)

CATALOG: dict[str, dict[str, TableDef]] = {
    benchmark: {row[0]: table_def(*row) for row in rows}
    for benchmark, rows in (("hybench", HYBENCH), ("chbenchmark", CHBENCHMARK))
}


def list_tables(benchmark: str) -> list[str]:
    """Table names of a benchmark, in declared order."""
    if benchmark.strip().lower() not in CATALOG:
        raise ValueError(f"unknown benchmark {benchmark!r}; known: {', '.join(CATALOG)}")
    return list(CATALOG[benchmark.strip().lower()])


def require(benchmark: str, table: str) -> TableDef:
    """Definition of a table, by case-insensitive name."""
    if table.strip().lower() not in list_tables(benchmark):
        raise ValueError(f"table {table!r} is not defined in {benchmark!r}")
    return CATALOG[benchmark.strip().lower()][table.strip().lower()]


def target_schema(
    change_schema: T.StructType, soft_delete: bool = False, keep: Iterable[str] = ()
) -> T.StructType:
    """Schema of the stored table: no metadata (but ``keep``), flags, and the bucket last."""
    kept = set(keep)
    fields = [f for f in change_schema.fields if (f.name not in META or f.name in kept) and f.name != BUCKET]
    if soft_delete:
        own = {IS_DELETED, DELETED_AT}
        fields = [f for f in fields if f.name not in own]
        fields.append(T.StructField(IS_DELETED, T.BooleanType(), False))
        fields.append(T.StructField(DELETED_AT, T.TimestampType(), True))
    if BUCKET in change_schema.fieldNames():
        fields.append(T.StructField(BUCKET, T.IntegerType(), False))
    return T.StructType(fields)


def register_table(
    spark: SparkSession, name: str, path: str, partitioned: bool = True, schema: T.StructType | None = None
) -> DataFrame:
    """Make the Parquet data at ``path`` a catalog table and return it."""
    if schema is None:
        schema = spark.read.option("mergeSchema", "true").parquet(path).schema
    columns = ", ".join(f"{quote(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    clause = f"PARTITIONED BY ({quote(BUCKET)})" if partitioned and BUCKET in schema.fieldNames() else ""
    location = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet {clause} LOCATION '{location}'")
    if clause:
        spark.sql(f"MSCK REPAIR TABLE {name}")
    return spark.table(name)


def ensure_table(
    spark: SparkSession, name: str, path: str, schema: T.StructType, auto_create: bool = True
) -> None:
    """Create an empty table at ``path`` under ``name`` unless the catalog has it."""
    if spark.catalog.tableExists(name):
        return
    if not auto_create:
        raise ValueError(f"table {name} does not exist and auto_create is off")
    columns = ", ".join(f"{quote(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    clause = f"PARTITIONED BY ({quote(BUCKET)})" if BUCKET in schema.fieldNames() else ""
    location = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet {clause} LOCATION '{location}'")


def missing_columns(actual: T.StructType, expected: T.StructType) -> list[T.StructField]:
    """Expected columns the actual schema lacks, by case-insensitive name."""
    have = {f.name.lower() for f in actual.fields}
    return [f for f in expected.fields if f.name.lower() not in have]


def evolve_schema(spark: SparkSession, name: str, expected: T.StructType) -> list[str]:
    """Add the columns a table lacks; rows written before read NULL there."""
    added = missing_columns(spark.table(name).schema, expected)
    if added:
        columns = ", ".join(f"{quote(f.name)} {f.dataType.simpleString()}" for f in added)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({columns})")
    return [f.name for f in added]


def validate_schema(actual: T.StructType, expected: T.StructType) -> None:
    """Every expected column must exist with its type; further target columns are allowed."""
    absent = missing_columns(actual, expected)
    if absent:
        raise ValueError(f"target lacks column(s): {', '.join(f.name for f in absent)}")
    for wanted in expected.fields:
        found = field(actual, wanted.name)
        if found.dataType.simpleString() != wanted.dataType.simpleString():
            raise ValueError(
                f"column {wanted.name}: expected {wanted.dataType.simpleString()}, "
                f"found {found.dataType.simpleString()}"
            )


def describe_tables(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """Columns of registered tables, one row each."""
    rows = [
        (name, position, c.name, c.dataType, bool(c.isPartition))
        for name in names
        for position, c in enumerate(spark.catalog.listColumns(name))
    ]
    return spark.createDataFrame(rows, "table_name string, position int, name string, type string, partition boolean")
