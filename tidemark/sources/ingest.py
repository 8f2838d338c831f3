"""Bulk load of text tables into bucketed state.

A resumable import loads the files of a folder in units, and keeps with the table which files are loaded: a
unit's rows and its entry appear in one step (:mod:`tidemark.sources.swap`), so an import that dies has loaded each
file wholly or not at all, and goes on where it was. The last step seals the import; until then no other import
touches the table.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.buckets import rebalance_by_bucket, with_bucket
from tidemark.names import BUCKET
from tidemark.operators.fold import fold_latest
from tidemark.operators.merge import replace_older, with_delete_flags
from tidemark.sources.catalog import TableDef, list_tables, require
from tidemark.sources.state import (
    StateTable,
    base_schema,
    is_declared,
    read_state,
    replace_buckets,
    replace_table,
)
from tidemark.sources.swap import decide, delete_path, files_in, get_marker, names_in, set_marker, staging

IMPORT_MODES = ("overwrite", "append", "upsert", "skip", "resume")


def scan_csv(spark: SparkSession, path: str | list[str], table: TableDef, raw: bool = False) -> DataFrame:
    """Header-less text under the declared schema; a malformed row fails the read.

    Empty fields are NULL. ``raw`` reads text and casts in a projection instead. The file
    is splittable, so one scan replaces any chunked load.
    """
    reader = spark.read.option("header", "false").option("nullValue", "").option("delimiter", table.delimiter)
    if not raw:
        return reader.schema(table.schema).option("mode", "FAILFAST").csv(path)
    text = ", ".join(f"`{f.name}` string" for f in table.schema.fields)
    rows = reader.schema(text).option("mode", "FAILFAST").csv(path)
    return rows.select(*[F.trim(F.col(f.name)).cast(f.dataType).alias(f.name) for f in table.schema.fields])


def _load(spark: SparkSession, rows: DataFrame, target: StateTable, mode: str, max_records_per_file: int) -> None:
    """Partitioned write by ``_bucket``; AQE decides how many files a bucket gets."""
    if mode == "append" and is_declared(spark, target):
        # The table may have been evolved: its schema stays, and columns the file lacks are NULL.
        declared = base_schema(spark, target)
        if extra := [c for c in rows.columns if c not in declared.names]:
            raise ValueError(f"the table has no columns {', '.join(extra)}; evolve it first")
        rows = rows.select(
            *[
                (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in declared.fields
            ]
        )
        writer = rebalance_by_bucket(rows).write.mode("append").partitionBy(BUCKET)
        if max_records_per_file > 0:
            writer = writer.option("maxRecordsPerFile", max_records_per_file)
        delete_path(spark, target.stats_path)
        writer.parquet(target.base_path)
    else:
        replace_table(spark, target, rebalance_by_bucket(rows), max_records_per_file)


def import_table(
    spark: SparkSession,
    csv_path: str,
    table: TableDef,
    target: StateTable,
    mode: str = "overwrite",
    max_records_per_file: int = 0,
) -> StateTable:
    """Load one text table into a state table.

    ``upsert`` (second and later loads) keeps, per key, the row with the greater version
    column of the two loads; only buckets the load touches are rewritten. ``skip`` leaves a table
    alone that is there, ``resume`` is :func:`import_resumable`. An import that was begun so and not
    finished can only be resumed or overwritten.
    """
    if mode not in IMPORT_MODES:
        raise ValueError(f"mode must be one of {', '.join(IMPORT_MODES)}; got {mode!r}")
    if mode == "resume":
        import_resumable(spark, csv_path, table, target)
        return target
    exists = is_declared(spark, target)
    if mode != "overwrite" and exists and not is_sealed(spark, target):
        raise ValueError(f"an import into {target.path} was not finished; mode 'resume' goes on with it")
    if mode == "skip" and exists:
        return target
    rows = with_bucket(scan_csv(spark, csv_path, table), table.keys, target.buckets, target.bucket_fn)
    if target.delete_mode == "soft":
        rows = with_delete_flags(rows)
    if mode != "upsert" or not exists:
        _load(spark, rows, target, "append" if mode == "append" else "overwrite", max_records_per_file)
        return target
    latest = fold_latest(rows, table.keys, [table.precombine]).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        touched = sorted(r[0] for r in latest.select(BUCKET).distinct().collect())
        state = read_state(spark, target, view="base", buckets=touched)
        replace_buckets(spark, target, replace_older(state, latest, table.keys, table.precombine), touched)
    finally:
        latest.unpersist()
    return target


def is_sealed(spark: SparkSession, target: StateTable) -> bool:
    """Whether no import is unfinished; tables that were not imported in units have none."""
    return is_declared(spark, target) and get_marker(spark, target.imports_path, {"sealed": True})["sealed"]


def _units(files: list[tuple[str, int]], unit_bytes: int) -> list[list[tuple[str, int]]]:
    """Files in the order of their names, as many together as fit ``unit_bytes``, or one that does not fit."""
    units: list[list[tuple[str, int]]] = []
    room = 0
    for name, size in files:
        if not units or size > room:
            units.append([])
            room = unit_bytes
        units[-1].append((name, size))
        room -= size
    return units


def import_resumable(
    spark: SparkSession,
    csv_path: str,
    table: TableDef,
    target: StateTable,
    unit_bytes: int = 64 << 30,
    max_units: int | None = None,
) -> bool:
    """Load a text file, or all files of a folder, each exactly once; whether the import is now finished.

    Files are loaded in units of up to ``unit_bytes`` (a larger file is a unit), one Spark job each. Run again after a crash, or after
    ``max_units`` units, it loads the files that are left. Loaded files must still be there with
    the sizes they had, else the import is refused; files that came since are loaded too. A sealed table is left
    alone. The driver holds names and sizes of the files and the names of a unit's output files.
    """
    exists = is_declared(spark, target)
    if exists and is_sealed(spark, target):
        return True
    files = files_in(spark, csv_path)
    if not files:
        raise ValueError(f"no files at {csv_path}")
    manifest = get_marker(spark, target.imports_path) if exists else None
    if manifest is None:
        manifest = {"source": csv_path, "loaded": {}, "sealed": False}
        empty = with_bucket(scan_csv(spark, csv_path, table).limit(0), table.keys, target.buckets, target.bucket_fn)
        empty = with_delete_flags(empty) if target.delete_mode == "soft" else empty
        replace_table(spark, target, empty, markers={target.imports_path: manifest})
    if manifest["source"] != csv_path:
        raise ValueError(f"the import into {target.path} was begun from {manifest['source']}")
    found, loaded = dict(files), manifest["loaded"]
    if changed := sorted(name for name, size in loaded.items() if found.get(name) != size):
        raise ValueError(f"loaded files have changed or are gone: {', '.join(changed[:5])}")
    units = _units([f for f in files if f[0] not in loaded], unit_bytes)
    for unit in units[:max_units]:
        rows = scan_csv(spark, [name for name, _ in unit], table)
        rows = with_bucket(rows, table.keys, target.buckets, target.bucket_fn)
        if target.delete_mode == "soft":
            rows = with_delete_flags(rows)
        staged = staging(spark, target.base_path)
        rebalance_by_bucket(rows).write.partitionBy(BUCKET).parquet(f"{staged}/rows")
        folders = [f for f in names_in(spark, f"{staged}/rows") if f.startswith(f"{BUCKET}=")]
        parts = [f"{f}/{name}" for f in folders for name in names_in(spark, f"{staged}/rows/{f}")]
        manifest = manifest | {"loaded": manifest["loaded"] | dict(unit)}
        moves = [(f"{staged}/rows/{part}", f"{target.base_path}/{part}") for part in parts]
        decide(spark, target.base_path, moves, {target.imports_path: manifest}, [target.stats_path])
    if max_units is not None and len(units) > max_units:
        return False
    set_marker(spark, target.imports_path, manifest | {"sealed": True})
    return True


def import_all(
    spark: SparkSession,
    benchmark: str,
    csv_root: str,
    target_root: str,
    tables: Iterable[str] | None = None,
    buckets: int = 16,
    bucket_fn: str = "xxhash64",
    mode: str = "skip",
) -> dict[str, StateTable]:
    """Load the tables of a benchmark one after the other; each load uses the whole cluster.

    The default mode leaves tables alone that are already there; ``resume`` goes on with one that is unfinished.
    """
    wanted = {t.strip().lower() for t in tables} if tables else None
    done = {}
    for name in list_tables(benchmark):
        if wanted is not None and name not in wanted:
            continue
        table = require(benchmark, name)
        target = StateTable(f"{target_root.rstrip('/')}/{name}", table.keys, buckets, bucket_fn)
        done[name] = import_table(spark, f"{csv_root.rstrip('/')}/{table.file}", table, target, mode)
    return done
