"""Replacing parts of a stored table so that a crash at any point loses and doubles nothing.

New rows are written to a folder beside the table. When they are all there, a small file that is
renamed into place says what is to change: directories to put in the place of old ones, markers to
set, folders to delete. From then on the change is decided. Its steps can be done any number of
times, so whoever comes next, reader or writer, finishes them; before that file is there, nothing
has changed. One writer at a time may work on a table.

A marker is a folder of numbered files with a JSON value each; the newest whole one counts.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

from tidemark.names import BUCKET


@lru_cache(maxsize=1)
def _path_class(jvm):
    # Looked up once: each part of a dotted name is a search of the whole class path.
    return getattr(jvm, "org.apache.hadoop.fs.Path")


def _at(spark: SparkSession, path: str):
    """The file system of a path, and the path for it."""
    target = _path_class(spark._jvm)(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def is_local(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is on a file system that this machine mounts."""
    return _at(spark, path)[0].getScheme() == "file"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on the file system its scheme names."""
    files, target = _at(spark, path)
    return files.exists(target)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, if it is there."""
    files, target = _at(spark, path)
    if files.exists(target):
        files.delete(target, True)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it does not exist."""
    files, target = _at(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(target)) if files.exists(target) else []


def files_in(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Path and size of a file, or of the data files right in a folder, by name."""
    files, target = _at(spark, path)
    if not files.exists(target):
        return []
    found = [(s.getPath(), s.getLen()) for s in files.listStatus(target) if s.isFile()]
    return sorted((p.toString(), size) for p, size in found if not p.getName().startswith(("_", ".")))


def numbers_in(spark: SparkSession, path: str, column: str) -> list[int]:
    """Values of the partition directories ``column=number`` in a folder."""
    split = [name.partition("=") for name in names_in(spark, path)]
    return sorted(int(number) for name, _, number in split if name == column)


def _move(spark: SparkSession, source: str, target: str) -> None:
    files, old = _at(spark, source)
    new = _at(spark, target)[1]
    files.mkdirs(new.getParent())
    if not files.rename(old, new):
        raise OSError(f"cannot move {source} to {target}")


def _write_json(spark: SparkSession, path: str, value) -> None:
    """Write a file that is there as a whole or not at all."""
    half = f"{path}.{uuid.uuid4().hex[:8]}.tmp"
    files, target = _at(spark, half)
    stream = files.create(target, True)
    stream.write(bytearray(json.dumps(value).encode()))
    stream.close()
    _move(spark, half, path)


def _read_json(spark: SparkSession, path: str):
    files, target = _at(spark, path)
    stream = files.open(target)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def set_marker(spark: SparkSession, folder: str, value) -> None:
    """Make ``value`` the marker's newest; older files go afterwards."""
    old = [n for n in names_in(spark, folder) if n.endswith(".json")]
    number = max((int(n.partition(".")[0]) for n in old), default=-1) + 1
    _write_json(spark, f"{folder}/{number:08d}.json", value)
    for name in old:
        delete_path(spark, f"{folder}/{name}")


def get_marker(spark: SparkSession, folder: str, default=None):
    """The marker's newest value."""
    whole = [n for n in names_in(spark, folder) if n.endswith(".json")]
    return _read_json(spark, f"{folder}/{whole[-1]}") if whole else default


def _staged(base: str) -> str:
    return f"{base.rstrip('/')}_staged"


def replace(
    spark: SparkSession,
    base: str,
    rows: DataFrame,
    buckets: Sequence[int] | None = None,
    markers: dict | None = None,
    delete: Sequence[str] = (),
    max_records_per_file: int = 0,
) -> None:
    """Make ``rows`` the whole content of some buckets (those the rows have, if None is given, are all there are).

    With ``buckets``, other buckets stay as they are and a listed one without rows becomes empty. Markers
    (folder to value, or to a function that gives it once the rows are written) are set and paths are
    deleted in the same step.
    """
    finish(spark, base)
    staged = _staged(base)
    delete_path(spark, staged)  # what an attempt left that was not decided
    writer = rows.write.partitionBy(BUCKET)
    if max_records_per_file > 0:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.parquet(f"{staged}/rows")
    filled = numbers_in(spark, f"{staged}/rows", BUCKET)
    plan = {
        "whole": buckets is None,
        "filled": filled,
        "emptied": sorted(set(buckets or ()) - set(filled)),
        "markers": {folder: value() if callable(value) else value for folder, value in (markers or {}).items()},
        "delete": list(delete),
    }
    _write_json(spark, f"{staged}/plan.json", plan)
    finish(spark, base)


def staging(spark: SparkSession, base: str) -> str:
    """An empty folder to write in what :func:`decide` is to put in place."""
    finish(spark, base)
    delete_path(spark, _staged(base))
    return _staged(base)


def decide(
    spark: SparkSession,
    base: str,
    moves: Sequence[Sequence[str]],
    markers: dict | None = None,
    delete: Sequence[str] = (),
) -> None:
    """Move files or folders from the staging folder to their places, whatever was there, set markers and delete paths, in one step."""
    plan = {"whole": False, "filled": [], "emptied": [], "moves": [list(m) for m in moves]}
    _write_json(spark, f"{_staged(base)}/plan.json", plan | {"markers": markers or {}, "delete": list(delete)})
    finish(spark, base)


def finish(spark: SparkSession, base: str) -> None:
    """Do what is left of a decided change; without one, nothing."""
    staged = _staged(base)
    if not path_exists(spark, f"{staged}/plan.json"):
        return
    plan = _read_json(spark, f"{staged}/plan.json")
    if plan["whole"]:
        if path_exists(spark, f"{staged}/rows"):
            delete_path(spark, base)
            _move(spark, f"{staged}/rows", base)
    else:
        for bucket in plan["filled"]:
            if path_exists(spark, source := f"{staged}/rows/{BUCKET}={bucket}"):  # else it was moved before
                delete_path(spark, f"{base}/{BUCKET}={bucket}")
                _move(spark, source, f"{base}/{BUCKET}={bucket}")
        for bucket in plan["emptied"]:
            delete_path(spark, f"{base}/{BUCKET}={bucket}")
    for source, target in plan.get("moves", ()):
        if path_exists(spark, source):  # else it was moved before
            delete_path(spark, target)
            _move(spark, source, target)
    for folder, value in plan["markers"].items():
        set_marker(spark, folder, value)
    for path in plan["delete"]:
        delete_path(spark, path)
    delete_path(spark, f"{staged}/plan.json")
    delete_path(spark, staged)
