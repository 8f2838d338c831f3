"""Running sums by key that hold for a key of any size: ranges are summed apart and joined at their edges."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.storage import stored

_WRAP = 1 << 64


def powers(base: int, exponents: np.ndarray) -> np.ndarray:
    """``base`` to each exponent (at least 0) modulo 2**64."""
    left = exponents.astype(np.uint64)
    out, square = np.ones(len(left), np.uint64), base % _WRAP
    while left.any():
        odd = (left & np.uint64(1)).astype(bool)
        out[odd] *= np.uint64(square)
        left >>= np.uint64(1)
        square = square * square % _WRAP
    return out


def _within_task(key_at: str, value_at: Sequence[str], base: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, row, first = TaskContext.get().partitionId(), 0, None
        key, count, sums = None, 0, [0] * len(value_at)
        for batch in batches:
            if not len(batch):
                continue
            keys = batch[key_at].to_numpy()
            first = keys[0] if first is None else first
            starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            group = np.repeat(np.arange(len(starts)), np.diff([*starts, len(keys)]))
            at = np.arange(len(keys)) - starts[group]
            goes_on = (group == 0) & (key is not None and keys[0] == key)
            index = at + np.where(goes_on, count, 0)
            columns = {n: batch[n] for n in batch.schema.names}
            new = []
            for name, before in zip(value_at, sums):
                term = columns[name].to_numpy().astype(np.uint64)
                if base != 1:
                    term = term * powers(base, index)
                total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(term)])
                total = total[1:] - total[starts[group]] + np.where(goes_on, np.uint64(before), np.uint64(0))
                columns[name] = pa.array(total.astype(np.int64))
                new.append(int(total[-1]))
            key, count, sums = keys[-1], int(index[-1]) + 1, new
            columns["__index"] = pa.array(index + 1)
            columns["__task"] = pa.array(np.full(len(keys), task, np.int32))
            columns["__row"] = pa.array(row + np.arange(len(keys)))
            columns["__first"] = pa.array(keys == first)
            row += len(keys)
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return run


def _with_carry(carry: dict[int, tuple], value_at: Sequence[str], base: int):
    tasks = np.array(sorted(carry), np.int32)
    counts = np.array([carry[t][0] for t in tasks.tolist()], np.int64)
    before = [np.array([carry[t][1][i] for t in tasks.tolist()], np.uint64) for i in range(len(value_at))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {n: batch[n] for n in batch.schema.names}
            task = columns.pop("__task").to_numpy()
            first = columns.pop("__first").to_numpy(zero_copy_only=False)
            del columns["__row"]
            at = np.minimum(np.searchsorted(tasks, task), max(len(tasks) - 1, 0))
            has = np.flatnonzero(first & (tasks[at] == task)) if len(tasks) else np.zeros(0, np.int64)
            if len(has):
                at = at[has]
                for name, sums in zip(value_at, before):
                    value = columns[name].to_numpy().astype(np.uint64)
                    scale = powers(base, counts[at]) if base != 1 else np.uint64(1)
                    value[has] = value[has] * scale + sums[at]
                    columns[name] = pa.array(value.astype(np.int64))
                index = columns["__index"].to_numpy().copy()
                index[has] += counts[at]
                columns["__index"] = pa.array(index)
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return run


def running_sums(
    rows: DataFrame, key: str, order_by: Sequence[Column], values: Sequence[str], base: int = 1
) -> DataFrame:
    """Replace ``values`` (long, not null) by their running sums in every key's order; adds ``__index`` from 1.

    The i-th value of a key, from 0, is multiplied by ``base ** i``; sums are modulo 2**64. ``key`` is
    long and not null. Rows equal in the order come anyhow. ``rows`` should be cheap to make, since
    they are sampled for ranges first.

    Ranges of (key, order) are summed by themselves, so a key of any number of rows is spread over
    tasks. The driver gets one row per task: the sums at the end of its first and its last key.
    """
    rows = rows.withColumn("__tie", F.monotonically_increasing_id())
    order = [F.col(key), *order_by, F.col("__tie")]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("__tie")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranged.schema.fields)
    local = ranged.mapInArrow(
        _within_task(key, values, base), f"{kinds}, __index long, __task int, __row long, __first boolean"
    )
    local = stored(local, "running-ranges")
    state = F.struct(key, "__index", *values)
    ends = local.groupBy("__task").agg(
        F.max_by(state, F.when(F.col("__first"), F.col("__row"))).alias("first"), F.max_by(state, "__row").alias("last")
    )
    carry, open_key, count, sums = {}, None, 0, [0] * len(values)
    for row in sorted(ends.collect(), key=lambda r: r["__task"]):
        first, last = row["first"], row["last"]
        if open_key == first[0]:
            carry[row["__task"]] = (count, sums)
            if last[0] == first[0]:
                scale = pow(base, count, _WRAP)
                sums = [(s + scale * v) % _WRAP for s, v in zip(sums, first[2:])]
                count += first[1]
                continue
        open_key, count, sums = last[0], last[1], [v % _WRAP for v in last[2:]]
    return local.mapInArrow(_with_carry(carry, values, base), f"{kinds}, __index long")
