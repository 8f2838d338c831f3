"""Best-fit packing of token pieces into windows, by partitions first and then up a tree of underfull windows.

Every task packs its pieces in runs of a bounded number: longest first, each into the fullest window
that still has room. Windows that are nearly full are done. The others become items of their filled
length and go to fewer tasks, which pack them the same way, until one run holds all that is left or
nothing fits together any more. Only windows move in these rounds; a piece learns its final place
from a table with one row for every window that was underfull.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.storage import stored
from tidemark.llm.tokens import encoder

#: Pieces (or underfull windows) that are packed together, and bytes of their rows.
RUN_ROWS = 1 << 16
RUN_BYTES = 1 << 26

#: Tasks whose underfull windows go to one task of the next round.
FAN_IN = 8


def _cut(path: str, window: int, end_id: int, text_at: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        for batch in batches:
            names = [n for n in batch.schema.names if n != text_at]
            for lo in range(0, len(batch), 256):
                texts = [t or "" for t in batch[text_at].slice(lo, 256).to_pylist()]
                row, start, length, raw = [], [], [], []
                for i, ids in enumerate(encode(texts), lo):
                    ids += end_id.to_bytes(4, "little")
                    for at in range(0, len(ids), 4 * window):
                        piece = ids[at : at + 4 * window]
                        row.append(i)
                        start.append(at // 4)
                        length.append(len(piece) // 4)
                        raw.append(piece)
                first = np.array(start, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch[n].take(pa.array(row)) for n in names),
                        pa.array((first // window).astype(np.int32)),
                        pa.array(first),
                        pa.array(length, pa.int64()),
                        pa.array(raw, pa.binary()),
                    ],
                    [*names, "piece", "start", "length", "ids"],
                )

    return run


def cut_long_texts(
    docs: DataFrame, tokenizer: str, window: int = 2048, end_id: int = 0, text_col: str = "text"
) -> DataFrame:
    """One piece per text of at most ``window`` ids, several for a longer one; other columns of ``docs`` stay.

    ``tokenizer`` is a tokenizer file that every executor has. A text's ids end with ``end_id``; a null
    or empty text is that id alone. Adds ``piece`` (from 0), ``start``, ``length`` and ``ids``
    (little-endian unsigned 32-bit), replacing columns of these names. Every row is a text of its own,
    whatever its other columns hold; an empty table gives no rows.
    """
    docs = docs.drop("piece", "start", "length", "ids")
    others = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name != text_col]
    out = ", ".join([*others, "piece int, start long, length long, ids binary"])
    return docs.mapInArrow(_cut(tokenizer, window, end_id, text_col), out)


def best_fit(sizes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit decreasing: the bin and the offset of every size, and the fill of every bin.

    Bins are numbered by their first item, largest first; sizes are 1 to ``window``.
    """
    order = np.argsort(-sizes, kind="stable")
    bins, offsets = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    room: list[int] = []
    # Open bins by the room they have left, and a bit for every room that some bin has.
    having: list[list[int]] = [[] for _ in range(window + 1)]
    some = 0
    for i, size in zip(order.tolist(), sizes[order].tolist()):
        fits = some >> size
        if fits:
            left = size + (fits & -fits).bit_length() - 1
            chosen = having[left].pop()
            if not having[left]:
                some ^= 1 << left
        else:
            left, chosen = window, len(room)
            room.append(window)
        bins[i], offsets[i] = chosen, window - left
        left -= size
        room[chosen] = left
        if left:
            having[left].append(chosen)
            some |= 1 << left
    return bins, offsets, window - np.array(room, np.int64)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows of a task in tables of bounded size."""
    held, rows, size = [], 0, 0
    for batch in batches:
        step = max(1, min(RUN_ROWS, RUN_BYTES * len(batch) // max(batch.nbytes, 1)))
        for lo in range(0, len(batch), step):
            part = batch.slice(lo, step)
            if held and (rows + len(part) > RUN_ROWS or size + part.nbytes > RUN_BYTES):
                yield pa.Table.from_batches(held)
                held, rows, size = [], 0, 0
            held.append(part)
            rows += len(part)
            size += part.nbytes
    if held:
        yield pa.Table.from_batches(held)


def _pack_pieces(window: int):
    """Rows with ``__bin`` (a number no other task gives), ``offset`` and ``__fill``, the final fill of the bin."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bin_id = TaskContext.get().partitionId() << 40
        for table in _runs(batches):
            bins, offsets, fill = best_fit(table["__size"].to_numpy(), window)
            table = table.drop_columns("__size")
            for name, values in (("__bin", bin_id + bins), ("offset", offsets), ("__fill", fill[bins])):
                table = table.append_column(name, pa.array(values))
            bin_id += len(fill)
            yield from table.to_batches()

    return run


def _pack_bins(window: int):
    """Each bin with the first one of its new bin as ``__root``, its offset there and the new fill."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches):
            ids, sizes = table["__bin"].to_numpy(), table["__fill"].to_numpy()
            bins, offsets, fill = best_fit(sizes, window)
            first = np.empty(len(fill), np.int64)
            first[bins[offsets == 0]] = ids[offsets == 0]
            new = [ids, first[bins], offsets, fill[bins]]
            yield pa.RecordBatch.from_arrays(list(map(pa.array, new)), ["__bin", "__root", "__shift", "__fill"])

    return run


def pack_best_fit(pieces: DataFrame, window: int = 2048, slack: int | None = None, length_col: str = "length") -> DataFrame:
    """Give every piece a ``sequence_id`` (any distinct numbers) and an ``offset`` in it; all columns stay.

    Lengths must be 1 to ``window``; another one (or null) raises. Pieces of a sequence are gapless from
    0 and never exceed the window. A sequence with at most ``slack`` places left (by default a 128th of
    the window) is not opened again. Columns of the two names are replaced (and none may begin with
    ``__``); equal rows are pieces of their own; an empty table gives no rows.

    The driver gets counts only. A task holds one run of pieces, however many it packs.
    """
    slack = window // 128 if slack is None else slack
    pieces = pieces.drop("sequence_id", "offset")
    size = F.col(length_col).cast("long")
    wrong = size.isNull() | (size < 1) | (size > window)
    checked = F.when(wrong, F.raise_error(F.lit(f"piece lengths must be 1 to {window}"))).otherwise(size)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    given = pieces.withColumn("__size", checked.cast("long"))
    # Stored, so that a task that runs again can not number its bins in another way than its readers saw.
    packed = stored(given.mapInArrow(_pack_pieces(window), f"{kinds}, __bin long, offset long, __fill long"), "local-bins")
    underfull = F.col("__fill") < window - slack
    items = stored(packed.where((F.col("offset") == 0) & underfull).select("__bin", "__fill"), "underfull")
    tasks, left, rounds = packed.agg(F.count_distinct(F.shiftright("__bin", 40))).first()[0], items.count(), []
    while left > 1:
        tasks, before = max(-(-tasks // FAN_IN), -(-left // RUN_ROWS)), tasks
        merged = items.repartition(tasks).mapInArrow(
            _pack_bins(window), "__bin long, __root long, __shift long, __fill long"
        )
        merged = stored(merged, "merged-bins")
        rounds.append(merged.select("__bin", "__root", "__shift"))
        items = merged.where((F.col("__shift") == 0) & underfull).select("__bin", "__fill")
        left, had = items.count(), left
        if tasks == 1 or (tasks == before and left > 0.99 * had):
            break
    if not rounds:
        return packed.withColumn("sequence_id", F.col("__bin")).select(*pieces.columns, "sequence_id", "offset")

    def followed(later: DataFrame, earlier: DataFrame) -> DataFrame:
        """Where bins of an earlier round are after the later ones."""
        moved = later.toDF("__root", "__to", "__by")
        return earlier.join(moved, "__root", "left").select(
            "__bin",
            F.coalesce("__to", "__root").alias("__root"),
            (F.col("__shift") + F.coalesce("__by", F.lit(0))).alias("__shift"),
        )

    moves = reduce(followed, reversed(rounds))
    placed = packed.join(moves, "__bin", "left")
    return placed.select(
        *pieces.columns,
        F.coalesce("__root", "__bin").alias("sequence_id"),
        (F.col("offset") + F.coalesce("__shift", F.lit(0))).alias("offset"),
    )
