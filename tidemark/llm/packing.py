"""Packing of token pieces into windows by non-negative least squares over length combinations.

Texts are tokenized and cut at whole windows, so only the last piece of a text is shorter. The
histogram of piece lengths is all the solver sees: every combination of up to three lengths that
fills a window exactly is a column, its repeat count an unknown that is at least zero, and the
histogram the right-hand side. Rounded counts are used as far as pieces reach; what is left is
packed greedily, longest first, still on the histogram. Pieces then take their places by length
and rank.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.storage import stored

_PIECES = "start long, length long, doc_tokens long, ids binary"

#: Characters on whose classes all versions of Unicode agree; texts of these may take the faster encoder.
_PLAIN = re.compile(r"[\t\n\r\x20-\x7eÀ-ÖØ-öø-ſ]*")

#: Runs that long are left to the library that splits them without going back: the other gives up on long white space.
_LONG_RUN = re.compile(r"\s{1000}|\S{1000}")


@lru_cache(maxsize=4)
def _encoder(path: str, ranks_path: str | None, pattern: str | None):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(path)
    added = [token.content for token in whole.get_added_tokens_decoder().values()]
    plain = None
    if ranks_path:
        import base64

        import tiktoken

        with open(ranks_path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        plain = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> np.ndarray:
        if (
            plain is not None
            and _PLAIN.fullmatch(text)
            and not _LONG_RUN.search(text)
            and not any(token in text for token in added)
        ):
            return plain.encode_to_numpy(text, disallowed_special=())
        return np.array(whole.encode_batch([text], add_special_tokens=False)[0].ids, np.uint32)

    return encode


def _tokenize(path: str, ranks_path: str | None, pattern: str | None, window: int, end_id: int, text_at: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(path, ranks_path, pattern)
        for batch in batches:
            names = [n for n in batch.schema.names if n != text_at]
            texts = batch[text_at]
            for lo in range(0, len(batch), 256):
                row, start, length, total, raw = [], [], [], [], []
                for i in range(lo, min(lo + 256, len(batch))):
                    ids = np.append(encode(texts[i].as_py() or ""), end_id).astype("<u4")
                    for at in range(0, len(ids), window):
                        piece = ids[at : at + window]
                        row.append(i)
                        start.append(at)
                        length.append(len(piece))
                        total.append(len(ids))
                        raw.append(piece.tobytes())
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch[n].take(pa.array(row)) for n in names),
                        pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()),
                        pa.array(total, pa.int64()),
                        pa.array(raw, pa.binary()),
                    ],
                    [*names, "start", "length", "doc_tokens", "ids"],
                )

    return run


def cut_pieces(
    docs: DataFrame,
    tokenizer: str,
    window: int = 1024,
    end_id: int = 0,
    ranks: str | None = None,
    pattern: str | None = None,
    text_col: str = "text",
) -> DataFrame:
    """Token pieces of every text, at most ``window`` ids each; other columns of ``docs`` stay.

    ``tokenizer`` is a tokenizer file that every executor has. A text's ids end with ``end_id``; a
    null text is that id alone. Adds ``start``, ``length``, ``doc_tokens`` (with the end) and ``ids``
    (little-endian unsigned 32-bit), replacing columns of these names.

    ``ranks`` may name the same vocabulary as a rank file with its split ``pattern``: texts of plain
    Latin characters are then encoded by the faster of two libraries, with the same ids. Texts that hold
    an added token (which is one id) or a run of 1,000 characters with or without white space are not.
    """
    docs = docs.drop("start", "length", "doc_tokens", "ids")
    others = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name != text_col
    )
    run = _tokenize(tokenizer, ranks, pattern, window, end_id, text_col)
    return docs.mapInArrow(run, f"{others}, {_PIECES}" if others else _PIECES)


class Slot(NamedTuple):
    """Pieces ``first .. first + repeats - 1`` of a length go to ``sequence``, ``sequence + 1``, ... at ``offset``."""

    length: int
    first: int
    repeats: int
    sequence: int
    offset: int


def combinations(lengths: Sequence[int], window: int) -> np.ndarray:
    """All one to three lengths (zeros fill up) that add up to the window."""
    have = np.zeros(window + 1, bool)
    have[list(lengths)] = True
    have[0] = True
    grid = np.flatnonzero(have)
    a, b = np.meshgrid(grid, grid, indexing="ij")
    c = window - a - b
    fits = (a >= b) & (b >= c) & (c >= 0)
    a, b, c = a[fits], b[fits], c[fits]
    return np.stack([a, b, c], 1)[have[c]]


def nonnegative_least_squares(columns: np.ndarray, target: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Repeat counts x >= 0 that bring the summed columns near the target: accelerated projected gradients.

    Residuals are weighted by length: a long piece that finds no place costs more padding.
    """
    n = len(target)
    weight = np.arange(n) / n
    weight[0] = 0

    def times(x: np.ndarray) -> np.ndarray:
        return sum(np.bincount(columns[:, i], x, n) for i in range(columns.shape[1])) * weight

    def back(r: np.ndarray) -> np.ndarray:
        r = r * weight
        return r[columns].sum(1)

    probe = np.ones(len(columns))
    for _ in range(20):
        probe = back(times(probe / np.linalg.norm(probe)))
    step = 1 / max(np.linalg.norm(probe), 1e-9)
    goal = target * weight
    x = y = np.zeros(len(columns))
    t = 1.0
    for _ in range(rounds):
        new = np.maximum(y - step * back(times(y) - goal), 0)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x


def plan_slots(histogram: np.ndarray, window: int) -> list[Slot]:
    """Places for ``histogram[l]`` pieces of each length ``l``: at most a few per combination of lengths."""
    left = histogram.astype(np.int64).copy()
    left[0] = 0
    used = np.zeros(window + 1, np.int64)
    slots: list[Slot] = []
    sequence = 0

    def place(parts: list[int], repeats: int) -> None:
        nonlocal sequence
        offset = 0
        for length in parts:
            slots.append(Slot(length, int(used[length]), repeats, sequence, offset))
            used[length] += repeats
            left[length] -= repeats
            offset += length
        sequence += repeats

    if left.any():
        columns = combinations(np.flatnonzero(left).tolist(), window)
        if len(columns):
            counts = np.rint(nonnegative_least_squares(columns, left.astype(float))).astype(np.int64)
            for i in np.argsort(-counts, kind="stable"):
                if counts[i] <= 0:
                    break
                parts = [int(x) for x in columns[i] if x]
                enough = min(left[x] // parts.count(x) for x in parts)
                if repeats := int(min(counts[i], enough)):
                    place(parts, repeats)
    while left.any():
        longest = int(np.flatnonzero(left)[-1])
        parts, space = [longest], window - longest
        while space:
            fits = [x for x in np.flatnonzero(left[: space + 1]) if left[x] > parts.count(x)]
            if not fits:
                break
            parts.append(int(fits[-1]))
            space -= parts[-1]
        place(parts, int(min(left[x] // parts.count(x) for x in set(parts))))
    return slots


def _assign(slots: list[Slot], window: int):
    ordered = sorted(slots)
    key = np.array([s.length for s in ordered], np.int64), np.array([s.first for s in ordered], np.int64)
    base, offset = np.array([s.sequence for s in ordered]), np.array([s.offset for s in ordered])
    start = np.searchsorted(key[0], np.arange(window + 2))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch["__length"].to_numpy(), batch["__rank"].to_numpy()
            at = np.zeros(len(length), np.int64)
            for one in np.unique(length):
                lo, hi = start[one], start[one + 1]
                of = length == one
                at[of] = lo + np.searchsorted(key[1][lo:hi], rank[of], "right") - 1
            names = [n for n in batch.schema.names if not n.startswith("__")]
            yield pa.RecordBatch.from_arrays(
                [*(batch[n] for n in names), pa.array(base[at] + rank - key[1][at]), pa.array(offset[at])],
                [*names, "sequence_id", "offset"],
            )

    return run


def pack_pieces(
    pieces: DataFrame, order_by: Sequence[str], window: int = 1024, length_col: str = "length"
) -> DataFrame:
    """Give every piece a ``sequence_id`` (from 0, without gaps) and an ``offset`` in it; all columns stay.

    Lengths must be 1 to ``window``; another one (or null) raises. Pieces of a sequence are gapless
    from 0 and never exceed the window. ``order_by`` ranks pieces of equal length; ties in it are
    ordered anyhow. Columns of the two names are replaced; an empty table gives no rows.

    The driver gets the histogram (at most ``window`` rows) and one row per task and length that
    the task holds: pieces are spread by ranges of (length, order), so those are at most tasks plus
    lengths, however many pieces share a length.
    """
    pieces = pieces.drop("sequence_id", "offset")
    length = F.col(length_col).cast("long")
    wrong = length.isNull() | (length < 1) | (length > window)
    checked = F.when(wrong, F.raise_error(F.lit(f"piece lengths must be 1 to {window}"))).otherwise(length)
    keys = [F.col(c) for c in order_by]
    # Stored first: the ranges are sampled from the pieces, which would be made twice.
    given = stored(pieces.withColumn("__length", checked.cast("long")), "pieces")
    ranged = given.repartitionByRange("__length", *keys)
    ranged = ranged.sortWithinPartitions("__length", *keys)
    ranged = ranged.withColumn("__task", F.spark_partition_id()).withColumn(
        "__at", F.monotonically_increasing_id() % F.lit(1 << 33)
    )
    ranged = stored(ranged, "ranged-pieces")
    held = ranged.groupBy("__task", "__length").agg(F.count(F.lit(1)).alias("n"), F.min("__at").alias("at")).collect()
    histogram, shift = np.zeros(window + 1, np.int64), []
    for row in sorted(held, key=lambda r: r["__task"]):
        shift.append((row["__task"], row["__length"], int(histogram[row["__length"]]) - row["at"]))
        histogram[row["__length"]] += row["n"]
    shifts = pieces.sparkSession.createDataFrame(shift, "__task int, __length long, __shift long")
    ranked = ranged.join(F.broadcast(shifts), ["__task", "__length"])
    ranked = ranked.withColumn("__rank", F.col("__at") + F.col("__shift"))
    ranked = ranked.select(*pieces.columns, "__length", "__rank")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return ranked.mapInArrow(_assign(plan_slots(histogram, window), window), f"{kinds}, sequence_id long, offset long")


def sequences_in_order(packed: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """Number the sequences of packed pieces anew, by the first of their pieces in ``order_by``.

    Ids stay 0 to n - 1 and pieces keep their sequence and offset. Sequences whose first pieces are
    equal in the order are numbered anyhow. The driver gets one row per task.
    """
    packed = stored(packed, "packed-pieces")
    first = packed.groupBy("sequence_id").agg(F.min(F.struct(*order_by)).alias("__first"))
    ranged = first.repartitionByRange("__first").sortWithinPartitions("__first").select(
        "sequence_id",
        F.spark_partition_id().alias("__task"),
        (F.monotonically_increasing_id() % F.lit(1 << 33)).alias("__at"),
    )
    ranged = stored(ranged, "ranged-sequences")
    shifts, before = [], 0
    for row in sorted(ranged.groupBy("__task").agg(F.count(F.lit(1)).alias("n")).collect()):
        shifts.append((row["__task"], before))
        before += row["n"]
    shift = packed.sparkSession.createDataFrame(shifts, "__task int, __shift long")
    new = ranged.join(F.broadcast(shift), "__task").select("sequence_id", (F.col("__at") + F.col("__shift")).alias("__new"))
    return packed.join(new, "sequence_id").withColumn("sequence_id", F.col("__new")).select(*packed.columns)
