"""Exact top-k search by inner product, block at a time.

Vectors are laid out in blocks of a range that a locality key orders. Per block and dimension
the smallest and largest component are kept; a query's terms with these maxima, summed, bound
every score in the block. A query takes its blocks in order of that bound, scores each through
the block's forward index (its rows), and stops when the next bound is below its k-th score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Vectors per block and per range of blocks, and queries per group. A task holds one range and one group.
BLOCK_ROWS = 128
RANGE_ROWS = 4096
GROUP_ROWS = 4096

#: Sums of products of whole numbers below this are exact in doubles.
EXACT = float(1 << 53)

_PACKED = "__part int, __n int, __dim int, __ids binary, __rows binary"
_HITS = "query_id long, vec_id long, score long"


def whole_components(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component, computed as double; null unless all are finite."""
    fine = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    # NaN sorts above infinity in comparisons, so it is not fine either.
    return F.when(fine & vector.isNotNull(), F.transform(vector, lambda x: F.floor(x.cast("double") * scale)))


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one partition, in order, as a few rows of raw little-endian numbers, one for each vector length."""
    for batch in batches:
        parts, vectors = batch["__part"].to_numpy(), batch["__vector"]
        ends, values = vectors.offsets.to_numpy(), vectors.values.to_numpy()
        ids, dims = batch["__id"].to_numpy(), np.diff(ends)
        cuts = np.flatnonzero(np.r_[True, (dims[1:] != dims[:-1]) | (parts[1:] != parts[:-1])]) if len(ids) else []
        for lo, hi in zip(cuts, [*cuts[1:], len(ids)], strict=True):
            for at in range(lo, hi, BLOCK_ROWS):
                to = min(at + BLOCK_ROWS, hi)
                yield pa.RecordBatch.from_pylist(
                    [{
                        "__part": int(parts[at]), "__n": to - at, "__dim": int(dims[at]),
                        "__ids": ids[at:to].tobytes(), "__rows": values[ends[at] : ends[to]].tobytes(),
                    }],
                    schema=pa.schema([("__part", pa.int32()), ("__n", pa.int32()), ("__dim", pa.int32()),
                                      ("__ids", pa.binary()), ("__rows", pa.binary())]),
                )


def _unpack(frame: pd.DataFrame, dim: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Ids and rows of each block; shorter vectors are filled up with zeros."""
    ids, rows = [], []
    for n, own, raw_ids, raw in zip(frame["__n"], frame["__dim"], frame["__ids"], frame["__rows"], strict=True):
        block = np.zeros((n, dim), np.int64)
        block[:, :own] = np.frombuffer(raw, np.int64).reshape(n, own)
        ids.append(np.frombuffer(raw_ids, np.int64))
        rows.append(block)
    return ids, rows


def search_blocks(
    query_ids: np.ndarray, queries: np.ndarray, ids: list[np.ndarray], rows: list[np.ndarray], k: int
) -> tuple[np.ndarray, np.ndarray, int]:
    """Per query the ids and scores of its best ``k`` rows (best first; -1 where there are fewer).

    Also returns the number of (query, block) pairs that were scored.
    """
    top = max((float(np.abs(x).max(initial=0)) for x in [queries, *rows]), default=0.0)
    kind = np.float64 if top * top * max(1, queries.shape[1]) < EXACT else np.int64
    worst = np.iinfo(np.int64).min + 1  # its negative is a number of the kind, too
    queries, rows = queries.astype(kind), [x.astype(kind) for x in rows]
    low, high = np.array([x.min(0) for x in rows]), np.array([x.max(0) for x in rows])
    bound = np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T
    order = np.argsort(-bound, axis=1, kind="stable")
    ranked = np.take_along_axis(bound, order, 1)
    best_ids = np.full((len(queries), k), np.iinfo(np.int64).max)
    best = np.full((len(queries), k), worst)
    scored = 0
    for step in range(len(rows)):
        # A block whose bound equals the k-th score may hold a smaller id of that score.
        active = np.flatnonzero((best_ids[:, -1] == np.iinfo(np.int64).max) | (ranked[:, step] >= best[:, -1]))
        if not len(active):
            break
        scored += len(active)
        chosen = order[active, step]
        by_block = np.argsort(chosen, kind="stable")
        cuts = np.flatnonzero(np.r_[True, np.diff(chosen[by_block]) != 0])
        for lo, hi in zip(cuts, [*cuts[1:], len(by_block)], strict=True):
            who, block = active[by_block[lo:hi]], chosen[by_block[lo]]
            score = (queries[who] @ rows[block].T).astype(np.int64)
            own = ids[block][None, :] == query_ids[who][:, None]
            all_scores = np.concatenate([best[who], np.where(own, worst, score)], 1)
            all_ids = np.concatenate(
                [best_ids[who], np.where(own, np.iinfo(np.int64).max, ids[block][None, :])], 1
            )
            first = np.lexsort((all_ids, -all_scores.astype(kind)), axis=1)[:, :k]
            best[who] = np.take_along_axis(all_scores, first, 1)
            best_ids[who] = np.take_along_axis(all_ids, first, 1)
    return np.where(best_ids == np.iinfo(np.int64).max, -1, best_ids), best, scored


def _search(k: int):
    def run(blocks: pd.DataFrame, groups: pd.DataFrame) -> pd.DataFrame:
        if not len(blocks) or not len(groups):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
        dim = int(max(blocks["__dim"].max(), groups["__dim"].max(), 1))
        ids, rows = _unpack(blocks, dim)
        query_ids, queries = _unpack(groups, dim)
        query_ids, queries = np.concatenate(query_ids), np.concatenate(queries)
        found, scores, _ = search_blocks(query_ids, queries, ids, rows, k)
        real = found >= 0
        who = np.repeat(query_ids, k).reshape(found.shape)
        return pd.DataFrame({"query_id": who[real], "vec_id": found[real], "score": scores[real]})

    return run


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    scale: int = 256,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """The ``k`` rows with the highest inner product for every query row, by whole-number components.

    A query never finds rows with its own id; ties go to the smaller id. Returns ``query_id``,
    ``rank`` (from 1), ``vec_id`` and ``score``; with fewer candidates than ``k``, all of them.
    Vectors that are null or hold null or non-finite components, and rows without an id, take no
    part. Missing components of shorter vectors count as zero. Rows that repeat an id are
    candidates each; as queries they give one list, that of one of them if their vectors differ.

    Rows are spread evenly by range over (locality key, id), so equal vectors fill no single
    task. Each range of blocks meets each group of queries in one task of bounded size; what is
    left after that is at most ``k`` rows per query and range.
    """
    spark = vectors.sparkSession
    whole = vectors.select(
        F.col(id_col).cast("long").alias("__id"),
        whole_components(F.col(vector_col), scale).alias("__vector"),
        F.coalesce(is_query, F.lit(False)).alias("__query"),
    ).where(F.col("__id").isNotNull() & F.col("__vector").isNotNull())
    rows = whole.count()
    parts = max(1, -(-rows // RANGE_ROWS))
    # Vectors with the same largest components in size are near each other: their blocks have narrow ranges.
    peak = F.array_max(F.transform("__vector", lambda x, i: F.struct(F.abs(x).alias("size"), i.alias("at"), x.alias("x"))))
    keyed = whole.withColumn("__peak", peak).select(
        "__id", "__vector", "__query",
        F.coalesce(F.col("__peak.at") * 2 + F.when(F.col("__peak.x") > 0, 1).otherwise(0), F.lit(-1)).alias("__near"),
    )
    size = F.size("__vector")
    ranged = keyed.repartitionByRange(parts, size, F.col("__near"), F.col("__id"))
    ranged = ranged.sortWithinPartitions(size, "__near", "__id")
    packed = ranged.select(F.spark_partition_id().alias("__part"), "__id", "__vector").mapInArrow(_pack, _PACKED)
    asked = keyed.where("__query").dropDuplicates(["__id"])
    groups = max(1, -(-asked.count() // GROUP_ROWS))
    group = F.pmod(F.xxhash64("__id"), F.lit(groups)).cast("int")
    queries = asked.select(group.alias("__group"), "__id", "__vector")
    # A query row for every range: the stated query set against all rows, in blocks.
    dealt = queries.select("__group", "__id", "__vector", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("__part"))
    block_side = packed.select("*", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("__group"))
    query_side = dealt.select(
        "__part", "__group", F.lit(1).alias("__n"), F.size("__vector").alias("__dim"),
        F.struct("__id", "__vector").alias("__one"),
    )
    hits = block_side.groupBy("__part", "__group").cogroup(query_side.groupBy("__part", "__group")).applyInPandas(
        _joined(_search(k)), _HITS
    )
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _joined(search):
    """Query rows arrive as plain rows; blocks of queries are made from them."""

    def run(blocks: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if len(queries):
            one = queries["__one"]
            queries = queries.assign(
                __ids=[np.array([x["__id"]], np.int64).tobytes() for x in one],
                __rows=[np.asarray(x["__vector"], np.int64).tobytes() for x in one],
            )
        return search(blocks, queries)

    return run
