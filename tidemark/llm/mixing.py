"""Interleaving of sources to target weights by Pfair scheduling.

Every source is cut into blocks of documents. With weight ``w`` (a share of all slots), block
``j`` of a source (from 0) is released at slot ``floor(j / w)`` and due before slot
``ceil((j + 1) / w)``; each slot goes to the released block with the earliest deadline. In every
prefix of the slots a source then has its share to within less than one block.

Weights are whole shares of a period, so the schedule repeats with it: one period is worked
out on the driver from the weights alone, and the documents are placed by arithmetic. When a
source has no block left, a new phase begins with the weights of the others.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.storage import stored
from tidemark.operators.fold import ranking

#: Slots of a period, at least; more when there are many sources.
PERIOD = 1024

#: Documents of a source that are numbered in one task.
RUN_ROWS = 1 << 11

#: Most slots of all patterns together that are sent to every task (16 MB); a longer plan is joined by a shuffle.
PLAN_SLOTS = 1 << 22


class Phase(NamedTuple):
    """A stretch of the schedule with fixed shares: block ``first + j`` of a source has slot
    ``base + (j // share) * period + pattern[j % share]``."""

    base: int
    source: str
    first: int
    last: int
    share: int
    period: int
    pattern: list[int]


def whole_shares(weights: Mapping[str, float], period: int) -> dict[str, int]:
    """Shares of ``period`` slots nearest to the weights, at least 1 each, with the period as their sum."""
    total = sum(weights.values())
    exact = {s: w / total * period for s, w in weights.items()}
    shares = {s: max(1, int(x)) for s, x in exact.items()}
    for step, sign in ((sum(shares.values()) > period, -1), (True, 1)):
        # Largest remainders first; taking away, the sources that are most above their weight.
        while step and (sum(shares.values()) - period) * sign < 0:
            best = max((s for s in shares if sign > 0 or shares[s] > 1), key=lambda s: (sign * (exact[s] - shares[s]), s))
            shares[best] += sign
    return shares


def edf_pattern(shares: Mapping[str, int], period: int) -> dict[str, list[int]]:
    """Slots of each source's blocks in one period: earliest deadline first among released blocks."""
    waiting = [(0, -(-period // share), source, 0) for source, share in shares.items()]
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int]] = []
    slots: dict[str, list[int]] = {source: [] for source in shares}
    for slot in range(period):
        while waiting and waiting[0][0] <= slot:
            _, deadline, source, j = heapq.heappop(waiting)
            heapq.heappush(ready, (deadline, source, j))
        deadline, source, j = heapq.heappop(ready)
        slots[source].append(slot)
        if j + 1 < shares[source]:
            release, due = (j + 1) * period // shares[source], -(-(j + 2) * period // shares[source])
            heapq.heappush(waiting, (release, due, source, j + 1))
    return slots


def plan_phases(blocks: Mapping[str, int], weights: Mapping[str, float], period: int = PERIOD) -> list[Phase]:
    """The whole schedule: at most one phase for each source that runs out."""
    left, done, base, phases = {s: n for s, n in blocks.items() if n}, dict.fromkeys(blocks, 0), 0, []
    while left:
        size = max(period, 1 << (16 * len(left) - 1).bit_length())
        shares = whole_shares({s: weights[s] for s in left}, size)
        pattern = edf_pattern(shares, size)
        ends = {s: (n - 1) // shares[s] * size + pattern[s][(n - 1) % shares[s]] + 1 for s, n in left.items()}
        length = min(ends.values())
        for s in sorted(left):
            taken = length // size * shares[s] + bisect_left(pattern[s], length % size)
            if taken:
                phases.append(Phase(base, s, done[s], done[s] + taken - 1, shares[s], size, pattern[s]))
            done[s] += taken
            left[s] -= taken
        left = {s: n for s, n in left.items() if n}
        base += length
    return phases


def power_weights(counts: Mapping[str, int], power: float = 0.5) -> dict[str, float]:
    """Target weights in proportion to a power of each source's size: below 1, small sources gain."""
    return {s: n**power for s, n in counts.items()}


def mix_sources(
    docs: DataFrame,
    weights: Mapping[str, float] | None = None,
    block_rows: int = 16,
    power: float = 0.5,
    id_col: str = "doc_id",
    source_col: str = "source",
) -> DataFrame:
    """Place every document in a sequence that keeps the sources' target weights.

    Within a source, documents are in hash order of their id (ties by id), those without an id in that
    of all their other columns, cut into blocks of ``block_rows``; the last block may be shorter. ``weights`` gives each source's share; without
    it, shares follow the source's size to the ``power``. Weights must be positive and name
    every source. Adds ``block`` (from 0 in its source), ``release``, ``deadline`` (of the block,
    as slots), ``slot`` (no slot is empty) and ``place`` (in the block) to the columns of ``docs``;
    columns of these names are replaced. Nothing is dropped or repeated.

    Documents without a source form a source of their own, named by null (in ``weights``: ""). Rows
    that are equal in id, or have none and are equal in all columns, are ordered anyhow. An empty table
    gives no rows.

    The driver sees one count per source, and works on one period per source that runs out: with
    ``n`` sources of different length, about ``16 * n ** 2`` slots. Sources are meant to be a list
    that people weigh, of up to about a thousand. The plan is broadcast up to ``PLAN_SLOTS``. A
    source is numbered in runs of about ``RUN_ROWS`` documents by ranges of the hash, so that no
    task holds a large source.
    """
    docs = docs.drop("block", "release", "deadline", "slot", "place")
    name = F.coalesce(F.col(source_col).cast("string"), F.lit(""))
    counts = {r["s"]: r["n"] for r in docs.groupBy(name.alias("s")).agg(F.count(F.lit(1)).alias("n")).collect()}
    if weights is None:
        weights = power_weights(counts, power)
    if unknown := [s for s in counts if weights.get(s, 0) <= 0]:
        raise ValueError(f"no positive weight for sources {sorted(unknown)[:5]}")
    blocks = {s: -(-n // block_rows) for s, n in counts.items()}
    phases = plan_phases(blocks, weights)

    others = [F.col(c) for c in ranking(docs, [id_col], [])]
    hashed = F.when(F.col(id_col).isNull(), F.xxhash64(*others)).otherwise(F.xxhash64(F.col(id_col)))
    spark = docs.sparkSession
    sizes = spark.createDataFrame(
        [(s, max(1, -(-n // RUN_ROWS))) for s, n in counts.items()], "__source string, __runs int"
    )
    # One row per source, as the driver has counted them.
    keyed = docs.withColumn("__source", name).withColumn("__key", F.shiftrightunsigned(hashed, 33))
    keyed = keyed.join(F.broadcast(sizes) if len(counts) < PLAN_SLOTS // 64 else sizes, "__source")
    keyed = keyed.withColumn("__run", F.floor(F.col("__key") * F.col("__runs") / F.lit(1 << 31)).cast("int"))
    # A row per run: the documents of the source before it.
    runs = keyed.groupBy("__source", "__run").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("__source").orderBy("__run").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.select("__source", "__run", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    starts = stored(starts, "source-runs")
    in_run = Window.partitionBy("__source", "__run").orderBy("__key", id_col)
    placed = keyed.withColumn("__at", F.row_number().over(in_run) - 1).join(starts, ["__source", "__run"])
    at = F.col("__before") + F.col("__at")
    placed = placed.withColumns({"block": F.floor(at / block_rows).cast("long"), "place": (at % block_rows).cast("int")})
    return _scheduled(placed, phases).drop("__source", "__key", "__runs", "__run", "__at", "__before")


def _scheduled(placed: DataFrame, phases: list[Phase]) -> DataFrame:
    """Slot, release and deadline of each row's block, from the phases of its source."""
    spark = placed.sparkSession
    by_source: dict[str, list[Phase]] = {}
    for phase in phases:
        by_source.setdefault(phase.source, []).append(phase)
    rows = [(s, [tuple(p) for p in own]) for s, own in by_source.items()]
    kind = "array<struct<base:long,source:string,first:long,last:long,share:long,period:long,pattern:array<int>>>"
    plan = spark.createDataFrame(rows, f"__source string, __phases {kind}")
    # The plan's size follows from the weights: one period for each source and phase.
    slots = sum(len(p.pattern) for p in phases)
    joined = placed.join(F.broadcast(plan) if slots <= PLAN_SLOTS else plan, "__source")
    mine = F.filter("__phases", lambda p: (p["first"] <= F.col("block")) & (F.col("block") <= p["last"]))
    joined = joined.withColumn("__phase", F.get(mine, F.lit(0)))
    phase = F.col("__phase")
    j: Column = F.col("block") - phase["first"]
    turn = F.floor(j / phase["share"]) * phase["period"]
    slot = phase["base"] + turn + F.get(phase["pattern"], (j % phase["share"]).cast("int"))
    release = phase["base"] + F.floor(j * phase["period"] / phase["share"])
    deadline = phase["base"] + F.ceil((j + 1) * phase["period"] / phase["share"])
    return joined.withColumns(
        {"release": release.cast("long"), "deadline": deadline.cast("long"), "slot": slot.cast("long")}
    ).drop("__phases", "__phase")
