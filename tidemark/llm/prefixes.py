"""A trie of conversation prefixes, screened by a count-min sketch before anything is grouped.

Every prefix of a rebuilt conversation has a digest of 128 bits that is a running sum over its turns, so
prefixes are made without holding a conversation in one place. A count-min sketch over the digests
never counts too low: a prefix with an estimate of one belongs to a single conversation, and its node
is written from its own row. Only prefixes that may be shared are shuffled and grouped exactly; what
the sketch takes for shared by mistake comes out of that as a node of one conversation.

Sums over subtrees are taken along conversations: a node belongs to its smallest member, whose path
leads through all ancestors, so a running sum from the deep end of every path, added up over the
members of a node, covers its subtree once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.running import powers, running_sums
from tidemark.llm.storage import stored
from tidemark.llm.words import mix

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)

#: Counters per prefix in each of the sketch's two rows, and most counters of a row (a bit of each is broadcast).
CELLS_PER_PREFIX = 8
MOST_CELLS = 1 << 27
_CHUNK = 1 << 16

#: Ids that are hashed as one piece of text.
_IDS = 1 << 13

_NODE = ["k1", "k2", "depth"]
_PARENT = ["p1", "p2", "above"]
_PREFIX = "conv long, depth long, k1 long, k2 long, p1 long, p2 long, bytes long, last boolean"


def _own_prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Prefixes that end with a turn of the conversation's own, put behind the turns it took over."""
    for batch in batches:
        of = {n: batch[n].to_numpy() for n in batch.schema.names if n != "conv"}
        depth = of["taken"] + of["__index"] - of["own_from"]
        moved = powers(_INVERSE, of["own_from"] - of["taken"])
        last = powers(_BASE, depth - 1)
        digests = []
        for i in "12":
            run, cut, base = (of[c + i].astype(np.uint64) for c in ("s", "cut", "base"))
            key = base + (run - cut) * moved
            digests.append((key, key - of["h" + i].astype(np.uint64) * last))
        (k1, p1), (k2, p2) = digests
        yield pa.RecordBatch.from_arrays(
            [
                batch["conv"],
                pa.array(depth),
                *(pa.array(x.astype(np.int64)) for x in (k1, k2, p1, p2)),
                batch["bytes"],
                pa.array(depth == of["depths"]),
            ],
            ["conv", "depth", "k1", "k2", "p1", "p2", "bytes", "last"],
        )


def prefix_rows(turns: DataFrame, shared_with: Column, shared_turns: Column, most_shared: int) -> tuple[DataFrame, DataFrame]:
    """Rebuilt conversations (``conv``, ``depths``) and all their prefixes but the empty one."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    narrow = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv"),
        "turn",
        F.md5(F.concat(F.md5(text), role)).alias("digest"),
        F.octet_length(text).cast("long").alias("bytes"),
    )
    narrow = narrow.withColumns({"h1": F.xxhash64("digest"), "h2": F.xxhash64(F.lit(1), "digest")})
    narrow = stored(narrow.withColumns({"s1": F.col("h1"), "s2": F.col("h2")}), "turns")
    order = [F.asc_nulls_first("turn"), F.col("digest")]
    rows = stored(running_sums(narrow, "conv", order, ["s1", "s2"], _BASE).drop("turn", "digest"), "turn-sums")

    few = F.when(F.col("__index") <= most_shared, F.struct("__index", "s1", "s2", "bytes"))
    heads = rows.groupBy("conv").agg(
        F.max("__index").alias("turns"), F.sort_array(F.collect_list(few)).alias("head")
    )
    heads = stored(heads.withColumns({"other": shared_with, "own_from": shared_turns.cast("long")}), "heads")
    given = heads.select(F.col("conv").alias("other"), F.col("head").alias("given"))
    own_at = F.least("own_from", "turns").cast("int")
    built = heads.join(given, "other", "left").withColumn("given", F.coalesce("given", F.array().cast(heads.schema["head"].dataType)))
    built = built.withColumn("taken", F.least(F.col("own_from"), F.size("given").cast("long")))
    at = lambda array, n, field: F.when(n > 0, F.try_element_at(F.col(array), n.cast("int"))[field]).otherwise(F.lit(0))
    built = built.select(
        "conv",
        "own_from",
        "taken",
        (F.col("taken") + F.greatest(F.col("turns") - F.col("own_from"), F.lit(0))).alias("depths"),
        F.slice("given", F.lit(1), F.col("taken").cast("int")).alias("given"),
        *(at("head", own_at, f"s{i}").alias(f"cut{i}") for i in "12"),
        *(at("given", F.col("taken"), f"s{i}").alias(f"base{i}") for i in "12"),
    )
    built = stored(built, "rebuilt")
    before = lambda field: F.when(F.col("i") > 0, F.try_element_at("given", F.col("i"))[field]).otherwise(F.lit(0))
    taken = built.select("conv", "depths", "given", F.posexplode("given").alias("i", "turn")).select(
        "conv",
        F.col("turn.__index").alias("depth"),
        *(F.col(f"turn.s{i}").alias(f"k{i}") for i in "12"),
        *(before(f"s{i}").alias(f"p{i}") for i in "12"),
        F.col("turn.bytes").alias("bytes"),
        (F.col("turn.__index") == F.col("depths")).alias("last"),
    )
    own = rows.join(built.drop("given"), "conv").where(F.col("__index") > F.col("own_from"))
    own = own.mapInArrow(_own_prefixes, _PREFIX)
    return built.select("conv", "depths"), stored(own.unionByName(taken), "prefixes")


def _cells(key: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """The cell of every digest in each row of the sketch."""
    for row in range(2):
        yield row * width + (mix(key.astype(np.uint64) + np.uint64(row * 0xA24BAED4963EE407)) % np.uint64(width)).astype(np.int64)


def _count_cells(width: int):
    """Per chunk of the sketch, the cells that some prefixes hit once, and more than once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = np.concatenate(list(_cells(batch["k1"].to_numpy(), width)))
            cell, hits = np.unique(cells, return_counts=True)
            chunk = cell // _CHUNK
            starts = np.flatnonzero(np.diff(chunk, prepend=-1))
            once, more = [], []
            for lo, hi in zip(starts, [*starts[1:], len(cell)]):
                at, n = (cell[lo:hi] % _CHUNK).astype("<u2"), hits[lo:hi]
                once.append(at[n == 1].tobytes())
                more.append(at[n > 1].tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(chunk[starts]), pa.array(once, pa.binary()), pa.array(more, pa.binary())], ["chunk", "once", "more"]
            )

    return run


def _merge_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A bit per cell of every chunk: whether more than one prefix hit it. Rows come sorted by chunk."""
    chunk, count = None, np.zeros(_CHUNK, np.uint8)

    def done() -> pa.RecordBatch:
        bits = np.packbits(count > 1, bitorder="little").tobytes()
        return pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), pa.array([bits], pa.binary())], ["chunk", "bits"])

    for batch in batches:
        for at, once, more in zip(batch["chunk"].to_pylist(), batch["once"].to_pylist(), batch["more"].to_pylist()):
            if at != chunk:
                if chunk is not None:
                    yield done()
                chunk = at
                count[:] = 0
            ones = np.frombuffer(once, "<u2")
            count[ones] = np.minimum(count[ones] + 1, 2)
            count[np.frombuffer(more, "<u2")] = 2
    if chunk is not None:
        yield done()


def _screen(width: int, sent):
    """Adds whether the prefix, and the one it extends, may be shared; the empty prefix may."""

    def seen_again(key: np.ndarray) -> np.ndarray:
        bits, out = sent.value, np.ones(len(key), bool)
        for cell in _cells(key, width):
            out &= (bits[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1 == 1
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            again = seen_again(batch["k1"].to_numpy())
            above = seen_again(batch["p1"].to_numpy()) | (batch["depth"].to_numpy() == 1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(again), pa.array(above)], [*batch.schema.names, "shared", "above_shared"]
            )

    return run


def screened(prefixes: DataFrame, cells_per_prefix: int = CELLS_PER_PREFIX, most_cells: int = MOST_CELLS) -> DataFrame:
    """Prefixes with ``shared`` and ``above_shared``: false is a proof that one conversation alone has it.

    The sketch grows with the number of prefixes up to ``most_cells`` in each of two rows; one bit of a
    counter (more than one) is broadcast, at most 32 MB. Beyond that more prefixes are grouped than need be.
    """
    spark = prefixes.sparkSession
    width = _CHUNK
    for_all = cells_per_prefix * prefixes.count()
    while width < min(for_all, most_cells):
        width *= 2
    counted = prefixes.select("k1").mapInArrow(_count_cells(width), "chunk long, once binary, more binary")
    merged = counted.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(_merge_cells, "chunk long, bits binary")
    bits = np.zeros(2 * width // 8, np.uint8)
    for row in merged.collect():
        bits[row["chunk"] * _CHUNK // 8 :][: _CHUNK // 8] = np.frombuffer(row["bits"], np.uint8)
    sent = spark.sparkContext.broadcast(bits)
    return stored(prefixes.mapInArrow(_screen(width, sent), f"{_PREFIX}, shared boolean, above_shared boolean"), "screened")


def _id_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (node, id) rows as pieces of comma-joined text with their first id."""
    for batch in batches:
        k1, k2, depth, ids = (batch[n].to_numpy() for n in [*_NODE, "conv"])
        new = np.concatenate([[True], (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1]) | (depth[1:] != depth[:-1])])
        starts = np.flatnonzero(new)
        cuts = [i for a, b in zip(starts, [*starts[1:], len(ids)]) for i in range(a, b, _IDS)]
        texts = [",".join(map(str, ids[a : min(b, a + _IDS)].tolist())) for a, b in zip(cuts, [*cuts[1:], len(ids)])]
        at = np.array(cuts, np.int64)
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(x[at]) for x in (k1, k2, depth, ids)), pa.array(texts, pa.string())], [*_NODE, "first", "ids"]
        )


def _hash_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of every node's pieces, joined; they come sorted and are never held together."""
    node, digest = None, None

    def done() -> pa.RecordBatch:
        values = [pa.array([v], pa.int64()) for v in node]
        return pa.RecordBatch.from_arrays([*values, pa.array([digest.hexdigest()])], [*_NODE, "sha"])

    for batch in batches:
        for *at, ids in zip(*(batch[n].to_pylist() for n in [*_NODE, "ids"])):
            if at != node:
                if node is not None:
                    yield done()
                node, digest = at, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
    if node is not None:
        yield done()


def ends_digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of the sorted, comma-joined ``conv`` of every node (k1, k2, depth): ``sha``.

    Ids are sorted by ranges and turned into pieces of text where they are, so one task reads about
    one row for 8,192 ids of a large node. The hash itself can only run through them one after the other.
    """
    order = [*_NODE, "conv"]
    ends = stored(ends, "ends")
    texts = ends.repartitionByRange(*order).sortWithinPartitions(*order)
    texts = texts.mapInArrow(_id_texts, "k1 long, k2 long, depth long, first long, ids string")
    texts = stored(texts, "end-texts").repartition(*_NODE).sortWithinPartitions(*_NODE, "first")
    return texts.mapInArrow(_hash_texts, "k1 long, k2 long, depth long, sha string")


def prefix_trie(
    turns: DataFrame, shared_with: Column, shared_turns: Column, most_shared: int, **sketch: int
) -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations, from the empty one.

    ``turns`` has ``conv_id``, ``turn``, ``role`` and ``text``; other columns are not looked at. A null
    role or text is empty, a null ``turn`` comes first, rows of one conversation and turn are ordered
    by a digest of text and role, and rows without a ``conv_id`` take no part. A conversation begins
    with the first ``shared_turns`` turns (at most ``most_shared``) of conversation ``shared_with``,
    both expressions over ``conv``, and goes on with its own turns behind as many of its own.

    Returns, per node: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens`` and ``ends_sha256``. Without conversations there is no
    row. Prefixes are equal if their 128-bit digests are: for n distinct prefixes the odds of a wrong
    match are about n squared to 2 ** 129.
    """
    built, prefixes = prefix_rows(turns, shared_with, shared_turns, most_shared)
    rows = screened(prefixes, **sketch)
    alone = rows.where(~F.col("shared"))
    grouped = rows.where("shared").groupBy(*_NODE).agg(
        F.min("conv").alias("first"),
        F.count(F.lit(1)).alias("n"),
        F.max("bytes").alias("bytes"),
        F.count_if("last").alias("n_ends"),
        F.min("p1").alias("p1"),
        F.min("p2").alias("p2"),
        (F.col("depth") - 1).alias("above"),
    )
    nodes = stored(grouped, "shared-nodes")
    children = nodes.select(*_PARENT).unionByName(
        alone.where("above_shared").select("p1", "p2", (F.col("depth") - 1).alias("above"))
    )
    children = stored(children.groupBy(*_PARENT).agg(F.count(F.lit(1)).alias("n_children")).toDF(*_NODE, "n_children"), "children")

    known = nodes.select(*_NODE, "first", "n", "n_ends", F.col("bytes").alias("node_bytes"))
    members = rows.where("shared").join(known, _NODE)
    mine = F.col("conv") == F.col("first")
    paths = members.select(
        *_NODE,
        "conv",
        F.when(mine, (F.col("n") - 1) * F.col("node_bytes")).otherwise(F.lit(0)).alias("saved"),
        F.when(mine & F.col("last") & (F.col("n_ends") == F.col("n")), F.lit(1)).otherwise(F.lit(0)).cast("long").alias("leaves"),
        (F.col("last") & (F.col("n_ends") > 1)).alias("many_ends"),
        F.lit(True).alias("grouped"),
    )
    tails = alone.where("last").select(
        *_NODE, "conv", F.lit(0).cast("long").alias("saved"), F.lit(1).cast("long").alias("leaves"),
        F.lit(False).alias("many_ends"), F.lit(False).alias("grouped"),
    )
    paths = stored(paths.unionByName(tails), "paths")
    sums = running_sums(paths, "conv", [F.desc("depth")], ["saved", "leaves"])
    sums = sums.where("grouped").groupBy(*_NODE).agg(F.sum("saved").alias("saved_tokens"), F.sum("leaves").alias("n_leaves"))

    zero = F.lit(0).cast("long")
    rootless = built.where(F.col("depths") == 0).select(zero.alias("k1"), zero.alias("k2"), zero.alias("depth"), "conv")
    shas = ends_digests(paths.where("many_ends").select(*_NODE, "conv").unionByName(rootless))
    shas = stored(shas, "end-digests")
    one_end = rows.where(F.col("shared") & F.col("last")).groupBy(*_NODE).agg(F.min("conv").alias("end"))
    nothing = F.lit(hashlib.sha256(b"").hexdigest())

    top = built.agg(F.min("conv").alias("first"), F.count(F.lit(1)).alias("n")).first()
    if not top["n"]:
        top_first = None
    else:
        top_first = top["first"]
    parents = nodes.select(
        F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("depth").alias("above"), F.col("first").alias("parent")
    )
    inner = (
        nodes.join(parents, _PARENT, "left")
        .join(children, _NODE, "left")
        .join(sums, _NODE)
        .join(one_end, _NODE, "left")
        .join(shas, _NODE, "left")
        .select(
            F.col("first").alias("conv_id"),
            "depth",
            F.when(F.col("depth") == 1, F.lit(top_first)).otherwise(F.coalesce("parent", "first")).alias("parent_conv_id"),
            F.col("n").alias("n_convs"),
            F.coalesce("n_children", zero).alias("n_children"),
            "n_leaves",
            "saved_tokens",
            F.when(F.col("n_ends") == 0, nothing)
            .otherwise(F.coalesce("sha", F.sha2(F.col("end").cast("string"), 256)))
            .alias("ends_sha256"),
        )
    )
    single = [
        F.lit(1).cast("long").alias("n_convs"),
        F.when(F.col("last"), zero).otherwise(F.lit(1)).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"),
        zero.alias("saved_tokens"),
        F.when(F.col("last"), F.sha2(F.col("conv").cast("string"), 256)).otherwise(nothing).alias("ends_sha256"),
    ]
    below_shared = F.col("above_shared") & (F.col("depth") > 1)
    local_parent = F.when(F.col("depth") == 1, F.lit(top_first)).otherwise(F.col("conv"))
    local = alone.where(~below_shared).select(
        F.col("conv").alias("conv_id"), "depth", local_parent.alias("parent_conv_id"), *single
    )
    edge = (
        alone.where(below_shared)
        .withColumn("above", F.col("depth") - 1)
        .join(parents, _PARENT)
        .select(F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), *single)
    )
    leaves = paths.agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    root = (
        built.agg(F.min("conv").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"))
        .where(F.col("n_convs") > 0)
        .crossJoin(leaves)
        .withColumns({"k1": zero, "k2": zero, "depth": zero})
        .join(children, _NODE, "left")
        .join(shas, _NODE, "left")
        .select(
            "conv_id",
            "depth",
            F.lit(None).cast("long").alias("parent_conv_id"),
            "n_convs",
            F.coalesce("n_children", zero).alias("n_children"),
            F.greatest(F.coalesce("leaves", zero), F.lit(1)).alias("n_leaves"),
            F.coalesce("saved", zero).alias("saved_tokens"),
            F.coalesce("sha", nothing).alias("ends_sha256"),
        )
    )
    return local.unionByName(edge).unionByName(inner).unionByName(root)
