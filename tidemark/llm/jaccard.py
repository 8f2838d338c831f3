"""Near-duplicate texts by Jaccard similarity of word shingles, with Bayesian pruning of MinHash pairs.

1. Texts with the same shingle set form a class, kept by its smallest id; only these are compared.
2. Bands of MinHash values give buckets. Small buckets give candidate pairs, whose MinHash values
   are compared a few at a time: a pair goes once the posterior probability that it reaches the
   threshold, given the matches so far, is below a tolerance.
3. What is left (and the members of large buckets, linked to the smallest of each) falls into blocks
   of linked texts. Inside a block, tiles of members are pruned in the same way and verified
   exactly by their shingles. A tile pair returns counts and a spanning forest, never all its pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.storage import stored
from tidemark.llm.words import LOWER, Block, Words, blocks, hash_words, mix, split_words, window_hashes

#: MinHash values; with bands of 4, a pair at 0.8 shares no band once in 20 million.
HASHES = 128
BAND = 4
STEP = 16
#: Buckets up to this size give pairs; larger ones go to blocks.
SMALL_BUCKET = 32
#: Members of a tile, and their shingles together (8 bytes each): long texts fill a tile sooner.
TILE = 512
TILE_SHINGLES = 1 << 21

_SIGNED = "__doc long, __id long, __size int, __set1 long, __set2 long, __sig binary"
_MULTIPLY = mix(np.arange(1, HASHES + 1, dtype=np.uint64)).astype(np.uint32) | np.uint32(1)
_ADD = mix(np.arange(HASHES + 1, 2 * HASHES + 1, dtype=np.uint64)).astype(np.uint32)


def shingles(block: Block, words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every shingle: windows of ``width`` words, or the whole of a shorter text that has words."""
    hashes = hash_words(block, words, LOWER)
    at, h = window_hashes(hashes, words, width)
    row = words.row[at]
    count = np.diff(words.first)
    rows, values = [row], [h]
    for n in range(1, width):
        if (count == n).any():
            at, h = window_hashes(hashes, words, n)
            short = count[words.row[at]] == n
            rows.append(words.row[at][short])
            values.append(mix(h[short] + np.uint64(n)))
    row, h = np.concatenate(rows), np.concatenate(values)
    order = np.argsort(row, kind="stable")
    return row[order], h[order]


def signatures(row: np.ndarray, h: np.ndarray, n: int) -> np.ndarray:
    """``n`` x ``HASHES`` MinHash values of 16 bits; rows without shingles keep zeros."""
    out = np.zeros((n, HASHES), np.uint16)
    if len(row):
        first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        low = (h ^ (h >> np.uint64(32))).astype(np.uint32)
        for k in range(HASHES):
            value = low * _MULTIPLY[k] + _ADD[k]
            value ^= value >> np.uint32(15)
            value *= np.uint32(0x2C1B3C6D)
            least = np.minimum.reduceat(value, first)
            out[row[first], k] = (mix(least.astype(np.uint64)) >> np.uint64(48)).astype(np.uint16)
    return out


def _set_hash(h: np.ndarray, kind: int = 0) -> np.uint64:
    """A hash of a set of distinct shingles, whatever their order."""
    return mix(h + np.uint64(kind * 77 + 1)).sum(dtype=np.uint64)


def _sign(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs = batch["__doc"].to_numpy()
            for block in blocks(batch["__text"]):
                n = len(block.offsets) - 1
                row, h = shingles(block, split_words(block), width)
                order = np.lexsort((h, row))
                row, h = row[order], h[order]
                new = np.r_[True, (row[1:] != row[:-1]) | (h[1:] != h[:-1])][: len(row)]
                row, h = row[new], h[new]
                sets = np.zeros((2, n), np.uint64)
                if len(row):
                    first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
                    for i in range(2):
                        sets[i, row[first]] = np.add.reduceat(mix(h + np.uint64(i * 77 + 1)), first)
                sig = signatures(row, h, n)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(docs[block.first : block.first + n]),
                        batch["__id"].slice(block.first, n),
                        pa.array(np.bincount(row, minlength=n).astype(np.int32)),
                        pa.array(sets[0].view(np.int64)),
                        pa.array(sets[1].view(np.int64)),
                        pa.array([x.tobytes() for x in sig], pa.binary()),
                    ],
                    ["__doc", "__id", "__size", "__set1", "__set2", "__sig"],
                )

    return run


@lru_cache(maxsize=8)
def least_matches(threshold: float, tolerance: float, hashes: int = HASHES, step: int = STEP) -> tuple[int, ...]:
    """After every ``step`` values, the fewest matches with posterior P(similarity >= threshold) >= tolerance.

    The prior is uniform, so the posterior after m matches of n is Beta(m + 1, n - m + 1); its
    upper tail is the chance of at most m successes in n + 1 trials at the threshold.
    """
    out = []
    for n in range(step, hashes + 1, step):
        tail, m = 0.0, 0
        while m <= n:
            tail += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if tail >= tolerance:
                break
            m += 1
        out.append(m)
    return tuple(out)


def bayes_keep(left: np.ndarray, right: np.ndarray, least: tuple[int, ...], step: int = STEP) -> np.ndarray:
    """Which pairs of signatures (rows of two arrays) stay likely to reach the threshold."""
    alive = np.arange(len(left))
    matches = np.zeros(len(left), np.int32)
    for i, enough in enumerate(least):
        part = slice(i * step, (i + 1) * step)
        matches[alive] += (left[alive, part] == right[alive, part]).sum(1, dtype=np.int32)
        alive = alive[matches[alive] >= enough]
    keep = np.zeros(len(left), bool)
    keep[alive] = True
    return keep


def _prune(threshold: float, tolerance: float):
    least = least_matches(threshold, tolerance)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                left, right = (_matrix(batch[c].to_pylist()) for c in ("__sig_a", "__sig_b"))
                keep = pa.array(bayes_keep(left, right, least))
                yield batch.select(["__a", "__b"]).filter(keep)

    return run


def _matrix(raw: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(raw), np.uint16).reshape(-1, HASHES)


def _shingle_sets(width: int):
    """Sorted distinct shingles of each text, as raw bytes; other columns go along."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = []
            for block in blocks(batch["__text"]):
                row, h = shingles(block, split_words(block), width)
                cuts = np.searchsorted(row, np.arange(1, len(block.offsets) - 1))
                sets += [np.unique(x) for x in np.split(h, cuts)]
            # Of rows that share an id, the one that was signed.
            signed = np.array([_set_hash(x) for x in sets], np.uint64).view(np.int64) == batch["__set1"].to_numpy()
            names = [n for n in batch.schema.names if n not in ("__text", "__set1")]
            yield pa.RecordBatch.from_arrays(
                [*(batch[n] for n in names), pa.array([x.tobytes() for x in sets], pa.binary())], [*names, "__set"]
            ).filter(pa.array(signed))

    return run


def similar_pairs(
    sigs: np.ndarray, sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, threshold: float, tolerance: float
) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (one of ``left``, one of ``right``, each once) whose sets reach the threshold."""
    least = least_matches(threshold, tolerance)
    size = np.array([len(s) for s in sets])
    found_a, found_b = [], []
    for at in range(0, len(left), 64):
        some = left[at : at + 64]
        a, b = np.repeat(some, len(right)), np.tile(right, len(some))
        once = a < b
        a, b = a[once], b[once]
        # No pair whose sizes differ too much can reach the threshold.
        fits = np.minimum(size[a], size[b]) >= threshold * np.maximum(size[a], size[b]) - 1e-9
        a, b = a[fits], b[fits]
        keep = bayes_keep(sigs[a], sigs[b], least)
        a, b = a[keep], b[keep]
        if not len(a):
            continue
        # Exact counts of shared shingles: a sparse product over what two texts or more have.
        rows, columns = np.unique(a), np.unique(b)
        shared = _overlaps([sets[i] for i in rows], [sets[i] for i in columns])
        both = shared[np.searchsorted(rows, a), np.searchsorted(columns, b)]
        hit = both >= threshold * (size[a] + size[b] - both) - 1e-9
        found_a.append(a[hit])
        found_b.append(b[hit])
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *found_a]), np.concatenate([none, *found_b])


def _overlaps(left: list[np.ndarray], right: list[np.ndarray], columns: int = 1 << 14) -> np.ndarray:
    """Sizes of all intersections, by matrix products over some shingles at a time."""
    a, b = np.concatenate(left), np.concatenate(right)
    of_a = np.repeat(np.arange(len(left)), [len(s) for s in left])
    of_b = np.repeat(np.arange(len(right)), [len(s) for s in right])
    common = np.intersect1d(a, b)
    at_a, at_b = np.searchsorted(common, a), np.searchsorted(common, b)
    in_a = (at_a < len(common)) & (common[np.minimum(at_a, len(common) - 1)] == a) if len(common) else a != a
    in_b = (at_b < len(common)) & (common[np.minimum(at_b, len(common) - 1)] == b) if len(common) else b != b
    out = np.zeros((len(left), len(right)), np.float32)
    for lo in range(0, len(common), columns):
        n = min(columns, len(common) - lo)
        x, y = np.zeros((len(left), n), np.float32), np.zeros((len(right), n), np.float32)
        for one, of, at, inside in ((x, of_a, at_a, in_a), (y, of_b, at_b, in_b)):
            here = inside & (at >= lo) & (at < lo + n)
            one[of[here], at[here] - lo] = 1
        out += x @ y.T
    return out.astype(np.int64)


def _tile(threshold: float, tolerance: float):
    def run(members: pd.DataFrame) -> pd.DataFrame:
        members = members.drop_duplicates("__doc").sort_values("__doc")
        docs, tile = members["__doc"].to_numpy(), members["__tile"].to_numpy()
        copies = members["__copies"].to_numpy()
        sigs = _matrix(list(members["__sig"]))
        sets = [np.frombuffer(s, np.uint64) for s in members["__set"]]
        t, u = int(members["__t"].iloc[0]), int(members["__u"].iloc[0])
        here, there = np.flatnonzero(tile == t), np.flatnonzero(tile == u)
        a, b = similar_pairs(sigs, sets, here, there, threshold, tolerance)
        if t != u:  # the pairs whose smaller id is in the other tile
            c, d = similar_pairs(sigs, sets, there, here, threshold, tolerance)
            a, b = np.concatenate([a, c]), np.concatenate([b, d])
        links = np.bincount(a, copies[b], len(docs)) + np.bincount(b, copies[a], len(docs))
        root = np.arange(len(docs))
        while len(a):  # smallest label around, until nothing changes
            before = root.copy()
            np.minimum.at(root, a, root[b])
            np.minimum.at(root, b, root[a])
            root = root[root]
            if (root == before).all():
                break
        linked = np.flatnonzero(links > 0)
        return pd.DataFrame(
            {"__doc": docs[linked], "__root": docs[root[linked]], "__links": links[linked].astype(np.int64)}
        )

    return run


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Add ``__doc``: the id where only one row has it, else a hash of id and text beyond 2 ** 62."""
    given = F.col(id_col).cast("long")
    ids = docs.select(given.alias("__again")).where(F.col("__again").isNotNull())
    again = stored(ids.groupBy("__again").count().where(F.col("count") > 1).select("__again"), "repeated-ids")
    made = F.xxhash64(given, F.col(text_col)).bitwiseAND((1 << 62) - 1).bitwiseOR(1 << 62)
    marked = docs.join(again, given == F.col("__again"), "left")
    return marked.withColumn("__doc", F.when(given.isNull() | F.col("__again").isNotNull(), made).otherwise(given)).drop("__again")


def _groups(docs: DataFrame, threshold: float, width: int, tolerance: float, id_col: str, text_col: str) -> DataFrame:
    """The result of :func:`near_duplicates` with each row's key ``__doc`` and that of its group's first row, ``__kept``."""
    texts = _keyed(docs.select(id_col, text_col), id_col, text_col)
    texts = texts.select("__doc", F.col(id_col).cast("long").alias("__id"), F.col(text_col).alias("__text"))
    signed = stored(texts.mapInArrow(_sign(width), _SIGNED), "signatures")
    some = signed.where(F.col("__size") > 0)
    place = F.struct(F.col("__id").isNull().alias("none"), F.col("__id").alias("id"), F.col("__doc").alias("key"))
    sets = some.groupBy("__set1", "__set2").agg(
        F.min("__doc").alias("__class"), F.min(place).alias("__first"), F.count(F.lit(1)).alias("__copies")
    )
    sets = stored(sets, "classes")
    kept = signed.alias("s").join(
        sets.alias("c"),
        (F.col("s.__doc") == F.col("c.__class"))
        & (F.col("s.__set1") == F.col("c.__set1"))
        & (F.col("s.__set2") == F.col("c.__set2")),
    )
    one = F.row_number().over(Window.partitionBy("__doc").orderBy("s.__set1", "s.__set2"))
    kept = kept.select("__doc", "s.__set1", "__size", "__copies", "__sig", one.alias("__one")).where(F.col("__one") == 1)
    kept = stored(kept.drop("__one"), "class-signatures")

    raw = BAND * 2
    bands = F.transform(
        F.sequence(F.lit(0), F.lit(HASHES // BAND - 1)),
        lambda i: F.xxhash64(i, F.substring("__sig", i * raw + 1, F.lit(raw))),
    )
    placed = kept.select("__doc", F.explode(bands).alias("__key"))
    buckets = placed.groupBy("__key").agg(F.count(F.lit(1)).alias("__n"), F.min("__doc").alias("__least"))
    buckets = stored(buckets.where(F.col("__n") > 1), "buckets")
    members = stored(placed.join(buckets, "__key"), "bucket-members")
    few = members.where(F.col("__n") <= SMALL_BUCKET)
    pairs = (
        few.select("__key", F.col("__doc").alias("__a"))
        .join(few.select("__key", F.col("__doc").alias("__b")), "__key")
        .where(F.col("__a") < F.col("__b"))
        .select("__a", "__b")
        .distinct()
    )
    side = kept.select("__doc", "__sig")
    pairs = pairs.join(side.select(F.col("__doc").alias("__a"), F.col("__sig").alias("__sig_a")), "__a")
    pairs = pairs.join(side.select(F.col("__doc").alias("__b"), F.col("__sig").alias("__sig_b")), "__b")
    likely = pairs.mapInArrow(_prune(threshold, tolerance), "__a long, __b long")
    many = members.where(F.col("__n") > SMALL_BUCKET).select(F.col("__least").alias("__a"), F.col("__doc").alias("__b"))
    block = components(likely.unionByName(many.where(F.col("__a") != F.col("__b"))), "__a", "__b")

    sized = block.join(kept.select(F.col("__doc").alias("node"), "__size"), "node")
    sizes = sized.groupBy("root").agg(F.count(F.lit(1)).alias("__n"), F.sum("__size").alias("__all"))
    tiles = F.ceil(F.greatest(F.col("__n") / TILE, F.col("__all") / TILE_SHINGLES)).cast("int")
    inside = block.join(stored(sizes, "block-sizes"), "root").select(
        F.col("node").alias("__doc"), F.col("root").alias("__block"), tiles.alias("__tiles")
    )
    inside = stored(inside.join(kept.drop("__size"), "__doc"), "block-members")
    full = texts.drop("__id").join(inside, "__doc").select("__doc", "__set1", "__block", "__tiles", "__copies", "__sig", "__text")
    kind = "__doc long, __block long, __tiles int, __copies long, __sig binary, __set binary"
    full = full.mapInArrow(_shingle_sets(width), kind)
    tile = F.pmod(F.xxhash64("__doc"), F.col("__tiles")).cast("int")
    full = full.withColumn("__tile", tile).withColumn(
        "__other", F.explode(F.sequence(F.lit(0), F.col("__tiles") - 1))
    )
    full = full.withColumn("__t", F.least("__tile", "__other")).withColumn("__u", F.greatest("__tile", "__other"))
    found = full.groupBy("__block", "__t", "__u").applyInPandas(
        _tile(threshold, tolerance), "__doc long, __root long, __links long"
    )
    found = stored(found, "tile-links")
    root = components(found.where(F.col("__doc") != F.col("__root")), "__doc", "__root")
    links = found.groupBy("__doc").agg(F.sum("__links").alias("__links"))
    links = links.join(root.select(F.col("node").alias("__doc"), F.col("root").alias("__root")), "__doc", "left")

    by_class = sets.join(links.withColumnRenamed("__doc", "__class"), "__class", "left")
    by_class = stored(by_class.withColumn("__root", F.coalesce("__root", "__class")), "class-links")
    first = by_class.groupBy("__root").agg(F.min("__first").alias("__group"))
    by_class = by_class.join(first, "__root").drop("__root", "__class")
    out = signed.select("__doc", "__id", "__set1", "__set2", "__size").join(by_class, ["__set1", "__set2"], "left")
    own = F.col("__size") == 0
    return out.select(
        "__doc",
        F.when(own, F.col("__doc")).otherwise(F.col("__group.key")).alias("__kept"),
        F.col("__id").alias(id_col),
        F.when(own, F.col("__id")).otherwise(F.col("__first.id")).alias("class_id"),
        F.when(own, F.col("__id")).otherwise(F.col("__group.id")).alias("group_id"),
        F.when(own, F.lit(1)).otherwise(F.col("__copies")).cast("long").alias("n_copies"),
        F.when(own, F.lit(0))
        .otherwise(F.col("__copies") - 1 + F.coalesce("__links", F.lit(0)))
        .cast("long")
        .alias("n_links"),
    )


def near_duplicates(
    docs: DataFrame,
    threshold: float = 0.8,
    width: int = 5,
    tolerance: float = 1e-6,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Every document's text class, near-duplicate group and number of links.

    Shingles are the distinct runs of ``width`` words of a text (A-Z in lower case; words end at
    blanks and controls from tab to carriage return); a shorter text with words has all of them as
    its only shingle. Two documents are linked if the Jaccard similarity of their shingles is
    at least ``threshold``. Returns ``id_col``, ``class_id`` (smallest id with the same shingles),
    ``group_id`` (smallest id that links lead to), ``n_copies`` (documents of the class) and
    ``n_links`` (documents it is linked to, copies included).

    Every row is a document of its own, also with a null or repeated id; nulls come after all ids, so
    a class or group is null only if no row of it has an id. Ids must be whole numbers below 2 ** 62.
    Texts that are null or have no words are linked to nothing, each its own class and group.
    An empty table gives no rows. No pair at or above the threshold that shares a bucket is lost
    but with the tolerated probability.
    """
    return _groups(docs, threshold, width, tolerance, id_col, text_col).drop("__doc", "__kept")


def one_of_each_group(
    docs: DataFrame,
    threshold: float = 0.8,
    width: int = 5,
    tolerance: float = 1e-6,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs``, with all columns, but only the first of every near-duplicate group.

    That is the row with the smallest id, nulls last; of rows equal in id and text any one stays, and
    another text under the same id is judged by itself. Rows without words all stay. No other column
    may be called ``__doc`` or ``__again``.
    """
    groups = _groups(docs, threshold, width, tolerance, id_col, text_col)
    gone = stored(groups.where(F.col("__doc") != F.col("__kept")).select("__doc").distinct(), "near-copies")
    left = _keyed(docs, id_col, text_col).join(gone, "__doc", "left_anti")
    made = F.col("__doc") >= 1 << 62
    # Rows of one key are equal in id and text.
    worded = F.coalesce(F.regexp_like(F.col(text_col), F.lit("[^\\x20\\x09-\\x0D]")), F.lit(False))
    first = F.row_number().over(Window.partitionBy("__doc").orderBy(F.lit(0)))
    repeated = left.where(made & worded).withColumn("__again", first).where(F.col("__again") == 1).drop("__again")
    return left.where(~(made & worded)).unionByName(repeated).drop("__doc")
