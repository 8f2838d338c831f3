"""Scoring of texts by a hashed maximum-entropy language model with class-factored softmax.

A word's probability is that of its class given the words before it, times that of the word in
its class. The class model is a softmax over a fixed number of classes with hashed features: the
word before, the two before, and skips over one and two words. It is trained by gradient steps
on all training texts in parallel, in rounds whose weights are averaged; every text belongs to one
of the rounds, so all rounds together read it once. The word's share of its class comes from counts
over the corpus.

Frequent words have classes of their own; all others have one by their spelling, so an unknown
word has a class too.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.storage import stored
from tidemark.llm.words import LOWER, Block, blocks, hash_words, mix, split_words

#: Classes, of which the first belong to one frequent word each; rows of hashed features.
CLASSES = 64
OWN = 24
FEATURES = 1 << 14
#: Frequent words whose counts go to every task; the others are joined.
HEAD = 1 << 18
#: Tokens of a gradient step, rounds, and distinct words a task holds before it passes them on.
STEP = 4096
ROUNDS = 2
#: Tokens of a feature above which its gradients are summed by themselves.
LARGE = 16
HELD = 1 << 20
#: Text for a worker of a round: its weights are a small part of what it reads.
WORKER_BYTES = 32 << 20
#: Rows of weights that are averaged together, and workers whose weights meet in one group.
CHUNK = 1 << 10
FAN_IN = 32

#: What stands for the end of a text, as a word.
END = np.uint64(0x5BD1E9955BD1E995)

_COUNTS = "__h long, __spelling int, __n long"
_WEIGHTS = "__worker int, __chunk int, __weights binary, __uses binary"
_SCORED = (
    "__row long, __h long, __tail boolean, __n long, __id string, __tokens long, __known long, "
    "__counts double, __classes double"
)


class Model(NamedTuple):
    """Class weights, words with classes of their own, words with counts at hand, and the vocabulary's sums."""

    weights: np.ndarray
    own: np.ndarray
    head: np.ndarray
    head_counts: np.ndarray
    class_log: np.ndarray  # log10(tokens + words + 1) of each class
    tokens: int
    words: int


def _tokens(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, hash and spelling class of every token: the words of each text and an end after them."""
    words = split_words(block)
    h = hash_words(block, words, LOWER)
    data = LOWER[block.data].astype(np.int64)
    last = data[words.end - 1]
    before = np.where(words.end - words.start > 1, data[words.end - 2], 0)
    spelling = (mix((last * 256 + before).astype(np.uint64)) >> np.uint64(33)).astype(np.int64) % (CLASSES - OWN)
    rows = len(block.offsets) - 1
    at = words.first[1:]
    return (
        np.insert(words.row, at, np.arange(rows)),
        np.insert(h, at, END),
        np.insert(spelling, at, 0).astype(np.int32),
    )


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Token counts, summed over as many texts as fit."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    size = 0

    def merged() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        h, s, n = (np.concatenate(x) for x in zip(*held, strict=True))
        keys, first, back = np.unique(h, return_index=True, return_inverse=True)
        return keys, s[first], np.bincount(back, n).astype(np.int64)

    def out(part: tuple[np.ndarray, np.ndarray, np.ndarray]) -> pa.RecordBatch:
        h, s, n = part
        return pa.RecordBatch.from_arrays(
            [pa.array(h.view(np.int64)), pa.array(s), pa.array(n)], ["__h", "__spelling", "__n"]
        )

    for batch in batches:
        for block in blocks(batch["__text"]):
            _, h, s = _tokens(block)
            keys, first, n = np.unique(h, return_index=True, return_counts=True)
            held.append((keys, s[first], n))
            size += len(keys)
            if size > HELD:
                held = [merged()]
                size = len(held[0][0])
                if size > HELD // 2:
                    yield out(held[0])
                    held, size = [], 0
    if held:
        yield out(merged())


def _features(row: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Hashed feature rows of each token: word before, two before, and skips of one and two words; row 0 is the bias."""
    n = len(h)
    past = []
    for back in (1, 2, 3):
        before = np.full(n, END, np.uint64)
        if n > back:
            same = row[back:] == row[:-back]
            before[back:][same] = h[:-back][same]
        past.append(before)
    one, two, three = past
    mask = np.uint64(FEATURES - 1)
    out = np.zeros((n, 4), np.int32)
    out[:, 0] = mix(one + np.uint64(1)) & mask
    out[:, 1] = mix(one * np.uint64(3) + mix(two)) & mask
    out[:, 2] = mix(two + np.uint64(2)) & mask
    out[:, 3] = mix(three + np.uint64(3)) & mask
    return out


def _classes(h: np.ndarray, spelling: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Class of each token: ``own`` are sorted hashes of the words with one of their own."""
    if not len(own):
        return OWN + spelling
    at = np.minimum(np.searchsorted(own, h), len(own) - 1)
    return np.where(own[at] == h, at, OWN + spelling)


class Buffers:
    """Room for the rows of a step, kept from step to step: fresh memory costs more than the sums in it."""

    def __init__(self, tokens: int = STEP):
        self.scores = np.empty((tokens, CLASSES), np.float32)
        self.part = np.empty((4 * tokens, CLASSES), np.float32)
        self.total = np.empty((4 * tokens, CLASSES), np.float32)


def _exponentials(weights: np.ndarray, features: np.ndarray, buffers: Buffers) -> np.ndarray:
    """Classes' unnormalised probabilities of each token, a few tokens at a time, in ``buffers.scores``."""
    for at in range(0, len(features), 1024):
        some = features[at : at + 1024]
        logits, part = buffers.scores[at : at + len(some)], buffers.part[: len(some)]
        np.take(weights, some[:, 0], axis=0, out=logits, mode="clip")
        for i in range(1, some.shape[1]):
            logits += np.take(weights, some[:, i], axis=0, out=part, mode="clip")
        logits += weights[0]
        if np.abs(logits).max(initial=0) > 40:  # where exponentials could leave the range of 32 bits
            logits -= logits.max(1, keepdims=True)
        np.exp(logits, out=logits)
    return buffers.scores[: len(features)]


def _row_sums(g: np.ndarray, tokens: np.ndarray, first: np.ndarray, count: np.ndarray, buffers: Buffers):
    """Sums of ``g`` over groups of tokens (``tokens[first : first + count]``): the groups, largest first, and their sums.

    Groups are added up side by side: the first token of each, then the second of those that have one,
    and so on. The few large ones are summed one by one.
    """
    by = np.argsort(-count, kind="stable")
    count, first = count[by], first[by]
    longer = lambda n: int(np.searchsorted(-count, -n, "left"))  # noqa: E731  groups of more than n tokens
    total, large = buffers.total[: len(by)], longer(LARGE)
    for i in range(large):
        np.add.reduce(g.take(tokens[first[i] : first[i] + count[i]], axis=0), axis=0, out=total[i])
    np.take(g, tokens[first[large:]], axis=0, out=total[large:], mode="clip")
    for k in range(1, LARGE):
        upto = longer(k)
        part = buffers.part[: max(upto - large, 0)]
        if not len(part):
            break
        total[large:upto] += np.take(g, tokens[first[large:upto] + k], axis=0, out=part, mode="clip")
    return by, total


def gradient_step(
    weights: np.ndarray, uses: np.ndarray, squares: np.ndarray, features: np.ndarray, y: np.ndarray, rate: float,
    buffers: Buffers,
) -> None:
    """One step on some tokens, in place; each feature row has its own step size by its past gradients."""
    g = _exponentials(weights, features, buffers)
    g /= g.sum(1, keepdims=True)
    g[np.arange(len(y)), y] -= 1
    flat = features.T.ravel()
    order = np.argsort(flat.astype(np.int16), kind="stable")  # rows fit 16 bits, which are sorted by radix
    ordered = flat[order]
    first = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    count = np.diff(np.r_[first, len(ordered)])
    by, total = _row_sums(g, order % len(y), first, count, buffers)
    rows = ordered[first][by]
    squares[rows] += np.einsum("ij,ij->i", total, total) / CLASSES
    uses[rows] += count[by]
    total *= (rate / (np.sqrt(squares[rows]) + 1e-6))[:, None]
    new = np.take(weights, rows, axis=0, out=buffers.part[: len(rows)], mode="clip")
    new -= total
    weights[rows] = new
    # The bias is in every token.
    total = g.sum(0)
    squares[0] += (total * total).mean()
    uses[0] += len(y)
    weights[0] -= rate * total / (np.sqrt(squares[0]) + 1e-6)


def _train(weights: np.ndarray, own: np.ndarray, rate: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = weights.copy()
        uses, squares = np.zeros(FEATURES, np.float32), np.zeros(FEATURES, np.float32)
        buffers = Buffers()
        for batch in batches:
            for block in blocks(batch["__text"]):
                row, h, spelling = _tokens(block)
                features, y = _features(row, h), _classes(h, spelling, own)
                for at in range(0, len(y), STEP):
                    gradient_step(w, uses, squares, features[at : at + STEP], y[at : at + STEP], rate, buffers)
        if uses.any():
            from pyspark import TaskContext

            worker = TaskContext.get().partitionId()
            for chunk in range(FEATURES // CHUNK):
                part = slice(chunk * CHUNK, (chunk + 1) * CHUNK)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([worker], pa.int32()),
                        pa.array([chunk], pa.int32()),
                        pa.array([(w[part] * uses[part, None]).astype(np.float32).tobytes()], pa.binary()),
                        pa.array([uses[part].tobytes()], pa.binary()),
                    ],
                    ["__worker", "__chunk", "__weights", "__uses"],
                )

    return run


def _add_up(part: pd.DataFrame) -> pd.DataFrame:
    """Sums of weights and uses of one chunk of features."""
    total = [sum(np.frombuffer(x, np.float32).astype(np.float64) for x in part[c]) for c in ("__weights", "__uses")]
    return pd.DataFrame(
        {
            "__worker": [int(part["__worker"].iloc[0]) // FAN_IN],
            "__chunk": [part["__chunk"].iloc[0]],
            "__weights": [total[0].astype(np.float32).tobytes()],
            "__uses": [total[1].astype(np.float32).tobytes()],
        }
    )


def _round(texts: DataFrame, weights: np.ndarray, own: np.ndarray, rate: float) -> np.ndarray:
    """Weights after one pass of ``texts``: the workers' means, by how often each used a feature."""
    sent = texts.mapInArrow(_train(weights, own, rate), _WEIGHTS)
    group = F.floor(F.col("__worker") / FAN_IN).cast("int")
    some = sent.groupBy("__chunk", group).applyInPandas(_add_up, _WEIGHTS)
    summed = some.groupBy("__chunk").applyInPandas(_add_up, _WEIGHTS)
    out = weights.copy()
    for r in summed.collect():
        part = slice(r["__chunk"] * CHUNK, (r["__chunk"] + 1) * CHUNK)
        uses = np.frombuffer(r["__uses"], np.float32)
        new = np.frombuffer(r["__weights"], np.float32).reshape(CHUNK, CLASSES)
        used = uses > 0
        out[part][used] = new[used] / uses[used, None]
    return out


def train(docs: DataFrame, rate: float = 0.2, text_col: str = "text") -> tuple[Model, DataFrame]:
    """A model of all texts, and the table of token counts (``__h``, ``__n``) that scoring joins.

    Null texts count as empty. The driver gets the class weights once a round, the ``HEAD`` most
    frequent words, and one row per class: all of fixed size. Counts are summed in each task
    before they are shuffled; weights are summed in two steps.
    """
    texts = docs.select(F.col(text_col).alias("__text"))
    counts = texts.mapInArrow(_count, _COUNTS).groupBy("__h").agg(
        F.first("__spelling").alias("__spelling"), F.sum("__n").alias("__n")
    )
    counts = stored(counts, "token-counts")
    # The least count of a frequent word, by a histogram of counts: a few hundred steps of 3 %.
    level = F.floor(F.log(F.col("__n").cast("double")) * 32).cast("int")
    levels = counts.groupBy(level.alias("l")).agg(F.count(F.lit(1)).alias("v"), F.min("__n").alias("n")).collect()
    least, taken = None, 0
    for r in sorted(levels, key=lambda r: -r["l"]):
        taken += r["v"]
        if taken > HEAD:
            break
        least = r["n"]
    head = counts.where(F.col("__n") >= least if least is not None else F.lit(False)).select("__h", "__n").toArrow()
    hashes, times = head["__h"].to_numpy().view(np.uint64), head["__n"].to_numpy()
    own = np.sort(hashes[np.lexsort((hashes, -times))[:OWN]])
    # Columns of the vocabulary by class; words with a class of their own are listed.
    listed = [int(x) for x in own.view(np.int64)]
    own_class = F.lit(None).cast("int")
    for i, x in enumerate(listed):
        own_class = F.when(F.col("__h") == F.lit(x), i).otherwise(own_class)
    cls = F.coalesce(own_class, F.col("__spelling") + OWN)
    sums = counts.groupBy(cls.alias("c")).agg(F.sum("__n").alias("n"), F.count(F.lit(1)).alias("v")).collect()
    class_log = np.zeros(CLASSES)
    for r in sums:
        class_log[r["c"]] = np.log10(r["n"] + r["v"] + 1)
    weights = np.zeros((FEATURES, CLASSES), np.float32)
    turn = F.pmod(F.xxhash64("__text", F.lit(7)), F.lit(ROUNDS))
    size = texts.agg(F.sum(F.octet_length("__text"))).first()[0] or 0
    workers = max(docs.sparkSession.sparkContext.defaultParallelism, -(-size // WORKER_BYTES))
    texts = texts.coalesce(workers)
    for i in range(ROUNDS):
        weights = _round(texts.where(turn == i), weights, own, rate)
    order = np.argsort(hashes)
    model = Model(
        weights, own, hashes[order], times[order], class_log,
        sum(r["n"] for r in sums), sum(r["v"] for r in sums),
    )
    return model, counts.select("__h", "__n")


def _score(model: Model):
    known_log = np.log10(model.head_counts + 1.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buffers = Buffers()
        for batch in batches:
            rows, ids = batch["__row"].to_numpy(), batch["__id"]
            for block in blocks(batch["__text"]):
                n = len(block.offsets) - 1
                row, h, spelling = _tokens(block)
                y, features = _classes(h, spelling, model.own), _features(row, h)
                chosen = np.zeros(len(y))
                for at in range(0, len(y), STEP):
                    part = slice(at, at + STEP)
                    p = _exponentials(model.weights, features[part], buffers)
                    chosen[part] = p[np.arange(len(p)), y[part]] / p.sum(1)
                classes = np.log10(np.maximum(chosen, 1e-30)) - model.class_log[y]
                if len(model.head):
                    place = np.minimum(np.searchsorted(model.head, h), len(model.head) - 1)
                    found = model.head[place] == h
                    counts = np.where(found, known_log[place], 0.0)
                else:
                    found, counts = np.zeros(len(h), bool), np.zeros(len(h))
                own = rows[block.first : block.first + n]
                yield _scored(
                    own, mix(own.view(np.uint64)), False, np.ones(n, np.int64), ids.slice(block.first, n),
                    np.bincount(row, minlength=n), np.bincount(row, found, n), np.bincount(row, counts, n),
                    np.bincount(row, classes, n),
                )
                # Rare words, once for each text: their counts are joined.
                if model.words > len(model.head) and not found.all():
                    order = np.lexsort((h[~found], row[~found]))
                    r, x = row[~found][order], h[~found][order]
                    first = np.flatnonzero(np.r_[True, (r[1:] != r[:-1]) | (x[1:] != x[:-1])])
                    times = np.diff(np.r_[first, len(r)])
                    zero = np.zeros(len(first))
                    none = pa.nulls(len(first), pa.string())
                    yield _scored(own[r[first]], x[first], True, times, none, zero, zero, zero, zero)

    return run


def _scored(row, h, tail, n, ids, tokens, known, counts, classes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(row), pa.array(h.view(np.int64)), pa.array(np.full(len(row), tail)), pa.array(n, pa.int64()), ids,
            pa.array(tokens.astype(np.int64)), pa.array(known.astype(np.int64)), pa.array(counts), pa.array(classes),
        ],
        ["__row", "__h", "__tail", "__n", "__id", "__tokens", "__known", "__counts", "__classes"],
    )


def score_texts(
    docs: DataFrame, model: Model, counts: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``n_tokens``, ``n_known`` (tokens seen in training), ``base_score`` and ``score`` of every text, with its ``id_col``.

    ``base_score`` is the log10 probability by smoothed counts of single tokens, ``score`` that by
    the model. Tokens are words (A-Z in lower case) and one end. Null and empty texts are an end
    alone. Rows that are equal in id and text come out as often as they are in ``docs``. With no
    training text, nothing is known and every class is as likely. An empty table gives no rows.

    Only words beyond the ``HEAD`` most frequent ones are shuffled, once for each text.
    """
    kind = docs.schema[id_col].dataType
    given = docs.select(
        F.xxhash64(F.col(id_col), F.col(text_col)).alias("__row"),
        F.col(id_col).cast("string").alias("__id"),
        F.col(text_col).alias("__text"),
    )
    parts = given.mapInArrow(_score(model), _SCORED)
    joined = parts.join(counts.select("__h", F.col("__n").alias("__c")), "__h", "left")
    tail = F.col("__tail")
    own = lambda c: F.when(~tail, F.col(c))
    rare = F.when(tail & F.col("__c").isNotNull(), F.col("__n"))
    out = joined.groupBy("__row").agg(
        F.count(own("__n")).alias("__times"),
        F.max("__id").alias("__id"),
        F.sum("__tokens").alias("__tokens"),
        (F.sum("__known") + F.coalesce(F.sum(rare), F.lit(0))).alias("__known"),
        (F.sum("__counts") + F.coalesce(F.sum(rare * F.log10(F.col("__c") + 1.0)), F.lit(0.0))).alias("__counts"),
        F.sum("__classes").alias("__classes"),
    )
    mean: Column = F.lit(1.0) / F.col("__times")
    tokens = F.round(F.col("__tokens") * mean).cast("long")
    whole = float(np.log10(model.tokens + model.words + 1))
    out = out.select(
        F.col("__id").cast(kind).alias(id_col),
        tokens.alias("n_tokens"),
        F.round(F.col("__known") * mean).cast("long").alias("n_known"),
        (F.col("__counts") * mean - tokens * F.lit(whole)).alias("base_score"),
        ((F.col("__counts") + F.col("__classes")) * mean).alias("score"),
        F.explode(F.sequence(F.lit(1), F.col("__times"))).alias("__copy"),
    )
    return out.drop("__copy")
