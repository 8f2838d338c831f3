"""Language of texts by sparse multinomial logistic regression on TF-IDF character n-grams.

One to three characters are hashed into a fixed number of features. Document frequencies are
counted over all training texts; weights are trained on a bounded sample by follow-the-
regularised-leader with elastic-net penalties, in rounds of parallel passes whose states are
averaged; a temperature, fitted on texts that no pass has seen, calibrates the scores.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.words import Block, blocks

FEATURES = 1 << 13
ORDERS = 3
#: Texts that are turned into features at once, and texts of a gradient step.
ROWS = 128
STEP = 32
#: Parallel passes of a round, whatever the size of the sample.
WORKERS = 6

UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")

#: A-Z to a-z; every other ASCII character but letters to a blank.
_FOLD = np.full(128, 32, np.uint32)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)


class Model(NamedTuple):
    """Weights by feature and language, IDF by feature, and the temperature."""

    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float


def _grams(block: Block) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row and feature of every n-gram of a block's texts, in order of rows, for one order after the other."""
    text = block.data.tobytes().decode("utf-8")
    code = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    # Characters start at bytes that continue nothing.
    lead = np.flatnonzero((block.data & 0xC0) != 0x80)
    row = np.repeat(
        np.arange(len(block.offsets) - 1), np.diff(np.searchsorted(lead, block.offsets))
    )
    code = np.where(code < 128, _FOLD[np.minimum(code, 127)], code).astype(np.uint64)
    packed = np.zeros(len(code), np.uint64)
    for n in range(1, min(ORDERS, len(code)) + 1):
        packed = (packed[: len(code) - n + 1] << np.uint64(21)) | code[n - 1 :]
        same = row[: len(row) - n + 1] == row[n - 1 :]
        hashed = (packed * np.uint64(0x9E3779B97F4A7C15 + 2 * n)) >> np.uint64(64 - FEATURES.bit_length() + 1)
        yield row[: len(row) - n + 1][same], hashed[same].astype(np.int64)


def counts_of(texts: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """First row and a matrix of n-gram counts, for some texts at a time."""
    for block in blocks(texts):
        grams = list(_grams(block))
        for lo in range(0, len(block.offsets) - 1, ROWS):
            hi = min(lo + ROWS, len(block.offsets) - 1)
            counts = np.zeros((hi - lo) * FEATURES, np.int64)
            for row, feature in grams:
                a, b = np.searchsorted(row, [lo, hi])
                counts += np.bincount((row[a:b] - lo) * FEATURES + feature[a:b], minlength=len(counts))
            yield block.first + lo, counts.reshape(hi - lo, FEATURES)


def tf_idf(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """(1 + log count) * idf, at length 1."""
    x = np.zeros(counts.shape, np.float32)
    some = counts > 0
    x[some] = 1 + np.log(counts[some])
    x *= idf.astype(np.float32)
    norm = np.sqrt((x * x).sum(1, keepdims=True))
    return x / np.maximum(norm, 1e-9)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(FEATURES, np.int64)
    for batch in batches:
        for _, counts in counts_of(batch["__text"]):
            total += (counts > 0).sum(0)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(FEATURES)), pa.array(total)], ["feature", "n"])


def ftrl_weights(z: np.ndarray, n: np.ndarray, alpha: float, l1: float, l2: float, beta: float = 1.0) -> np.ndarray:
    """The weights of a state: zero wherever the summed gradients stay within the L1 penalty."""
    return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2))


def ftrl_step(z: np.ndarray, n: np.ndarray, x: np.ndarray, y: np.ndarray, alpha: float, l1: float, l2: float) -> None:
    """One gradient step on some texts (features, language numbers), in place."""
    w = ftrl_weights(z, n, alpha, l1, l2)
    p = _softmax(x @ w)
    p[np.arange(len(y)), y] -= 1
    g = x.T @ p
    sigma = (np.sqrt(n + g * g) - np.sqrt(n)) / alpha
    z += g - sigma * w
    n += g * g


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def _pass(z: np.ndarray, n: np.ndarray, idf: np.ndarray, languages: list[str], alpha: float, l1: float, l2: float):
    number = {lang: i for i, lang in enumerate(languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_z, own_n, seen = z.copy(), n.copy(), 0
        for batch in batches:
            labels = np.array([number[x] for x in batch["__lang"].to_pylist()], np.int64)
            for first, counts in counts_of(batch["__text"]):
                x, y = tf_idf(counts, idf), labels[first : first + len(counts)]
                for at in range(0, len(y), STEP):
                    ftrl_step(own_z, own_n, x[at : at + STEP], y[at : at + STEP], alpha, l1, l2)
                seen += len(y)
        yield pa.RecordBatch.from_arrays(
            [pa.array([seen]), pa.array([own_z.tobytes()], pa.binary()), pa.array([own_n.tobytes()], pa.binary())],
            ["seen", "z", "n"],
        )

    return run


def _logits(idf: np.ndarray, weights: np.ndarray, languages: list[str]):
    number = {lang: i for i, lang in enumerate(languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = [number[x] for x in batch["__lang"].to_pylist()]
            for first, counts in counts_of(batch["__text"]):
                out = (tf_idf(counts, idf) @ weights).astype(np.float64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(y[first : first + len(out)], pa.int64()), pa.array(out.tolist(), pa.list_(pa.float64()))],
                    ["y", "logits"],
                )

    return run


def fit_temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature with the least log loss, by golden-section search over its logarithm."""
    def loss(t: float) -> float:
        scaled = logits / np.exp(t)
        scaled = scaled - scaled.max(1, keepdims=True)
        return float((np.log(np.exp(scaled).sum(1)) - scaled[np.arange(len(y)), y]).mean())

    lo, hi, ratio = np.log(0.02), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = hi - ratio * (hi - lo), lo + ratio * (hi - lo)
        lo, hi = (lo, b) if loss(a) < loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


def train(
    labelled: DataFrame,
    per_language: int = 4000,
    rounds: int = 3,
    alpha: float = 0.5,
    l1: float = 0.02,
    l2: float = 0.1,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> Model:
    """Learn from texts with a language; rows without text or language are left out.

    Document frequencies are over all of ``labelled``. Weights and temperature use about
    ``per_language`` texts of each language, chosen by a hash of id and text, whole; every tenth of
    these is for the temperature only. The driver gets one row per language, one count per
    feature, ``WORKERS`` states of fixed size per round, and the logits of the temperature texts.
    Without any text, the model knows no language.
    """
    rows = labelled.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(
        F.col(text_col).alias("__text"),
        F.col(lang_col).cast("string").alias("__lang"),
        F.pmod(F.xxhash64(F.col(id_col), F.col(text_col)), F.lit(1 << 30)).alias("__draw"),
    )
    sizes = {r["__lang"]: r["n"] for r in rows.groupBy("__lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(sizes)
    shape = (FEATURES, len(languages))
    if not languages:
        return Model([], np.zeros(FEATURES), np.zeros(shape), 1.0)
    frequency = rows.select("__text").mapInArrow(_frequencies, "feature long, n long")
    counted = frequency.groupBy("feature").agg(F.sum("n").alias("n")).collect()
    df = np.zeros(FEATURES)
    for r in counted:
        df[r["feature"]] = r["n"]
    idf = np.log((1 + sum(sizes.values())) / (1 + df)) + 1

    share: Column = F.lit(0)
    for lang, n in sizes.items():
        share = F.when(F.col("__lang") == lang, int(min(1.0, per_language / n) * (1 << 30))).otherwise(share)
    sample = rows.where(F.col("__draw") < share)
    aside = F.pmod(F.xxhash64("__draw", "__text"), F.lit(10)) == 0
    learn = sample.where(~aside).repartition(WORKERS, F.xxhash64("__text", "__draw"))
    # Learning depends on the order of texts, which a shuffle leaves open.
    learn = learn.sortWithinPartitions("__draw", "__text", "__lang").select("__text", "__lang").coalesce(WORKERS)
    z, n = np.zeros(shape), np.zeros(shape)
    for _ in range(rounds):
        passes = learn.mapInArrow(_pass(z, n, idf, languages, alpha, l1, l2), "seen long, z binary, n binary")
        states = [s for s in passes.collect() if s["seen"]]
        if not states:
            break
        # Each worker adds its own gradients to the common state.
        average = lambda name: sum(
            np.frombuffer(s[name], np.float64).reshape(shape) * s["seen"] for s in states
        ) / sum(s["seen"] for s in states)
        z, n = average("z"), average("n")
    weights = ftrl_weights(z, n, alpha, l1, l2)
    tests = sample.where(aside).select("__text", "__lang")
    tests = tests.mapInArrow(_logits(idf, weights, languages), "y long, logits array<double>").collect()
    temperature = 1.0
    if tests:
        tests.sort(key=lambda t: (t["y"], t["logits"]))
        temperature = fit_temperature(np.array([t["logits"] for t in tests]), np.array([t["y"] for t in tests]))
    return Model(languages, idf, weights, temperature)


def _predict(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch["__text"]
            best, score = np.full(len(batch), -1), np.zeros(len(batch))
            if model.languages:
                for first, counts in counts_of(texts):
                    p = _softmax((tf_idf(counts, model.idf) @ model.weights).astype(np.float64) / model.temperature)
                    best[first : first + len(p)] = p.argmax(1)
                    score[first : first + len(p)] = p.max(1)
            for i, text in enumerate(texts):
                if not text.is_valid or not _LETTER.search(text.as_py()):
                    best[i], score[i] = -1, 0.0
            names = [n for n in batch.schema.names if n != "__text"]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch[n] for n in names),
                    pa.array([model.languages[b] if b >= 0 else UNKNOWN for b in best], pa.string()),
                    pa.array(score),
                ],
                [*names, "lang_pred", "score"],
            )

    return run


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Add ``lang_pred`` and ``score`` (its calibrated probability) to all columns; the text alone decides.

    Texts that are null or have no letter get ``und`` and 0, and so do all texts if the model
    knows no language. Columns of the two names are replaced; an empty table gives no rows.
    """
    docs = docs.drop("lang_pred", "score")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    given = docs.withColumn("__text", F.col(text_col))
    return given.mapInArrow(_predict(model), f"{kinds}, lang_pred string, score double")
