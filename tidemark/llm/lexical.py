"""Ranked lexical search by scanning texts with an automaton of all query terms.

Items (the queries) are taken in blocks of bounded size. For a block, an Aho-Corasick automaton of its
distinct terms, each guarded by a blank on either side, goes to every task; texts have their separators
turned into blanks, so a match is a whole term. One scan per block gives every document's terms with
their counts, and the same pass its length; there is no index of the documents. The counts give document
frequencies, and a second pass over them (not over the texts) scores every document for the items that
its terms lead to. A task keeps the k best documents of each item, so few rows are ranked at the end.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.storage import stored
from tidemark.llm.words import LOWER, blocks, split_words

#: Bytes that separate terms: those of ASCII that are neither letters nor digits.
SEPARATORS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])

#: Bytes as the automaton reads them: separators as blanks, A-Z lower-cased.
_READ = np.where(SEPARATORS, np.uint8(32), LOWER)

#: Bytes of the terms of a block of items; the automaton takes some fifty times that.
BLOCK_BYTES = 1 << 19

#: Scores that are held as floating point: up to here every whole number is exact.
_EXACT = 1 << 53


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in blocks(batch["__text"]):
            words = split_words(block, SEPARATORS)
            data = _READ[block.data].tobytes()
            terms = [data[a:b] for a, b in zip(words.start.tolist(), words.end.tolist())]
            key = batch["__item"].slice(block.first).take(pa.array(words.row))
            yield pa.RecordBatch.from_arrays([key, pa.array(terms, pa.binary())], ["__item", "term"])


class _Scanner:
    """Distinct terms of a block as an automaton over blanks and terms; built once per Python worker."""

    made: tuple[str, object] | None = None

    @classmethod
    def of(cls, shared):
        if cls.made is None or cls.made[0] != shared.id:
            import ahocorasick

            automaton = ahocorasick.Automaton()
            for i, term in enumerate(shared.value):
                automaton.add_word(f" {term.decode('latin-1')} ", i)
            automaton.make_automaton()
            cls.made = shared.id, automaton
        return cls.made[1]


class _Shared:
    """A broadcast value with a name that no other has, also in workers that live on."""

    def __init__(self, value, session):
        self._sent, self.id = session.sparkContext.broadcast(value), uuid.uuid4().hex

    @property
    def value(self):
        return self._sent.value


def _scan(shared: _Shared):
    """Documents with their number of terms, and which terms of the block they hold how often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _Scanner.of(shared) if shared.value else None
        for batch in batches:
            for block in blocks(batch["__text"]):
                words = split_words(block, SEPARATORS)
                read = _READ[block.data].tobytes()
                at = block.offsets.tolist()
                terms, counts = [], []
                for a, b in zip(at, at[1:]):
                    text = f" {read[a:b].decode('latin-1')} "
                    found = np.fromiter((i for _, i in automaton.iter(text)) if automaton else (), np.int32)
                    one, tf = np.unique(found, return_counts=True)
                    terms.append(one.astype("<i4").tobytes())
                    counts.append(tf.astype("<i4").tobytes())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["__doc"].slice(block.first, len(at) - 1),
                        pa.array(np.diff(words.first).astype(np.int64)),
                        pa.array(terms, pa.binary()),
                        pa.array(counts, pa.binary()),
                    ],
                    ["__doc", "n", "terms", "counts"],
                )

    return run


def _ragged(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of a binary column of 32-bit numbers, and how many each row has."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]].view("<i4"), np.diff(offsets) // 4


def _frequencies(n_terms: int):
    """How many documents of the task hold each term; term -1 counts documents with a term, -2 sums their terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, docs, length = np.zeros(n_terms, np.int64), 0, 0
        for batch in batches:
            df += np.bincount(_ragged(batch["terms"])[0], minlength=n_terms)
            n = batch["n"].to_numpy()
            docs += int((n > 0).sum())
            length += int(n.sum())
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1, -2, *some.tolist()], pa.int32()), pa.array([docs, length, *df[some].tolist()], pa.int64())],
            ["term", "df"],
        )

    return run


def _spread(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Indices ``first[i], ..., first[i] + count[i] - 1`` for every i, one after the other."""
    ends = np.cumsum(count)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - count - first, count)


def _best(item: np.ndarray, doc: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Rows of the k best documents of every item: by score, then by id."""
    order = np.lexsort((doc, -score, item))
    starts = np.searchsorted(item[order], item[order])
    return order[np.arange(len(order)) - starts < k]


def _score(shared: _Shared, n_docs: int, length: int, n_items: int, k: int):
    """The k best documents of the task for every item: ``__at`` (its number in the block), ``__doc`` and ``score``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, first, items, repeats, exact = shared.value
        # A document leads to at most all items, by at most all postings.
        size = max(1, (1 << 21) // max(n_items, len(items)))
        no_id = np.iinfo(np.int64).max
        best = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)]
        least = np.ones(n_items, np.int64)
        for batch in batches:
            for lo in range(0, len(batch), size):
                part = batch.slice(lo, size)
                # A missing id ranks behind all others and is given back as missing.
                doc = part["__doc"].fill_null(no_id).to_numpy()
                n = part["n"].to_numpy()
                term, per_doc = _ragged(part["terms"])
                tf = _ragged(part["counts"])[0].astype(np.int64)
                row = np.repeat(np.arange(len(part)), per_doc)
                m = 25 + 75 * n * n_docs // length
                value = weight[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m[row]))
                fan = first[term + 1] - first[term]
                post = _spread(first[term], fan)
                cell = np.repeat(row, fan) * n_items + items[post]
                gain = np.repeat(value, fan) * repeats[post]
                if exact:
                    total = np.bincount(cell, gain, len(part) * n_items).astype(np.int64)
                else:
                    total = np.zeros(len(part) * n_items, np.int64)
                    np.add.at(total, cell, gain)
                hit = np.flatnonzero(total >= np.tile(least, len(part)))
                found = [hit % n_items, doc[hit // n_items], total[hit]]
                best = [np.concatenate(pair) for pair in zip(best, found)]
                if len(best[0]) > 4 * k * n_items or lo + size >= len(batch):
                    top = _best(*best, k)
                    best = [values[top] for values in best]
                    full = np.flatnonzero(np.bincount(best[0], minlength=n_items) >= k)
                    lowest = np.full(n_items, no_id)
                    np.minimum.at(lowest, best[0], best[2])
                    least[full] = lowest[full]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(best[0].astype(np.int32)),
                pa.array(best[1], mask=best[1] == no_id),
                pa.array(best[2]),
            ],
            ["__at", "__doc", "score"],
        )

    return run


def rank_documents(
    items: DataFrame,
    docs: DataFrame,
    k: int = 10,
    block_bytes: int = BLOCK_BYTES,
    item_id: str = "item_id",
    doc_id: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The ``k`` best documents of every item: ``item_id``, ``rank`` (from 1), ``doc_id`` (long) and ``score`` (above 0).

    Terms are runs of ASCII letters, digits and all other characters outside ASCII, A-Z lower-cased. With N
    documents that have a term, L terms in them, and for a document its n terms, m = 25 + 75 n N div L. A
    term in df documents has the weight w = floor(1000 ln((2 N + 2) / (2 df + 1))); an item's score sums
    w (10^9 tf div (1000 tf + 8 m)) over its terms, repeats included. Equal scores are ranked by ``doc_id``.

    Rows of equal item id (null too) are one item with all their terms. Every row of ``docs`` is a document,
    also with a repeated id; one without an id ranks last among equals. Null texts have no terms; items
    without a match and empty tables give no rows. Other columns are not looked at.

    Items are spread by hash over blocks of about ``block_bytes`` of distinct terms; a block's terms and
    frequencies are what the driver gets and every task holds. Each block is one scan of the texts.
    """
    spark = docs.sparkSession
    texts = items.select(F.col(item_id).cast("long").alias("__item"), F.col(text_col).cast("string").alias("__text"))
    terms = texts.mapInArrow(_item_terms, "__item long, term binary").groupBy("__item", "term").count()
    terms = stored(terms, "item-terms")
    size = terms.agg(F.sum(F.octet_length("term") + F.lit(16))).first()[0] or 0
    n_blocks = -(-size // block_bytes)
    block = F.pmod(F.xxhash64(F.coalesce("__item", F.lit(-1)), F.col("__item").isNull()), F.lit(max(n_blocks, 1)))
    narrow = docs.select(F.col(doc_id).cast("long").alias("__doc"), F.col(text_col).cast("string").alias("__text"))
    ranked = None
    for number in range(n_blocks):
        mine = terms.where(block == number).collect()
        if not mine:
            continue
        words = sorted({r["term"] for r in mine})
        keys = sorted({r["__item"] for r in mine}, key=lambda i: (i is None, i))
        at, item_at = {w: i for i, w in enumerate(words)}, {i: n for n, i in enumerate(keys)}
        scan = _scan(_Shared([bytes(w) for w in words], spark))
        seen = stored(narrow.mapInArrow(scan, "__doc long, n long, terms binary, counts binary"), "term-counts")
        df = dict(seen.mapInArrow(_frequencies(len(words)), "term int, df long").groupBy("term").sum("df").collect())
        n_docs, length = df.get(-1, 0), df.get(-2, 0)
        if not n_docs:
            return spark.createDataFrame([], f"`{item_id}` long, rank int, `{doc_id}` long, score long")
        weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df.get(i, 0) + 1))) for i in range(len(words))])
        posts = sorted((at[r["term"]], item_at[r["__item"]], r["count"]) for r in mine)
        term, item, repeats = (np.array(x, np.int64) for x in zip(*posts))
        most = np.bincount(item, weight[term].astype(float) * repeats * 1e6).max()
        index = weight, np.searchsorted(term, np.arange(len(words) + 1)), item, repeats, bool(most < _EXACT)
        scored = seen.mapInArrow(
            _score(_Shared(index, spark), n_docs, length, len(keys), k), "__at int, __doc long, score long"
        )
        # Stored, since the driver's table of item ids below belongs to this block only.
        names = spark.createDataFrame(list(enumerate(keys)), f"__at int, `{item_id}` long")
        best = stored(scored, "best-documents").join(F.broadcast(names), "__at").drop("__at")
        ranked = best if ranked is None else ranked.unionByName(best)
    if ranked is None:
        return spark.createDataFrame([], f"`{item_id}` long, rank int, `{doc_id}` long, score long")
    order = Window.partitionBy(item_id).orderBy(F.desc("score"), F.asc_nulls_last("__doc"))
    ranked = ranked.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select(item_id, "rank", F.col("__doc").alias(doc_id), "score")
