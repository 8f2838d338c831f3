"""Removal of word passages that occur earlier in the corpus, found by difference-cover anchors.

Positions of a text are taken modulo a period. The residues of a difference cover have every
difference among them, so two equal passages, wherever they start, have both a cover position
at one common distance from their starts, less than a period in. Hashing short windows at
cover positions only (4 of 13) therefore still gives every pair of equal long windows a shared
anchor. Anchors that occur once are dropped; around the others the long windows are compared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.storage import stored
from tidemark.llm.words import blocks, hash_words, mix, split_words, window_hashes

#: Periods and their difference covers, largest first.
COVERS = {13: (0, 1, 3, 9), 7: (1, 2, 4), 3: (0, 1), 1: (0,)}

#: Shortest anchor, in words: shorter ones would be frequent by chance.
LEAST_ANCHOR = 8

#: ``__at`` holds the row's tag, a word position and a flag: see :func:`_place`.
_ANCHORS = "__h long, __doc long, __at long"
_WINDOWS = "__h long, __doc long, __at long, __n int"
_BLOCK = 1 << 21
_TAG = 40


def choose_cover(width: int) -> tuple[int, tuple[int, ...], int]:
    """Period, cover and anchor length for windows of ``width`` words: anchor + period - 1 <= width."""
    for period, cover in COVERS.items():
        if width - period + 1 >= LEAST_ANCHOR or period == 1:
            return period, cover, width - period + 1
    raise AssertionError


def _earlier_in_block(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by the keys (last is the main one); whether each has the main key of the one before it."""
    order = np.lexsort(keys)
    same = np.zeros(len(order), bool)
    same[1:] = keys[-1][order[1:]] == keys[-1][order[:-1]]
    return order, same


def _place(tag: np.ndarray, position: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Tag, position and flag as one number: fewer bytes to shuffle than three columns."""
    return (tag << _TAG) | (position << 1) | known


def _stray(doc: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Hashes for rows that need not meet others of their content."""
    return mix(mix(doc.view(np.uint64)) + at.astype(np.uint64))


def _anchors(width: int):
    period, cover, length = choose_cover(width)
    wanted = np.isin(np.arange(period), cover)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, tags = batch["__doc"].to_numpy(), batch["__tag"].to_numpy().astype(np.int64)
            for block in blocks(batch["__text"], _BLOCK):
                words = split_words(block)
                at, h = window_hashes(hash_words(block, words), words, length)
                position = at - words.first[words.row[at]]
                # Only texts with a whole window can lose words.
                long = (words.first[words.row[at] + 1] - words.first[words.row[at]]) >= width
                keep = wanted[position % period] & long
                at, h, position = at[keep], h[keep], position[keep]
                row = block.first + words.row[at]
                # What repeats within the block is known to repeat: only the first of each goes
                # to where its hash belongs, so a frequent passage does not fill one task.
                order, same = _earlier_in_block(h)
                known = same.copy()
                known[:-1] |= same[1:]
                h, doc = h[order], docs[row[order]]
                place = _place(tags[row[order]], position[order], known)
                h = np.where(same, _stray(doc, place), h)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.view(np.int64)), pa.array(doc), pa.array(place)], ["__h", "__doc", "__at"]
                )

    return run


def _windows(width: int):
    _, _, length = choose_cover(width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, tags = batch["__doc"].to_numpy(), batch["__tag"].to_numpy().astype(np.int64)
            anchors = batch["__anchors"]
            ends, values = anchors.offsets.to_numpy(), anchors.values.to_numpy()
            for block in blocks(batch["__text"], _BLOCK):
                words = split_words(block)
                at, h = window_hashes(hash_words(block, words), words, width)
                mark = np.zeros(len(words.start) + 1, np.int32)
                lo, hi = block.first, block.first + len(block.offsets) - 1
                anchor, of = values[ends[lo] : ends[hi]], np.repeat(np.arange(lo, hi), np.diff(ends[lo : hi + 1]))
                mine = (anchor >> _TAG) == tags[of]
                base, anchor = words.first[of[mine] - lo], (anchor[mine] & ((1 << _TAG) - 1)) >> 1
                np.add.at(mark, base + np.maximum(anchor - (width - length), 0), 1)
                np.add.at(mark, base + anchor + 1, -1)
                keep = np.cumsum(mark)[at] > 0
                at, h = at[keep], h[keep]
                if not len(at):
                    continue
                start = at - words.first[words.row[at]]
                doc, tag = docs[lo + words.row[at]], tags[lo + words.row[at]]
                order, same = _earlier_in_block(start, doc, h)
                h, tag, doc, start = h[order], tag[order], doc[order], start[order]
                # Rows equal in id and position are no earlier occurrence of each other.
                first = np.maximum.accumulate(np.where(same, 0, np.arange(len(h))))
                known = (doc != doc[first]) | (start != start[first])
                new = ~known
                yield _window_batch(h[new], doc[new], _place(tag[new], start[new], False), 1)
                # What is known to repeat goes as runs of starts.
                tag, doc, start = tag[known], doc[known], start[known]
                back = np.lexsort((start, tag, doc))
                tag, doc, start = tag[back], doc[back], start[back]
                run_on = (doc[1:] == doc[:-1]) & (tag[1:] == tag[:-1]) & (start[1:] == start[:-1] + 1)
                head = np.flatnonzero(np.r_[True, ~run_on][: len(doc)])
                place = _place(tag[head], start[head], True)
                yield _window_batch(_stray(doc[head], place), doc[head], place, np.diff(np.r_[head, len(doc)]))

    return run


def _window_batch(h, doc, place, n) -> pa.RecordBatch:
    size = np.broadcast_to(np.asarray(n, np.int32), h.shape)
    return pa.RecordBatch.from_arrays(
        [pa.array(h.view(np.int64)), pa.array(doc), pa.array(place), pa.array(size)], ["__h", "__doc", "__at", "__n"]
    )


def _cut(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, tags = batch["__spans"].to_pylist(), batch["__tag"].to_pylist()
            n_words, n_removed, kept = [], [], []
            copies = batch["__copy"].to_pylist()
            for text, tag, repeated, copy in zip(batch["__text"], tags, spans, copies, strict=True):
                words = (text.as_py() or "").encode().split()
                n_words.append(len(words))
                if copy and len(words) >= width:
                    words = []
                elif repeated:
                    mark = np.zeros(len(words) + 1, np.int32)
                    for span in repeated:
                        if span["__at"] >> _TAG == tag:
                            start = (span["__at"] & ((1 << _TAG) - 1)) >> 1
                            mark[start] += 1
                            mark[min(len(words), start + span["__n"] + width - 1)] -= 1
                    stay = np.cumsum(mark[:-1]) == 0
                    words = [words[i] for i in np.flatnonzero(stay)]
                n_removed.append(n_words[-1] - len(words))
                kept.append(b" ".join(words).decode())
            left = [batch.column(i) for i, name in enumerate(batch.schema.names) if not name.startswith("__")]
            names = [name for name in batch.schema.names if not name.startswith("__")]
            yield pa.RecordBatch.from_arrays(
                [*left, pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())],
                [*names, "n_words", "n_removed", "kept_text"],
            )

    return run


def remove_repeated_passages(
    docs: DataFrame, width: int = 20, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Cut from every text the words of passages of ``width`` words that also start earlier.

    Earlier means in a document with a smaller id, or before in the same one; passages are
    judged on the texts as they come in. Words are runs of other characters than blanks and
    the controls from tab to carriage return. Returns ``id_col``, ``n_words``, ``n_removed`` and
    ``kept_text``, the words that stay joined by one blank; other columns are left out.

    Null texts have no words; null ids count as one document before all others; windows of rows
    equal in id are no earlier occurrence of each other at the same start; an empty table gives
    no rows.

    The texts are shuffled once, by id (all joins use that exchange), anchors and long windows
    once each by their hash; a passage sends at most one row per block of texts to its hash.
    """
    plain = docs.select(
        F.col(id_col),
        F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**63))).alias("__doc"),
        F.md5(F.coalesce(F.col(text_col), F.lit(""))).alias("__md5"),
        F.col(text_col).alias("__text"),
    )
    # Exact copies of an earlier text lose every word, and no other text's result depends on them.
    narrow = plain.select("__doc", "__md5")
    copied = narrow.groupBy("__md5").agg(F.min("__doc").alias("__first"), F.max("__doc").alias("__last"))
    copied = stored(copied.where(F.col("__first") < F.col("__last")).select("__md5", "__first"), "copied-texts")
    later = F.col("__first").isNotNull() & (F.col("__first") < F.col("__doc"))
    notes = (
        narrow.join(copied, "__md5", "left")
        .groupBy("__doc")
        .agg((F.count(F.lit(1)) > 1).alias("__again"), F.collect_set(F.when(later, F.col("__md5"))).alias("__copies"))
        .where(F.col("__again") | (F.size("__copies") > 0))
    )
    # Texts are told apart by their id, and by a tag where rows share one.
    texts = plain.join(stored(notes, "copy-notes"), "__doc", "left").select(
        id_col,
        "__doc",
        F.when(F.col("__again"), F.pmod(F.hash("__md5"), F.lit(1 << 20))).otherwise(0).cast("int").alias("__tag"),
        F.coalesce(F.array_contains("__copies", F.col("__md5")), F.lit(False)).alias("__copy"),
        "__text",
    )
    # The id goes along in every branch, so that all of them read one exchange of the texts.
    fresh = texts.where(~F.col("__copy")).select(id_col, "__doc", "__tag", "__text")
    known = (F.col("__at") % 2) == 1
    position = F.shiftright(F.col("__at") % (1 << _TAG), 1)
    anchors = fresh.mapInArrow(_anchors(width), _ANCHORS)
    shared = anchors.withColumn("__times", F.count(F.lit(1)).over(Window.partitionBy("__h")))
    shared = shared.where(known | (F.col("__times") > 1))
    by_row = shared.groupBy("__doc").agg(F.collect_list("__at").alias("__anchors"))
    windows = fresh.join(by_row, "__doc").select(id_col, "__doc", "__tag", "__text", "__anchors")
    windows = windows.mapInArrow(_windows(width), _WINDOWS)
    place = F.rank().over(Window.partitionBy("__h").orderBy("__doc", position))
    repeated = windows.withColumn("__place", place).where(known | (F.col("__place") > 1))
    spans = repeated.groupBy("__doc").agg(F.collect_list(F.struct("__at", "__n")).alias("__spans"))
    kind = docs.schema[id_col].dataType.simpleString()
    return (
        texts.join(spans, "__doc", "left")
        .select(id_col, "__tag", "__text", "__spans", "__copy")
        .mapInArrow(_cut(width), f"`{id_col}` {kind}, n_words long, n_removed long, kept_text string")
    )
