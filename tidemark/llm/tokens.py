"""Token ids of texts by a tokenizer file that drops white space, with the ids of words kept between texts.

Such a tokenizer never merges over white space, so a run of other characters has the same ids wherever
it stands. A text is split at white space; the words of a run not seen before are encoded by the model
of the ``tokenizers`` library, and the ids of a text are those of its runs, joined. This is done
for texts of characters on whose classes all versions of Unicode agree; other texts, texts that hold
an added token, and tokenizers of another make are encoded whole by the library. Both ways give the
same ids.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Sequence
from functools import lru_cache

import numpy as np

_LETTERS = "a-zA-ZÀ-ÖØ-öø-įı-ſ"

#: Texts that are split here: no character with its own rule of normal form or case among them.
_PLAIN = re.compile(rf"[\t\n\r\x20-\x7e{_LETTERS}]*")

#: Words of the one known make of tokenizer, over plain characters, and its pattern in the file (fixed values).
_WORDS = re.compile(rf"[{_LETTERS}]+|'(?:s|t|re|ve|m|ll|d)|[0-9]|[^\s{_LETTERS}0-9]+")
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

#: Runs kept between batches, and the longest that is kept.
KEPT_RUNS = 1 << 20
LONGEST_RUN = 64


def _drops_spaces(made: dict) -> bool:
    """Whether this is the make of tokenizer that is split here."""
    parts = (made.get("pre_tokenizer") or {}).get("pretokenizers", [])
    steps = [(n["type"], n.get("content")) for n in (made.get("normalizer") or {}).get("normalizers", [])]
    return (
        steps == [("NFC", None), ("Replace", " "), ("Lowercase", None)]
        and [p["type"] for p in parts] == ["Split", "ByteLevel"]
        and parts[0]["pattern"] == {"Regex": _PATTERN}
    )


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself where it can be printed, else 256 and up."""
    own = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD]
    others = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(others)}


class Encoder:
    """``encode(texts)``: the ids of every text as little-endian unsigned 32-bit numbers."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self._whole = Tokenizer.from_file(path)
        self._model = self._whole.model
        with open(path, encoding="utf-8") as file:
            made = json.load(file)
        self._splits = _drops_spaces(made)
        self._added = [t["content"] for t in made.get("added_tokens", [])]
        self._letters = _byte_letters()
        # Runs of late, and runs of before that: half of the kept ones at most are let go at a time.
        self._kept: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}

    def _word_ids(self, word: str) -> bytes:
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(self._letters)
        return array("I", [token.id for token in self._model.tokenize(word)]).tobytes()

    def _run_ids(self, run: str) -> bytes:
        """Ids of a run that is not among those of late; its words are runs too."""
        ids = self._older.get(run)
        if ids is None:
            words = [run] if run.isalpha() else _WORDS.findall(run)
            if words == [run]:
                ids = self._word_ids(run)
            else:
                ids = b"".join([self._kept.get(word) or self._run_ids(word) for word in words])
        if len(run) <= LONGEST_RUN:
            self._kept[run] = ids
            if len(self._kept) >= KEPT_RUNS // 2:
                self._kept, self._older = {}, self._kept
        return ids

    def _plain(self, text: str) -> bool:
        return self._splits and _PLAIN.fullmatch(text) is not None and not any(a in text for a in self._added)

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        out = []
        for text in texts:
            if not self._plain(text):
                ids = self._whole.encode_batch_fast([text], add_special_tokens=False)[0].ids
                out.append(np.array(ids, "<u4").tobytes())
                continue
            runs = text.lower().split()
            ids = list(map(self._kept.get, runs))
            if None in ids:
                ids = [self._run_ids(run) if i is None else i for run, i in zip(runs, ids)]
            out.append(b"".join(ids))
        return out


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One encoder per tokenizer file and Python worker."""
    return Encoder(path)
