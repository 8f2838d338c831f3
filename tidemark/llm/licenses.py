"""Licence notices found through a positional index of rare notice words.

The index lists, for the words of highest IDF of every notice, where they stand relative to the
notice's key phrase. A file is looked up by the rarest licence words it has: those of the key
phrases whose words it holds all of. Each place of such a word votes for a start, and the votes of
a phrase's rare words are intersected. At the starts that are left the key phrase must stand word
for word; none that stands is missed, since it casts all of these votes. The rare words of the
whole notice then vote for each place, a few words of drift allowed, so that a notice with words put
in, left out or changed still scores. Everything is DataFrame functions on one row per document.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.lines import lower_ascii
from tidemark.llm.quality import words_of

#: All ASCII but digits and a-z; what is left after A-Z became a-z are words.
SEPARATORS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


class Template(NamedTuple):
    """A licence: its label, the phrase that must stand, notices with that phrase, and whether it is a base phrase."""

    label: str
    key: str
    forms: tuple[str, ...] = ()
    base: bool = False


# The notices that licences ask to be put into files, lower-cased and without punctuation.
_MIT = """permission is hereby granted free of charge to any person obtaining a copy of this software and associated
documentation files the software to deal in the software without restriction including without limitation the rights
to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom
the software is furnished to do so subject to the following conditions the above copyright notice and this permission
notice shall be included in all copies or substantial portions of the software"""
_BSD = """redistribution and use in source and binary forms with or without modification are permitted provided that the
following conditions are met redistributions of source code must retain the above copyright notice this list of
conditions and the following disclaimer redistributions in binary form must reproduce the above copyright notice this
list of conditions and the following disclaimer in the documentation and or other materials provided with the
distribution"""
_ISC = """permission to use copy modify and or distribute this software for any purpose with or without fee is hereby
granted provided that the above copyright notice and this permission notice appear in all copies"""
_APACHE = """licensed under the apache license version 2 0 the license you may not use this file except in compliance with
the license you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by
applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without
warranties or conditions of any kind either express or implied see the license for the specific language governing
permissions and limitations under the license"""
_GPL_3 = """this program is free software you can redistribute it and or modify it under the terms of the gnu general
public license as published by the free software foundation either version 3 of the license or at your option any later
version this program is distributed in the hope that it will be useful but without any warranty without even the implied
warranty of merchantability or fitness for a particular purpose see the gnu general public license for more details"""
_MPL = """this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not
distributed with this file you can obtain one at http mozilla org mpl 2 0"""
_UNLICENSE = """this is free and unencumbered software released into the public domain anyone is free to copy modify
publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose
commercial or non commercial and by any means"""

#: The base phrases first.
TEMPLATES = (
    Template("cc-by", "cc by", base=True),
    Template("gpl", "general public license", base=True),
    Template("reserved", "all rights reserved", base=True),
    Template("cc-by-nc", "cc by nc", ("licensed under cc by nc 4 0",)),
    Template("cc-by-sa", "cc by sa", ("licensed under cc by sa 4 0",)),
    Template("gpl-3.0", "gnu general public license version 3", ("licensed under the gnu general public license version 3",)),
    Template("gpl-3.0", "either version 3 of the license", (_GPL_3,)),
    Template("lgpl", "gnu lesser general public license", ("under the terms of the gnu lesser general public license",)),
    Template("agpl", "gnu affero general public license", ("under the terms of the gnu affero general public license",)),
    Template("apache-2.0", "apache license version 2 0", ("licensed under the apache license version 2 0", _APACHE)),
    Template("apache-2.0", "apache license 2 0", ("licensed under the apache license 2 0",)),
    Template("mit", "mit license", ("released under the mit license",)),
    Template("mit", "permission is hereby granted free of charge",
             ("permission is hereby granted free of charge to any person obtaining a copy of this software", _MIT)),
    Template("bsd", "redistribution and use in source and binary forms",
             ("redistribution and use in source and binary forms with or without modification are permitted", _BSD)),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose", (_ISC,)),
    Template("mpl-2.0", "mozilla public license", ("subject to the terms of the mozilla public license v 2 0", _MPL)),
    Template("unlicense", "free and unencumbered software", (_UNLICENSE,)),
)


class _Posting(NamedTuple):
    """A word of a notice, its place from the start of the key phrase, and its weight."""

    word: str
    at: int
    weight: float


def document_frequency(docs: DataFrame, vocabulary: Sequence[str], text_col: str = "text") -> dict[str, int]:
    """In how many documents each word of the (small) vocabulary stands."""
    words = words_of(lower_ascii(F.col(text_col)), SEPARATORS)
    found = docs.select(F.explode(F.array_intersect(words, F.lit(list(vocabulary)))).alias("w"))
    counts = {r["w"]: r["n"] for r in found.groupBy("w").agg(F.count(F.lit(1)).alias("n")).collect()}
    return {w: counts.get(w, 0) for w in vocabulary}


def _rarest(words: Sequence[str], idf: dict[str, float], n: int, start: int = 0) -> list[_Posting]:
    """The ``n`` places of highest IDF; of equal ones, the first."""
    ranked = sorted(range(len(words)), key=lambda i: (-idf[words[i]], i))[:n]
    return [_Posting(words[i], i - start, idf[words[i]]) for i in sorted(ranked)]


def _postings(template: Template, idf: dict[str, float], n: int) -> list[list[_Posting]]:
    """The index entries of every notice of a licence."""
    key, out = template.key.split(), []
    for form in template.forms:
        words = form.split()
        start = next(i for i in range(len(words)) if words[i : i + len(key)] == key)
        out.append(_rarest(words, idf, n, start))
    return out


def _starts(key: Sequence[str], lead: Sequence[_Posting]) -> Column:
    """Where the key phrase stands: starts that all its rare words vote for, checked word for word."""
    def votes_of(p: _Posting) -> Column:
        return F.transform(F.filter("__hits", lambda h: h["w"] == p.word), lambda h: h["i"] - p.at)
    votes = [votes_of(p) for p in lead]
    agreed = votes[0]
    for more in votes[1:]:
        agreed = F.array_intersect(agreed, more)
    phrase = F.lit(list(key))
    return F.filter(agreed, lambda s: F.when(s >= 0, F.slice("__words", s + 1, len(key)) == phrase).otherwise(False))


def _agreeing(start: Column, form: Sequence[_Posting], drift: int) -> tuple[Column, Column]:
    """Number and share by weight of a notice's rare words that stand within ``drift`` words of their places."""
    def stands(p: Column) -> Column:
        first = F.greatest(start + p["at"] - drift, F.lit(0))
        window = F.slice("__words", first + 1, F.greatest(start + p["at"] + drift + 1 - first, F.lit(0)))
        return F.array_contains(window, p["word"])
    index = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(p._fields, p)]) for p in form])
    found = F.filter(index, stands)
    weight = F.aggregate(found, F.lit(0.0), lambda total, p: total + p["weight"])
    return F.size(found), F.least(F.lit(1.0), F.round(weight / sum(p.weight for p in form), 6))


def _places(template: Template, lead: Sequence[_Posting], forms: list[list[_Posting]], drift: int) -> Column:
    """The standing key phrases, each with the notice that most of the IDF speaks for."""
    def place(start: Column) -> Column:
        votes, score = F.lit(len(lead)), F.lit(1.0)
        if forms:
            each = [_agreeing(start, form, drift) for form in forms]
            best = F.array_max(F.array(*[F.struct(s.alias("score"), v.alias("votes")) for v, s in each]))
            votes, score = best["votes"], best["score"]
        label, base = F.lit(template.label), F.lit(template.base)
        return F.struct(start.alias("start"), label.alias("label"), base.alias("base"), score.alias("score"), votes.alias("votes"))
    return F.transform(_starts(template.key.split(), lead), place)


def scan_licenses(
    docs: DataFrame,
    templates: Sequence[Template] = TEMPLATES,
    least: float = 0.0,
    text_col: str = "text",
    rare: int = 16,
    drift: int = 4,
) -> DataFrame:
    """Add the licence notices of every document.

    Words are runs of digits, letters a-z (A-Z count as these) and characters beyond ASCII.
    ``n_words``; ``places``, an array of (label, base, start, score, votes) in order of start, where
    ``start`` is the word at which the licence's key phrase begins, ``votes`` the number of the ``rare``
    rarest words of its notice that stand within ``drift`` words of their places, and ``score`` their share of the
    IDF of these words (base phrases: all of it). Of several notices of a licence the best one counts.
    A standing key phrase is a place whatever else stands; ``least`` above 0 asks for a score, but not of base
    phrases. All columns of ``docs`` stay; columns of the two names are replaced.

    Null and empty texts have no words and no places; an empty table gives no rows. Work on a text
    grows with its words and places, whatever stands how often. The driver gets one count per notice word.
    """
    docs = docs.drop("n_words", "places")
    vocabulary = sorted({w for t in templates for text in (t.key, *t.forms) for w in text.split()})
    frequency = document_frequency(docs, vocabulary, text_col)
    total = max(1, docs.count())
    idf = {w: math.log((total + 1) / (n + 1)) + 1 for w, n in frequency.items()}
    leads = [_rarest(t.key.split(), idf, 2) for t in templates]

    out = docs.withColumn("__words", words_of(lower_ascii(F.col(text_col)), SEPARATORS))
    keys = sorted({w for t in templates for w in t.key.split()}, key=lambda w: (-idf[w], w))
    out = out.withColumn("__has", F.array_intersect(F.lit(keys), "__words"))  # the file's licence words, rarest first
    holds = [F.size(F.array_except(F.lit(sorted(set(t.key.split()))), F.col("__has"))) == 0 for t in templates]
    none = F.array().cast("array<string>")
    ask = F.flatten(F.array(*[F.when(h, F.lit([p.word for p in lead])).otherwise(none) for h, lead in zip(holds, leads)]))
    out = out.withColumn("__ask", ask)
    listed = F.transform("__words", lambda w, i: F.struct(w.alias("w"), i.alias("i")))
    hits = F.filter(listed, lambda h: F.array_contains("__ask", h["w"]))
    out = out.withColumn("__hits", F.when(F.size("__ask") > 0, hits))

    empty = F.array().cast("array<struct<start:int,label:string,base:boolean,score:double,votes:int>>")
    found = []
    for t, h, lead in zip(templates, holds, leads):
        places = _places(t, lead, _postings(t, idf, rare), drift)
        if least > 0 and not t.base:
            places = F.filter(places, lambda p: p["score"] >= least)
        found.append(F.when(h, places).otherwise(empty))
    places = F.when(F.col("__hits").isNull(), empty).otherwise(F.sort_array(F.concat(*found)))
    out = out.withColumns({"n_words": F.size("__words").cast("long"), "places": places})
    return out.drop("__words", "__has", "__ask", "__hits")
