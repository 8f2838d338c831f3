"""Every operator on odd input, and against brute force where there is no SQL."""

import collections
import math
import re
import zlib

import numpy as np
import pytest

from tidemark.llm import checked, jaccard, langid, licenses, lines, lm, mixing, packing, quality, substring, topk
from tests.conftest import DATA, DATA_10X

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_words long, label string"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls everywhere, empty and long texts, repeated rows, and columns named like the operators' own."""
    passage = " ".join(f"word{i}" for i in range(60))
    long = " ".join(f"w{i % 977}" for i in range(20_000))
    rows = [
        (1, passage, "en", "a", 7, "x"), (1, passage, "en", "a", 7, "x"), (2, passage, None, None, None, None),
        (3, None, "en", "a", 1, "x"), (4, "", "de", "b", 1, "x"), (5, " \n\t\n", "de", "b", 1, "x"),
        (6, long, "en", "a", 1, "x"), (7, "intro " + passage + " end", "fr", "b", 1, "x"), (8, "é ß 漢字 123", "fr", None, 0, ""),
        (None, passage, "en", "a", 1, "x"), (9, "All rights reserved.\nCC BY-NC 4.0", "de", "b", 1, "x"),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def operators(spark):
    def score(d):
        model, counts = lm.train(d)
        return lm.score_texts(d, model, counts)

    import public_tokenizers as public

    cut = lambda d: packing.cut_pieces(d.select("doc_id", "text"), public.path("byte_bpe_50k.json"))
    trusted = spark.createDataFrame([(1,), (6,), (None,)], "doc_id long")
    return {
        "substring": substring.remove_repeated_passages,
        "lines": lines.drop_shared_lines,
        "jaccard": jaccard.near_duplicates,
        "lm": score,
        "quality": lambda d: quality.quality_rules(d, trusted),
        "licenses": licenses.scan_licenses,
        "langid": lambda d: langid.predict(d, langid.train(d)),
        "mixing": mixing.mix_sources,
        "packing": lambda d: packing.pack_pieces(cut(d), ["doc_id", "start"]),
    }


NAMES = ["substring", "lines", "jaccard", "lm", "quality", "licenses", "langid", "mixing", "packing"]


@pytest.mark.parametrize("name", NAMES)
def test_odd_rows(spark, odd, name):
    out = operators(spark)[name](odd)
    assert len(set(out.columns)) == len(out.columns)
    ids = collections.Counter(r["doc_id"] for r in out.collect())
    if name == "packing":
        assert set(ids) == {None, *range(1, 10)}
    else:
        assert ids == collections.Counter([None, 1, 1, *range(2, 10)])


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(spark, odd, name):
    assert operators(spark)[name](odd.limit(0)).count() == 0


def test_odd_results(spark, odd):
    cut = {r["doc_id"]: r for r in substring.remove_repeated_passages(odd).where("doc_id in (1, 2, 3, 7)").collect()}
    assert (cut[2]["n_removed"], cut[7]["n_removed"], cut[7]["kept_text"], cut[3]["n_words"]) == (60, 60, "intro end", 0)
    near = {r["doc_id"]: r for r in jaccard.near_duplicates(odd).collect()}
    assert (near[1]["n_copies"], near[2]["class_id"], near[7]["group_id"], near[3]["n_links"]) == (4, 1, 1, 0)
    lic = {r["doc_id"]: r for r in licenses.scan_licenses(odd).collect()}
    assert [p["label"] for p in lic[9]["places"] if p["base"]] == ["reserved", "cc-by"]
    lang = {r["doc_id"]: r["lang_pred"] for r in langid.predict(odd, langid.train(odd)).collect()}
    assert lang[3] == lang[4] == lang[5] == "und"


def test_topk_odd_vectors(spark):
    rows = [(0, [1.0, 0.5]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]),
            (5, [0.5, 0.5]), (6, [0.5, 0.5]), (7, []), (None, [1.0, 1.0]), (8, [1e12, 1e12]), (50, [2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [(r["query_id"], r["rank"], r["vec_id"]) for r in topk.top_k(df, df.vec_id == 0, k=4).orderBy("rank").collect()]
    assert got == [(0, 1, 8), (0, 2, 50), (0, 3, 5), (0, 4, 6)]
    assert topk.top_k(df.limit(0), df.vec_id == 0).count() == 0


def test_block_bounds_prune_and_stay_exact():
    rng = np.random.default_rng(1)
    centre = rng.normal(0, 60, (16, 32)).astype(np.int64)
    rows = [(centre[i] + rng.integers(-3, 4, (64, 32))) for i in range(16)]
    ids = [np.arange(i * 64, i * 64 + 64) for i in range(16)]
    query = centre[:4] + 1
    found, score, scored = topk.search_blocks(np.full(4, -5), query, ids, rows, 5)
    exact = query @ np.concatenate(rows).T
    for i in range(4):
        assert list(found[i]) == list(np.lexsort((np.arange(1024), -exact[i]))[:5])
    assert scored < 4 * 16


def test_pfair_deviation_is_below_one_block():
    blocks, weights = {"a": 400, "b": 37, "c": 5, "d": 90}, {"a": 5.0, "b": 2.0, "c": 1.0, "d": 3.3}
    phases = mixing.plan_phases(blocks, weights)
    slots = {}
    for p in phases:
        for block in range(p.first, p.last + 1):
            j = block - p.first
            slot = p.base + j // p.share * p.period + p.pattern[j % p.share]
            assert p.base + j * p.period // p.share <= slot < p.base - (-(j + 1) * p.period // p.share)
            assert slot not in slots
            slots[slot] = p.source
    assert sorted(slots) == list(range(sum(blocks.values())))
    assert collections.Counter(slots.values()) == blocks
    first = {p.source: p for p in phases if p.base == 0}
    end = min(p.base for p in phases if p.base)
    for t in range(1, end):
        for s, p in first.items():
            assert abs(sum(slots[i] == s for i in range(t)) - t * p.share / p.period) < 1


def test_packing_is_an_exact_round_trip(spark):
    import public_tokenizers as public
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    rows = checked.op2_pack_tokens(spark, DATA).collect()
    pieces, fill = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        fill[r["sequence_id"]].append((r["offset"], r["length"]))
    for doc, text in texts.items():
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for r in sorted(pieces[doc], key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"]) == (at, len(ids))
            assert zlib.crc32(ids[at : at + r["length"]].tobytes()) == r["ids_crc32"]
            at += r["length"]
        assert at == len(ids)
    for parts in fill.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 1024
    assert sorted(fill) == list(range(len(fill)))


def test_base_scores_and_held_out_gain(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tokens = {d: [*WORD.findall((t or "").translate(lower)), None] for d, t in docs.items()}
    count = collections.Counter(w for d, ws in tokens.items() if zlib.crc32(str(d).encode()) % 7 != 2 for w in ws)
    n, v = sum(count.values()), len(count)
    rows = checked.op6_lm_score(spark, DATA).collect()
    assert len(rows) == len(docs)
    for r in rows:
        base = sum(math.log10((count[w] + 1) / (n + v + 1)) for w in tokens[r["doc_id"]])
        assert r["base_score"] == pytest.approx(base) and r["train_tokens"] == n
        assert r["n_known"] == sum(count[w] > 0 for w in tokens[r["doc_id"]])
    held = [r for r in checked.op6_lm_score(spark, DATA_10X).collect() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_quality_counts_and_verdicts(spark):
    rows = {r["doc_id"]: r for r in checked.op7_quality_rules(spark, DATA).collect()}
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    for d in spark.read.parquet(f"{DATA}/documents.parquet").collect():
        words, at = WORD.findall(d["text"] or ""), collections.defaultdict(list)
        for i in range(len(words) - 2):
            at[tuple(words[i : i + 3])].append(i)
        covered = {i + k for p in at.values() if len(p) > 1 for i in p for k in range(3)}
        r = rows[d["doc_id"]]
        assert (r["n_words"], r["n_repeat_words"]) == (len(words), len(covered))
        worded = [x for x in (d["text"] or "").split("\n") if WORD.search(x)]
        assert (r["word_chars"], r["n_dup_lines"]) == (len("".join(words)), len(worded) - len(set(worded)))
        assert r["n_symbols"] == len(re.findall(r"[#*$%&|<>]", d["text"] or ""))
        if d["doc_id"] in labels and not r["base_failed"]:
            assert r["kept"] == (labels[d["doc_id"]]["quality"] == 1)
    # A filter on the verdict must not copy the steps into each other.
    judged = quality.quality_rules(
        spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet").where("quality = 1")
    )
    assert judged.where("kept and n_repeat_words >= 0").count() > 0


def test_language_accuracy(spark):
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    held = [r for r in checked.op9_language_id(spark, DATA).collect() if r["held_out"]]
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) > 0.95


def test_bayes_bounds_keep_likely_pairs():
    least = jaccard.least_matches(0.8, 1e-6)
    rng = np.random.default_rng(0)
    left = rng.integers(0, 1 << 16, (2000, jaccard.HASHES)).astype(np.uint16)
    right = np.where(rng.random(left.shape) < 0.8, left, left + np.uint16(1))
    assert jaccard.bayes_keep(left, right, least).all()
    far = np.where(rng.random(left.shape) < 0.3, left, left + np.uint16(1))
    assert not jaccard.bayes_keep(left, far, least).any()


def _fold(text):
    return text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def _without_shared_lines(texts):
    """Texts by id without the lines (keys of 10 code points or more) that a smaller id has too."""
    first, out = {}, {}
    for doc in sorted(texts):
        stay = []
        for line in texts[doc].split("\n"):
            key = _fold(line.strip(" \t\n\x0b\f\r"))
            if len(key) < 10 or first.setdefault(key, doc) == doc:
                stay.append(line)
        out[doc] = "\n".join(stay)
    return out


def _near_groups(texts):
    """Smallest id that links of at least 0.8 lead to, by comparing all pairs that share a shingle."""
    sets, holders = {}, collections.defaultdict(list)
    for doc, text in texts.items():
        words = WORD.findall(_fold(text))
        sets[doc] = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
        for shingle in sets[doc]:
            holders[shingle].append(doc)
    both = collections.Counter((a, b) for docs in holders.values() for a in docs for b in docs if a < b)
    group = {doc: doc for doc in texts}
    changed = True
    while changed:
        changed = False
        for (a, b), n in both.items():
            if 5 * n >= 4 * (len(sets[a]) + len(sets[b]) - n) and group[a] != group[b]:
                group[a] = group[b] = min(group[a], group[b])
                changed = True
    return group


def test_pipeline_against_brute_force(spark):
    import corpus_pipeline
    import public_tokenizers as public
    from tokenizers import Tokenizer

    kept = {r["doc_id"] for r in checked.op7_quality_rules(spark, DATA_10X).collect() if r["kept"]}
    docs = spark.read.parquet(f"{DATA_10X}/documents.parquet").collect()
    texts = _without_shared_lines({d["doc_id"]: d["text"] for d in docs if d["doc_id"] in kept})
    texts = {doc: texts[doc] for doc, group in _near_groups(texts).items() if doc == group}
    assert 0 < len(texts) < len(kept)
    tokenizer = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    pieces = collections.Counter()
    for doc, text in texts.items():
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 0], "<u4")
        for at in range(0, len(ids), 1024):
            piece = ids[at : at + 1024]
            pieces[doc, at, len(piece), zlib.crc32(piece.tobytes()), len(ids)] += 1
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    rows = corpus_pipeline.run(spark, DATA_10X).collect()
    assert collections.Counter(tuple(r[c] for c in columns) for r in rows) == pieces


@pytest.fixture(scope="module")
def clashing(odd):
    """Odd documents with columns named like those that the stages' operators add."""
    names = ["block", "slot", "place", "n_lines", "kept_text", "kept", "class_id", "start", "n_chars"]
    return odd.selectExpr("*", *[f"n_words as {n}" for n in names])


@pytest.mark.parametrize("at", range(5))
def test_stages_on_odd_documents(spark, clashing, at):
    import corpus_pipeline

    name, stage = corpus_pipeline.STAGES[at]
    out = stage(spark, clashing, DATA)
    assert stage(spark, clashing.limit(0), DATA).count() == 0
    if name == "packing":
        assert {r["doc_id"] for r in out.collect()} == {None, *range(1, 10)}
        return
    assert out.columns == clashing.columns
    given = collections.Counter(tuple(r) for r in clashing.drop("text", "n_chars").collect())
    left = collections.Counter(tuple(r) for r in out.drop("text", "n_chars").collect())
    assert left <= given  # whole rows, with their own values in the clashing columns
    if name in ("line_dedup", "source_mixing"):
        assert left == given
    if name == "ngram_jaccard":  # one of the copies of document 1, of which one has no id; those without words all stay
        assert {r[0] for r in left} == {1, 3, 4, 5, 6, 8, 9}
    if name == "line_dedup":
        text = {r["doc_id"]: (r["text"], r["n_chars"]) for r in out.collect()}
        assert text[2] == ("", 0) and text[3] == (None, 1) and text[1] == (" ".join(f"word{i}" for i in range(60)), 7)


def test_long_texts_fill_tiles_sooner(spark, monkeypatch):
    """Small tiles give the same groups and links."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    whole = sorted(map(tuple, jaccard.near_duplicates(docs).collect()))
    monkeypatch.setattr(jaccard, "TILE_SHINGLES", 300)
    assert sorted(map(tuple, jaccard.near_duplicates(docs).collect())) == whole


def test_mixed_rows_keep_their_sources_shares(spark):
    """Every document once; blocks are whole, within their release and deadline, and one for each slot."""
    docs = {r["doc_id"]: r["source"] for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    rows = checked.op10_mix_sources(spark, DATA).collect()
    assert {r["doc_id"]: r["source"] for r in rows} == docs and len(rows) == len(docs)
    by_slot = collections.defaultdict(list)
    for r in rows:
        by_slot[r["slot"]].append(r)
        assert r["release"] <= r["slot"] < r["deadline"]
    assert sorted(by_slot) == list(range(len(by_slot)))
    size, numbers = collections.Counter(docs.values()), collections.defaultdict(list)
    for slot in sorted(by_slot):
        block = by_slot[slot]
        assert len({(r["source"], r["block"]) for r in block}) == 1
        assert sorted(r["place"] for r in block) == list(range(len(block)))
        numbers[block[0]["source"]].append(block[0]["block"])
    assert {s: b for s, b in numbers.items()} == {s: list(range(-(-n // 16))) for s, n in size.items()}


def test_licence_base_places(spark):
    """The base by brute force; the method only adds labels."""
    phrases = {("cc", "by"): "cc-by", ("general", "public", "license"): "gpl", ("all", "rights", "reserved"): "reserved"}
    rows = {r["doc_id"]: r for r in checked.op8_license_scan(spark, DATA_10X).collect()}
    docs = spark.read.parquet(f"{DATA_10X}/documents.parquet").collect()
    assert len(rows) == len(docs)
    for d in docs:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", _fold(d["text"] or ""))
        at = [(i, label) for i in range(len(words)) for p, label in phrases.items() if tuple(words[i : i + len(p)]) == p]
        starts, labels = [i for i, _ in at], sorted({label for _, label in at})
        r = rows[d["doc_id"]]
        assert (r["n_words"], r["n_base"], r["base_labels"]) == (len(words), len(at), ",".join(labels))
        assert (r["first_word"], r["last_word"]) == (min(starts, default=None), max(starts, default=None))
        assert set(labels) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1


@pytest.mark.parametrize("name", sorted(checked.ORACLES))
def test_against_sql(spark, name):
    from tests.oracle import connect, difference

    assert difference(connect(DATA), checked.QUERIES[name](spark, DATA), checked.ORACLES[name]) is None


def test_packed_windows_follow_the_mix(spark):
    """Pieces of equal length and windows stand in the order of slot and place, not of ids."""
    import corpus_pipeline
    from tidemark.llm.storage import stored

    docs = spark.read.parquet(f"{DATA_10X}/documents.parquet")
    mixed = mixing.mix_sources(docs.select("doc_id", "source"), block_rows=16, power=0.5)
    at = {r["doc_id"]: (r["slot"], r["place"]) for r in mixed.collect()}
    ordered = stored(corpus_pipeline.mixing_stage(spark, docs, DATA_10X).repartition(1).sortWithinPartitions("doc_id"), "by-id")
    assert len(at) == ordered.count()
    packed = []
    for given in (stored(corpus_pipeline.mixing_stage(spark, docs, DATA_10X), "mixed"), ordered):
        packed.append(corpus_pipeline.packing_stage(spark, given, DATA_10X).collect())
    key = lambda r: (*at[r["doc_id"]], r["start"])
    windows, full = collections.defaultdict(list), []
    for r in packed[0]:
        windows[r["sequence_id"]].append(r)
        if r["length"] == 1024:
            full.append(r)
    assert sorted(windows) == list(range(len(windows)))
    assert all(sum(r["length"] for r in w) <= 1024 for w in windows.values())
    firsts = [min(map(key, windows[i])) for i in range(len(windows))]
    assert firsts == sorted(firsts)
    assert len(full) > 50 and sorted(full, key=key) == sorted(full, key=lambda r: r["sequence_id"])
    # The same documents in another order are packed otherwise.
    assert collections.Counter(map(tuple, packed[0])) != collections.Counter(map(tuple, packed[1]))


def test_licence_key_phrases_are_not_missed(spark):
    """A standing key phrase is aligned whatever other words of its template stand, or occur anywhere."""
    texts = [
        (1, "licensed under the MIT License"), (2, "It is distributed under the MIT License, see there."),
        (3, "released under the MIT License"), (4, "mit without the license"),
        (5, "Redistribution and use in source and binary forms with or without modification are permitted"),
        (6, "Foo is subject to the new terms of the Mozilla Public License v 2 0"),
        (7, "licensed under the MIT license and again under the MIT license"),
    ]
    docs = spark.createDataFrame([*texts, *((i, "released software of version 3") for i in range(8, 40))], "doc_id long, text string")
    rows = {r["doc_id"]: r["places"] for r in licenses.scan_licenses(docs).collect()}
    labels = {i: [p["label"] for p in rows[i]] for i, _ in texts}
    assert labels == {1: ["mit"], 2: ["mit"], 3: ["mit"], 4: [], 5: ["bsd"], 6: ["mpl-2.0"], 7: ["mit", "mit"]}
    assert [p["start"] for p in rows[7]] == [3, 9] and all(p["score"] >= 0.6 for i in labels for p in rows[i])


def test_near_duplicates_by_row(spark):
    """Texts under one id, and rows without an id, are documents of their own."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [(1, a), (2, b), (2, a), (None, c), (None, c), (None, c + " more"), (None, ""), (None, None), (3, b + " end"), (7, ""), (7, "")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, class_id string, __id int")
    got = jaccard.near_duplicates(df)
    want = [(1, 1, 1, 2, 1), (2, 1, 1, 2, 1), (2, 2, 2, 1, 1), (3, 3, 2, 1, 1), (7, 7, 7, 1, 0), (7, 7, 7, 1, 0)]
    nulls = [(None, None, None, 2, 2), (None, None, None, 2, 2), (None, None, None, 1, 2)] + 2 * [(None, None, None, 1, 0)]
    assert collections.Counter(map(tuple, got.collect())) == collections.Counter(want + nulls)
    import corpus_pipeline

    left = corpus_pipeline.near_stage(spark, df, DATA)
    assert left.columns == df.columns
    kept = collections.Counter((r["doc_id"], r["text"][:2] if r["text"] else r["text"]) for r in left.collect())
    assert kept == collections.Counter([(1, "a0"), (2, "b0"), (None, "c0"), (None, ""), (None, None), (7, ""), (7, "")])


def test_long_runs_and_added_tokens_have_the_library_ids(spark):
    import public_tokenizers as public
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    texts = ["a" + " " * 2_000_000 + "b", "\t " * 500_000, "a<|endoftext|>b", "x" * 30_000, "plain text"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    pieces = packing.cut_pieces(
        df, public.path("byte_bpe_50k.json"), ranks=public.path("byte_bpe_50k.tiktoken"), pattern=public.PATTERN
    )
    got = collections.defaultdict(dict)
    for r in pieces.collect():
        got[r["doc_id"]][r["start"]] = np.frombuffer(r["ids"], "<u4")
    for i, text in enumerate(texts):
        ids = np.concatenate([got[i][at] for at in sorted(got[i])])
        assert ids.tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 0]
    assert got[2][0].tolist() == [64, 50256, 65, 0]


def test_likelihood_ratios_by_brute_force(spark):
    """``llr`` and ``kept`` from plain counts of the same hash buckets."""
    import regex
    import xxhash

    def buckets(text):
        tokens = regex.findall(r"[\p{L}\p{N}]+|[^\p{L}\p{N}\x20\x09-\x0D]+", text or "")
        hashes = [xxhash.xxh64_intdigest(t.encode(), seed=42) for t in tokens]
        pairs = [xxhash.xxh64_intdigest(t.encode(), seed=h) for h, t in zip(hashes, tokens[1:])]
        return [h % quality.BUCKETS for h in hashes] + [quality.BUCKETS + h % quality.BUCKETS for h in pairs]

    docs = {r["doc_id"]: buckets(r["text"]) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    labels = spark.read.parquet(f"{DATA}/labels.parquet").collect()
    trusted = {r["doc_id"] for r in labels if r["quality"] == 1 and r["toxic"] == 0}
    every = collections.Counter(b for grams in docs.values() for b in grams)
    good = collections.Counter(b for d, grams in docs.items() if d in trusted for b in grams)
    totals = [[sum(n for b, n in c.items() if (b >= quality.BUCKETS) == pair) for pair in (False, True)] for c in (every, good)]

    def weight(b):
        pair = b >= quality.BUCKETS
        share = [(c[b] + 1) / (total[pair] + quality.BUCKETS) for c, total in ((every, totals[0]), (good, totals[1]))]
        return round(math.log(share[1] / share[0]) * quality.UNIT)

    weights = {b: weight(b) for b in every}
    for r in checked.op7_quality_rules(spark, DATA).collect():
        grams = docs[r["doc_id"]]
        if not grams:
            assert r["llr"] is None and not r["kept"]
            continue
        llr = sum(weights[b] for b in grams) / len(grams) / quality.UNIT
        assert r["llr"] == pytest.approx(llr, abs=2e-6)
        if abs(llr - checked.QUALITY_THRESHOLD) > 1e-5:
            assert r["kept"] == (not r["base_failed"] and llr >= checked.QUALITY_THRESHOLD)


def test_licence_notices_by_votes(spark):
    """Standing key phrases alone are places; whole notices score by their rare words, also with words put in."""
    whole = licenses._BSD.replace("\n", " ")
    torn = whole.replace("provided that the", "provided always that each of the").replace("disclaimer", "notes")
    texts = [
        "This file is under the Mozilla Public License", "MIT License", "see the Apache License 2.0",
        "permission is hereby granted free of charge", "Redistribution and use in source and binary forms are permitted",
        whole, torn, "mit the license", "license mit license " * 3000, "cc by", "redistribution of binary forms and use in source",
        licenses._GPL_3.upper(),
    ]
    docs = spark.createDataFrame(list(enumerate([*texts, *["the words of any text"] * 30])), "doc_id long, text string")
    got = {r["doc_id"]: r["places"] for r in licenses.scan_licenses(docs).where(f"doc_id < {len(texts)}").collect()}
    labels = [sorted({p["label"] for p in got[i]}) for i in range(len(texts))]
    assert labels == [["mpl-2.0"], ["mit"], ["apache-2.0"], ["mit"], ["bsd"], ["bsd"], ["bsd"], [], ["mit"], ["cc-by"], [], ["gpl", "gpl-3.0"]]
    score = {i: max(p["score"] for p in got[i]) for i in (4, 5, 6)}
    votes = {i: max(p["votes"] for p in got[i]) for i in (4, 5, 6)}
    assert score[5] == 1.0 and votes[5] > votes[4] and score[4] <= score[6] <= 1.0
    assert [p["start"] for p in got[8]] == [3 * i + 1 for i in range(3000)]


def test_licence_labels_by_brute_force(spark):
    """All labels, places, votes and scores of a table, counted word by word in plain Python."""
    import math

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    words = {r["doc_id"]: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", _fold(r["text"] or "")) for r in docs.collect()}
    held = collections.Counter(w for ws in words.values() for w in set(ws))
    idf = lambda w: math.log((len(words) + 1) / (held[w] + 1)) + 1
    want = collections.defaultdict(list)
    for t in licenses.TEMPLATES:
        key, indexed = t.key.split(), []
        for form in map(str.split, t.forms):
            start = next(i for i in range(len(form)) if form[i : i + len(key)] == key)
            chosen = sorted(range(len(form)), key=lambda i: (-idf(form[i]), i))[:16]
            indexed.append([(form[i], i - start) for i in chosen])
        for doc_id, ws in words.items():
            for s in [i for i in range(len(ws)) if ws[i : i + len(key)] == key]:
                best = (1.0, min(2, len(key)))
                for k, form in enumerate(indexed):
                    on = [w for w, at in form if w in ws[max(0, s + at - 4) : max(0, s + at + 5)]]
                    one = (min(1.0, round(sum(map(idf, on)) / sum(idf(w) for w, _ in form), 6)), len(on))
                    best = max(best, one) if k else one
                want[doc_id].append((s, t.label, t.base, best[0], best[1]))
    for r in licenses.scan_licenses(docs).select("doc_id", "places").collect():
        got, expected = [tuple(p) for p in r["places"]], sorted(want[r["doc_id"]])
        assert [(*g[:3], g[4]) for g in got] == [(*e[:3], e[4]) for e in expected]
        assert all(abs(g[3] - e[3]) < 2e-6 for g, e in zip(got, expected))
    assert sum(map(len, want.values())) > 5


def test_counts_of_ngrams_hash_rows_and_not_lambdas(spark, folder, monkeypatch):
    from pyspark.sql import functions as F

    from tidemark.llm import quality

    kept, plans, keep = [], [], quality.stored

    def note(df, label):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        kept.append(keep(df, label))
        return kept[-1]

    monkeypatch.setattr(quality, "stored", note)
    docs = spark.createDataFrame([(1, "a b, a"), (2, "b"), (3, None), (4, "")], "doc_id long, text string")
    quality.ngram_weights(docs, docs.where("doc_id = 1"), 10)
    assert "lambda" not in plans[0]
    # a b , a: four words and three pairs; b: one word. A last word has no pair.
    two = F.col("__bucket") >= quality.BUCKETS
    found = kept[0].groupBy(two.alias("two")).agg(F.sum("__all"), F.sum("__good")).collect()
    assert sorted(tuple(r) for r in found) == [(False, 5, 4), (True, 3, 3)]
