"""Lexical search, best-fit packing and the prefix trie on odd input and against brute force."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import bestfit, checked, lexical, prefixes, running
from tidemark.llm.tokens import Encoder
from tests.conftest import DATA, DATA_10X

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def ranked(items, docs, k):
    """The contract of the search, word for word; ``docs`` are (id, text) rows."""
    held = [(d, collections.Counter(TERM.findall((t or "").translate(LOWER)))) for d, t in docs]
    held = [(d, c, sum(c.values())) for d, c in held if c]
    n_docs, length = len(held), sum(n for _, _, n in held)
    df = collections.Counter(t for _, c, _ in held for t in c)
    wanted = collections.defaultdict(collections.Counter)
    for i, text in items:
        wanted[i].update(TERM.findall((text or "").translate(LOWER)))
    out = []
    for i, terms in wanted.items():
        scores = []
        for d, c, n in held:
            m = 100 - 75 + (75 * n * n_docs) // length
            score = sum(
                r * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                for t, r in terms.items() if c[t]
            )
            if score > 0:
                scores.append((-score, d is None, d or 0, d))
        out += [(i, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scores)[:k], 1)]
    return out


def test_lexical_search_on_odd_rows(spark):
    long = " ".join(f"w{i % 977}" for i in range(300_000))
    docs = [(1, "The cat, the hat"), (1, "The cat, the hat"), (2, None), (3, ""), (4, " \n\t"), (5, long), (None, "cat é漢字 hat"),
            (6, "É é 漢字, İx"), (7, "cathat thecat"), (8, "under_score the-cat"), (9, "\x00cat\x7fhat")]
    items = [(1, "the CAT the w5 w7"), (1, "hat"), (None, "é 漢字"), (2, None), (3, ""), (4, "nowhere"), (5, "cathat"), (6, "score")]
    got = lexical.rank_documents(
        spark.createDataFrame([(*i, "x", 1) for i in items], "item_id long, text string, rank string, score int"),
        spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, score string, __doc int"), k=3
    )
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    want = sorted(ranked(items, docs, 3), key=key)
    assert sorted(map(tuple, got.collect()), key=key) == want and len(want) == 6
    some = spark.createDataFrame(items, "item_id long, text string")
    rows = spark.createDataFrame(docs, "doc_id long, text string")
    blocked = lexical.rank_documents(some, rows, k=3, block_bytes=40)
    assert sorted(map(tuple, blocked.collect()), key=key) == want
    assert lexical.rank_documents(some.limit(0), rows).count() == lexical.rank_documents(some, rows.limit(0)).count() == 0
    assert lexical.rank_documents(some, rows.where("doc_id in (2, 3, 4)")).count() == 0


def test_lexical_scores_beyond_floating_point(spark):
    items = [(1, "rare " * 3_000 + "cat")]
    docs = [(i, "cat " * (i % 3 + 1) + ("rare" if i % 50 == 0 else "x")) for i in range(200)]
    got = lexical.rank_documents(
        spark.createDataFrame(items, "item_id long, text string"), spark.createDataFrame(docs, "doc_id long, text string")
    )
    assert sorted(map(tuple, got.collect())) == sorted(ranked(items, docs, 10))


def test_kept_runs_give_the_library_ids():
    import public_tokenizers as public
    from tokenizers import Tokenizer

    path = public.path("word_bpe_49k.json")
    texts = ["", "x<|endoftext|>y <|startoftext|>", "\t " * 100_000, "a" + " " * 2_000_000 + "b", "a" * 10_000,
             "It's THE end's 'S 'LL we'll 1234 a1b2 __init__ é É İstanbul ŉ ſ ß ẞ  two\n\nnew \r\n x", "漢字 日本 ñ ́a é", "''s ... ,.;'sing"]
    whole, own = Tokenizer.from_file(path), Encoder(path)
    for _ in range(2):
        for text, ids in zip(texts, own.encode(texts)):
            assert np.frombuffer(ids, "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids


def test_best_fit_packing_is_an_exact_round_trip(spark):
    import public_tokenizers as public
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public.path("word_bpe_49k.json"))
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{DATA_10X}/documents.parquet").collect()}
    pieces, fill = collections.defaultdict(list), collections.defaultdict(list)
    for r in checked.op12_best_fit_packing(spark, DATA_10X).collect():
        pieces[r["doc_id"]].append(r)
        fill[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(pieces) == set(texts)
    for doc, text in texts.items():
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        mine = sorted(pieces[doc], key=lambda r: r["piece"])
        assert [(r["piece"], r["start"]) for r in mine] == [(i, 2048 * i) for i in range(-(-len(ids) // 2048))]
        for r in mine:
            part = ids[r["start"] : r["start"] + 2048]
            assert (r["length"], r["ids_crc32"]) == (len(part), zlib.crc32(part.tobytes()))
    used = 0
    for parts in fill.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 2048
        used += end
    assert len(fill) <= 1.005 * used / 2048 + 1


def test_underfull_windows_meet_up_the_tree(spark, monkeypatch):
    monkeypatch.setattr(bestfit, "RUN_ROWS", 64)
    rng = np.random.default_rng(3)
    lengths = rng.integers(1, 101, 3_000).tolist() + [100] * 20 + [60] * 50
    df = spark.createDataFrame([(i, n, "x", 0) for i, n in enumerate(lengths)], "id int, length int, offset string, sequence_id int")
    rows = bestfit.pack_best_fit(df.repartition(40), window=100, slack=0).collect()
    assert sorted((r["id"], r["length"]) for r in rows) == list(enumerate(lengths))
    fill = collections.defaultdict(list)
    for r in rows:
        fill[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in fill.values():
        assert [o for o, _ in sorted(parts)] == np.cumsum([0, *(n for _, n in sorted(parts))])[:-1].tolist()
        assert sum(n for _, n in parts) <= 100
    bins, _, _ = bestfit.best_fit(np.array(lengths), 100)
    assert len(fill) <= 1.05 * (bins.max() + 1)  # runs of 64 pieces of half a window each
    assert bestfit.pack_best_fit(df.limit(0), window=100).count() == 0
    with pytest.raises(Exception, match="piece lengths"):
        bestfit.pack_best_fit(df, window=99).collect()


def test_pieces_of_odd_texts(spark):
    import public_tokenizers as public

    rows = [(1, None, 5, "x"), (1, None, 5, "x"), (None, "", 5, "x"), (2, "a " * 5_000, None, "x"), (3, " \n", 1, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, start int, piece string")
    packed = bestfit.pack_best_fit(bestfit.cut_long_texts(df, public.path("word_bpe_49k.json")))
    got = [(r["doc_id"], r["piece"], r["start"], r["length"]) for r in packed.collect()]
    assert collections.Counter(got) == collections.Counter(
        [(1, 0, 0, 1), (1, 0, 0, 1), (None, 0, 0, 1), (3, 0, 0, 1), (2, 0, 0, 2048), (2, 1, 2048, 2048), (2, 2, 4096, 905)]
    )


def trie(rows, shared_with, shared_turns):
    """All nodes of rebuilt conversations by their whole prefixes; ``rows`` are (conv_id, turn, role, text)."""
    md5 = lambda b: hashlib.md5(b).hexdigest()
    turns = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            turns[c].append(((turn is not None, turn or 0, md5((md5(text.encode()) + role).encode())), (role, text)))
    turns = {c: [x for _, x in sorted(t, key=lambda x: x[0])] for c, t in turns.items()}
    members, ends = collections.defaultdict(set), collections.defaultdict(list)
    for c, own in turns.items():
        h = shared_turns(c)
        path = tuple(turns.get(shared_with(c), [])[:h] + own[h:])
        for d in range(len(path) + 1):
            members[path[:d]].add(c)
        ends[path].append(c)
    children = collections.Counter(p[:-1] for p in members if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
    return sorted(
        (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p],
         hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest())
        for p, m in members.items()
    )


def rebuilt_from(c):
    return c - int(math.fmod(c, 5)), zlib.crc32(str(c).encode()) % 9


def in_spark(spark, rows, **sketch):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, depth string, k1 int")
    conv = F.col("conv")
    got = prefixes.prefix_trie(df, conv - conv % 5, F.crc32(conv.cast("string")) % 9, 8, **sketch)
    return sorted(map(tuple, got.collect()))


@pytest.mark.parametrize("sketch", [{}, {"cells_per_prefix": 0, "most_cells": 1}])
def test_prefix_trie_on_odd_rows(spark, sketch):
    copies = [(c, t, "user", f"copy {t}") for c in range(100, 160) for t in range(12)]
    rows = [
        (0, 0, "user", "hi"), (0, 1, "bot", "é漢字"), (1, 0, "user", "hi"), (1, None, None, None), (2, 5, "user", "hi"), (2, 5, "user", "ho"),
        (2, 5, "user", "ho"), (-7, 1, "user", "hi"), (-5, 0, "user", "hi"), (7, 0, "user", "x"), (8, 0, "", ""), (None, 0, "user", "hi"),
        (9, 0, "user", "y" * 100_000), (12, 0, "user", "z"), (13, 0, "user", "z"), *((30, 7, "user", "again") for _ in range(500)),
        *((31, t % 3, "user", f"t{t}") for t in range(300)), *copies,
    ]
    want = trie(rows, lambda c: rebuilt_from(c)[0], lambda c: rebuilt_from(c)[1])
    assert in_spark(spark, rows, **sketch) == want


def test_prefix_trie_without_turns(spark):
    """Conversations that only take turns over from one that is absent have no turn: the root is all there is."""
    alone = [c for c in range(1, 200) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 2][:5]
    rows = [(c, 0, "user", "gone") for c in alone]
    want = trie(rows, lambda c: rebuilt_from(c)[0], lambda c: rebuilt_from(c)[1])
    assert in_spark(spark, rows) == want and len(want) == 1
    assert in_spark(spark, []) == []


def test_many_ends_are_hashed_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefixes, "_IDS", 7)
    ends = spark.range(0, 1000).selectExpr("id % 2 AS k1", "0L AS k2", "3L AS depth", "id AS conv").repartition(9)
    got = {r["k1"]: r["sha"] for r in prefixes.ends_digests(ends).collect()}
    assert got == {k: hashlib.sha256(",".join(map(str, range(k, 1000, 2))).encode()).hexdigest() for k in (0, 1)}


@pytest.mark.parametrize("base", [1, 0x9E3779B97F4A7C15])
def test_running_sums_join_at_range_edges(spark, base):
    rng = np.random.default_rng(5)
    rows = [(int(k), i, int(v)) for i, (k, v) in enumerate(zip(np.sort(rng.integers(0, 4, 3_000)) ** 3, rng.integers(-(2**62), 2**62, 3_000)))]
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = running.running_sums(spark.createDataFrame(rows, "k long, i long, v long").repartition(5), "k", [F.col("i")], ["v"], base)
        got = sorted((r["k"], r["i"], r["__index"], r["v"]) for r in out.collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    total, seen, want = collections.Counter(), collections.Counter(), []
    for k, i, v in rows:
        total[k] += v * pow(base, seen[k], 2**64)
        seen[k] += 1
        want.append((k, i, seen[k], (total[k] + 2**63) % 2**64 - 2**63))
    assert got == want


def test_small_tables_against_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    db = duckdb.connect()
    for name in ("documents", "benchmark", "conversations"):
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    for name in ("op11_lexical_search", "op13_prefix_trie"):
        frame = checked.QUERIES[name](spark, DATA)
        result = db.execute(checked.ORACLES[name])
        order = [[d[0] for d in result.description].index(c) for c in frame.columns]
        want = [tuple(r[i] for i in order) for r in result.fetchall()]
        key = lambda r: tuple((v is None, v) for v in r)
        assert sorted(map(tuple, frame.collect()), key=key) == sorted(want, key=key)
