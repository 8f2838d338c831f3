"""Language scores and mixing schedules against plain versions; order and missing ids."""

import collections
import math

import numpy as np
import pytest
from conftest import DATA
from pyspark.sql import functions as F

from tidemark.llm import langid, mixing


def features(text):
    """Feature counts of a text, one character after the other."""
    codes = []
    for c in text:
        if "A" <= c <= "Z":
            c = c.lower()
        codes.append(ord(c) if ord(c) > 127 or "a" <= c <= "z" else 32)
    counts = collections.Counter()
    for n in (1, 2, 3):
        for i in range(len(codes) - n + 1):
            packed = 0
            for code in codes[i : i + n]:
                packed = (packed * 2**21 + code) % 2**64
            counts[packed * (0x9E3779B97F4A7C15 + 2 * n) % 2**64 * langid.FEATURES // 2**64] += 1
    return counts


def test_scores_by_brute_force(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    model = langid.train(docs)
    frequency = collections.Counter()
    texts = [r["text"] for r in docs.where("lang is not null and text is not null").collect()]
    for text in texts:
        frequency.update(features(text).keys())
    for feature in range(0, langid.FEATURES, 97):
        assert model.idf[feature] == pytest.approx(math.log((1 + len(texts)) / (1 + frequency[feature])) + 1)
    assert (model.weights == 0).any()  # the L1 penalty leaves features out
    for r in langid.predict(docs.where("text is not null").limit(40), model).collect():
        x = {f: (1 + math.log(n)) * model.idf[f] for f, n in features(r["text"]).items()}
        norm = math.sqrt(sum(v * v for v in x.values())) or 1.0
        logits = [sum(v / norm * model.weights[f][k] for f, v in x.items()) for k in range(len(model.languages))]
        odds = [math.exp((v - max(logits)) / model.temperature) for v in logits]
        if r["lang_pred"] == langid.UNKNOWN:
            assert not any(c.isalpha() for c in r["text"])
            continue
        assert r["lang_pred"] == model.languages[int(np.argmax(odds))]
        assert r["score"] == pytest.approx(max(odds) / sum(odds), abs=1e-4)


def test_steps_by_brute_force():
    """Follow the regularised leader, one weight after the other."""
    rng = np.random.default_rng(3)
    alpha, l1, l2, shape = 0.5, 0.02, 0.1, (6, 3)
    z, n = np.zeros(shape), np.zeros(shape)
    plain_z, plain_n = [[0.0] * 3 for _ in range(6)], [[0.0] * 3 for _ in range(6)]
    for _ in range(8):
        x = np.abs(rng.normal(size=(5, 6))) * (rng.random((5, 6)) < 0.6)
        y = rng.integers(0, 3, 5)
        langid.ftrl_step(z, n, x, y, alpha, l1, l2)
        w = [[0.0] * 3 for _ in range(6)]
        for f in range(6):
            for k in range(3):
                if abs(v := plain_z[f][k]) > l1:
                    w[f][k] = -(v - math.copysign(l1, v)) / ((1 + math.sqrt(plain_n[f][k])) / alpha + l2)
        gradient = [[0.0] * 3 for _ in range(6)]
        for row, label in zip(x.tolist(), y.tolist()):
            e = [math.exp(sum(row[f] * w[f][k] for f in range(6))) for k in range(3)]
            for f in range(6):
                for k in range(3):
                    gradient[f][k] += row[f] * (e[k] / sum(e) - (k == label))
        for f in range(6):
            for k in range(3):
                g, old = gradient[f][k], plain_n[f][k]
                plain_z[f][k] += g - (math.sqrt(old + g * g) - math.sqrt(old)) / alpha * w[f][k]
                plain_n[f][k] = old + g * g
    assert z == pytest.approx(np.array(plain_z)) and n == pytest.approx(np.array(plain_n))


def test_learning_does_not_depend_on_the_order_of_rows(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text", "lang")
    one, other = (langid.train(d) for d in (docs.repartition(3), docs.orderBy(F.rand(1)).repartition(7)))
    assert one.temperature == other.temperature
    assert np.array_equal(one.idf, other.idf) and np.array_equal(one.weights, other.weights)


def earliest_deadlines_first(blocks, weights):
    """Source and block of every slot, decided slot by slot."""
    left, done, slots = dict(blocks), dict.fromkeys(blocks, 0), []
    while any(left.values()):
        live = [s for s in left if left[s]]
        period = max(mixing.PERIOD, 1 << (16 * len(live) - 1).bit_length())
        share = mixing.whole_shares({s: weights[s] for s in live}, period)
        assert sum(share.values()) == period
        begun, turn = len(slots), dict.fromkeys(live, 0)
        while all(left[s] for s in live):
            now = len(slots) - begun
            ready = [s for s in live if turn[s] * period // share[s] <= now]
            source = min(ready, key=lambda s: (math.ceil((turn[s] + 1) * period / share[s]), s))
            slots.append((source, done[source]))
            for counter, step in ((turn, 1), (done, 1), (left, -1)):
                counter[source] += step
    return slots


@pytest.mark.parametrize(
    "blocks, weights",
    [
        ({"a": 400, "b": 37, "c": 5, "d": 90}, {"a": 5.0, "b": 2.0, "c": 1.0, "d": 3.3}),
        ({"a": 3000, "b": 2500, "c": 1}, {"a": 1.0, "b": 1.0, "c": 1.0}),
        ({"a": 1}, {"a": 0.1}),
        ({f"s{i:03}": 1 + i % 7 for i in range(90)}, {f"s{i:03}": 1.0 + i for i in range(90)}),
    ],
)
def test_schedule_by_brute_force(blocks, weights):
    planned = {}
    for p in mixing.plan_phases(blocks, weights):
        for block in range(p.first, p.last + 1):
            turn, j = divmod(block - p.first, p.share)
            planned[p.base + turn * p.period + p.pattern[j]] = (p.source, block)
    assert [planned[t] for t in sorted(planned)] == earliest_deadlines_first(blocks, weights)
    assert sorted(planned) == list(range(sum(blocks.values())))


def test_rows_without_an_id_are_spread(spark, monkeypatch):
    monkeypatch.setattr(mixing, "RUN_ROWS", 50)
    docs = spark.range(1000).selectExpr("cast(null as long) doc_id", "'a' source", "concat('text ', id) text", "map(id, 1) m")
    plan = mixing.mix_sources(docs)
    assert plan.select("text").distinct().count() == 1000
    assert plan.groupBy("block").count().agg(F.max("count"), F.count("*")).first() == (16, 63)
    # Rows in order of their text would show one run only: neighbours come from all over the table.
    first = sorted(int(r["text"].split()[1]) for r in plan.where("block = 0").collect())
    assert first[-1] - first[0] > 200
