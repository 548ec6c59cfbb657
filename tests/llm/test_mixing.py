from __future__ import annotations

import heapq
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tripline.llm import mixing
from tripline.llm.common import table
from tripline.llm.queries import QUERIES


def plain_apportion(votes, seats, most):
    """The textbook way: one seat after the other."""
    held = [0] * len(votes)
    heap = [(-Fraction(v), i) for i, v in enumerate(votes) if v > 0 and most[i] > 0]
    heapq.heapify(heap)
    for _ in range(seats):
        if not heap:
            break
        _, i = heapq.heappop(heap)
        held[i] += 1
        if held[i] < most[i]:
            heapq.heappush(heap, (-Fraction(votes[i], 2 * held[i] + 1), i))
    return held


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 50), st.integers(0, 40)), min_size=1, max_size=12),
       st.integers(0, 200))
def test_highest_quotients(parties, seats):
    votes, most = [v for v, _ in parties], [m for _, m in parties]
    got = mixing.apportion(np.array(votes, float), seats, np.array(most, np.int64))
    assert got.tolist() == plain_apportion(votes, seats, most)


def plain_targets(sizes, weights):
    total, capped = sum(sizes), set()
    while True:
        free = [i for i in range(len(sizes)) if i not in capped]
        rest = total - 3 * sum(sizes[i] for i in capped)
        share = {i: Fraction(rest * weights[i], sum(weights[j] for j in free)) for i in free}
        over = [i for i in free if share[i] > 3 * sizes[i]]
        if not over:
            return [float(share[i]) if i in share else 3.0 * sizes[i] for i in range(len(sizes))]
        capped |= set(over)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 10_000), min_size=1, max_size=15))
def test_targets(sizes):
    weights = [1 + i % 3 for i in range(len(sizes))]
    got = mixing.targets(sizes, weights)
    assert got == pytest.approx(plain_targets(sizes, weights))
    assert sum(got) == pytest.approx(sum(sizes))


def check(rows, docs, block=mixing.BLOCK):
    """Targets by hand, taken words by highest quotients over the sources, bounds by row."""
    sizes = defaultdict(int)
    for _, text, source in docs:
        sizes[source] += len([w for w in (text or "").split()])
    order = sorted(sizes, key=lambda s: (s is None, s))
    due = dict(zip(order, plain_targets([sizes[s] for s in order],
                                        [1 + i % 3 for i in range(len(order))])))
    taken = defaultdict(int)
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(due[r.source])
        assert 0 <= r.taken <= 3 * r["size"]
        assert r.taken == r.passes * r["size"] + sum(p["to"] - p["from"] for p in r.parts)
        assert all(0 <= p["from"] < p["to"] <= r["size"] for p in r.parts)
        taken[r.source] += r.taken
    assert sorted((r.doc_id is None, r.doc_id or 0, r["size"]) for r in rows) == sorted(
        (i is None, i or 0, len((t or "").split())) for i, t, _ in docs)
    assert all(taken[s] % block == 0 for s in taken)
    return taken, due


def digest(rows):
    return sorted(map(str, rows))


def test_mix_keeps_targets(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rows = mixing.mix(docs).collect()
    taken, due = check(rows, [(r.doc_id, r.text, r.source) for r in docs.collect()])
    assert all(abs(taken[s] - due[s]) <= mixing.BLOCK for s in due)
    assert digest(rows) == digest(mixing.mix(docs.repartition(7)).collect())
    assert digest(rows) != digest(mixing.mix(docs, seed=12).collect())
    assert QUERIES["op11_mixing"](spark, sf_dir).columns == [
        "doc_id", "size", "source_size", "target", "taken"]


def test_tree_of_shards(spark, monkeypatch):
    """Many levels: small shards and a fan of two, one source with two thirds of all rows."""
    monkeypatch.setattr(mixing, "SHARD", 8)
    monkeypatch.setattr(mixing, "FAN_BITS", 1)
    monkeypatch.setattr(mixing, "COPIES", 16)
    docs = [(i, "w " * (1 + i * 7919 % 40), "hot" if i % 3 else f"s{i % 4}") for i in range(900)]
    docs += [(7, "a b c", "hot")] * 500
    rows = mixing.mix(spark.createDataFrame(docs, "doc_id long, text string, source string"),
                      block=2).collect()
    taken, due = check(rows, docs, 2)
    assert all(abs(taken[s] - due[s]) <= 40 for s in due)


def test_edges(spark, edges, nothing):
    rows = mixing.mix(edges.withColumn("source", edges.doc_id.cast("string"))).collect()
    docs = [(r.doc_id, r.text, None if r.doc_id is None else str(r.doc_id)) for r in edges.collect()]
    taken, due = check(rows, docs)
    assert all(taken[s] <= 3 * sum(len((t or "").split()) for _, t, x in docs if x == s) for s in due)
    none = nothing.withColumn("source", nothing.text)
    assert mixing.mix(none).collect() == []
    blank = spark.createDataFrame([(1, None, "a"), (2, "", None)],
                                  "doc_id long, text string, source string")
    assert {(r.doc_id, r["size"], r.target, r.taken) for r in mixing.mix(blank).collect()} == {
        (1, 0, 0.0, 0), (2, 0, 0.0, 0)}


def test_too_many_sources_are_refused(spark, monkeypatch):
    rows = spark.createDataFrame([(i, "a", str(i)) for i in range(5)],
                                 "doc_id long, text string, source string")
    deal = mixing._sources(16, (1,), 3)
    monkeypatch.setattr(mixing, "MOST_SOURCES", 4)
    frame = rows.selectExpr("source as name", "1L as words", "0L as most").toPandas()
    with pytest.raises(ValueError, match="sources"):
        deal(frame)
