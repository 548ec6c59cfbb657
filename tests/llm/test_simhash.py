from __future__ import annotations

import re

import numpy as np
import pytest
import xxhash

from tripline.llm import components, simhash
from tripline.llm.queries import QUERIES


def plain_print(text: str | None) -> int:
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    grams = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(prints: list[int], bits: int = 4) -> list[set[int]]:
    values = np.array(prints, dtype=np.uint64)
    parent = list(range(len(values)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(values[i + 1:] ^ values[i]) <= bits):
            parent[top(i + 1 + int(j))] = top(i)
    out: dict[int, set[int]] = {}
    for i in range(len(values)):
        out.setdefault(top(i), set()).add(i)
    return list(out.values())


def test_fingerprints(spark, sf_dir, edge_rows):
    for _, text in edge_rows:
        if len(text or "") < 1000:
            assert simhash.fingerprint(text) == plain_print(text)
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(30).collect()
    assert all(simhash.fingerprint(r.text) == plain_print(r.text) for r in rows)


def test_query_equals_all_pairs(spark, sf_dir):
    rows = QUERIES["op2_simhash"](spark, sf_dir).collect()
    prints = [int(r.fingerprint, 16) for r in rows]
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    for group in plain_groups(prints):
        least = min(rows[i].doc_id for i in group)
        assert {rows[i].component_id for i in group} == {least}


@pytest.mark.parametrize("limit", [simhash.BLOCK, 50])
def test_dense_clusters(spark, limit):
    """Near copies by the hundred in one bucket, also when it is cut into blocks."""
    rng = np.random.default_rng(5)
    values = {0, 2**64 - 1}
    for base in rng.integers(0, 2**63, 3).tolist():
        for _ in range(300):
            value = base
            for bit in rng.integers(0, 30, rng.integers(0, 6)).tolist():
                value ^= 1 << bit
            values.add(value)
    values = sorted(values)
    df = spark.createDataFrame([(simhash._signed(v),) for v in values], "fingerprint long")
    got: dict[int, set[int]] = {}
    for r in simhash.classes(df, 4, limit).collect():
        got.setdefault(r.root, set()).add(values.index(r.fingerprint % 2**64))
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, plain_groups(values)))


def test_every_pair_within_reach_meets():
    """Any 4 bits: some segment differs by at most one."""
    rng = np.random.default_rng(0)
    bits = np.array([rng.choice(64, rng.integers(0, 5), replace=False).tolist()
                     for _ in range(3000)], dtype=object)
    diffs = np.array([sum(1 << b for b in chosen) for chosen in bits], dtype=np.uint64)
    assert (simhash._first_variant(diffs, 4) >= 0).all()
    assert [w for _, w in simhash.segments(4)] == [21, 21, 22]


def test_edges(spark, edges, edge_rows, nothing):
    rows = simhash.groups(edges).collect()
    assert len(rows) == len(edge_rows)
    assert {r.component_id for r in rows if r.fingerprint == 0} == {1}
    kept = simhash.keep_one(edges)
    assert kept.columns == edges.columns
    left = [(r.doc_id, r.text) for r in kept.collect()]
    assert len(left) == len(plain_groups([r.fingerprint % 2**64 for r in rows]))
    assert left.count((4, edge_rows[6][1])) == 1 and (1, None) in left
    assert simhash.groups(nothing).count() == 0 and simhash.keep_one(nothing).count() == 0


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 100), (205, 200), (200, 210), (210, 205)]
    df = spark.createDataFrame(chain, "u long, v long")
    got = {r.node: r.root for r in components.components(df).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {205: 200, 210: 200}
    assert components.components(df.where("u < 0")).count() == 0
