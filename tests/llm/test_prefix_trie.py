from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.oracle_check import connect, differences
from tripline.llm import prefix_trie
from tripline.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"


def remainder(c, n):
    return c - int(c / n) * n


def plain_rebuilt(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in own.items()}
    h = {c: zlib.crc32(str(c).encode()) % 4 for c in own}
    return {c: own.get(c - remainder(c, 20), [])[:h[c]] + own[c][h[c]:] for c in own}


def plain_trie(whole):
    members, ends, kids = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, seq in whole.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
            if d:
                kids[tuple(seq[:d - 1])].add(tuple(seq[:d]))
        ends[tuple(seq)].append(c)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, ms in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in kids
            saved[node[:d]] += (len(ms) - 1) * len(node[-1][1].split()) if node else 0
    return sorted((min(ms), len(node), min(members[node[:-1]]) if node else -1, len(ms),
                   len(kids.get(node, ())), leaves[node], saved[node], hashlib.sha256(
                       ",".join(map(str, sorted(ends.get(node, ())))).encode()).hexdigest())
                  for node, ms in members.items())


def got(df, **options):
    rows = prefix_trie.trie(prefix_trie.rebuilt(df), **options).select(*prefix_trie.COLUMNS).collect()
    return sorted((r[0], r[1], -1 if r[2] is None else r[2], *r[3:]) for r in rows)


def plain(rows):
    return plain_trie(plain_rebuilt(rows))


@settings(max_examples=200, deadline=None)
@given(st.sets(st.lists(st.integers(1, 9), max_size=6).map(tuple), min_size=1, max_size=40))
def test_double_array_holds_all_paths_and_no_other(paths):
    paths = sorted(paths)
    trie = prefix_trie.DoubleArray(prefix_trie._levels([list(p) for p in paths]), 9)
    nodes = {p[:d] for p in paths for d in range(len(p) + 1)}
    places = {}
    for node in sorted(nodes, key=len):
        places[node] = trie.child(places[node[:-1]], node[-1]) if node else 0
        assert places[node] >= 0
        for c in range(1, 10):
            if (*node, c) not in nodes:
                assert trie.child(places[node], c) == -1
    assert len(set(places.values())) == len(nodes)
    assert sorted(trie.slot) == sorted(places.values())


def test_query_equals_sql(spark, sf_dir):
    assert differences(QUERIES["op12_prefix_trie"](spark, sf_dir), connect(sf_dir),
                       entry.oracle_sql()["op12_prefix_trie"]) == []


@pytest.mark.parametrize("shard_turns", [1_000_000, 40, 3])
def test_shards_agree_with_brute_force(spark, shard_turns):
    """Nodes on the edges of many small shards, hot first turns, copies, prefixes of others."""
    draw = random.Random(5)
    rows = []
    for c in range(120):
        if c % 3 == 0:
            seq = ["hot", "same", "end"]
        elif c % 3 == 1:
            seq = ["hot"] + [draw.choice("ab") for _ in range(draw.randrange(6))]
        else:
            seq = [draw.choice("abc") for _ in range(1 + draw.randrange(4))]
        rows += [(c, i, "user" if i % 2 else "system", f"{t} word {t}") for i, t in enumerate(seq)]
    rows += [(500, i, "user", "again") for i in range(60)]
    assert got(spark.createDataFrame(rows, SCHEMA), shard_turns=shard_turns) == plain(rows)


def test_edges(spark):
    rows = [(0, None, None, None), (0, 1, "a", "x y"), (0, 1, "a", "x y"), (1, 5, "a", ""),
            (1, 6, "a", " \n"), (2, None, "b", "z"), (3, 0, "a", "word " * 30_000),
            (None, 0, "a", "lost"), (-5, 0, "u", "neg"), (-25, 0, "u", "neg"), (41, 0, "u", "only"),
            (47, 0, "u", "only")]
    rows += [(c, 0, "u", "one") for c in range(20, 40)] + [(2 ** 40 + c, 0, "u", "one") for c in range(9)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns(
        {c: F.lit(1) for c in ("key", "sequence", "words", "head", "h", "shard")})
    assert got(df) == plain(rows)
    nothing = df.limit(0)
    assert got(nothing) == []
