from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.oracle_check import connect, differences
from tripline.llm import divergence
from tripline.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, lang string, source string"


def plain_words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall("[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)


def plain(rows, least=10, top=10):
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        found = Counter(plain_words(text))
        docs[lang].update(found.keys())
        counts[lang, source].update(found)
    out = []
    for lang in {x for x, _ in groups}:
        kept = [t for t, n in docs[lang].items() if n >= least]
        sources = sorted(s for x, s in groups if x == lang)
        whole = Counter()
        for s in sources:
            whole.update(counts[lang, s])

        def shares(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10 ** 9 * (count[t] + 2) // (total + 2 * len(kept)) for t in kept}

        p, q = {s: shares(counts[lang, s]) for s in sources}, shares(whole)
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = [(x, sum(f(p[s][t], p[x][t]) for t in kept)) for x in sources if x != s]
            terms = [(t, f(p[s][t], q[t])) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                found = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, s, part, item, v, n + 1) for n, (item, v) in enumerate(found)]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in divergence.audit(df).collect())


@given(st.text(max_size=60), st.integers(1, 20))
def test_words_by_pattern(text, size):
    text = text.encode("utf-8", "ignore").decode()
    before, divergence.PIECE = divergence.PIECE, size
    try:
        assert [w.decode() for part in divergence.words(text) for w in part] == plain_words(text)
    finally:
        divergence.PIECE = before


def test_query_equals_sql(spark, sf_dir):
    assert differences(QUERIES["op13_divergence"](spark, sf_dir), connect(sf_dir),
                       entry.oracle_sql()["op13_divergence"]) == []


@pytest.mark.parametrize("group_block, term_block", [(64, 2048), (3, 7), (1, 1)])
def test_cells_add_up(spark, monkeypatch, group_block, term_block):
    """Few and many cells, groups that lack terms, a language that keeps none."""
    monkeypatch.setattr(divergence, "GROUP_BLOCK", group_block)
    monkeypatch.setattr(divergence, "TERM_BLOCK", term_block)
    monkeypatch.setattr(divergence, "MOST_ENTRIES", 20)
    draw = random.Random(2)
    rows = [(i, " ".join(f"w{'ab'[i % 2]}é{'x' * draw.randrange(12)}" for _ in range(9)),
             "en" if i % 5 else "de", f"s{i % 7}") for i in range(160)]
    rows += [(900, "rare words only", "fr", "s1"), (901, "", "fr", "s2"), (902, None, None, None),
             (903, "...", "en", "empty"), (904, "WAÉ other", "", "Ω"), (905, "waé", None, "z")]
    assert got(spark.createDataFrame(rows, SCHEMA)) == plain(rows)


def test_large_counts_stay_exact(spark):
    big = 10 ** 14
    df = spark.createDataFrame([(big, 3 * big), (0, 7), (5 * 10 ** 12, 9 * 10 ** 15 - 1)], "n long, d long")
    for r in df.select("n", "d", divergence.share(F.col("n"), F.col("d")).alias("p")).collect():
        assert r.p == 1 + 10 ** 9 * (r.n + 2) // r.d


def test_edges(spark, edges, edge_rows, nothing):
    rows = [(i, t, "x" if i and i % 2 else None, str(i)) for i, t in edge_rows] * 10
    df = spark.createDataFrame([(*r, 1, 2, 3, 4, 5) for r in rows],
                               SCHEMA + ", term int, n int, docs int, p int, value int")
    assert got(df) == plain(rows)
    empty = df.limit(0)
    assert got(empty) == []
