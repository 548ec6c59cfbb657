from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.oracle_check import connect, differences
from tripline.llm import decontaminate
from tripline.llm.queries import QUERIES


def plain_words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def plain(docs, items):
    windows: dict[tuple, set] = {}
    for item_id, text in items:
        w = plain_words(text)
        size = min(10, len(w))
        for s in range(len(w) - size + 1 if size else 0):
            windows.setdefault(tuple(w[s:s + size]), set()).add(item_id)
    out = []
    for doc_id, text in docs:
        w, hit, found = plain_words(text), set(), set()
        for size in {len(k) for k in windows}:
            for s in range(len(w) - size + 1):
                if tuple(w[s:s + size]) in windows:
                    hit.update(range(s, s + size))
                    found |= windows[tuple(w[s:s + size])]
        out.append((doc_id, len(w), len(hit), sorted(str(i) for i in found if i is not None)))
    return out


def got(docs, items):
    return [(r.doc_id, r.n_words, r.n_hit, r["items"])
            for r in decontaminate.contamination(docs, items).collect()]


def by_text(rows):
    return sorted(rows, key=str)


@pytest.mark.parametrize("name", ["op8_decontamination", "op9_line_rules"])
def test_query_equals_sql(spark, sf_dir, name):
    assert differences(QUERIES[name](spark, sf_dir), connect(sf_dir),
                       entry.oracle_sql()[name]) == []


def test_planted_spans_of_every_length(spark):
    item = [f"w{i}" for i in range(40)]
    items = [(1, " ".join(item)), (2, " ".join(item[5:25])), (3, "Short One here"), (4, "solo"),
             (5, ""), (6, None), (7, "a b a b a b a b a b a b a b"), (None, "nameless item of x")]
    docs = []
    for n in range(1, 41):
        docs.append((n, "pre fix " + " ".join(item[40 - n:]) + " post"))
        docs.append((100 + n, " ".join(item[:n]) + ", SHORT one; Here solo"))
        docs.append((200 + n, " ".join(item[3:3 + n]) + " x " + " ".join(item[3:3 + n])))
    docs += [(300, "b a b a b a b a b a b a b a b a b"), (301, "É Solo é SOLO"), (302, None),
             (302, None), (None, "solo"), (None, ""), (303, "w0"), (304, "nameless ITEM of x")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    tests = spark.createDataFrame(items, "item_id long, text string")
    assert by_text(got(df, tests)) == by_text(plain(docs, items))


def test_other_capitals_stay(spark):
    items = [(1, " ".join(f"Écluse{i}" for i in range(12)))]
    docs = [(1, items[0][1]), (2, items[0][1].replace("É", "é")), (3, items[0][1].lower())]
    assert by_text(got(spark.createDataFrame(docs, "doc_id long, text string"),
                       spark.createDataFrame(items, "item_id long, text string"))) == by_text(
        plain(docs, items))


def test_edges(spark, edges, edge_rows, nothing):
    items = spark.createDataFrame([(1, "fox jumps over the lazy dog again it ran to a b")],
                                  "item_id long, text string")
    rows = got(edges, items)
    assert by_text(rows) == by_text(plain(edge_rows, [(1, items.first().text)]))
    clean = decontaminate.clean(edges, items)
    assert clean.columns == edges.columns
    assert clean.count() == sum(not hit for _, _, hit, _ in rows)
    assert got(nothing, items) == []
    none = items.limit(0)
    assert {hit for _, _, hit, _ in got(edges, none)} == {0}
    assert decontaminate.clean(edges, none).count() == len(edge_rows)


def test_texts_beyond_the_positions_are_refused(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "POSITION_BITS", 4)
    items = spark.createDataFrame([(1, "a b c d e f g h i j k")], "item_id long, text string")
    short = spark.createDataFrame([(1, "w " * 15)], "doc_id long, text string")
    assert decontaminate.contamination(short, items).first().n_words == 15
    with pytest.raises(Exception, match="words or more"):
        decontaminate.contamination(short.withColumn("text", F.repeat("text", 2)), items).collect()
