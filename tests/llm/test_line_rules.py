from __future__ import annotations

from tripline.llm import line_rules


def judged(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: r for r in line_rules.judge(df).collect()}


def test_lines_that_fail_go(spark):
    prose = "A line of plain prose that says something and ends well."
    bad = ["Home | News | Sport | About", "All rights reserved.", "no end of sentence",
           "$$$ ### buy %%% now &&& !!!", "Accept cookies to go on."]
    more = "Another sentence follows here, quite unlike all of those before it.”"
    few = "Few words stay, as nearly every line had to go. "
    rows = judged(spark, [prose, "\n".join([prose, *bad, "", more]), "\n".join([few, *bad])])
    assert rows[0].cleaned == prose and rows[0].kept
    assert rows[1].cleaned == "\n".join([prose, "", more])
    assert rows[1].kept and not rows[1].base_failed
    assert rows[2].cleaned == few and not rows[2].base_failed and not rows[2].kept


def test_prose_cut_short_stays(spark):
    rows = judged(spark, ["One sentence here. And two there! Three, are they not? Then it is cut",
                          "One sentence alone and then more words that come to no end at all"])
    assert rows[0].kept and not rows[1].kept


def test_base_counts(spark):
    rows = judged(spark, ["a b c d e a b c d e x", "x\ny\nx\n \nx", "a a a a a a a",
                          "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10.", "p#q é| <>"])
    assert [rows[i].n_repeat_words for i in range(5)] == [10, 0, 7, 0, 0]
    assert [rows[i].n_dup_lines for i in range(5)] == [0, 2, 0, 0, 0]
    assert [rows[i].base_failed for i in range(5)] == [True, True, True, False, True]
    assert (rows[4].n_symbols, rows[4].word_chars, rows[4].n_words) == (4, 7, 3)
    assert rows[3].kept


def test_edges(spark, edges, edge_rows, nothing):
    rows = line_rules.judge(edges).collect()
    assert len(rows) == len(edge_rows)
    for r in rows:
        if r.doc_id in (1, 2, 3):
            assert (r.n_words, r.word_chars, r.base_failed, r.kept) == (0, 0, True, False)
    assert line_rules.judge(nothing).count() == 0
