from __future__ import annotations

import pytest
from hypothesis import given
from hypothesis import strategies as st

from tripline.llm import html_text, licences
from tripline.llm.queries import QUERIES


@pytest.mark.parametrize("html, text", [
    ("<p>a<p>b", "a\n\nb"), ("<div>a</div><div>b</div>", "a\nb"), ("a <b> b</b>c", "a bc"),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "- a\n- b\n  - c\n- d"),
    ("<ol start=9><li>a<li>b</ol>", "9. a\n10. b"),
    ("<table><tr><th>Name<th>Age<tr><td>Ann B<td>3</table>", "Name   Age\nAnn B  3"),
    ("<table><tr><td>a<br>b<td>c</table>", "a  c\nb"),
    ("<table><tr><td><table><tr><td>x<td>y</table><td>z</table>", "x  y  z"),
    ("<pre> a\n  b</pre>", " a\n  b"), ("x<script>var t='</p>'</script>y", "xy"),
    ("<div hidden>a<p>b</div>c", "c"), ("<p style='DISPLAY : none'>a</p>b", "b"),
    ("<title>t</title><body>b", "b"), ("a&amp;b&nbsp;&copy", "a&b\xa0©"), ("a<br>b", "a\nb"),
    ("<dl><dt>T<dd>D</dl>", "T\n  D"), ("<!-- a -->b<![CDATA[c]]>", "b"), ("", ""), (None, ""),
    ("</p></div>x</table>", "x"), ("<p>a<table><tr><td>q</table>", "a\n\nq"),
    ("<blockquote>a<br>b</blockquote>c", "  a\n  b\n\nc"), ("a<hr>b", "a\n\n---\n\nb"),
    ("<select><option>a<option>b</select>", "a\nb"), ("<", "<"), ("a < b", "a < b"),
])
def test_layout(html, text):
    assert html_text.visible_text(html) == text


def test_depth_and_length():
    assert html_text.visible_text("<div>" * 50_000 + "x") == "x"
    assert html_text.visible_text("<table><tr><td>" * 600 + "x").strip() == "x"
    assert len(html_text.visible_text("<p>word</p>" * 20_000).split()) == 20_000


def test_pages(spark, sf_dir):
    rows = QUERIES["op3_html_text"](spark, sf_dir).collect()
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    assert {r.page_id for r in rows} == set(pages)
    assert all(r.text and "<p>" not in r.text and "track(" not in r.text for r in rows)


def test_extract_edges(spark):
    df = spark.createDataFrame([(1, None, "u", "old"), (1, None, "u", "old"), (None, "<p>a", None, "")],
                               "page_id long, html string, url string, text string")
    out = html_text.extract(df)
    assert out.columns == ["page_id", "url", "text"]
    assert sorted(r.text for r in out.collect()) == ["", "", "a"]
    assert html_text.extract(df.limit(0)).count() == 0


def plain_scan(text, threshold=licences.THRESHOLD):
    """All templates against all parts, without bounds."""
    text = text or ""
    parts = [*text.split("\n"), *licences._PARAGRAPH.split(text), text]
    best: dict[str, float] = {}
    for part in parts:
        own = licences.bigrams(licences.normalised(part))
        found = [(licences.dice(own, licences.bigrams(licences.normalised(t))), name)
                 for name, t in licences.TEMPLATES]
        top = max(found)[0]
        if top >= threshold:
            for value, name in found:
                if value == top:
                    best[name] = max(value, best.get(name, 0))
    return best


def test_scan_equals_all_templates(spark, sf_dir):
    rows = QUERIES["op10_licences"](spark, sf_dir).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        want = plain_scan(texts[r.doc_id])
        assert r.licences == ",".join(sorted(want))
        assert r.best_dice == max(want.values(), default=0.0)
    assert any(r.licences for r in rows)


def test_whole_templates_with_changes():
    match = licences.Matcher()
    for name, text in licences.TEMPLATES:
        assert match.scan(f"Some words.\n{text.upper()}\nMore words here.")[name] == 1.0 \
            or "\n" in text
        assert match.scan("Intro.\n\n" + text + "\n\nEnd.")[name] == 1.0
    long = dict((n, t) for n, t in licences.TEMPLATES if len(t) > 800)["MIT"]
    assert match.scan(long.replace("Software", "Work"))["MIT"] > 0.8
    assert match.scan("Licensed under no terms at all, said the fox.") == {}


def test_scan_edges(spark, edges, edge_rows, nothing):
    rows = licences.scan(edges).collect()
    assert len(rows) == len(edge_rows) and {r.n_licences for r in rows} == {0}
    assert licences.scan(nothing).count() == 0


MIT = dict((n, t) for n, t in licences.TEMPLATES if len(t) > 800)["MIT"]
PROSE = "It was a long day in the yard and nobody came to see the horses there. " * 12


def test_licences_inside_long_documents():
    scan = licences.Matcher().scan
    mit = MIT.replace("conditions: The above", "conditions:\n\nThe above").replace(
        "Software. THE", "Software.\n\nTHE")
    gpl = [t for n, t in licences.TEMPLATES if n == "GPL-3.0"][1].replace(
        "version. This", "version.\n\nThis").replace("details.", "details.\n\nYou should have "
        "received a copy of the GNU General Public License along with this program.")
    assert mit.count("\n\n") == 2
    assert scan(f"{PROSE}\n\n{mit}\n\n{PROSE}") == {"MIT": 1.0}
    assert scan(f"{PROSE}\n\n{gpl}\n\n{PROSE}")["GPL-3.0"] > 0.9
    assert scan(f"{PROSE} Released under the MIT License. {PROSE}") == {"MIT": 1.0}
    gnu3 = "This work is licensed under the GNU General Public License, version 3."
    assert scan(f"{PROSE}\n{gnu3}\n{MIT}\n{PROSE}") == {"GPL-3.0": 1.0, "MIT": 1.0}
    assert scan(PROSE * 3) == {}


def test_runs_equal_all_windows():
    """The best coefficient of one template over all windows, by brute force."""
    import random

    rng = random.Random(3)
    for _ in range(150):
        template = " ".join(rng.choices("abcd", k=rng.randint(2, 14)))
        words = rng.choices("abcdx", k=rng.randint(0, 30))
        own = licences.bigrams(template.split())
        want = max((licences.dice(licences.bigrams(words[i:j]), own) for i in range(len(words))
                    for j in range(i + 2, len(words) + 1)), default=0.0)
        got = licences.Matcher((("T", template),)).scan(" ".join(words)).get("T", 0.0)
        assert abs(got - (want if want >= licences.THRESHOLD else 0.0)) < 1e-12


def test_whole_licence_texts():
    scan = licences.Matcher().scan
    for name, text in licences.all_templates()[len(licences.TEMPLATES):]:
        found = scan(f"{PROSE}\n\n{text}\n\n{PROSE}")
        assert found == {name: 1.0}
    texts = dict(licences.all_templates()[len(licences.TEMPLATES):])
    assert set(scan("Copyright (c) 2020, A. B.\n" + texts["BSD-2-Clause"].split("\n", 2)[2])) == {
        "BSD-2-Clause"}
    for kind in licences.CC_KINDS:
        assert set(scan(f"{PROSE} licensed under CC {kind} 3.0. {PROSE}")) == {f"CC-{kind}-3.0"}


def test_standard_notices():
    scan = licences.Matcher().scan
    for name, text in licences.TEMPLATES:
        assert set(scan(f"{PROSE} {text} {PROSE}")) == {name}


@pytest.mark.parametrize("deep", ["<font>" * 3000, "<div>" * 3000, "<table><tr><td>" * 700])
def test_deep_pages_keep_their_rules(deep):
    page = (deep + "a<script>bad()</script><span style='display:none'>bad<b>bad</b></span><p>b<p>c"
            "<ul><li>d<li>e</ul><table><tr><td>f<td>g</table><style>bad</style>h")
    words = html_text.visible_text(page).split()
    assert [w for w in words if w != "-"] == list("abcdefgh")
    assert html_text.visible_text("<div hidden>" + deep + "</b>x") == ""


def test_nesting_takes_linear_time():
    assert html_text.visible_text("<p>" + "<table><td>" + "<div><b>" * 100_000 + "x") .strip() == "x"
    assert len(html_text.visible_text("<blockquote>x" * 3000).split()) == 3000


@pytest.mark.parametrize("html, text", [
    ("so <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x=2</annotation></math>.", "so x=2."),
    ("a<svg><title>t</title><g>no<text>Jan</text><text>F<tspan>eb</tspan></text></g><defs><text>no"
     "</text></defs></svg>b", "a Jan Feb b"),
    ("<svg><path d='M0'><p>a</p>b", "a\n\nb"), ("<text>a</text>b", "ab"),
    ("<svg><text>a</svg>b<svg>no</svg>", "a b"),
    ("<table><tr><th colspan=2>Name<th>Age<tr><td>Ann<td>B<td>3</table>", "Name    Age\nAnn  B  3"),
    ("<table><tr><td rowspan=2>a<td>b<td>c<tr><td>d<td>e</table>", "a  b  c\n   d  e"),
    ("<table><tr><td rowspan=0>a<td>b<tr><td>c<tr><td>d</table>", "a  b\n   c\n   d"),
    ("<table><tr><td colspan=3>long heading<tr><td>a<td>b<td>c</table>", "long heading\na  b  c"),
    ("<table><tr><td colspan=2 rowspan=2>a<td>b<tr><td>c</table>", "a  b\n   c"),
    ("<table><tr><td colspan=x rowspan=-1>a<td colspan=0>b<tr><td>c<td>d</table>", "a  b\nc  d"),
    ("<table><tr><td colspan=1000>a<td>b</table>", "a  b"),
])
def test_formulas_drawings_and_spans(html, text):
    assert html_text.visible_text(html) == text


@pytest.mark.parametrize("html, text", [
    ("<details>hid <p>den<summary>Sum<b>mary</b></summary>more<summary>two</summary></details>z", "Summary\nz"),
    ("<details open><summary>S</summary>shown</details>", "S\nshown"),
    ("<details><div>x</div></details>after", "after"),
    ("a<dialog>no</dialog>b<dialog open>yes</dialog>", "ab\nyes"),
    ("<p style='visibility:hidden'>no <b style='visibility: visible'>yes</b> no</p>x", "yes\n\nx"),
    ("<p style='visibility:visible;visibility:collapse'>no</p><p>x", "x"),
    ("<p style='display:none'>no <b style='visibility:visible'>no</b></p>x", "x"),
    ("a<!-- b", "a"), ("a <b", "a"), ("a < b", "a < b"), ("<script>x <!-- </script>y", "y"),
    ("<table><tfoot><tr><td>foot</tfoot><tbody><tr><td>one<tr><td>two</table>", "one\ntwo\nfoot"),
    ("<table><tfoot><tr><td>foot<tbody><tr><td>one</table>", "one\nfoot"),
    ("<ol><li>a<li value=9>b<li>c</ol>", "1. a\n9. b\n10. c"),
    ("<ol reversed><li>a<li>b<ol><li>in</ol><li>c</ol>", "3. a\n2. b\n   1. in\n1. c"),
    ("<ol reversed start=5><li>a<li>b</ol>", "5. a\n4. b"),
    ("<ol start=-1><li>a<li>b</ol>", "-1. a\n0. b"),
    ("<ol type=a start=26><li>a<li>b</ol>", "z. a\naa. b"),
    ("<ol type=I start=4><li>a<li>b</ol>", "IV. a\nV. b"),
    ("<ol type=i start=0><li>a</ol>", "0. a"),
    ("<pre>\n  x\n y</pre>", "  x\n y"),
    ("a<textarea>\n<b>1 &lt; 2</b>\n z</textarea>b", "a\n<b>1 < 2</b>\n z\nb"),
    ("<ruby>\u6f22<rp>(</rp><rt>kan</rt><rp>)</rp></ruby>", "\u6f22kan"),
    ("<table><tr><td>\u6f22\u5b57<td>x<tr><td>abc<td>y<tr><td>e\u0301<td>z</table>",
     "\u6f22\u5b57  x\nabc   y\ne\u0301     z"),
])
def test_what_shows_and_where(html, text):
    assert html_text.visible_text(html) == text


def node(tree, veiled=False):
    """What a reader sees of a small tree, rendered straight from its definition."""
    if isinstance(tree, str):
        return "" if veiled else tree
    tag, style, children = tree
    if "none" in style:
        return ""
    veiled = "hidden" in style or veiled and "visible" not in style
    return "".join(node(c, veiled) for c in children)


def markup(tree):
    if isinstance(tree, str):
        return tree
    tag, style, children = tree
    return f"<{tag} style='{style}'>" + "".join(map(markup, children)) + f"</{tag}>"


TREES = st.recursive(
    st.sampled_from(["a", "bc", "d"]),
    lambda inner: st.tuples(st.sampled_from(["b", "i", "span"]),
                            st.sampled_from(["", "display:none", "visibility:hidden", "visibility:visible"]),
                            st.lists(inner, max_size=4)), max_leaves=20)


@given(TREES)
def test_small_trees_against_a_reference_renderer(tree):
    assert html_text.visible_text(markup(tree)) == node(tree)


def test_very_long_page_on_spark(spark):
    page = "<ul>" + "<li>word <b>and</b> more" * 100_000 + "</ul>"
    rows = spark.createDataFrame([(1, page, "old"), (2, None, "old")], "page_id long, html string, text string")
    got = {r.page_id: r.text for r in html_text.extract(rows).collect()}
    assert got[1].count("\n") == 99_999 and got[1].startswith("- word and more\n") and got[2] == ""
