import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from riskweft.llm import html

CASES = [
    ("<p>a<p>b &amp; c", "a\n\nb & c"),
    ("one<br>two<br/>three", "one\ntwo\nthree"),
    ("<ul><li>x<li>y<ol start=3><li>1<li>2</ol></ul>z", "- x\n- y\n\n  3. 1\n  4. 2\n\nz"),
    ("<table><tr><th>Name<th>N<tr><td>foo<td>12</table>", "Name  N\nfoo   12"),
    ("<table><tr><td rowspan=2>a<td>b<tr><td>c</table>", "a  b\n   c"),
    ("<table><tr><td colspan=2>wide cell<td>x<tr><td>a<td>b<td>c</table>", "wide cell  x\na  b  c"),
    ("<table><td>a<p>b</table>", "a\nb"),
    ("<head><title>no</title></head><body>yes<script>if (a < b) x('</p>')</script><style>p{}</style>", "yes"),
    ("<div hidden>a</div><div style='color:red; display : none'>b</div><p aria-hidden=true>c</p><span style=\"visibility:hidden\">d</span>e", "e"),
    ("<pre>a\n  b\n</pre>", "a\n  b"),
    ("<div>a<div>b</div>c</div>", "a\nb\nc"),
    ("x <b> y</b>  <i>z </i> w", "x y z w"),
    ("<dl><dt>t<dd>d<dt>u</dl>", "t\n    d\nu"),
    ("<!-- a > b --><!doctype html>t<!-- open", "t"),
    ("a < b and c > d & e &lt;p&gt;", "a < b and c > d & e <p>"),
    ("<h1>T</h1>text<hr>more", "T\n\ntext\n\nmore"),
    ("<a href='x>y'>link</a>", "link"),
    ("</p>end</div> of", "end of"),
    ("<textarea>a<b></textarea>", "a<b>"),
    ("", ""), (" \n ", ""), ("plain\n text", "plain text"),
]


@pytest.mark.parametrize("page,text", CASES)
def test_rendering(page, text):
    assert html.page_text(page) == text


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "<td>", "<tr>", "<table>", "</table>", "<li>", "<ul>", "</ul>", "<b", ">", "</b>", "\"", "'", "<!--", "-->", "<pre>", "<script>", "</script>", "&amp", ";", "x", " ", "<br>", "<div hidden>", "</div>", "<dd>", "<"]), max_size=40))
def test_never_fails(parts):
    html.page_text("".join(parts))


def test_deep_and_long_pages():
    assert html.page_text("<div>" * 5000 + "in" + "</div>" * 5000) == "in"
    assert html.page_text("<ul><li>" * 2000 + "in").endswith("in")
    assert html.page_text("<table><tr><td>" * 1000 + "in").endswith("in")
    assert len(html.page_text("<p>word</p>" * 50_000).split()) == 50_000
    html.page_text("<a " * 100_000)
    html.page_text("<" * 200_000)


def test_depth_changes_nothing():
    for depth in (0, 149, 150, 200, 3000):
        page = "<div>" * depth + "%s" + "</div>" * depth
        for inner, text in CASES:
            if "<!-- open" not in inner and "end</div>" not in inner:  # these two change what is around them
                said = html.page_text(page % inner)
                assert [x for x in said.split("\n") if x] == [x for x in text.split("\n") if x], (depth, inner)
        hidden = "a<span style='display:none'>b<i>c</i></span><select><option>x<option>y</select><template>z</template>d"
        assert html.page_text(page % hidden) == "ad"


def test_many_open_elements_take_linear_time():
    for many in ("<div>", "<p><button>", "<li><ul>", "<option>", "<td>", "<i>", "<dd><dl>"):
        html.page_text("<p><button><table><li><ul>" + many * 30_000)
        html.page_text("<div>" * 30_000 + many * 30_000 + "</b>" * 30_000)
    assert html.page_text("<table><tr><td colspan=150>a<td>b<tr>" + "<td>c" * 151 + "</table>").split("\n")[0].split() == ["a", "b"]


def test_all_visible_words_come_out_once(spark):
    import os
    import re

    from plain import SF

    if not os.path.isdir(SF):
        pytest.skip("test tables not present")
    for row in html.extract(spark.read.parquet(f"{SF}/pages.parquet")).collect():
        assert row["text"] is not None
    for row in spark.read.parquet(f"{SF}/pages.parquet").limit(40).collect():
        body = re.sub(r"(?is)<head.*?</head>|<script.*?</script>|<style.*?</style>|<!--.*?-->", "", row["html"])
        want = re.sub(r"(?s)<[^>]+>", " ", body)
        import html as entities

        got = re.sub(r"(?m)^\s*-\s", "", html.page_text(row["html"]))
        assert sorted("".join(entities.unescape(want).split())) == sorted("".join(got.split()))


def test_nulls_and_empty(spark):
    schema = "page_id long, url string, html string, text string, title string"
    rows = [(1, None, None, "x", "y"), (None, "u", "<title>a  &amp; b</title><p>c", "x", "y")]
    found = {r["page_id"]: tuple(r) for r in html.extract(spark.createDataFrame(rows, schema)).collect()}
    assert found == {1: (1, None, None, None), None: (None, "u", "a & b", "c")}
    assert html.extract(spark.createDataFrame([], schema)).count() == 0
