"""Table extraction from markup."""

import time
from html import escape

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from racelake.sources import html


def cells(markup, table=0, **how):
    return [r["cells"] for r in html.parse_tables(markup, **how)[table]["rows"]]


def test_open_tags_entities_and_inline_markup():
    page = "<table><tr><th>A<th>B<tr><td>1 &amp; 2<td><b>x</b><br>y<tr><td>&nbsp;<td></table>"
    assert html.parse_tables(page) == [
        {"headers": ["A", "B"], "rows": [{"cells": ["1 & 2", "xy"], "links": None}]}
    ]


def test_spanning_cells_are_repeated():
    page = (
        "<table><thead><tr><th rowspan=2>P</th><th colspan='2'>Session</th></tr><tr><th>Q1</th><th>Q2</th></tr></thead>"
        "<tr><td rowspan=\"2\">1</td><td>a</td><td>b</td></tr><tr><td>c</td><td>d</td></tr><tr><td colspan=3>* note</td></tr></table>"
    )
    assert html.parse_tables(page)[0]["headers"] == ["P P", "Session Q1", "Session Q2"]
    assert cells(page) == [["1", "a", "b"], ["1", "c", "d"], ["* note"] * 3]


def test_comments_scripts_and_hidden_parts_do_not_count():
    page = (
        "<!-- <table><tr><td>no</td></tr></table> --><script>'<table>'</script><table><tr><th>A</th></tr>"
        "<tr><td><span style='display: none'>no<b>no</b></span>yes</td></tr><tr style=\"display:none\"><td>no</td></tr></table>"
        "<table style='display:none'><tr><td>no</td></tr></table>"
    )
    assert [t["headers"] for t in html.parse_tables(page)] == [["A"]]
    assert cells(page) == [["yes"]]


def test_nested_tables_stand_on_their_own():
    page = "<table><tr><td>out<table><tr><td>in</td></tr></table></td><td>x</td></tr></table>"
    assert [[r["cells"] for r in t["rows"]] for t in html.parse_tables(page)] == [[["outin", "x"]], [["in"]]]


def test_short_rows_are_filled_and_empty_rows_dropped():
    assert cells("<table><tr><th>A</th><th>B</th></tr><tr><td>1</td></tr><tr><td></td></tr><tr></tr></table>") == [["1", None]]


def test_links_mode():
    page = "<table><tr><td><img alt=x><i>Flag of X</i><a href='/a?x=1&amp;y=2'>Big<b>Prize</b></a></td><td>3 < 4</td></tr></table>"
    row = html.parse_tables(page, with_links=True)[0]["rows"][0]
    assert row == {"cells": ["Big Prize", "3 < 4"], "links": [["/a?x=1&y=2"], []]}


def test_broken_markup_stays_cheap():
    start = time.perf_counter()
    for page in ("<table>" + "<td x=\"" * 50_000, "<table><tr>" + "<td " * 50_000, "<script " * 20_000, "<!--" * 50_000, "<table>" * 2000):
        html.parse_tables(page)
    assert time.perf_counter() - start < 20
    assert cells("<table><tr><td>cut o") == [["cut o"]]


plain = st.text(st.characters(blacklist_categories=("Cs", "Cc", "Zs", "Zl", "Zp")), min_size=1, max_size=8)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 4).flatmap(lambda w: st.tuples(st.lists(plain, min_size=w, max_size=w), st.lists(st.lists(plain, min_size=w, max_size=w), max_size=5))))
def test_round_trip(table):
    heads, rows = table
    page = "<table><thead><tr>" + "".join(f"<th>{escape(h)}</th>" for h in heads) + "</tr></thead><tbody>"
    page += "".join("<tr>" + "".join(f"<td>{escape(x)}</td>" for x in r) + "</tr>" for r in rows) + "</tbody></table>"
    assert html.parse_tables(page) == [{"headers": heads, "rows": [{"cells": r, "links": None} for r in rows]}]


def test_title(spark):
    cases = {
        "<h2>Two <b>parts</b> &amp; more</h2><h1>x</h1>": "Two parts & more", "<!-- <h1>no</h1> --><h1 class=a> yes\n</h1>": "yes",
        "<p>none</p>": None, "<header>h</header>": None, "<h1></h1>": None, None: None,
    }
    got = spark.createDataFrame([(k,) for k in cases], "h string").select(html.title(F.col("h"))).collect()
    assert [r[0] for r in got] == list(cases.values())


def test_extraction_keeps_every_page(spark):
    pages = spark.createDataFrame([(1, "<table><tr><td>a</td></tr></table>"), (2, ""), (3, None)], "id int, html string")
    got = {r["id"]: r for r in html.extract_tables(pages, ["id"]).collect()}
    assert got[1]["tables"][0]["rows"][0]["cells"] == ["a"] and got[1]["error"] is None
    assert got[2]["tables"] == [] and got[2]["error"] is None
    assert got[3]["tables"] == [] and "TypeError" in got[3]["error"]
