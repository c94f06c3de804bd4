"""Findings of round three: pages read in fewer steps."""

import time

from pyspark.sql import functions as F

from racelake.sources import html


def test_title_is_read_up_to_the_heading_only(spark):
    cases = {
        "<h1>Big <!-- </h1> -->one</h1>" + "<script>" * 60_000: "Big one",
        "<!-- open <h1>yes</h1>": "yes",
        "<style>h1</style><h10>no</h10><script>'<h1>no</h1>'</script><h2 id=a>A &lt;<i>B</i></h2><h1>no</h1>": "A < B",
        "<h1>never closed": None,
        "x" * 1_000_000 + "<p>" * 100_000 + "<h1>late</h1>": "late",
    }
    start = time.perf_counter()
    got = spark.createDataFrame([(k,) for k in cases], "h string").select(html.title(F.col("h"))).collect()
    assert [r[0] for r in got] == list(cases.values())
    assert time.perf_counter() - start < 20


def test_runs_of_rows_are_one_token():
    rows = "<tr><td>1</td><td> a</td></tr>\n<tr class='x'>\n<TD id=\"2\">2</TD> <td></td></tr >" * 3
    assert [t[0] for t in html._TOKEN.finditer(rows)] == [rows]
    assert html.parse_tables("<table><tr><td>a</td></tr> \n</table>")[0]["rows"][0]["cells"] == ["a"]
    assert [r["cells"] for r in html.parse_tables(f"<table>{rows}</table>")[0]["rows"]] == [["1", "a"], ["2", None]] * 3


def test_rows_that_span_or_hide_are_read_one_by_one():
    page = (
        "<table><tr><td>1</td><td>2</td></tr><tr><td>a</td></tr><tr><td title=\"x>y\" colspan=2>s</td></tr><tr style='display:none'><td>no</td></tr>"
        "<tr><td title='a>b'>q</td><td>   </td></tr><tr><td> </td><td> </td></tr><tr><td>x &amp;\n y</td><td>&nbsp;</td></tr></table>"
    )
    assert [r["cells"] for r in html.parse_tables(page)[0]["rows"]] == [["1", "2"], ["a", None], ["s", "s"], ["q", None], ["x & y", None]]


def test_white_space_is_tidied_by_the_batch_as_by_the_text():
    texts = ["", " ", None, "a", " a ", "a  b", "a\nb", "a  b", " x　", "a\x1cb", "a\x1f\x85b", "​", "a\rb"]
    assert html._tidied_texts(texts).to_pylist() == [html._tidied(t) if t else None for t in texts]
