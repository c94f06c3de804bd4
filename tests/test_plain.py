"""Plain pages are read by the batch with the results of the reader that goes page by page."""

import random

import pyarrow as pa
import pytest

from racelake.sources import html

PIECES = [
    "<table>", "</table>", "<TABLE class='a'>", "<thead>", "</thead>", "<tbody>", "</tbody >", "<tfoot>", "<tr>", "</tr>", "<tr class=x>",
    "<td>", "</td>", "<th>", "</th>", "<td colspan=2>", "<td colspan=\"0\">", "<th colspan='3' class=y>", "<td rowspan=2>", "<td title='a>b'>", "<td title='it>", "<tdé>",
    "<td >", "</td\n>", "<track>", "<t", "<td/>", "<td style='display:none'>", "<!-- <td>no</td> -->", "<!--", "-->", "<script>'<td>'</script>",
    "<scrıpt>", "<style>", "</style >", "<b>", "</b>", "<a title='<td>'>", "x", " a  b\n", "&nbsp;", "&amp;", "&#9;é", " ", "1 > 0", "'", '"', "Kſ",
]
WHOLE = ["<tr><td>1</td><td> a  b</td></tr>", "<tr><th>H</th><th> I </th></tr>", "<tr><td colspan=3>* n</td></tr>", "<tr><td> </td><td>&nbsp;</td></tr>", "<tr></tr>", "<tr><th>r</th><td>é&lt;</td></tr>",
         "<tr><td><i>Flag of A</i><a href='/a?x=1&amp;y=2'>B <b>C</b></a></td><td> D<A class=x HREF=e>f</A><a>g</a> </td></tr>", "<tr><td>Flag of Z</td><td>Flag of Y</td></tr>",
         "<tr><td><span style='display: none'>no</span>yes</td><td><br></td></tr>"]


def _both(pages, with_links=False):
    column = pa.array(pages, pa.string())
    read, errors = html._read_pages(column, with_links)
    found = [html._all_contents(p, with_links) if p is not None else [] for p in pages]
    assert read.type == html._ARROW_TABLES and [e is None for e in errors] == [p is not None for p in pages]
    for page, a, b in zip(pages, read.to_pylist(), html._tables_column(found, with_links).to_pylist()):
        assert a == b, page
    return html._plain_tables(column, with_links)[0]


@pytest.mark.parametrize("with_links", (False, True))
def test_pages_of_pieces_as_page_by_page(with_links):
    draw, plain = random.Random(7), 0
    for _ in range(60):
        pages = [None, ""]
        for _ in range(80):
            rows = "".join(draw.choice(WHOLE) for _ in range(draw.randrange(5)))
            page = f"<h1>x</h1><table>{draw.choice(['', '<thead><tr><th>A</th></tr></thead><tbody>', '<thead>' + WHOLE[0] * 2 + '</thead>'])}{rows}</table>" * draw.randrange(3)
            for _ in range(draw.choice((0, 0, 1, 2, 12))):
                at = draw.randrange(len(page) + 1)
                page = page[:at] + draw.choice(PIECES) + page[at:]
            pages.append(page)
        plain += _both(pages, with_links).sum()
    assert 1000 < plain < 4500


def test_plain_pages_need_no_step_per_tag(monkeypatch):
    page = "<!-- <table> --><h1>A</h1><table><tr><th> a</th><th>b </th></tr>" + "<tr class='r'><td>1</td><td id=\"q\">x &amp;  y</td></tr>" * 30 + "<tr><td colspan=2>* n</td></tr></table>"
    read = html.parse_tables(page)
    linked = "<h1>Races</h1><table><tr><th>Grand Prix</th></tr><tr><td><img/><i>Flag of X</i><a href='/r'>GP <i>1</i></a></td></tr></table>"
    index = html.parse_tables(linked, with_links=True)
    monkeypatch.setattr(html, "_all_contents", lambda *_: 1 / 0)
    tables, errors = html._read_pages(pa.array([page] * 3 + [""]), False)
    assert errors == [None] * 4 and tables.to_pylist() == [read] * 3 + [[]]
    assert html._read_pages(pa.array([linked]), True)[0].to_pylist() == [index] and index[0]["rows"][0]["links"] == [["/r"]]


def test_batches_that_begin_within_a_column():
    pages = ["<table><tr><td>é</td></tr></table>", None, "<table><tr><td>2<b>x</b></td></tr></table>", "<table><tr><th>3</th></tr><tr><td>4</td></tr></table>", ""]
    whole = html._read_pages(pa.array(pages), False)[0].to_pylist()
    for lo in range(len(pages)):
        assert html._read_pages(pa.array(pages).slice(lo), False)[0].to_pylist() == whole[lo:]
    assert html._read_pages(pa.array([], pa.string()), False)[0].to_pylist() == []
