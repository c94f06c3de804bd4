"""Tables and links out of stored HTML, page by page on the executors.

Only this module runs Python on the data path: a page is one row, so a task holds one Arrow batch
of pages at a time, whatever their number.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from html import unescape
from html.entities import name2codepoint
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from racelake.functions import links as urls
from racelake.functions.text import null_if_blank
from racelake.sources.plain import plain_tables
from racelake.shipping import ship

_ROW = T.StructType(
    [T.StructField("cells", T.ArrayType(T.StringType())),
     T.StructField("links", T.ArrayType(T.ArrayType(T.StringType())))]
)
TABLES = T.ArrayType(
    T.StructType(
        [T.StructField("headers", T.ArrayType(T.StringType())), T.StructField("rows", T.ArrayType(_ROW))]
    )
)

_TEXTS = pa.list_(pa.string())
_ARROW_ROW = pa.struct([("cells", _TEXTS), ("links", pa.list_(_TEXTS))])
_ARROW_TABLES = pa.list_(pa.struct([("headers", _TEXTS), ("rows", pa.list_(_ARROW_ROW))]))

_FLAG = "Flag of "
_PAGES = 512
"""pages whose tables are gathered before they go back"""

_SPACES = re.compile(r"\s{2,}|[\r\n]")
# Span limits of the HTML standard, and elements that are never closed.
_MAX_COLSPAN, _MAX_ROWSPAN = 1000, 65534
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}

_ATTRIBUTES = r"""([^<>"']*+(?:(?:"[^"]*"|'[^']*')[^<>"']*+)*+)"""
# attributes that neither span nor hide, nor hold a tag's ends
_PLAIN = r"""(?:\s(?:(?!span|display)[^<>"']|"(?:(?!span|display)[^<>"])*+"|'(?:(?!span|display)[^<>'])*+')*+)?+"""
_WORD_ROW = rf"tr{_PLAIN}>\s*+(?:<t[dh]{_PLAIN}>[^<]*+</t[dh]\s*+>\s*+)++</tr\s*+>\s*+"
_PARTS = (
    rf"(t[dh])\b{_ATTRIBUTES}>([^<]*+)</t[dh]\s*>"  # a whole cell without markup in it
    rf"|(/?)(table|thead|tbody|tfoot|tr|td|th)\b{_ATTRIBUTES}>"
    r"|!--.*?(?:-->|\Z)"  # comment
    r"|(?:script|style)\b.*?(?:</(?:script|style)\s*>|\Z)"  # raw text, never shown
)
_PART = re.compile(f"<(?:{_PARTS})", re.I | re.S)
_TOKEN = re.compile(rf"<(?:({_WORD_ROW}(?:<{_WORD_ROW})*+)|{_PARTS})", re.I | re.S)  # runs of rows of nothing but such cells first
_ROW_END = re.compile(r"</tr\s*>\s*", re.I)
_CELL = re.compile(rf"<t([dh])\b{_ATTRIBUTES}>([^<]*+)<", re.I)
_BARE = re.compile(r"<td>([^<]*+)</td>")
_WHITE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())  # what \s and strip() take for white space
_SPACED = f"[\r\n]|[{_WHITE}]{{2}}"  # whether _SPACES occurs, for Arrow
_TAG = re.compile(rf"<(/?)([a-z][^\s<>/]*){_ATTRIBUTES}>", re.I)
_ATTRIBUTE = re.compile(r"""([^\s=/"']+)\s*=\s*("[^"]*"|'[^']*'|[^\s"']+)""")
_HIDDEN = re.compile(r"display\s*:\s*none", re.I)


def _attributes(attrs: str) -> dict[str, str]:
    return {name.lower(): unescape(value.strip("\"'")) for name, value in _ATTRIBUTE.findall(attrs)}


def _span(attrs: dict[str, str], name: str, limit: int) -> int:
    digits = re.match(r"\s*(\d+)", attrs.get(name, ""))
    return min(max(int(digits[1]), 1), limit) if digits else 1


def _shown(markup: str) -> str:
    """Markup without the elements that are not displayed."""
    kept, hidden, at = [], [], 0
    for tag in _TAG.finditer(markup):
        end, name, attrs = tag[1], tag[2].lower(), tag[3]
        if not hidden:
            kept.append(markup[at : tag.start()])
            if not end and name not in _VOID and _HIDDEN.search(attrs):
                hidden.append(name)
            else:
                kept.append(tag[0])
        elif end:
            if name in hidden:
                while hidden.pop() != name:
                    pass
        elif name not in _VOID:
            hidden.append(name)
        at = tag.end()
    return "".join(kept) + ("" if hidden else markup[at:])


def _tidied(text: str) -> str | None:
    return _SPACES.sub(" ", text.strip()) or None


class _Cell:
    """A cell, as the markup between its tags."""

    __slots__ = ("head", "across", "down", "markup")

    def __init__(self, tag: str, attrs: str):
        self.head = tag == "th"
        self.across = self.down = 1
        self.markup = ""
        if attrs and "span" in attrs.lower():
            spans = _attributes(attrs)
            self.across = _span(spans, "colspan", _MAX_COLSPAN)
            self.down = _span(spans, "rowspan", _MAX_ROWSPAN)

    def text(self) -> str | None:
        """All text of the cell run together."""
        text = self.markup
        if "<" in text:
            text = _TAG.sub("", _shown(text) if _HIDDEN.search(text) else text)
        if "&" in text:
            text = unescape(text)
        return _tidied(text)

    def spaced_text(self, without: str | None = None) -> str | None:
        """The pieces of text of the cell with a space in between; some pieces may be left out."""
        markup = self.markup
        if "<" not in markup:
            text = unescape(markup) if "&" in markup else markup
            return None if without and without in text else _tidied(text)
        pieces = _TAG.sub("\0", _shown(markup) if _HIDDEN.search(markup) else markup).split("\0")
        if "&" in markup:
            pieces = map(unescape, pieces)
        said = [words for x in pieces if (words := x.strip()) and not (without and without in words)]
        return _SPACES.sub(" ", " ".join(said)) or None

    def links(self) -> list[str]:
        if "<a" not in self.markup and "<A" not in self.markup:
            return []
        anchors = (_attributes(attrs) for end, name, attrs in _TAG.findall(self.markup) if name in ("a", "A") and not end)
        return [a["href"].strip() for a in anchors if "href" in a]


class _WordRow:
    """A row of cells that hold words only, without spans or hidden parts: nearly all rows of most pages."""

    __slots__ = ("kinds", "words")

    def __init__(self, words: list[str], kinds: list[str] | None = None):
        self.kinds, self.words = kinds, words  # without kinds all are td

    @classmethod
    def read(cls, row: str) -> _WordRow:
        words = _BARE.findall(row)
        if len(words) == row.count("</"):
            return cls(words)
        found = _CELL.findall(row)
        return cls([words for *_, words in found], [kind for kind, _, _ in found])

    def all_heads(self) -> bool:
        return self.kinds is not None and all(kind in "hH" for kind in self.kinds)

    def cells(self) -> list[_Cell]:
        cells = [_Cell("t" + kind.lower(), "") for kind in self.kinds or "d" * len(self.words)]
        for cell, words in zip(cells, self.words):
            cell.markup = words
        return cells

    def texts(self) -> list[str | None]:
        """As ``_Cell.text``, but for white space; what few cells need is looked for in all of them at once."""
        whole = "".join(self.words)
        if "&" in whole:
            return [cell.text() for cell in self.cells()]
        return [] if not whole or whole.isspace() else self.words


class _Table:
    def __init__(self):
        self.rows: list[tuple[bool, list[_Cell] | _WordRow]] = []  # (stands in a thead, cells)
        self.in_head = self.hidden_part = self.row_open = False
        self.cell: _Cell | None = None  # the open one
        self.across = self.down = False  # whether some cell spans columns, rows

    def start(self, tag: str, attrs: str) -> None:
        hidden = attrs != "" and _HIDDEN.search(attrs) is not None
        self.cell = None
        if tag in ("td", "th"):
            if not self.row_open:
                self._open_row(False)
            self.cell = _Cell(tag, attrs)
            self.across = self.across or self.cell.across > 1
            self.down = self.down or self.cell.down > 1
            if not hidden:
                self._cells.append(self.cell)
        elif tag == "tr":
            self._open_row(hidden)
        else:
            self.in_head, self.hidden_part, self.row_open = tag == "thead", hidden, False

    def _open_row(self, hidden: bool) -> None:
        self._cells: list[_Cell] = []
        self.row_open = True
        if not hidden and not self.hidden_part:
            self.rows.append((self.in_head, self._cells))

    def whole_rows(self, rows: str) -> None:
        self.cell, self.row_open = None, False
        if self.hidden_part:
            return
        head = self.in_head
        rows = rows.rstrip()
        if rows.startswith("<tr><td>") and rows.endswith("</td></tr>"):  # cut at the tags, if these are all there are
            cut = [row.split("</td><td>") for row in rows[8:-10].split("</td></tr><tr><td>")]
            if rows.count("<") == 2 * (len(cut) + sum(map(len, cut))):
                self.rows += [(head, _WordRow(words)) for words in cut]
                return
        self.rows += [(head, _WordRow.read(row)) for row in _ROW_END.split(rows) if row]

    def end(self, tag: str) -> None:
        self.cell = None
        if tag not in ("td", "th"):
            self.row_open = False
            if tag != "tr":
                self.in_head = self.hidden_part = False


def _add(around: list[_Table], markup: str) -> None:
    """Add markup to the open cells: the innermost one and, in nested tables, those around it."""
    for table in around:
        if table.cell is not None:
            table.cell.markup += markup


def _tables(html: str) -> list[_Table]:
    """The tables of a page, nested ones included, in document order."""
    tables: list[_Table] = []
    around: list[_Table] = []  # open tables, innermost last
    at = 0
    for token in _TOKEN.finditer(html):
        if token[1] is None:
            at = _read(token, html, at, around, tables)
        elif len(around) == 1:
            if at < token.start():
                _add(around, html[at : token.start()])
            around[0].whole_rows(token[0])
            at = token.end()
        elif around:  # rows in a nested table
            for part in _PART.finditer(html, token.start(), token.end()):
                at = _read(part, html, at, around, tables)
        else:
            at = token.end()
    if around and around[-1].cell is not None:  # a page cut off inside a cell
        around[-1].cell.markup += html[at:]
    return tables


def _read(token: re.Match, html: str, at: int, around: list[_Table], tables: list[_Table]) -> int:
    """Take in a token and the markup ahead of it, from place ``at`` on; gives the token's end."""
    start, stop = token.span()
    if at < start and around:
        _add(around, html[at:start])
    cell, cell_attrs, words, end, tag, attrs = token.groups()[-6:]
    if tag is not None:
        tag = tag.lower()
        if tag == "table":
            if end:
                if around:
                    around.pop()
            else:
                around.append(_Table())
                if not attrs or not _HIDDEN.search(attrs):
                    tables.append(around[-1])
        elif around:
            if end:
                around[-1].end(tag)
            else:
                around[-1].start(tag, attrs)
    elif cell is not None and around:
        around[-1].start(cell.lower(), cell_attrs)
        _add(around, words)
        around[-1].cell = None
    return stop


def _grid(rows: list[list[_Cell]]) -> list[list[_Cell]]:
    """Rows with spanning cells repeated in every place they cover."""
    grid: list[list[_Cell]] = []
    below: dict[int, tuple[_Cell, int]] = {}  # column -> cell from above and its rows still to come
    for row in rows:
        out: list[_Cell] = []
        left = iter(row)
        cell = next(left, None)
        while cell is not None or len(out) in below:
            if len(out) in below:
                above, more = below.pop(len(out))
                if more > 1:
                    below[len(out)] = (above, more - 1)
                out.append(above)
                continue
            for _ in range(cell.across):
                if cell.down > 1:
                    below[len(out)] = (cell, cell.down - 1)
                out.append(cell)
            cell = next(left, None)
        grid.append(out)
    return grid


def _header_rows(rows: list[tuple[bool, list[_Cell] | _WordRow]]) -> set[int]:
    """The rows of the head section, or without one the first rows of nothing but header cells."""
    marked = {i for i, (head, _) in enumerate(rows) if head}
    if not marked:
        for i, (_, cells) in enumerate(rows):
            if not (cells.all_heads() if isinstance(cells, _WordRow) else all(c.head for c in cells)):
                break
            marked.add(i)
    return marked


def _row_texts(row: list[_Cell] | _WordRow) -> list[str | None]:
    if isinstance(row, _WordRow):
        return row.texts()
    texts, last, text = [], None, None
    for cell in row:
        if cell is not last:  # a spanning cell is read once
            last, text = cell, cell.text()
        texts.append(text)
    return texts


def _width(row: list[_Cell] | _WordRow) -> int:
    return len(row.words) if isinstance(row, _WordRow) else len(row)


def _contents(table: _Table, with_links: bool) -> tuple[list[str], list[list[str | None]], list[list[list[str]]] | None]:
    """Headers (several header rows joined), the texts of each row's cells, and their link targets if asked for.

    White space of the texts, but not of the headers, is still as it was written.
    """
    rows = [row for row in table.rows if row[1]]
    tops = _header_rows(rows)
    if with_links or table.down:
        grid = [cells.cells() if isinstance(cells, _WordRow) else cells for _, cells in rows]
        if table.across or table.down:
            grid = _grid(grid)
    elif table.across:  # without cells from above, only the rows that hold spans change
        grid = [cells if isinstance(cells, _WordRow) else _grid([cells])[0] for _, cells in rows]
    else:
        grid = [cells for _, cells in rows]
    width = max(map(_width, grid), default=0)
    headers = [[] for _ in range(width)] if tops else []
    texts_of, links_of = [], [] if with_links else None
    for i, row in enumerate(grid):
        if i in tops:
            for header, text in zip(headers, (cell.spaced_text() for cell in row) if with_links else _row_texts(row)):
                header.append(_tidied(text) if text else None)
            continue
        if with_links:
            # the words that stand for a flag image are no part of the first cell
            texts = [cell.spaced_text(_FLAG if n == 0 else None) for n, cell in enumerate(row)]
        else:
            texts = _row_texts(row)
        if any(texts):
            texts_of.append(texts if len(texts) == width else texts + [None] * (width - len(texts)))
            if with_links:
                links_of.append([cell.links() for cell in row])
    return [" ".join(filter(None, parts)) for parts in headers] if tops else [""] * width, texts_of, links_of


def _all_contents(html: str, with_links: bool) -> list[tuple]:
    return [_contents(t, with_links) for t in _tables(html)]


def parse_tables(html: str, with_links: bool = False) -> list[dict]:
    """All tables of a page: headers and rows of cell texts.

    With links, cells also carry their link targets, cell texts keep a space between their parts
    and the first cell of a row loses the words that stand for a flag image.
    """
    return [
        {"headers": heads, "rows": [{"cells": [_tidied(x) if x else None for x in cells], "links": links[i] if links else None} for i, cells in enumerate(rows)]}
        for heads, rows, links in _all_contents(html, with_links)
    ]


def _lists(sizes: list[int], values: pa.Array) -> pa.ListArray:
    """Values cut into lists of the given sizes."""
    return pa.ListArray.from_arrays(pa.array(list(accumulate(sizes, initial=0)), pa.int32()), values)


def _tidied_texts(texts: list[str | None] | pa.Array) -> pa.Array:
    """As ``_tidied``, text by text; few hold white space that is to be replaced."""
    trimmed = pc.utf8_trim(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), _WHITE)
    spaced = pc.fill_null(pc.match_substring_regex(trimmed, _SPACED), False)
    if spaced.true_count:
        replaced = pa.array([_SPACES.sub(" ", x) for x in trimmed.filter(spaced).to_pylist()], pa.string())
        trimmed = pc.replace_with_mask(trimmed, spaced, replaced)
    return pc.if_else(pc.equal(pc.binary_length(trimmed), 0), None, trimmed)


def _tables_column(pages: list[list[tuple]], with_links: bool) -> pa.Array:
    """The tables of some pages as one column: flat values and the sizes of the lists they are cut into."""
    tables = list(chain.from_iterable(pages))
    rows = [r for _, found, _ in tables for r in found]
    cells = _lists(list(map(len, rows)), _tidied_texts(list(chain.from_iterable(rows))))
    if with_links:
        linked = [r for *_, found in tables for r in found]
        anchors = [a for row in linked for a in row]
        targets = _lists(list(map(len, anchors)), pa.array(list(chain.from_iterable(anchors)), pa.string()))
        links = _lists(list(map(len, linked)), targets)
    else:
        links = pa.nulls(len(rows), pa.list_(_TEXTS))
    found = _lists([len(t[1]) for t in tables], pa.StructArray.from_arrays([cells, links], fields=list(_ARROW_ROW)))
    heads = _lists([len(t[0]) for t in tables], pa.array(list(chain.from_iterable(t[0] for t in tables)), pa.string()))
    whole = pa.StructArray.from_arrays([heads, found], fields=list(_ARROW_TABLES.value_type))
    return _lists(list(map(len, pages)), whole)


def _spans(tag: str, attrs: str) -> tuple[int, int]:
    cell = _Cell(tag, attrs)
    return cell.across, cell.down


def _of_words(markup: str) -> _Cell:
    cell = _Cell("td", "")
    cell.markup = markup
    return cell


def _plain_tables(column: pa.Array, with_links: bool) -> tuple[np.ndarray, pa.Array]:
    links = pa.list_(_TEXTS)
    if with_links:
        return plain_tables(column, _spans, lambda x, without: _of_words(x).spaced_text(without), _tidied_texts, links, lambda x: _of_words(x).links(), _FLAG)
    return plain_tables(column, _spans, lambda x, _: _of_words(x).text(), _tidied_texts, links)


def _read_pages(column: pa.Array, with_links: bool) -> tuple[pa.Array, list[str | None]]:
    """The tables of some pages as one column, and why a page gave none: plain pages all at once, the others one by one."""
    plain, tables = _plain_tables(column, with_links)
    errors: list[str | None] = [None] * len(column)
    others = np.flatnonzero(~plain)
    if not len(others):
        return tables, errors
    found = []
    for i, html in zip(others, column.take(pa.array(others)).to_pylist()):
        try:
            found.append(_all_contents(html, with_links))
        except Exception as problem:  # one bad page must not end the run
            found.append([])
            errors[i] = f"{type(problem).__name__}: {problem}"
    read = _tables_column(found, with_links)
    if len(others) == len(column):
        return read, errors
    order = np.arange(len(column))
    order[others] = len(column) + np.arange(len(others))
    return pa.concat_arrays([tables, read]).take(pa.array(order)), errors


def extract_tables(pages: DataFrame, keep: Sequence[str], with_links: bool = False) -> DataFrame:
    """Pages as ``keep`` columns, ``tables`` and ``error`` (null, or why the page gave none).

    One row per input page: nothing is dropped, a page that cannot be read keeps its error text.
    """
    ship(pages.sparkSession)
    narrow = pages.select(*keep, "html")
    schema = T.StructType(
        [narrow.schema[c] for c in keep]
        + [T.StructField("tables", TABLES), T.StructField("error", T.StringType())]
    )

    def read_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(lo, _PAGES) for b in batches for lo in range(0, b.num_rows, _PAGES)):
            tables, errors = _read_pages(batch.column("html"), with_links)
            arrays = [batch.column(c) for c in keep]
            arrays += [tables, pa.array(errors, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, [*keep, "tables", "error"])

    return narrow.mapInArrow(read_batches, schema)


# --- rules that need no parser ---

# The named character references of HTML 4 by the standard library's table, and ``apos``.
_NAMED = {name: chr(code) for name, code in name2codepoint.items()} | {"apos": "'"}


def unescaped(text: Column) -> Column:
    """Text with its character references decoded: decimal, hexadecimal and named ones.

    The text is cut at every ``&``; a part that begins with a reference gets its character.
    """
    named = F.create_map(*(F.lit(x) for pair in sorted(_NAMED.items()) for x in pair))

    def character(reference: Column) -> Column:
        found = F.when(reference == "amp", "&")  # the frequent ones first, without the table
        for name in ("lt", "gt", "quot", "nbsp", "apos"):
            found = found.when(reference == name, _NAMED[name])
        code = F.lpad(
            F.when(reference.rlike("^#[xX]"), F.substring(reference, 3, 6)).otherwise(F.conv(F.substring(reference, 2, 7), 10, 16)), 8, "0"
        )
        valid = (code > "00000000") & (F.upper(code) <= "0010FFFF") & ~F.upper(code).between("0000D800", "0000DFFF")
        numeric = F.when(valid, F.decode(F.unhex(code), "UTF-32"))
        return found.when(reference.startswith("#"), numeric).when(reference != "", F.try_element_at(named, reference))

    # step by step, since a lambda computes an expression as often as it stands there
    pattern = "^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);"
    cut = F.transform(F.split(text, "&", -1), lambda piece, i: F.struct(
        piece.alias("piece"), F.when(i > 0, F.regexp_extract(piece, pattern, 1)).alias("reference")))
    read = F.transform(cut, lambda p: F.struct(p["piece"].alias("piece"), p["reference"].alias("reference"), character(p["reference"]).alias("char")))

    def part(p: Column) -> Column:
        rest = F.substring(p["piece"], F.length(p["reference"]) + 2, F.length(p["piece"]))
        return F.when(p["reference"].isNull(), p["piece"]).when(p["char"].isNotNull(), F.concat(p["char"], rest)).otherwise(F.concat(F.lit("&"), p["piece"]))

    return F.when(text.contains("&"), F.array_join(F.transform(read, part), "")).otherwise(text)


def plain_text(markup: Column) -> Column:
    """Markup as text: tags out, character references in, white space collapsed."""
    # an array's element is computed once, however often the step behind it uses it
    text = F.transform(F.transform(F.array(markup), lambda m: F.regexp_replace(m, r"<[^>]*>", " ")), unescaped)
    return F.trim(F.regexp_replace(F.get(text, F.lit(0)), r"[\s\u00A0]+", " "))


def title(html: Column) -> Column:
    """Text of the first ``h1`` or ``h2``, null when there is none."""
    unshown = r"<(?:!--.*?-->|(script|style)\b.*?</\{}>)"
    # read up to the first heading, step by step without a way back: what follows it is not searched
    ahead = rf"(?:[^<]++|{unshown.format(1)}|<(?!h[12]\b[^>]*>))*+"
    inside = rf"((?:[^<]++|{unshown.format(3)}|<(?!/h[12]>))*+)"
    found = F.regexp_extract(html, rf"(?is)\A{ahead}<h[12]\b[^>]*>{inside}</h[12]>", 2)
    hidden = r"(?is)<(?:!--.*?-->|script\b.*?</script>|style\b.*?</style>)"
    heading = F.transform(F.array(found), lambda h: F.when(h.contains("<"), F.regexp_replace(h, hidden, "")).otherwise(h))
    return null_if_blank(plain_text(F.get(heading, F.lit(0))))


def page_links(pages: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Every link of a page, in order, as text, target as written and absolute URL."""
    anchor = r"""(?is)<a\s(?:[^>]*?\s)?href\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)[^>]*>(.*?)</a>"""
    found = F.arrays_zip(
        F.regexp_extract_all("html", F.lit(anchor), F.lit(1)).alias("href"),
        F.regexp_extract_all("html", F.lit(anchor), F.lit(2)).alias("text"),
    )
    rows = pages.select(*keep, "url", F.posexplode(found).alias("link_no", "link"))
    href = unescaped(F.regexp_replace("link.href", "^[\"']|[\"']$", ""))
    return rows.select(
        *keep, "url", (F.col("link_no") + 1).alias("link_no"), plain_text(F.col("link.text")).alias("text"), href.alias("href"),
    ).select(*keep, "link_no", "text", "href", urls.absolute(F.col("url"), F.col("href")).alias("target"))
