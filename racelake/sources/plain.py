"""Tables of plain pages, read a batch at a time.

A page is plain if its cells close and cover no rows but their own, and if its tables are not nested and none of their tags hides
something: nearly all pages of results are. Tags are then found by their places in the bytes of the whole batch, with arrays
instead of a step per tag, and only cells with markup in them are read one by one. Any other page is left to the reader
of ``html``, and a plain one gives the same tables there.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from html import unescape

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_TABLE, _THEAD, _SECTION, _TR, _TD, _TH = range(1, 7)
_SHORT = np.zeros(256, np.int8)  # by the letter after the t
_SHORT[list(b"rdh")] = _TR, _TD, _TH
_LONG = {b"table": _TABLE, b"thead": _THEAD, b"tbody": _SECTION, b"tfoot": _SECTION}
_LT, _GT, _SLASH, _DASH = b"<>/-"
_SPACES = np.isin(np.arange(256), list(b" \t\n\r\x0b\x0c"))
_WORD = np.isin(np.arange(256), list(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_"))

# comments and raw text are passed over, as ``html`` does it; white space beyond ASCII is left to it
_SKIPPED = re.compile(rb"<(?:!--.*?(?:-->|\Z)|(?:script|style)\b.*?(?:</(?:script|style)[\s\x1c-\x1f]*>|\Z))", re.I | re.S)
_ODD_RAW = re.compile(rb"<(?:/(?:script|style)[\s\x1c-\x1f]*|script|style)[\x80-\xff]", re.I)
_ODD_ATTRIBUTES = "(?i:display)|[İıſ]"
_QUOTED = r"""\A(?:[^"']|"[^"]*"|'[^']*')*\z"""
_COLSPAN = re.compile(r"""\s+colspan\s*=\s*(["']?)0*([1-9][0-9]{0,2})\1\s*""", re.I | re.A)  # nothing but this, below the limit


def _cut(text: pa.Buffer, base: int, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The texts between places that do not overlap: every other one of those between all the places."""
    places = np.empty(2 * len(starts), np.int32)
    places[0::2], places[1::2] = starts + base, ends + base
    between = pa.StringArray.from_buffers(max(2 * len(starts) - 1, 0), pa.py_buffer(places), text)
    return between.take(pa.array(np.arange(0, len(between), 2)))


def _taken(texts: pa.Array, places: np.ndarray) -> pa.Array:
    return texts.take(pa.array(places, mask=places < 0))


def _sizes(of: np.ndarray, n: int) -> np.ndarray:
    """Where each of ``n`` lists begins and ends, given the list of every value in order."""
    return np.concatenate([[0], np.cumsum(np.bincount(of, minlength=n))]).astype(np.int32)


def _list(offsets: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values)


def _replaced(texts: pa.Array, where: np.ndarray, values: list[str | None]) -> pa.Array:
    return pc.replace_with_mask(texts, pa.array(where), pa.array(values, pa.string())) if len(values) else texts


def _holds(texts: pa.Array, mark: str) -> np.ndarray:
    return pc.match_substring(texts, mark).to_numpy(zero_copy_only=False)


def _picked(texts: pa.Array, where: np.ndarray) -> list[str]:
    return texts.filter(pa.array(where)).to_pylist() if where.any() else []


def _passed_over(text: np.ndarray, at: np.ndarray, pages: np.ndarray, starts: np.ndarray, bad: np.ndarray) -> np.ndarray:
    """Comments and raw texts, by the places where one may begin."""
    data, spans, over = text.tobytes(), [], 0
    for begin, page, stop in zip(at.tolist(), pages.tolist(), starts[pages + 1].tolist()):
        if begin >= over and (met := _SKIPPED.match(data, begin, stop)):
            over = met.end()
            spans.append((begin, over))
            if data[begin + 1] != 33:  # no comment
                bad[page] |= _ODD_RAW.search(data, begin, over) is not None
    return np.array(spans, np.int64).reshape(-1, 2)


def plain_tables(
    html: pa.Array, spans_of: Callable[[str, str], tuple[int, int]], text_of: Callable[[str, str | None], str | None],
    tidied: Callable[[pa.Array], pa.Array], links: pa.DataType, links_of: Callable[[str], list[str]] | None = None, unsaid: str | None = None,
) -> tuple[np.ndarray, pa.Array]:
    """Which pages are plain, and the tables of all pages, none where a page is not.

    ``spans_of`` reads the columns and rows that a cell covers from its tag and attributes, ``text_of`` the text of a cell
    with markup, ``links_of`` its links, if these are asked for; ``tidied`` is for the white space of all texts.
    Pieces of text that hold ``unsaid`` are left out of a row's first cell.
    """
    n = len(html)
    html = html.cast(pa.string())
    bad = html.is_null().to_numpy(zero_copy_only=False).copy()
    _, offsets, data = html.buffers()
    offsets = np.frombuffer(offsets, np.int32, n + 1, 4 * html.offset).astype(np.int64) if n else np.zeros(1, np.int64)
    base, data = int(offsets[0]), data or pa.py_buffer(b"")
    starts = offsets - base
    text = np.frombuffer(data, np.uint8, int(starts[-1]), base)
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    for mark in (0xC4, 0xC5):  # letters that count as an i or s if case does not matter
        at = np.flatnonzero(text == mark)
        follows = padded[at + 1]
        at = at[(follows == 0xB0) | (follows == 0xB1) if mark == 0xC4 else follows == 0xBF]
        bad[np.searchsorted(starts, at, "right") - 1] = True

    # tags by name
    marks = np.flatnonzero(text | 2 == _GT)  # both < and >
    at = np.flatnonzero(text[marks] == _LT)
    lt, end = marks[at], np.append(marks, 0)[at + 1]
    closes = padded[lt + 1] == _SLASH
    name = lt + 1 + closes
    first = padded[name] | 0x20
    may_skip = lt[(padded[lt + 1] == ord("!")) | ((first == ord("s")) & ~closes)]
    named = np.flatnonzero(first == ord("t"))
    name = name[named]
    kind, name_end = _SHORT[padded[name + 1] | 0x20], name + 2
    long = np.flatnonzero(_WORD[padded[name_end]])
    kind[long] = 0
    if len(long):
        letters = [padded[name[long] + i] | 0x20 for i in range(1, 5)]
        for tag, code in _LONG.items():
            same = long[np.logical_and.reduce([letters[i - 1] == tag[i] for i in range(1, 5)])]
            same = same[~_WORD[padded[name[same] + 5]]]
            kind[same], name_end[same] = code, name[same] + 5
    found = kind > 0
    named, kind, name_end = named[found], kind[found], name_end[found]
    place, closing, end = lt[named], closes[named], end[named]
    page = np.repeat(np.arange(n), np.diff(np.searchsorted(place, starts)))
    spans = np.zeros((0, 2), np.int64)
    if len(may_skip):
        spans = _passed_over(text, may_skip, np.searchsorted(starts, may_skip, "right") - 1, starts, bad)
        if len(spans):
            over = np.searchsorted(place, spans)  # the tags ahead of a span and of its end
            if (over[:, 0] < over[:, 1]).any():
                depth = np.zeros(len(place) + 1, np.int64)
                np.add.at(depth, over[:, 0], 1)
                np.add.at(depth, over[:, 1], -1)
                read = np.cumsum(depth)[:-1] == 0
                kind, place, closing, name_end, page, end = (x[read] for x in (kind, place, closing, name_end, page, end))
    after = padded[name_end]
    bad[page[(padded[end] != _GT) | (end >= starts[page + 1]) | (end < place) | ((after != _GT) & ~_SPACES[after])]] = True

    def left(*arrays: np.ndarray) -> list[np.ndarray]:
        good = ~bad[arrays[0]] if bad.any() else None
        return list(arrays) if good is None else [x[good] for x in arrays]

    page, kind, place, closing, name_end, end = left(page, kind, place, closing, name_end, end)

    # attributes
    across = np.ones(len(page), np.int64)
    told = np.flatnonzero(end > name_end)
    if len(told):
        attributes = _cut(data, base, name_end[told], end[told])
        blank = pc.equal(pc.binary_length(pc.ascii_trim_whitespace(attributes)), 0).to_numpy(zero_copy_only=False)
        odd = pc.or_(pc.match_substring_regex(attributes, _ODD_ATTRIBUTES), pc.invert(pc.match_substring_regex(attributes, _QUOTED)))
        bad[page[told[odd.to_numpy(zero_copy_only=False) | (closing[told] & ~blank)]]] = True
        spanning = pc.match_substring(attributes, "span", ignore_case=True).to_numpy(zero_copy_only=False) & (kind[told] >= _TD)
        for i, attrs in zip(told[spanning], attributes.filter(pa.array(spanning)).to_pylist()):
            if plainly := _COLSPAN.fullmatch(attrs):
                across[i] = int(plainly[2])
                continue
            across[i], down = spans_of("th" if kind[i] == _TH else "td", attrs)
            bad[page[i]] |= down > 1
        if links_of:
            bad[page[across > 1]] = True
        page, kind, closing, place, end, across = left(page, kind, closing, place, end, across)

    # tags in their order: cells that close in open rows, within tables that are not nested
    is_cell = kind >= _TD
    opens = is_cell & ~closing
    following = np.append(place, 0)[1:]  # where the next of these tags is
    closed = opens & np.append(is_cell & closing, False)[1:] & (np.append(page, -1)[1:] == page)
    closed &= np.searchsorted(spans[:, 0], end) == np.searchsorted(spans[:, 0], following)
    bad[page[opens & ~closed]] = True
    bad[page[is_cell & closing & ~np.append(False, closed)[:-1]]] = True
    frame = np.flatnonzero(~is_cell)
    frame_kind, frame_page = np.append(kind[frame] + 8 * closing[frame], 0), np.append(page[frame], -1)

    def in_row(at: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Whether the tag of the frame ahead opened a row on the same page."""
        return (before >= 0) & (frame_kind[before] == _TR) & (frame_page[before] == page[at])

    cells = np.flatnonzero(opens)
    bad[page[cells[~in_row(cells, np.searchsorted(frame, cells) - 1)]]] = True
    ends = np.flatnonzero(frame_kind[:-1] == _TR + 8)
    bad[page[frame[ends][~in_row(frame[ends], ends - 1)]]] = True
    bounds = np.flatnonzero(kind == _TABLE)
    if len(bounds):
        number = np.arange(len(bounds)) - np.searchsorted(page[bounds], page[bounds])
        bad[page[bounds[closing[bounds] != (number % 2 == 1)]]] = True
        last = np.append(page[bounds][1:] != page[bounds][:-1], True)
        bad[page[bounds[last & ~closing[bounds]]]] = True
    around = np.searchsorted(bounds, np.arange(len(page))) - 1  # the bound ahead
    inner = kind != _TABLE
    inside = (around >= 0) & ~np.append(closing[bounds], True)[around] & (np.append(page[bounds], -1)[around] == page)
    bad[page[inner & ~inside]] = True
    page, kind, closing, following, end, across = left(page, kind, closing, following, end, across)

    while True:  # twice at most
        # rows with cells, their tables and heads
        table_of, row_of = np.cumsum((kind == _TABLE) & ~closing) - 1, np.cumsum((kind == _TR) & ~closing) - 1
        tables, rows = np.flatnonzero((kind == _TABLE) & ~closing), np.flatnonzero((kind == _TR) & ~closing)
        cells = np.flatnonzero((kind >= _TD) & ~closing)
        row_table, cell_row = table_of[rows], row_of[cells]
        counts = np.bincount(cell_row, minlength=len(rows))
        filled = counts > 0
        sections = np.flatnonzero((kind == _THEAD) | (kind == _SECTION) | ((kind == _TABLE) & ~closing))
        section = sections[np.searchsorted(sections, rows) - 1] if len(rows) else rows
        marked = (kind[section] == _THEAD) & ~closing[section] & filled
        has_marked = np.bincount(row_table[marked], minlength=len(tables)) > 0
        heads = np.bincount(cell_row, kind[cells] == _TH, minlength=len(rows)) == counts
        others = np.cumsum(filled & ~heads)
        ahead = np.append(0, others)[np.searchsorted(row_table, row_table)]
        tops = np.where(has_marked[row_table], marked, filled & (others == ahead))
        several = np.bincount(row_table[tops], minlength=len(tables)) > 1
        if not several.any():
            break
        bad[page[tables[several]]] = True
        page, kind, closing, following, end, across = left(page, kind, closing, following, end, across)

    markup = _cut(data, base, end[cells] + 1, following[cells])
    marked, coded = _holds(markup, "<"), _holds(markup, "&")
    if unsaid:
        leading = ~tops[cell_row] & (np.diff(cell_row, prepend=-1) > 0)
        marked |= leading & _holds(markup, unsaid)
        read = [text_of(x, unsaid if lead else None) for x, lead in zip(_picked(markup, marked), leading[marked])]
    else:
        read = [text_of(x, None) for x in _picked(markup, marked)]
    texts = _replaced(markup, coded & ~marked, [unescape(x) for x in _picked(markup, coded & ~marked)])
    texts = tidied(_replaced(texts, marked, read))
    known = texts.is_valid().to_numpy(zero_copy_only=False)

    # places: a spanning cell stands in several, short rows are filled up
    cell = np.repeat(np.arange(len(cells)), across[cells])
    row = cell_row[cell]
    width = np.bincount(row, minlength=len(rows))
    column = np.arange(len(cell)) - (np.cumsum(width) - width)[row]
    table_width = np.zeros(len(tables), np.int64)
    np.maximum.at(table_width, row_table, width)
    kept = filled & ~tops & (np.bincount(cell_row, known, minlength=len(rows)) > 0)
    row_starts = np.append(0, np.cumsum(table_width[row_table[kept]]))
    placed = kept[row]
    places = np.full(row_starts[-1], -1)
    places[row_starts[(np.cumsum(kept) - 1)[row[placed]]] + column[placed]] = cell[placed]
    head_starts = np.append(0, np.cumsum(table_width))
    topped = tops[row]
    head_places = np.full(head_starts[-1], -1)
    head_places[head_starts[row_table[row[topped]]] + column[topped]] = cell[topped]

    values = _list(row_starts, _taken(texts, places))
    fields = [pa.field("cells", values.type), pa.field("links", links)]
    if links_of:
        shown = kept[cell_row]
        targets = [links_of(x) for x in _picked(markup, marked & shown)]
        sizes = np.zeros(len(cells), np.int64)
        sizes[marked & shown] = [len(x) for x in targets]
        anchors = _list(np.append(0, np.cumsum(sizes[shown])), pa.array([x for found in targets for x in found], pa.string()))
        targets = _list(np.append(0, np.cumsum(width[kept])), anchors)
    else:
        targets = pa.nulls(len(values), links)
    struct = pa.StructArray.from_arrays([values, targets], fields=fields)
    found_rows = _list(_sizes(row_table[kept], len(tables)), struct)
    headers = _list(head_starts, pc.fill_null(_taken(texts, head_places), ""))
    fields = [pa.field("headers", headers.type), pa.field("rows", found_rows.type)]
    return ~bad, _list(_sizes(page[tables], n), pa.StructArray.from_arrays([headers, found_rows], fields=fields))
