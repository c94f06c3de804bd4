"""Secrets in plain and encoded text.

A worklist starts with the text itself. Every layer is scanned by the three rules, and its encoded
regions (percent escapes, ``\\u``/``\\x`` escapes, base64, and compressed data inside base64) are unwrapped
to further layers until none is new. A layer carries the place in the original text of each of its
characters, so that a secret found five layers down is a span of the original. Layers seen before are
skipped, which ends cycles such as a text that decodes to itself.

A region need not decode as a whole: bytes that are not UTF-8 become separators, which no rule matches, and the
rest of the layer is kept. Base64 runs go on over line ends and are decoded in all four alignments, so that
words and paths ahead of the encoded part do not matter; compressed data begins wherever its signature is.

Spans are (kind, start, end) in code points, end exclusive. Those of the text itself come first by the
rules alone; a decoded layer only adds spans, and none that such a span already covers.

Cases: null and empty texts have no spans; repeated rows give repeated results; further columns are
ignored; an empty table gives an empty one. Decompressed data is scanned to its end, however long, as a stream
of windows, and all its members; a bomb therefore costs time but not memory. Inside such a stream, compressed
data in base64 that is escaped as well (percent or backslash) is found only if it is shorter than a window.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from racelake.llm.staging import documents, tidy
from racelake.shipping import ship

KINDS = ("assign", "access", "hex")
WINDOW = 1 << 20
"""bytes of decompressed data that make a layer at a time"""
OVERLAP = 1 << 17
_STEP = 1 << 14
"""bytes that are decompressed, or come out, at a time"""

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")

_PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_ESCAPE = re.compile(r"\\u[0-9A-Fa-f]{4}|\\x[0-9A-Fa-f]{2}")
_LETTERS = "[A-Za-z0-9+/_-]"
_BREAK = r"[ \t]*+[\r\n][ \t\r\n]*+"
# at least 16 letters, which may go on over line ends
_BASE64 = re.compile(
    rf"(?<!{_LETTERS})(?=(?:{_LETTERS}(?:{_BREAK})?+){{16}}){_LETTERS}++(?:{_BREAK}{_LETTERS}++)*+={{0,2}}"
)
_BROKEN = re.compile(r"\s+")
# a layer without it holds neither a secret nor a region with one, all of which are longer
_LEGIBLE = re.compile(rb"[\t\n\r\x20-\x7e]{16}")
_SPACES = re.compile(rb" {64,}")
_RUN = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_- \t\r\n"
_PACKED = re.compile(rb"\x1f\x8b\x08|\x78[\x01\x5e\x9c\xda]")

Span = tuple[str, int, int]


def rules(text: str) -> list[Span]:
    """The spans that the three rules find in a text as it stands, by start and then kind."""
    found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return [(KINDS[k], s, e) for s, k, e in sorted(found)]


class Layer:
    """A text and, for each of its characters, where it begins and ends in the original."""

    def __init__(self, text: str, starts: np.ndarray, ends: np.ndarray):
        self.text, self.starts, self.ends = text, starts, ends

    def origin(self, start: int, end: int) -> tuple[int, int]:
        return int(self.starts[start:end].min()), int(self.ends[start:end].max())


def _spread(decoded: bytes, starts: np.ndarray, ends: np.ndarray) -> Layer:
    """A layer of decoded bytes, of which each comes from (start, end) of the original; a byte that is not UTF-8 is a lone surrogate."""
    text = decoded.decode("utf-8", "surrogateescape")
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    width = 1 + (code >= 0x80).astype(np.int64) + (code >= 0x800) + (code >= 0x10000)
    width[(code >= 0xDC80) & (code < 0xDD00)] = 1
    last = np.cumsum(width) - 1
    return Layer(text, starts[last - width + 1], ends[last])


def _percent(layer: Layer) -> Layer | None:
    """The whole layer with its percent escapes resolved."""
    out: list[str] = []
    starts, ends, at = [], [], 0
    for m in _PERCENT.finditer(layer.text):
        raw = bytes.fromhex(m.group().replace("%", ""))
        offsets = m.start() + 3 * np.arange(len(raw))
        inner = _spread(raw, layer.starts[offsets], layer.ends[offsets + 2])
        out += [layer.text[at : m.start()], inner.text]
        starts += [layer.starts[at : m.start()], inner.starts]
        ends += [layer.ends[at : m.start()], inner.ends]
        at = m.end()
    return _joined(layer, out, starts, ends, at)


def _escapes(layer: Layer) -> Layer | None:
    """The whole layer with its backslash escapes resolved; surrogate pairs make one character."""
    out: list[str] = []
    starts, ends, at = [], [], 0
    for m in _ESCAPE.finditer(layer.text):
        lo, hi = layer.origin(m.start(), m.end())
        code = int(m.group()[2:], 16)
        if 0xDC00 <= code < 0xE000 and out and at == m.start() and out[-1] and 0xD800 <= ord(out[-1]) < 0xDC00:
            out[-1] = chr(0x10000 + (ord(out[-1]) - 0xD800 << 10) + code - 0xDC00)
            ends[-1] = np.array([hi])
        else:
            out += [layer.text[at : m.start()], chr(code)]
            starts += [layer.starts[at : m.start()], np.array([lo])]
            ends += [layer.ends[at : m.start()], np.array([hi])]
        at = m.end()
    return _joined(layer, out, starts, ends, at)


def _joined(layer: Layer, out: list[str], starts: list, ends: list, at: int) -> Layer | None:
    if not out:
        return None
    text = "".join([*out, layer.text[at:]])
    return Layer(text, np.concatenate([*starts, layer.starts[at:]]), np.concatenate([*ends, layer.ends[at:]]))


def _cut(data: bytes) -> Iterator[bytes]:
    for at in range(0, len(data), _STEP):
        yield data[at : at + _STEP]


class _Inflated:
    """What the gzip or zlib data at the start of a stream holds, in pieces; iterated once.

    Members that follow each other are one stream. Damaged data ends it behind the last byte that it gives.
    """

    def __init__(self, pieces: Iterator[bytes]):
        self.pieces = pieces
        self.used = 0
        """bytes read so far that belong to the data"""
        self.open = True
        """the data goes on beyond what was read"""
        self.damaged = False

    def __iter__(self) -> Iterator[bytes]:
        inner, rest = None, b""
        for piece in self.pieces:
            rest += piece
            while rest:
                if inner is None or inner.eof:
                    if inner is not None:
                        self.used += len(rest) - len(rest := rest.lstrip(b"\0"))  # padding between members
                    if len(rest) < 3:
                        break
                    if not _PACKED.match(rest):
                        self.open = False
                        return
                    inner = zlib.decompressobj(47)
                kept = inner.copy()
                try:
                    while rest and not inner.eof:
                        out = inner.decompress(rest, _STEP)
                        left = inner.unused_data if inner.eof else inner.unconsumed_tail
                        self.used += len(rest) - len(left)
                        rest = left
                        if not inner.eof:
                            kept = inner.copy()
                        if out:
                            yield out
                except (zlib.error, ValueError):
                    self.open, self.damaged = False, True
                    yield from self._last(kept, rest)
                    return
        if inner is not None and not inner.eof:
            try:
                out = inner.flush()
            except zlib.error:
                out = b""
            if out:
                yield out
        self.open = inner is not None and not inner.eof

    def _last(self, inner, rest: bytes) -> Iterator[bytes]:
        """What comes before the damage."""
        for i in range(len(rest)):
            try:
                out = inner.decompress(rest[i : i + 1])
            except zlib.error:
                return
            self.used += 1
            if out:
                yield out


def _streams(data: bytes) -> Iterator[_Inflated]:
    """Compressed data at the start of ``data``, then what is compressed inside that, to the innermost; none is held."""
    depth, seen = 1, set()
    while True:
        def opened() -> _Inflated:
            stream = _Inflated(_cut(data))
            for _ in range(1, depth):
                stream = _Inflated(iter(stream))
            return stream

        yield opened()
        begin, digest = b"", hashlib.blake2b()
        for piece in opened():
            if len(begin) < 3:
                begin += piece
            elif not _PACKED.match(begin):
                return
            digest.update(piece)
        # data that inflates to itself ends here
        if not _PACKED.match(begin) or digest.digest() in seen:
            return
        seen.add(digest.digest())
        depth += 1


def _windows(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """A stream in windows that overlap, so that every secret and region up to ``OVERLAP`` lies whole in one.

    Longer regions go on in the next window, where their alignment is found anew; those that hold compressed
    data that goes on are kept whole.
    """
    held, new, size = bytearray(), 0, WINDOW
    for piece in pieces:
        held += piece
        new += len(piece)
        if len(held) < size:
            continue
        # a rule takes any number of them
        held = bytearray(_SPACES.sub(b" " * 64, held))
        if len(held) < size:
            continue
        window = bytes(held)
        yield window
        new = 0
        del held[: _kept(window)]
        size = max(WINDOW, 2 * len(held))
    if new:
        yield bytes(held)


def _kept(window: bytes) -> int:
    """Where the next window begins."""
    at = len(window) - OVERLAP
    tail = len(window.rstrip(_RUN))
    if tail < at:
        for m in _BASE64.finditer(window[tail:].decode("ascii")):
            if m.end() == len(window) - tail and m.start() + tail < at and _unfinished(m.group()):
                return m.start() + tail
    return at


def _decoded(region: str) -> Iterator[tuple[int, bytes]]:
    """(shift, bytes) of a base64 region in each alignment, if there is anything in it."""
    body = _BROKEN.sub("", region.rstrip("=")).translate({45: 43, 95: 47})
    for shift in range(4):
        part = body[shift:]
        part = part[: len(part) - (len(part) % 4 == 1)]
        raw = base64.b64decode(part + "=" * (-len(part) % 4))
        if _LEGIBLE.search(raw) or _PACKED.search(raw):
            yield shift, raw


def _unfinished(region: str) -> bool:
    """Whether compressed data in a base64 region goes on beyond its end."""
    for _, raw in _decoded(region):
        for at in _PACKED.finditer(raw):
            stream = _Inflated(_cut(raw[at.start() :]))
            for _ in stream:
                pass
            if stream.open:
                return True
    return False


def _base64s(layer: Layer) -> Iterator[Layer]:
    """Layers for every region that may be base64, in each alignment, and for compressed data inside."""
    for m in _BASE64.finditer(layer.text):
        place = None
        for shift, raw in _decoded(m.group()):
            if place is None:
                place = m.start() + np.flatnonzero(np.frombuffer(m.group().rstrip("=").encode(), np.uint8) > 32)
            bits = np.arange(len(raw)) * 8
            first, last = place[shift + bits // 6], place[shift + (bits + 7) // 6]
            if _LEGIBLE.search(raw):
                yield _spread(raw, layer.starts[first], layer.ends[last])
            done = 0
            for at in _PACKED.finditer(raw):
                if at.start() < done:
                    continue
                data = raw[at.start() :]
                whole = _Inflated(_cut(data))
                if not sum(map(len, whole)):
                    continue
                if not whole.open:
                    done = at.start() + whole.used
                reach = at.start() + whole.used
                # where damaged data would have ended is unknown
                end = m.end() if whole.damaged or reach == len(raw) else int(last[reach - 1]) + 1
                lo, hi = layer.origin(int(first[at.start()]), end)
                for stream in _streams(data):
                    for window in _windows(iter(stream)):
                        if _LEGIBLE.search(window):
                            yield _spread(window, *(np.broadcast_to(np.int64(x), len(window)) for x in (lo, hi)))


def _below(layer: Layer) -> Iterator[Layer]:
    """The layers right below one, each made when it is asked for."""
    for unwrap in (_percent, _escapes):
        inner = unwrap(layer)
        if inner is not None:
            yield inner
    yield from _base64s(layer)


def unwrapped(text: str) -> Iterator[Layer]:
    """All layers below a text, each once."""
    if "%" not in text and "\\" not in text and not _BASE64.search(text):
        return
    places = np.arange(len(text), dtype=np.int64)
    seen = {hashlib.blake2b(text.encode("utf-8", "surrogatepass")).digest()}
    work = [_below(Layer(text, places, places + 1))]
    while work:
        inner = next(work[-1], None)
        if inner is None:
            work.pop()
            continue
        mark = hashlib.blake2b(inner.text.encode("utf-8", "surrogatepass")).digest()
        # equal layers from different places of the text are different finds
        mark += inner.starts[:1].tobytes() + inner.ends[-1:].tobytes()
        if mark not in seen:
            seen.add(mark)
            work.append(_below(inner))
            yield inner


def scan(text: str | None) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans) of a text, both by start and then kind."""
    if not text:
        return [], []
    base = rules(text)
    added: set[Span] = set()
    for layer in unwrapped(text):
        for kind, start, end in rules(layer.text):
            lo, hi = layer.origin(start, end)
            if not any(k == kind and s <= lo and hi <= e for k, s, e in base):
                added.add((kind, lo, hi))
    order = {k: i for i, k in enumerate(KINDS)}
    return base, sorted([*base, *added], key=lambda x: (x[1], order[x[0]], x[2]))


def redacted(text: str | None) -> str | None:
    """The text with every found span replaced by ``[SECRET]``; a text without any is returned as it is."""
    spans = sorted((s, e) for _, s, e in scan(text)[1])
    if not spans:
        return text
    out, at, end = [], 0, 0
    for s, e in spans:
        if s >= end:
            out += [text[end:s], "[SECRET]"]
        end = max(end, e)
    return "".join([*out, text[end:]])



_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [scan(t.as_py()) for t in batch.column("text")]
        as_rows = [pa.array([[dict(zip(("kind", "start", "end"), s)) for s in f[i]] for f in found], _SPAN) for i in (0, 1)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *as_rows], names=["doc_id", "base", "spans"])


def find(docs: DataFrame) -> DataFrame:
    """(doc_id, base, spans) of ``docs`` (doc_id, text); spans are arrays of (kind, start, end)."""
    span = "array<struct<kind: string, start: long, end: long>>"
    ship(docs.sparkSession)
    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(tidy(_find), f"doc_id long, base {span}, spans {span}")


def _redact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = batch.schema.get_field_index("text")
        yield batch.set_column(at, "text", pa.array([redacted(t.as_py()) for t in batch.column(at)], pa.string()))


def redact(docs: DataFrame) -> DataFrame:
    """The rows with secrets taken out of their text; all other columns as they are."""
    ship(docs.sparkSession)
    return docs.mapInArrow(tidy(_redact), docs.schema)


def query(spark: SparkSession, folder: str) -> DataFrame:
    joined = "array_join(transform({}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')"
    return find(documents(ship(spark), folder)).selectExpr(
        "doc_id",
        *(f"cast(size(filter(base, s -> s.kind = '{k}')) as long) n_{k}" for k in KINDS),
        f"sha2({joined.format('base')}, 256) base_sha256",
        f"{joined.format('spans')} spans",
    )
