"""Token ids of whole texts by the tokenizers library, a batch of texts at a time.

Byte-level pre-tokens never reach over a space between two characters that are no white space, so texts are
cut before such spaces; likewise on both sides of a lone line feed between such characters, and between an ASCII letter
and a mark of ``MARKS``. The cuts are found on the bytes of a whole batch; the pieces share its buffer, equal
pieces are found by a dictionary encoding, and only pieces that this process has not met are given to the
library, exactly as it would get a text. Special strings hold no space and stay whole within their piece; the other
cuts are made only if no special string holds a line feed or a mark.

A piece met before is known by two 64-bit sums of its bytes, each with weights of its own that are drawn at random: two
pieces that differ agree in both with a chance below 2**-112.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

STEP = 4 << 20
"""bytes of text encoded at a time, or one longer text"""
JOINED = 128
"""pieces that are given to the library as one text"""
KNOWN_PIECES = 2_500_000
KNOWN_IDS = 12 << 20
"""pieces, and their ids, that a Python process remembers before it starts anew; 24 and 4 bytes each"""
LONG_PIECE = 256
"""bytes above which a piece is not remembered"""
MARKS = b".,;:!?"

_IS_MARK, _IS_LETTER = (np.isin(np.arange(256), list(x)) for x in (MARKS, b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"))
_WEIGHTS = np.random.default_rng(20).integers(0, 1 << 64, (2, LONG_PIECE), np.uint64)

_processes: dict[str, "Known"] = {}


def _ascii_space(byte: np.ndarray) -> np.ndarray:
    return (byte == 32) | ((byte >= 9) & (byte <= 13)) | ((byte >= 28) & (byte <= 31))


def _opens_wide_space(lead: np.ndarray, second: np.ndarray) -> np.ndarray:
    wide = (lead == 0xE2) & ((second == 0x80) | (second == 0x81))
    return wide | ((lead == 0xE1) & (second == 0x9A)) | ((lead == 0xE3) & (second == 0x80))


def _narrow_space(lead: np.ndarray, second: np.ndarray) -> np.ndarray:
    return (lead == 0xC2) & ((second == 0x85) | (second == 0xA0))


def _lone(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Those of some places that stand between two characters that are no white space.

    Bytes that might belong to white space beyond ASCII count as white space: that only leaves places out.
    """
    at = at[(at > 2) & (at < len(data) - 3)]
    one, two, three = (data[at - k] for k in (1, 2, 3))
    ahead, then = data[at + 1], data[at + 2]
    unsafe = _ascii_space(one) | _ascii_space(ahead)
    unsafe |= _narrow_space(two, one) | _narrow_space(ahead, then)
    unsafe |= _opens_wide_space(three, two) | _opens_wide_space(ahead, then)
    return at[~unsafe]


def safe_cuts(data: np.ndarray, fine: bool = False) -> np.ndarray:
    """Places of single spaces; with ``fine`` also of single line feeds, what follows them, and marks after a letter."""
    spaces = _lone(data, np.flatnonzero(data == 32))
    if not fine:
        return spaces
    feeds = _lone(data, np.flatnonzero(data == 10))
    marks = np.flatnonzero(_IS_MARK[data[1:]] & _IS_LETTER[data[:-1]]) + 1
    return np.sort(np.concatenate([spaces, feeds, feeds + 1, marks]), kind="stable")


def _layout(pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of strings that fill their buffer from its start, and the bounds of each."""
    bounds = np.frombuffer(pieces.buffers()[1], np.int32)[: len(pieces) + 1]
    return np.frombuffer(pieces.buffers()[2], np.uint8)[: bounds[-1]], bounds


def _sums(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two weighted sums of the bytes of every piece; of a long one, its first bytes."""
    sizes = np.minimum(np.diff(bounds), LONG_PIECE)
    ends = np.cumsum(sizes)
    place = np.arange(ends[-1]) - np.repeat(ends - sizes, sizes)
    own = data[np.repeat(bounds[:-1], sizes) + place].astype(np.uint64) + np.uint64(1)
    first, second = (np.add.reduceat(own * weights[place], ends - sizes) for weights in _WEIGHTS)
    return first, second


def _between_spaces(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Pieces that begin with a space, and go on and end with no white space: put side by side they stay apart."""
    starts, ends = bounds[:-1].astype(np.int64), bounds[1:].astype(np.int64)
    last = len(data) - 1
    ahead, then = data[np.minimum(starts + 1, last)], data[np.minimum(starts + 2, last)]
    one, two, three = (data[np.maximum(ends - k, 0)] for k in (1, 2, 3))
    spaced = _ascii_space(ahead) | _narrow_space(ahead, then) | _opens_wide_space(ahead, then)
    spaced |= _ascii_space(one) | _narrow_space(two, one) | _opens_wide_space(three, two)
    return (data[starts] == 32) & (ends - starts > 1) & ~spaced


class Known:
    """A vocabulary with the ids of the pieces met so far."""

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        added = self.tokenizer.get_added_tokens_decoder()
        self.fine = not any(byte in b"\n" + MARKS for token in added.values() for byte in token.content.encode())
        # a byte-level token has one character per byte; special strings stand for themselves
        self.widths = np.zeros(self.tokenizer.get_vocab_size(), np.int64)
        for token, i in self.tokenizer.get_vocab().items():
            self.widths[i] = len(token)
        for i, token in added.items():
            self.widths[i] = len(token.content.encode())
        self._forget()

    def _forget(self) -> None:
        self.first, self.second = (np.zeros(0, np.uint64) for _ in range(2))  # sums of the pieces, sorted by the first
        self.starts, self.lengths, self.ids = (np.zeros(0, np.int32) for _ in range(3))

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        coded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(c.ids, np.int32) for c in coded]

    def _joined(self, pieces: pa.Array) -> tuple[list[np.ndarray], np.ndarray]:
        """The ids of pieces that may stand next to each other, and the number of each one's ids.

        They are encoded many at a time; the bytes that tokens cover tell where one piece ends.
        """
        data, bounds = _layout(pieces)
        text, edges = data.tobytes(), [*bounds[:-1:JOINED].tolist(), int(bounds[-1])]
        coded = self._encode([text[lo:hi].decode() for lo, hi in zip(edges, edges[1:])])
        last = np.searchsorted(np.cumsum(self.widths[np.concatenate(coded)]), bounds[1:]) + 1
        return coded, np.diff(last, prepend=0)

    def look_up(self, pieces: pa.Array, remember: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, length) of the ids of each of some different pieces, and the ids they point into."""
        if len(self.first) > remember or len(self.ids) > KNOWN_IDS:
            self._forget()
        data, bounds = _layout(pieces)
        first, second = _sums(data, bounds)
        long = np.diff(bounds) > LONG_PIECE
        order = np.argsort(first)
        at = np.empty(len(first), np.int64)
        at[order] = np.searchsorted(self.first, first[order])
        met, clear = np.zeros(len(first), bool), np.ones(len(first), bool)
        inside = np.flatnonzero(at < len(self.first))
        same = inside[self.first[at[inside]] == first[inside]]
        met[same] = (self.second[at[same]] == second[same]) & ~long[same]
        clear[same] = False  # a first sum stands for one piece only; others that have it are not remembered
        clear[order[1:]] &= first[order[1:]] != first[order[:-1]]
        starts, lengths = (np.zeros(len(first), np.int32) for _ in range(2))
        starts[met], lengths[met] = self.starts[at[met]], self.lengths[at[met]]
        joins = _between_spaces(data, bounds)
        words, others, passing = (np.flatnonzero(~met & x) for x in (joins & ~long, ~joins & ~long, long))
        coded, sizes = self._joined(pieces.take(pa.array(words))) if len(words) else ([], np.zeros(0, np.int64))
        alone = self._encode(pieces.take(pa.array(np.concatenate([others, passing]))).to_pylist())
        new = np.concatenate([words, others, passing])
        lengths[new] = np.concatenate([sizes, np.array(list(map(len, alone)), np.int64)])
        starts[new] = len(self.ids) + np.cumsum(lengths[new]) - lengths[new]
        ids = np.concatenate([self.ids, *coded, *alone])
        kept = new[: len(new) - len(passing)]
        self.ids = ids[: len(self.ids) + int(lengths[kept].sum())] if len(passing) else ids
        kept = kept[clear[kept]]
        kept = kept[np.argsort(first[kept])]
        place = at[kept]
        for name, own in (("first", first), ("second", second), ("starts", starts), ("lengths", lengths)):
            setattr(self, name, np.insert(getattr(self, name), place, own[kept]))
        return starts, lengths, ids


def _known(vocabulary: str) -> Known:
    if vocabulary not in _processes:
        _processes[vocabulary] = Known(vocabulary)
    return _processes[vocabulary]


def slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Bounds of runs of rows of at most ``STEP`` bytes, a longer text by itself."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + STEP, "right")) - 1)
        yield lo, min(hi, len(texts))
        lo = hi


def encode(texts: pa.Array, vocabulary: str, remember: int = KNOWN_PIECES) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts of a slice (strings, null: empty) in one array, and the number of each text's ids.

    ``remember`` is the number of pieces above which those met so far are forgotten: memory against time.
    """
    if texts.null_count:
        texts = texts.fill_null("")
    bounds = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    lo, hi = int(bounds[0]), int(bounds[-1])
    if lo == hi:
        return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
    whole = texts.buffers()[2]
    known = _known(vocabulary)
    cuts = safe_cuts(np.frombuffer(whole, np.uint8)[lo:hi], known.fine).astype(np.int32) + np.int32(lo)
    edges = np.insert(cuts, np.searchsorted(cuts, bounds), bounds)
    edges = edges[np.concatenate([[True], edges[1:] != edges[:-1]])]  # no piece is empty
    pieces = pa.Array.from_buffers(pa.string(), len(edges) - 1, [None, pa.py_buffer(edges), whole])
    coded = pieces.dictionary_encode()
    starts, lengths, ids = known.look_up(coded.dictionary, remember)
    which = coded.indices.to_numpy(zero_copy_only=False)
    per_piece = lengths[which]
    ends = np.cumsum(per_piece, dtype=np.int32)
    at = np.repeat(starts[which] - (ends - per_piece), per_piece)
    at += np.arange(ends[-1], dtype=np.int32)
    before = np.concatenate([[0], ends])
    return ids[at].astype(np.uint32), np.diff(before[np.searchsorted(edges, bounds)]).astype(np.int64)
