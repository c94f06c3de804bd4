"""Plain versions of the operators, on Python rows; slow and simple."""

import base64
import hashlib
import math
import re
import zlib
from collections import defaultdict

import public_tokenizers
import tiktoken


def sha(text) -> str:
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def private_spans(text):
    """Contract 1: (kind, start, end) by kind, then start."""
    text = text or ""
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        if 13 <= len(digits(m.group())) <= 19 and luhn(digits(m.group())):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(digits(m.group())) <= 15:
            out.append(("phone", *m.span()))
    return out


def repeated_bytes(docs, width=50):
    """Contract 2: {doc_id: flags of removed bytes}; docs is a list of (doc_id, bytes)."""
    first = {}
    for doc, data in sorted(docs):
        for i in range(len(data) - width + 1):
            first.setdefault(data[i : i + width], doc)
    out = []
    for doc, data in docs:
        gone = [False] * len(data)
        for i in range(len(data) - width + 1):
            if first[data[i : i + width]] < doc:
                gone[i : i + width] = [True] * width
        out.append((doc, data, gone))
    return out


def removal_row(doc, data, gone):
    spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
    return (doc, len(data), sum(gone), spans, sha(bytes(b for b, g in zip(data, gone) if not g)))


def secret_spans(text):
    """Contract 4, base rules: (kind, start, end) by start, then kind."""
    text, found = text or "", []
    assign = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    found += [(m.start(), 0, m.end()) for m in re.finditer(assign, text, re.I | re.A) if len(m.group(2)) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 16]
    return [(("assign", "access", "hex")[k], s, e) for s, k, e in sorted(found)]


def tiktoken_encoding():
    lines = open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def encoded_row(coder, doc, text):
    ids = coder.encode_ordinary(text or "")
    return (doc, len(ids), sha(",".join(map(str, ids))), sha((text or "").encode()))


def stored_rows(docs, vocabulary):
    """Contract 3: (doc_id, start, n_tokens, crc) in ascending doc_id order."""
    import numpy as np
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary)
    at, out = 0, []
    for doc, text in sorted(docs, key=lambda d: (d[0], d[1] or "")):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((doc, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def lowered(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered(text))
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def jaccard_components(docs, k=4, percent=85):
    """Contract 8: {doc_id: (n_shingles, component_id)} by comparing all pairs."""
    sets = {d: shingles(t, k) for d, t in docs}
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                a_root, b_root = sorted((root(a), root(b)))
                parent[b_root] = a_root
    return {d: (len(s), root(d)) for d, s in sets.items()}


def item_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))


def contamination(docs, items, width=10):
    """Contract 9: (doc_id, n_words, n_hit, n_items, digest, contaminated)."""
    windows = defaultdict(set)
    for item, text in items:
        words = item_words(text)
        for i in range(max(1, len(words) - width + 1) if words else 0):
            windows[tuple(words[i : i + width])].add(item)
    sizes = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        words, hit, named = item_words(text), set(), set()
        for n in sizes:
            for i in range(len(words) - n + 1):
                if found := windows.get(tuple(words[i : i + n])):
                    hit.update(range(i, i + n))
                    named |= found
        names = ",".join(sorted(map(str, named)))
        out.append((doc, len(words), len(hit), len(named), sha(names), bool(hit)))
    return out


def nearest(rows, queries, k=10):
    """Contract 10: (query_id, rank, vec_id, score); rows are (vec_id, list)."""
    kept = [
        (v, [math.floor(1024 * x) for x in e])
        for v, e in rows
        if e is not None and all(x is not None and math.isfinite(x) for x in e)
    ]
    out = []
    for q, x in kept:
        if queries(q):
            scored = sorted((-sum(a * b for a, b in zip(x, y)), v) for v, y in kept if v != q)[:k]
            out += [(q, rank, v, -s) for rank, (s, v) in enumerate(scored, 1)]
    return out
