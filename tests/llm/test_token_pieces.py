"""Findings of round three: a word is encoded once, whatever mark or line end stands behind it."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from racelake.llm import token_ids, token_store

VOCABULARY = public_tokenizers.path(token_store.VOCABULARY)
PARTS = [
    "Lorem", "ipsum", "it's", "I'll.", "x.y", "1,5", "naïve", "é", "日本語", "🙂", "<|endoftext|>", "a<|endoftext|>.", ".", ",", "...", "?!", "'", "'s.",
    " ", "  ", "\n", "\n\n", "\r\n", "\t", " ", "\u0085", " ", "　", "\x1c", "w" * 300, "word:" * 60, "end;\nNext", "a\nb\nc", "\nb",
]


@pytest.fixture(autouse=True)
def fresh():
    token_ids._processes.clear()
    yield
    token_ids._processes.clear()


def expected(texts):
    return [c.ids for c in token_ids._known(VOCABULARY).tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def found(texts, remember=token_ids.KNOWN_PIECES):
    ids, counts = token_ids.encode(pa.array(texts), VOCABULARY, remember)
    return [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]


def test_ids_of_random_texts_are_the_library_s():
    rng = random.Random(5)
    for remember in (token_ids.KNOWN_PIECES, 20):
        for _ in range(40):
            texts = ["".join(rng.choice(PARTS) + rng.choice(["", " ", "\n", ". "]) for _ in range(rng.randrange(60))) for _ in range(20)]
            assert found(texts, remember) == expected(texts)


def test_a_word_is_encoded_once_whatever_follows_it(monkeypatch):
    known, given = token_ids._known(VOCABULARY), []
    encode = known._encode
    monkeypatch.setattr(known, "_encode", lambda texts: given.extend(texts) or encode(texts))
    words = [f"wort{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(200)]
    for end in ("", ".", ",", "\n", ":\n", "?"):
        text = "".join(f" {w}{end}" if not end.endswith("\n") else f" {w}{end}Z" for w in words) + " last one"
        assert found([text]) == expected([text])
    assert sum(map(len, given)) < 2 * sum(len(w) + 1 for w in words)


def test_pieces_of_one_sum_are_told_apart(monkeypatch):
    first = np.zeros(token_ids.LONG_PIECE, np.uint64)  # every piece has the same first sum
    monkeypatch.setattr(token_ids, "_WEIGHTS", np.stack([first, token_ids._WEIGHTS[1]]))
    texts = ["one two three two one.", "four, two one", "one two"]
    for _ in range(3):
        assert found(texts) == expected(texts)
    assert len(token_ids._known(VOCABULARY).first) == 1
