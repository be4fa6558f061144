from __future__ import annotations

import json
import random

import cases
import numpy as np
import pytest

from tallyhouse.llm import wordpiece
from tallyhouse.llm.packing import byte_letters
from tallyhouse.llm.queries import tokenizer_file
from tallyhouse.llm.wordpiece import Automaton, automaton, token_counts


def greedy(word: bytes, initial, continuing) -> int:
    at, pieces = 0, 0
    while at < len(word):
        known = continuing if at else initial
        size = next((n for n in range(len(word) - at, 0, -1) if word[at : at + n] in known), 0)
        if not size:
            return 0
        at, pieces = at + size, pieces + 1
    return pieces


@pytest.mark.parametrize("seed", range(5))
def test_automaton_equals_greedy_search(monkeypatch, seed):
    monkeypatch.setattr(wordpiece, "LONG_WORD", 20)
    draw = random.Random(seed)
    word = lambda most: bytes(draw.choice(b"abc") for _ in range(draw.randrange(1, most)))
    initial, continuing = {word(6) for _ in range(20)}, {word(7) for _ in range(25)}
    words = [word(30) for _ in range(400)]
    matcher = Automaton(initial, continuing)
    data = np.frombuffer(b"".join(words), dtype=np.uint8)
    end = np.cumsum([len(w) for w in words])
    got = matcher.counts(data, end - [len(w) for w in words], end)
    assert got.tolist() == [greedy(w, initial, continuing) for w in words]
    assert [matcher.count(w) for w in words] == got.tolist()


def whole_vocabulary(path):
    """Pieces that start words and pieces that go on, straight from the file."""
    with open(path, encoding="utf-8") as file:
        pieces = json.load(file)["model"]["vocab"]
    byte_of = {letter: byte for byte, letter in byte_letters().items()}
    blank = byte_letters()[0x20]
    known = [p for p in pieces if all(c in byte_of for c in p)]
    initial = {bytes(byte_of[c] for c in p[1:]) for p in known if p[0] == blank}
    return initial, {bytes(byte_of[c] for c in p) for p in known if p[0] != blank}


def greedy_from_the_blank(word: bytes, initial, continuing) -> int:
    """Greedy pieces of a word behind a blank; the piece of the blank alone takes no byte of the word."""
    size = next((n for n in range(len(word), -1, -1) if word[:n] in initial), None)
    if size is None:
        return 0
    rest = greedy(word[size:], continuing, continuing)
    return 1 + rest if rest or size == len(word) else 0


def test_counts_of_documents(spark):
    """Against greedy search over the whole vocabulary, word by word."""
    path = tokenizer_file("byte_bpe_50k.json")
    rows = cases.documents(6, 30)
    got = token_counts(cases.frame(spark, rows), path).collect()
    pieces = whole_vocabulary(path)
    want = []
    for r in rows:
        counts = [greedy_from_the_blank(w.encode(), *pieces) for w in cases.words(r[1])]
        want.append((r[0], len(counts), sum(max(c, 1) for c in counts), counts.count(0)))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert token_counts(cases.empty(spark), path).count() == 0


def test_a_vocabulary_of_another_kind_is_refused():
    with pytest.raises(ValueError, match="no vocabulary of bytes"):
        automaton(tokenizer_file("word_bpe_49k.json"))


@pytest.mark.parametrize("seed", range(3))
def test_initial_piece_of_no_bytes(monkeypatch, seed):
    monkeypatch.setattr(wordpiece, "LONG_WORD", 20)
    draw = random.Random(seed)
    word = lambda most: bytes(draw.choice(b"abc") for _ in range(draw.randrange(1, most)))
    initial, continuing = {word(6) for _ in range(8)} | {b""}, {word(7) for _ in range(15)} | {b"a"}
    words = [word(30) for _ in range(400)]
    matcher = Automaton(initial, continuing)
    data = np.frombuffer(b"".join(words), dtype=np.uint8)
    end = np.cumsum([len(w) for w in words])
    got = matcher.counts(data, end - [len(w) for w in words], end)
    whole = [greedy_with_blank(w, {b" " + p for p in initial} | continuing) for w in words]
    assert got.tolist() == whole and any(whole)
    assert [matcher.count(w) for w in words] == whole


def greedy_with_blank(word: bytes, pieces) -> int:
    """Longest matches over all pieces, of the word with the blank before it."""
    word, at, n = b" " + word, 0, 0
    longest = max(map(len, pieces))
    while at < len(word):
        size = next((k for k in range(min(longest, len(word) - at), 0, -1) if word[at : at + k] in pieces), 0)
        if not size:
            return 0
        at, n = at + size, n + 1
    return n


def test_scripts_without_blanks_equal_greedy_search_over_the_vocabulary(spark):
    path = tokenizer_file("byte_bpe_50k.json")
    with open(path, encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    byte_of = {letter: byte for byte, letter in byte_letters().items()}
    pieces = {bytes(byte_of[c] for c in p) for p in vocabulary if all(c in byte_of for c in p)}
    thai, chinese, korean = "ภาษาไทยไม่มีช่องว่าง", "中文没有空格所以一段是一个词", "한국어"
    texts = [thai, chinese, korean, f"{thai} and {chinese} 1", chinese * 40, "বাংলা தமிழ்"]
    rows = [(i, t, None, None, 0, 0, "") for i, t in enumerate(texts)]
    want = {}
    for i, text in enumerate(texts):
        counts = [greedy_with_blank(w.encode(), pieces) for w in cases.words(text)]
        want[i] = (len(counts), sum(max(c, 1) for c in counts), counts.count(0))
    got = token_counts(cases.frame(spark, rows), path).collect()
    assert {r.doc_id: (r.n_words, r.n_tokens, r.n_unknown) for r in got} == want
    assert all(unknown == 0 for _, _, unknown in want.values())
