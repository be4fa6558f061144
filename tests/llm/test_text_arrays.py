"""Hashes of words and of sequences of words."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from tallyhouse.llm.text_arrays import LONG, sequence_hash, words_of


def _words(*texts):
    (words,) = words_of(iter([pa.RecordBatch.from_pydict({"text": list(texts)})]))
    return words


def thue_morse(n: int, one: str, other: str) -> list[str]:
    return [other if bin(i).count("1") % 2 else one for i in range(n)]


def test_sequences_of_thue_and_morse_are_told_apart():
    for n in (1024, 2048, 4096):
        a, b = "".join(thue_morse(n, "a", "b")), "".join(thue_morse(n, "b", "a"))
        assert len(set(_words(f"{a} {b} {a}").hash.tolist())) == 2
        both = sequence_hash(_words(" ".join(thue_morse(n, "a", "b")), " ".join(thue_morse(n, "b", "a"))))
        assert both[0] != both[1]


def test_equal_words_have_equal_hashes_wherever_they_stand():
    for n in (1, 7, LONG - 1, LONG, LONG + 1, 5000):
        word = "xy" * n
        words = _words(f"a {word}", f"{word} {word}a", word)
        assert len({int(words.hash[i]) for i in (1, 2, 4)}) == 1 and words.hash[3] != words.hash[2]
    assert len(np.unique(_words(" ".join("q" * n for n in range(1, 600))).hash)) == 599
