"""Token counts by a linear longest-match automaton.

Greedy word-piece tokenization takes the longest piece that starts a word, then the longest continuation
piece, and so on. The automaton does it in one pass over a word: a trie of the pieces, and for every node a
failure link to where matching goes on once the next byte has no edge, with the number of pieces that are
then complete. Pieces themselves are never built. A word that has no such split is one unknown token.
The blank before a word may be a piece of its own: an initial piece of no bytes, taken where no longer one fits.

Distinct words of a chunk of texts run through the automaton side by side, one byte a step, and their counts
are spread to all their occurrences. Words are runs without white space (`[^\\x20\\x09-\\x0D]+`), matched as
UTF-8 bytes.

Null and empty texts have no words and no tokens. Rows are counted each on its own, repeated or not; an empty
table gives no rows; further columns are ignored. The length of a word is not limited.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallyhouse.llm.packing import byte_letters
from tallyhouse.llm.text_arrays import Words, words_of
from tallyhouse.llm.work_tables import reach_workers

NOTHING = -1
#: Stands for the end of a word; no piece has it, as it is no byte of UTF-8.
END = 0xFF
#: Longer words run through the automaton one by one.
LONG_WORD = 256


class Automaton:
    """initial: pieces that start a word, that of no bytes among them if a word may start with a continuing
    one; continuing: pieces further inside. Both as bytes."""

    def __init__(self, initial: set[bytes], continuing: set[bytes]) -> None:
        # Nodes 0 and 1: the start of a word, and the place behind a piece
        edges: dict[int, int] = {}
        ends: list[bool] = [False, False]
        parent, label = [NOTHING, NOTHING], [0, 0]
        for root, pieces in ((0, initial), (1, continuing)):
            for piece in sorted(pieces):
                node = root
                for byte in piece:
                    key = node << 8 | byte
                    if key not in edges:
                        edges[key] = len(ends)
                        ends.append(False)
                        parent.append(node)
                        label.append(byte)
                    node = edges[key]
                ends[node] = ends[node] or node > 1
        depth = [0] * len(ends)
        for node in range(2, len(ends)):
            depth[node] = depth[parent[node]] + 1
        link, popped = [NOTHING] * len(ends), [0] * len(ends)
        if b"" in initial:
            link[0], popped[0] = 1, 1
        for node in sorted(range(2, len(ends)), key=depth.__getitem__):
            if ends[node]:
                link[node], popped[node] = 1, 1
                continue
            at, pieces = link[parent[node]], popped[parent[node]]
            while at != NOTHING and (at << 8 | label[node]) not in edges:
                pieces += popped[at]
                at = link[at]
            if at != NOTHING:
                link[node], popped[node] = edges[at << 8 | label[node]], pieces
        self.edges, self.link, self.popped = edges, np.array(link), np.array(popped)
        self.size = 1 << (2 * len(edges)).bit_length()
        self.keys = np.full(self.size, NOTHING, dtype=np.int64)
        self.targets = np.full(self.size, NOTHING, dtype=np.int64)
        for key, target in edges.items():
            slot = self._slot(key)
            while self.keys[slot] != NOTHING:
                slot = (slot + 1) % self.size
            self.keys[slot], self.targets[slot] = key, target

    def _slot(self, key):
        return (key * 0x9E3779B1 >> 12) % self.size

    def _step(self, nodes: np.ndarray, bytes_: np.ndarray) -> np.ndarray:
        """Where the edges lead; NOTHING where there is none."""
        wanted = nodes << 8 | bytes_
        slots = self._slot(wanted)
        found = np.where(self.keys[slots] == wanted, self.targets[slots], NOTHING)
        open_ = np.flatnonzero((self.keys[slots] != wanted) & (self.keys[slots] != NOTHING))
        while len(open_):
            slots[open_] = (slots[open_] + 1) % self.size
            keys = self.keys[slots[open_]]
            hit = keys == wanted[open_]
            found[open_[hit]] = self.targets[slots[open_[hit]]]
            open_ = open_[~hit & (keys != NOTHING)]
        return found

    def count(self, word: bytes) -> int:
        """Pieces of one word; 0 if it has no split."""
        node, pieces = 0, 0
        for byte in (*word, END):
            while (node << 8 | byte) not in self.edges:
                if byte == END and node == 1:
                    return pieces
                if self.link[node] == NOTHING:
                    return 0
                pieces += int(self.popped[node])
                node = int(self.link[node])
            node = self.edges[node << 8 | byte]
        raise AssertionError("the end of a word has no edge")

    def counts(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Pieces of many words at once; 0 for those without a split."""
        pieces = np.zeros(len(start), dtype=np.int64)
        word = np.flatnonzero(end - start <= LONG_WORD)
        for at in np.flatnonzero(end - start > LONG_WORD):
            pieces[at] = self.count(data[start[at] : end[at]].tobytes())
        data = np.append(data, np.uint8(END))
        node, place = np.zeros(len(word), dtype=np.int64), start[word]
        while len(word):
            over = place >= end[word]
            byte = np.where(over, END, data[np.minimum(place, len(data) - 1)]).astype(np.int64)
            to = self._step(node, byte)
            fails = to == NOTHING
            place = place + ~fails
            at = node[fails]
            pieces[word[fails]] += self.popped[at]
            link = self.link[at]
            to[fails] = link
            stuck = link == NOTHING
            lost = np.flatnonzero(fails)[stuck]
            pieces[word[lost[~(over[lost] & (node[lost] == 1))]]] = 0
            go = np.ones(len(word), dtype=bool)
            go[lost] = False
            word, node, place = word[go], to[go], place[go]
        return pieces


@lru_cache(maxsize=2)
def automaton(path: str) -> Automaton:
    """From a byte-level vocabulary file: pieces behind a blank, and the blank alone, start words; all others
    continue them."""
    with open(path, encoding="utf-8") as file:
        described = json.load(file)
    if (described.get("pre_tokenizer") or {}).get("type") != "ByteLevel" or described.get("normalizer"):
        raise ValueError(f"{path} is no vocabulary of bytes whose words begin with a blank")
    vocabulary = described["model"]["vocab"]
    byte_of = {letter: byte for byte, letter in byte_letters().items()}
    blank = byte_letters()[0x20]
    initial, continuing = set(), set()
    for piece in vocabulary:
        if all(c in byte_of for c in piece):
            starts = piece.startswith(blank)
            encoded = bytes(byte_of[c] for c in piece[starts:])
            if (encoded or starts) and END not in encoded:
                (initial if starts else continuing).add(encoded)
    return Automaton(initial, continuing)


def chunk_counts(words: Words, matcher: Automaton) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, tokens and unknown words of each text."""
    _, one, of = np.unique(words.hash, return_index=True, return_inverse=True)
    pieces = matcher.counts(words.data, words.start[one], words.end[one])[of.reshape(-1)]
    sums = np.append(0, np.cumsum(np.maximum(pieces, 1)))
    unknown = np.append(0, np.cumsum(pieces == 0))
    return np.diff(words.first), np.diff(sums[words.first]), np.diff(unknown[words.first])


def token_counts(documents: DataFrame, vocabulary_path: str) -> DataFrame:
    """doc_id, n_words, n_tokens and n_unknown (words that are one unknown token) of every row."""
    reach_workers(documents.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = automaton(vocabulary_path)
        for words in words_of(batches):
            arrays = [pa.array(c, pa.int64()) for c in chunk_counts(words, matcher)]
            yield pa.RecordBatch.from_arrays(
                [words.rows.column("doc_id"), *arrays],
                names=["doc_id", "n_words", "n_tokens", "n_unknown"],
            )

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(
        count, f"doc_id {kind}, n_words long, n_tokens long, n_unknown long"
    )
