"""Spelling variants: words one edit apart, found over a reduced alphabet.

Words are counted in the tasks that read the texts and then by word. Every letter is hashed to one of a few
symbols; a reduced word and its whole one-edit neighbourhood (itself, every deletion, replacement and
insertion of a symbol) meet the reduced vocabulary in a join by hash, and each pair that meets is verified on
the original words. Two words one edit apart have reduced words at most one edit apart, so no pair is lost;
hashes only add pairs that the verification drops. The alphabet grows as the seventh root of the vocabulary,
so that even the shortest reduced words stay about as many as the words. A bitmap of fixed size tells most
neighbours that no word has before they are shuffled.

Rows without a text have no words. A row without an id keeps its runs as they are. Repeated rows count as
often as they occur. Words of any length take part: hashes of a neighbourhood are built from prefix sums, a
block of positions at a time, never as strings.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.presence import maybe_present, presence_bitmap
from tallyhouse.llm.text_arrays import U, mix, release_memory
from tallyhouse.llm.work_tables import WorkTables

#: Words have at least so many letters and occurrences, and a form at least so many times their occurrences.
LEAST_LETTERS, LEAST_COUNT, FORM_FACTOR = 7, 2, 10
#: One distinct run of a document in so many, by checksum, loses a letter.
DROP_EVERY = 31
#: Distinct words, and bytes of them, that a task counts before it passes its counts on.
HELD_WORDS, HELD_BYTES = 400_000, 16 << 20
#: Letters of which the neighbourhoods are built at once, and letters of the words taken at once (a longer
#: word is taken alone).
BLOCK_LETTERS, TAKEN_LETTERS = 1 << 15, 1 << 15

_BASE = 0x9E3779B97F4A7C15
_INVERSE = U(pow(_BASE, -1, 1 << 64))


def _runs(least: int) -> re.Pattern:
    # A run is as long as it can be, so a shorter run has no match inside
    return re.compile(rf"[a-zÀ-ÿ]{{{least},}}")


def _counting(least: int):
    pattern = _runs(least)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        size = 0

        def passed_on() -> pa.RecordBatch:
            words = pa.array(held.keys(), pa.large_string())
            return pa.RecordBatch.from_arrays([words, pa.array(held.values(), pa.int64())], ["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                text = text.as_py()
                if not text:
                    continue
                start = None if doc_id is None else zlib.crc32(f"{doc_id}:".encode())
                for run, n in Counter(pattern.findall(text.encode().lower().decode())).items():
                    if start is not None:
                        check = zlib.crc32(run.encode(), start)
                        if check % DROP_EVERY == 0:
                            at = check % len(run)
                            run = run[:at] + run[at + 1 :]
                            if len(run) < least:
                                continue
                    if run not in held:
                        size += len(run)
                    held[run] += n
                if len(held) >= HELD_WORDS or size >= HELD_BYTES:
                    yield passed_on()
                    held.clear()
                    size = 0
        if held:
            yield passed_on()
        held.clear()
        release_memory()

    return count


def word_counts(documents: DataFrame, least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words of all texts that are long and frequent enough."""
    counted = documents.select("doc_id", "text").mapInArrow(_counting(least_letters), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def alphabet_size(vocabulary: int, least_letters: int = LEAST_LETTERS) -> int:
    """So many symbols that the shortest reduced words can be as many as the words."""
    return max(2, int(np.ceil(vocabulary ** (1 / least_letters))))


class _Letters:
    """Letters of several words as symbols from 1, with the hashes of all prefixes."""

    def __init__(self, words: pa.Array, symbols: int) -> None:
        text = "".join(words.to_pylist())
        points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
        self.symbol = mix(points.astype(U)) % U(symbols) + U(1)
        length = np.asarray(pc.utf8_length(words), dtype=np.int64)
        self.first = np.concatenate(([0], np.cumsum(length)))
        self.word = np.repeat(np.arange(len(length)), length)
        self.at = np.arange(len(points)) - self.first[self.word]
        self.power = np.full(int(length.max(initial=0)) + 2, _BASE, dtype=U)
        self.power[0] = 1
        np.cumprod(self.power, out=self.power)
        # Sums run over all words; a word's own prefix is a difference
        self.sums = np.concatenate((np.zeros(1, U), np.cumsum(self.symbol * self.power[self.at])))
        self.origin = self.sums[self.first[:-1]]
        self.whole = self.sums[self.first[1:]] - self.origin

    def neighbours(self, symbols: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(word, hash) of every neighbour, none twice where two edits give the same reduced word."""
        yield np.arange(len(self.whole)), self.whole
        for low in range(0, len(self.word), BLOCK_LETTERS):
            cut = slice(low, min(low + BLOCK_LETTERS, len(self.word)))
            word, at, symbol = self.word[cut], self.at[cut], self.symbol[cut]
            before = self.sums[cut.start : cut.stop] - self.origin[word]
            through = before + symbol * self.power[at]
            whole, power = self.whole[word], self.power[at]
            # Of equal neighbours in a row only the first goes, and a symbol is inserted only before another
            new = np.ones(len(word), dtype=bool)
            earlier = self.symbol[cut.start - 1 : cut.stop - 1] if cut.start else np.concatenate(([U(0)], symbol[:-1]))
            new[at > 0] = symbol[at > 0] != earlier[at > 0]
            yield word[new], (before + (whole - through) * _INVERSE)[new]
            for step in range(1, symbols):
                other = (symbol - U(1) + U(step)) % U(symbols) + U(1)
                yield word, whole + (other - symbol) * power
                yield word, before + other * power + (whole - before) * U(_BASE)
        last = self.first[1:] - self.first[:-1]
        for symbol in range(1, symbols + 1):
            yield np.arange(len(self.whole)), self.whole + U(symbol) * self.power[last]


def _taken(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows of a batch, a bounded number of letters at a time."""
    ends = np.cumsum(np.asarray(pc.utf8_length(batch.column("word")), dtype=np.int64))
    low = 0
    while low < batch.num_rows:
        done = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, done + TAKEN_LETTERS, "right")))
        yield batch.slice(low, high - low)
        low = high


def _reduced(symbols: int):
    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in (rows for batch in batches for rows in _taken(batch)):
            reduced = pa.array(mix(_Letters(rows.column("word"), symbols).whole).view(np.int64))
            yield pa.RecordBatch.from_arrays([reduced, rows.column("word"), rows.column("n")], ["reduced", "word", "n"])

    return reduce


def _neighbourhoods(symbols: int, present):
    """Of every word the neighbours that the bitmap does not rule out."""

    def generate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = present.value
        for rows in (rows for batch in batches for rows in _taken(batch)):
            found_word, found_hash = [], []
            for word, hashes in _Letters(rows.column("word"), symbols).neighbours(symbols):
                hashes = mix(hashes)
                maybe = maybe_present(bitmap, hashes)
                found_word.append(word[maybe])
                found_hash.append(hashes[maybe])
            word, hashes = np.concatenate(found_word), np.concatenate(found_hash)
            # A word names a hash once, so that a pair of words cannot meet twice
            order = np.lexsort((hashes, word))
            word, hashes = word[order], hashes[order]
            once = np.ones(len(word), dtype=bool)
            once[1:] = (word[1:] != word[:-1]) | (hashes[1:] != hashes[:-1])
            chosen = pa.array(word[once])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(hashes[once].view(np.int64)),
                    rows.column("word").cast(pa.large_string()).take(chosen),
                    rows.column("n").take(chosen),
                ],
                ["reduced", "word", "n"],
            )
        release_memory()

    return generate


def near_pairs(vocabulary: DataFrame, symbols: int | None = None) -> DataFrame:
    """(word, n, other, other_n) of all words exactly one edit apart, each pair from both sides."""
    symbols = symbols or alphabet_size(vocabulary.count())
    schema = "reduced long, word string, n long"
    reduced = vocabulary.mapInArrow(_reduced(symbols), schema)
    present = presence_bitmap(reduced, F.col("reduced"))
    near = vocabulary.mapInArrow(_neighbourhoods(symbols, present), schema)
    others = reduced.select("reduced", F.col("word").alias("other"), F.col("n").alias("other_n"))
    met = near.join(others, "reduced").where(F.col("word") != F.col("other"))
    return met.where(F.levenshtein("word", "other", 1) == 1).drop("reduced")


def _roots(forms: DataFrame, work: WorkTables) -> DataFrame:
    """(word, root): pointers doubled until no root has a form. Counts rise tenfold with each step, so the
    chains are short."""
    step = 0
    roots = work.keep(forms.select("word", F.col("form").alias("root")), "roots-0")
    while True:
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        joined = roots.join(onward, "root", "left")
        step += 1
        further = work.keep(joined.select("word", F.coalesce("further", "root").alias("root"), "further"), f"roots-{step}")
        work.drop(f"roots-{step - 1}")
        roots = further.select("word", "root")
        if further.where(F.col("further").isNotNull()).isEmpty():
            return roots


def spelling_variants(
    documents: DataFrame,
    least_letters: int = LEAST_LETTERS,
    least_count: int = LEAST_COUNT,
    form_factor: int = FORM_FACTOR,
    symbols: int | None = None,
) -> DataFrame:
    """Per word: its form (the most frequent word one edit away, where that is frequent enough), the root its
    forms lead to, its occurrences, the number of words one edit away and the form's occurrences.

    Ties go to the smaller word in code-point order. ``symbols`` fixes the size of the alphabet, which
    changes the work and not the result."""
    work = WorkTables(documents.sparkSession, "spelling")
    vocabulary = work.keep(word_counts(documents, least_letters, least_count), "vocabulary")
    pairs = near_pairs(vocabulary, symbols)
    best = F.min(F.struct((-F.col("other_n")).alias("order"), F.col("other").alias("form")))
    near = work.keep(
        pairs.groupBy("word", "n")
        .agg(F.count("*").alias("n_near"), best.alias("best"))
        .select("word", "n_near", "best.form", (-F.col("best.order")).alias("form_n"), "n"),
        "near",
    )
    enough = F.col("form_n") >= form_factor * F.col("n")
    near = near.select(
        "word",
        "n_near",
        F.when(enough, F.col("form")).alias("form"),
        F.when(enough, F.col("form_n")).alias("form_n"),
    )
    roots = _roots(near.where(F.col("form").isNotNull()), work)
    return (
        vocabulary.join(near, "word", "left")
        .join(roots, "word", "left")
        .select(
            "word",
            "form",
            F.coalesce("root", "word").alias("root"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            "form_n",
        )
    )
