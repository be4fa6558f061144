"""Best-fit packing planned on the histogram of lengths.

Documents are tokenized where they lie and cut into pieces of at most `capacity` tokens; only lengths and
checksums leave the task. The plan never sees a document: it is made from the number of pieces of each
length, at most `capacity` numbers. Best fit goes from the longest length to the shortest and moves whole
groups of equal sequences at once: all that have the smallest sufficient room take one piece each. A step of
the plan reads "pieces `first` to `last` of this length go to the sequences from `sequence` on, at this
offset". Pieces are numbered within their length and take their slots by a join on that number.

The numbering is spread: pieces of a length are dealt over parts by a digest, counted there, and numbered
from the sum of the parts before, so a length that a third of all pieces share is no single task.

A null text counts as empty and gives one piece holding the end token. Repeated rows and repeated ids are
packed each on their own. An empty table gives no rows. Further columns are ignored.
"""

from __future__ import annotations

import bisect
import math
import re
import string
import unicodedata
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.work_tables import WorkTables

#: Control characters that str.split() takes for blanks and the tokenizer does not.
CONTROLS = re.compile("[\x1c-\x1f]")
BLANKS = re.compile("[ \t\n\r]+")
#: Words, and parts of words, that a worker remembers; beyond it the memory starts anew.
WORDS, PARTS = 100_000, 250_000
#: Texts by which a worker sees whether a tokenizer gives the same ids word by word.
PROBES = ("Hello World again", "don't STOP, it's 10.5% \u00c9t\u00e9!?", "a  b\tc\n\nd", "x_y--z (q) \u4e2d\u6587 e\u0301")
#: Punctuation that the tokenizer splits off as one run behind letters; an apostrophe may start an ending.
TAIL = "".join(c for c in string.punctuation if c != "'")

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: itself where it prints."""
    prints = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return {b: chr(b if b in prints else next(others)) for b in range(256)}


class WordIds(dict):
    """Ids of blank-free words, as bytes of little-endian 32-bit numbers, tokenized once and remembered.

    Words of letters and punctuation behind them are looked up by part and go to the tokenizer's model
    directly; all others go through the whole tokenizer. That holds for tokenizers that lower-case and drop
    blanks; for one that gives other ids for PROBES, every text goes through the whole tokenizer at once.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.parts: dict[str, bytes] = {}
        self.letters = byte_letters()
        self.by_word = all(self._of_words(text) == self._of_whole(text) for text in PROBES)

    def part(self, text: str) -> bytes:
        found = self.parts.get(text)
        if found is None:
            if len(self.parts) >= PARTS:
                self.parts.clear()
            shown = text if text.isascii() else "".join(map(self.letters.__getitem__, text.encode()))
            ids = array("I", [t.id for t in self.tokenizer.model.tokenize(shown)])
            found = self.parts[text] = ids.tobytes()
        return found

    def __missing__(self, word: str) -> bytes:
        if len(self) >= WORDS:
            self.clear()
        bare = word.rstrip(TAIL)
        core = bare.lower()
        if core.isalpha() and "\u03a3" not in bare and unicodedata.is_normalized("NFC", bare):
            ids = self.part(core)
            if len(bare) < len(word):
                ids += self.part(word[len(bare) :])
        else:
            ids = self._of_whole(word)
        self[word] = ids
        return ids

    def of_text(self, text: str) -> bytes:
        return self._of_words(text) if self.by_word else self._of_whole(text)

    def _of_whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _of_words(self, text: str) -> bytes:
        words = BLANKS.split(text) if CONTROLS.search(text) else text.split()
        return b"".join(map(self.__getitem__, words))


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    """One for each worker process; it outlives a task."""
    return WordIds(path)


def pieces_of(documents: DataFrame, tokenizer_path: str, capacity: int, end_id: int) -> DataFrame:
    """doc_id, piece, start, length and checksum of every piece."""
    end = array("I", [end_id]).tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = word_ids(tokenizer_path)
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                rows = []
                for doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text")), strict=True):
                    ids = known.of_text(text or "") + end
                    for piece, start in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[start : start + 4 * capacity]
                        rows.append((doc_id, piece, start // 4, len(part) // 4, zlib.crc32(part)))
                columns = list(zip(*rows, strict=True)) or [()] * 5
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return documents.select("doc_id", "text").mapInArrow(cut, _PIECES)


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Steps (length, first, last, sequence, offset); first and last number pieces within the length."""
    steps: list[tuple[int, int, int, int, int]] = []
    groups: dict[int, list[tuple[int, int]]] = {}  # room left: groups of sequences (first, number)
    rooms: list[int] = []  # sorted, those with groups
    made = 0

    def put(room: int, group: tuple[int, int]) -> None:
        if room:
            if room not in groups:
                bisect.insort(rooms, room)
                groups[room] = []
            groups[room].append(group)

    for length in sorted(counts, reverse=True):
        first, left = 0, counts[length]
        while left:
            at = bisect.bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                sequence, number = groups[room].pop()
                if not groups[room]:
                    del groups[room], rooms[at]
                if number > left:
                    put(room, (sequence + left, number - left))
                    number = left
            else:
                # As many new sequences as this length fills by itself
                room, sequence = capacity, made
                number = math.ceil(left / (capacity // length))
                made += number
            steps.append((length, first, first + number - 1, sequence, capacity - room))
            put(room - length, (sequence, number))
            first, left = first + number, left - number
    return steps


def pack(
    documents: DataFrame,
    tokenizer_path: str,
    *,
    capacity: int = 2048,
    end_id: int = 0,
    pieces_per_part: int = 2048,
) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id and offset in the sequence."""
    spark = documents.sparkSession
    work = WorkTables(spark, "packing")
    pieces = work.keep(pieces_of(documents, tokenizer_path, capacity, end_id), "pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    steps = spark.createDataFrame(
        plan(counts, capacity), "length long, first long, last long, sequence long, offset long"
    )
    n_parts = max(1, math.ceil(max(counts.values(), default=0) / pieces_per_part))
    dealt = pieces.withColumn(
        "part", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(n_parts))
    )
    before = (
        dealt.groupBy("length", "part")
        .agg(F.count("*").alias("n"))
        .withColumn(
            "before",
            F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n"),
        )
        .drop("n")
    )
    within = Window.partitionBy("length", "part").orderBy("doc_id", "piece")
    numbered = (
        dealt.withColumn("at", F.row_number().over(within))
        .join(before, ["length", "part"])
        .withColumn("at", F.col("before") + F.col("at") - 1)
    )
    return numbered.join(
        steps.withColumnRenamed("length", "planned"),
        (F.col("length") == F.col("planned")) & F.col("at").between(F.col("first"), F.col("last")),
    ).select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("sequence") + F.col("at") - F.col("first")).alias("sequence_id"),
        "offset",
    )
