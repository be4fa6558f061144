"""Exact duplicates: a Golomb-coded exchange of fingerprints, then a comparison of bytes.

Texts are equal when they agree without the characters `[\\x20\\x09-\\x0D]`. Of equal texts the row with the most
code points stays, then the one with the smallest id (null last), then the first in the table of blocks.

Tasks that read documents write blocks of rows: id, length and SHA-256 of each, in the order of the digests.
A block sends every owner (a range of fingerprints, the leading bits of the digests) its distinct fingerprints
as one Golomb-coded list, and gets a bitmap back that tells which of them another block sent too. A hot text is
one entry of a block, however often the block has it. Fingerprints have a few bits more than the number of
rows needs, so almost all texts that occur once leave here. The texts of the others are read again, collapsed
in the tasks that read them, shuffled, and compared byte by byte; two texts with one digest would end the job
with an error instead of counting as equal. Blocks get the size and the row that stays of their groups back,
one entry per group.

A null text is an empty one. Empty texts equal each other. Every row counts, repeated rows too; exactly one of a
group is kept. Rows without an id have a null keep_id only where no row of their group has one that comes first.
Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.presence import maybe_present, presence_bitmap
from tallyhouse.llm.text_arrays import U, release_memory
from tallyhouse.llm.work_tables import WorkTables

BLANKS = b" \t\n\x0b\x0c\r"
#: Rows of a block, rows whose fingerprints one owner compares, and bits of a fingerprint beyond those that
#: number the rows (one text in 2**SLACK_BITS is suspected wrongly).
BLOCK_ROWS, OWNER_ROWS, SLACK_BITS = 1 << 16, 1 << 20, 8
#: Bytes of texts among which a task looks for equal ones before it passes them on.
HELD_BYTES = 16 << 20

_BLOCK = "block string, doc_ids array<long>, n_chars array<long>, digests binary"


def _texts(batch: pa.RecordBatch) -> Iterator[bytes]:
    for text in batch.column("text").cast(pa.large_binary()):
        yield (text.as_py() or b"").translate(None, BLANKS)


def _digest_order(digests: np.ndarray) -> np.ndarray:
    """Order of rows of four 64-bit numbers each."""
    return np.lexsort(digests.T[::-1])


def _digests(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, dtype=">u8").astype(U).reshape(-1, 4)


def _new(rows: np.ndarray) -> np.ndarray:
    """Of sorted rows those that differ from the one before."""
    new = np.ones(len(rows), dtype=bool)
    differs = rows[1:] != rows[:-1]
    new[1:] = differs.any(axis=1) if differs.ndim > 1 else differs
    return new


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of rows, named at random once: later passes read the names from the written table."""
    held: list[tuple] = []

    def block() -> pa.RecordBatch:
        digests = _digests(b"".join(row[2] for row in held))
        order = _digest_order(digests)
        columns = [
            [uuid.uuid4().hex],
            [[held[i][0] for i in order]],
            [[held[i][1] for i in order]],
            [b"".join(held[i][2] for i in order)],
        ]
        kinds = [pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
        names = ["block", "doc_ids", "n_chars", "digests"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    for batch in batches:
        lengths = pc.fill_null(pc.utf8_length(batch.column("text")), 0).to_pylist()
        for doc_id, length, text in zip(batch.column("doc_id").to_pylist(), lengths, _texts(batch)):
            held.append((doc_id, length, hashlib.sha256(text).digest()))
            if len(held) == BLOCK_ROWS:
                yield block()
                held.clear()
        release_memory()
    if held:
        yield block()


def golomb_encode(values: np.ndarray, universe: int) -> tuple[int, bytes, bytes]:
    """Sorted distinct numbers below universe: the bits of a remainder, the quotients in unary and the
    remainders of the gaps between them."""
    n = len(values)
    width = max(0, int(math.log2(max(1, universe // max(n, 1)))))
    gaps = np.diff(values, prepend=U(0)).astype(np.int64)
    gaps[1:] -= 1
    ends = np.cumsum((gaps >> width) + 1) - 1
    unary = np.zeros(int(ends[-1]) + 1 if n else 0, dtype=np.uint8)
    unary[ends] = 1
    rest = (gaps[:, None] >> np.arange(width)) & 1
    return width, np.packbits(unary).tobytes(), np.packbits(rest.astype(np.uint8)).tobytes()


def golomb_decode(n: int, width: int, quotients: bytes, remainders: bytes) -> np.ndarray:
    ends = np.flatnonzero(np.unpackbits(np.frombuffer(quotients, np.uint8)))[:n]
    bits = np.unpackbits(np.frombuffer(remainders, np.uint8))[: n * width].reshape(n, width)
    gaps = ((np.diff(ends, prepend=-1) - 1) << width) + bits.astype(np.int64) @ (1 << np.arange(width))
    return (np.cumsum(gaps) + np.arange(n)).astype(U)


def _prints(digests: np.ndarray, bits: int) -> np.ndarray:
    return digests[:, 0] >> U(64 - bits)


def _send(bits: int, owner_bits: int):
    """The lists of a block's distinct fingerprints, one for each owner."""
    below = bits - owner_bits

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, digests in zip(batch.column("block"), batch.column("digests")):
                prints = np.unique(_prints(_digests(digests.as_py()), bits))
                owners = prints >> U(below)
                starts = np.flatnonzero(_new(owners))
                lists = [prints[a:b] & U((1 << below) - 1) for a, b in zip(starts, [*starts[1:], len(prints)])]
                coded = [golomb_encode(values, 1 << below) for values in lists]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(owners[starts].astype(np.int64)),
                        pa.array([block.as_py()] * len(lists)),
                        pa.array([len(values) for values in lists], pa.int32()),
                        *(pa.array(part, kind) for part, kind in zip(zip(*coded), [pa.int32(), pa.binary(), pa.binary()])),
                    ],
                    ["owner", "block", "n", "width", "quotients", "remainders"],
                )

    return send


def _reply(messages: pa.Table) -> pa.Table:
    """To each block the bitmap of its fingerprints that other blocks sent too."""
    rows = messages.select(["n", "width", "quotients", "remainders"]).to_pylist()
    lists = [golomb_decode(**row) for row in rows]
    prints = np.concatenate(lists)
    order = np.argsort(prints, kind="stable")
    same = prints[order][1:] == prints[order][:-1]
    shared = np.zeros(len(prints), dtype=bool)
    shared[order[1:]] |= same
    shared[order[:-1]] |= same
    ends = np.cumsum([len(values) for values in lists])
    bitmaps = [np.packbits(shared[end - len(values) : end]).tobytes() for values, end in zip(lists, ends)]
    columns = [messages.column("block"), messages.column("owner"), messages.column("n"), pa.array(bitmaps, pa.binary())]
    return pa.Table.from_arrays(columns, ["block", "owner", "n", "bitmap"])


def _mark(bits: int):
    """Blocks with the bitmap of their rows whose fingerprint another row has, here or elsewhere."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = []
            for digests, replies in zip(batch.column("digests"), batch.column("replies")):
                new = _new(_prints(_digests(digests.as_py()), bits))
                replies = sorted(replies.as_py(), key=lambda reply: reply["owner"])
                elsewhere = np.concatenate(
                    [np.unpackbits(np.frombuffer(r["bitmap"], np.uint8))[: r["n"]].astype(bool) for r in replies]
                )
                place = np.cumsum(new) - 1
                marks.append(np.packbits((elsewhere | (np.bincount(place) > 1))[place]).tobytes())
            kept = batch.select(["block", "doc_ids", "n_chars", "digests"])
            yield kept.append_column("suspects", pa.array(marks, pa.binary()))

    return mark


def _groups_of(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A block's suspect rows, where each run of equal digests among them starts, and all digests."""
    digests = _digests(row["digests"])
    suspects = np.flatnonzero(np.unpackbits(np.frombuffer(row["suspects"], np.uint8))[: len(digests)])
    return suspects, np.flatnonzero(_new(digests[suspects])), digests


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One entry of a block per suspect digest: its rows and the one of them that would stay."""
    names = ["block", "digest", "n", "n_chars", "doc_id", "at"]
    kinds = [pa.string(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    for batch in batches:
        for row in (row for i in range(batch.num_rows) for row in batch.slice(i, 1).to_pylist()):
            suspects, starts, _ = _groups_of(row)
            found = []
            for a, b in zip(starts, [*starts[1:], len(suspects)]):
                ids, chars, members = row["doc_ids"], row["n_chars"], suspects[a:b]
                at = min(members, key=lambda i: (-chars[i], ids[i] is None, ids[i] or 0, i))
                found.append((row["block"], row["digests"][32 * at : 32 * at + 32], b - a, chars[at], ids[at], at))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds)], names)


def _collapsed(wanted):
    """Texts that may be suspects, each once for a bounded amount of texts read."""

    def collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, list[bytes]] = {}
        size = 0

        def passed_on() -> pa.RecordBatch:
            pairs = [(digest, text) for digest, texts in held.items() for text in texts]
            columns = [pa.array(part, kind) for part, kind in zip(zip(*pairs), [pa.binary(), pa.large_binary()])]
            return pa.RecordBatch.from_arrays(columns, ["digest", "norm"])

        for batch in batches:
            for text in _texts(batch):
                digest = hashlib.sha256(text).digest()
                if not maybe_present(wanted.value, _digests(digest)[:, 0])[0]:
                    continue
                same = held.setdefault(digest, [])
                if text not in same:
                    same.append(text)
                    size += len(text) + 64
                    if size >= HELD_BYTES:
                        yield passed_on()
                        held.clear()
                        size = 0
            release_memory()
        if held:
            yield passed_on()

    return collapse


def _result(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All rows of the blocks with what their groups came to."""
    for batch in batches:
        for row in (row for i in range(batch.num_rows) for row in batch.slice(i, 1).to_pylist()):
            suspects, starts, digests = _groups_of(row)
            keep_id, size, kept = list(row["doc_ids"]), np.ones(len(digests), np.int64), np.ones(len(digests), bool)
            verdicts = sorted(row["verdicts"] or [], key=lambda verdict: verdict["digest"])
            if len(verdicts) != len(starts):
                raise ValueError(f"block {row['block']} has {len(starts)} groups, but {len(verdicts)} answers")
            for verdict, a, b in zip(verdicts, starts, [*starts[1:], len(suspects)]):
                for at in suspects[a:b]:
                    keep_id[at], size[at] = verdict["keep_id"], verdict["size"]
                    kept[at] = verdict["keep_block"] == row["block"] and verdict["keep_at"] == at
            blob = row["digests"].hex()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(keep_id, pa.int64()),
                    pa.array(size),
                    pa.array(kept),
                    pa.array([blob[64 * i : 64 * i + 64] for i in range(len(digests))], pa.string()),
                ],
                ["doc_id", "keep_id", "group_size", "kept", "text_sha256"],
            )


def _suspects(blocks: DataFrame, n_rows: int, owner_rows: int, slack_bits: int) -> DataFrame:
    """Blocks with their suspects marked, by the exchange of fingerprints."""
    owner_bits = max(0, math.ceil(math.log2(max(1, n_rows / owner_rows))))
    bits = min(62, max(math.ceil(math.log2(n_rows + 1)) + slack_bits, owner_bits + 1))
    messages = blocks.select("block", "digests").mapInArrow(
        _send(bits, owner_bits), "owner long, block string, n int, width int, quotients binary, remainders binary"
    )
    replies = messages.groupBy("owner").applyInArrow(_reply, "block string, owner long, n int, bitmap binary")
    by_block = replies.groupBy("block").agg(F.collect_list(F.struct("owner", "n", "bitmap")).alias("replies"))
    return blocks.join(by_block, "block").mapInArrow(_mark(bits), f"{_BLOCK}, suspects binary")


def _verified(documents: DataFrame, groups: DataFrame) -> DataFrame:
    """Digests with the number of different texts that have them, for the groups' digests."""
    number = F.conv(F.substring(F.hex("digest"), 1, 16), 16, -10).cast("long")
    wanted = presence_bitmap(groups, number)
    texts = documents.select("text").mapInArrow(_collapsed(wanted), "digest binary, norm binary")
    texts = texts.join(groups.select("digest"), "digest", "left_semi")
    return texts.groupBy("digest", "norm").count().groupBy("digest").agg(F.count("*").alias("n_texts"))


def exact_duplicates(
    documents: DataFrame, owner_rows: int = OWNER_ROWS, slack_bits: int = SLACK_BITS
) -> DataFrame:
    """Per row: doc_id, keep_id, group_size, whether it is kept, and the SHA-256 of its text without blanks."""
    work = WorkTables(documents.sparkSession, "exact-dedup")
    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    blocks = work.keep(documents.mapInArrow(_blocks, _BLOCK), "blocks")
    n_rows = blocks.agg(F.sum(F.size("doc_ids"))).first()[0] or 0
    marked = work.keep(_suspects(blocks, n_rows, owner_rows, slack_bits), "marked")
    work.drop("blocks")
    entries = work.keep(
        marked.mapInArrow(_entries, "block string, digest binary, n long, n_chars long, doc_id long, at long"), "entries"
    )
    order = [(-F.col("n_chars")).alias("fewer"), F.col("doc_id").isNull().alias("last"), "doc_id", "block", "at"]
    groups = entries.groupBy("digest").agg(F.sum("n").alias("size"), F.min(F.struct(*order)).alias("best"))
    groups = work.keep(groups, "groups")
    several = groups.where(F.col("size") > 1)
    checked = groups.join(_verified(documents, several), "digest", "left")
    wrong = F.raise_error(F.concat(F.lit("texts with one digest: "), F.hex("digest")))
    size = F.when((F.col("size") > 1) & (F.coalesce("n_texts", F.lit(0)) != 1), wrong.cast("long")).otherwise(F.col("size"))
    answers = checked.select(
        "digest",
        size.alias("size"),
        F.col("best.doc_id").alias("keep_id"),
        F.col("best.block").alias("keep_block"),
        F.col("best.at").alias("keep_at"),
    )
    verdicts = (
        entries.select("block", "digest")
        .join(answers, "digest")
        .groupBy("block")
        .agg(F.collect_list(F.struct("digest", "size", "keep_id", "keep_block", "keep_at")).alias("verdicts"))
    )
    schema = "doc_id long, keep_id long, group_size long, kept boolean, text_sha256 string"
    return marked.join(verdicts, "block", "left").mapInArrow(_result, schema)
