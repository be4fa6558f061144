"""Removal of repeated word windows.

A word goes if a window of `width` consecutive words that covers it also starts in a document with a smaller
id. Every window of every whole text has its Rabin-Karp hash. The smallest hash among the `gram`-word grams of
a window, its anchor, depends on the window alone; consecutive windows with the same anchor make a run.
Equal windows have equal anchors, so windows are counted by anchor:

* an anchor in one document only cannot repeat, and its windows are done;
* equal runs are settled as one, by the run's hash: all windows go except in the smallest document;
* where an anchor has different runs (at the ends of a repeated passage, around an edit), one document of each
  different run gives the hashes of the run's windows one by one, which are then counted by themselves.

The hashes shuffled are so a fraction of the windows, and the result is that of counting all. Equal
runs within a task are settled there: a passage in a third of all documents leaves one row for each task.
Removed windows merge into maximal intervals of words.

Null or empty texts, and texts of fewer words than a window: nothing is removed. Rows with a null id neither
lose words nor make others lose them. Rows with the same id do not remove each other's words, each gets its
own result. A text of more than 2**28 words ends the job with an error. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.text_arrays import U, Words, mix, rolling, words_of
from tallyhouse.llm.work_tables import WorkTables

#: Low bits of a sliding minimum that hold the word's place in the chunk.
PLACE_BITS = U(28)
#: Runs gathered before equal ones are settled in the task.
FLUSH_RUNS = 200_000

_RUNS = "anchor long, run long, doc_id long, row_id long, start int, windows int, settled boolean"
_RUN_SCHEMA = pa.schema(
    [("anchor", pa.int64()), ("run", pa.int64()), ("doc_id", pa.int64()), ("row_id", pa.int64()),
     ("start", pa.int32()), ("windows", pa.int32()), ("settled", pa.bool_())]
)


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every `width` neighbours."""
    n, span = len(x) - width + 1, 1
    while 2 * span <= width:
        x = np.minimum(x[: len(x) - span], x[span:])
        span *= 2
    return np.minimum(x[:n], x[width - span : width - span + n])


def window_runs(words: Words, width: int, gram: int) -> tuple[np.ndarray, ...]:
    """Runs of a chunk: text, first window (word place in the chunk), number of windows, anchor, run hash;
    and the hash of every window by its place."""
    hashes = rolling(words.hash, width)
    if not len(hashes):
        empty = np.empty(0, dtype=np.int64)
        return empty, empty, empty, empty.astype(U), empty.astype(U), hashes
    if len(hashes) >> int(PLACE_BITS):
        raise ValueError(f"a text of more than 2**{PLACE_BITS} words")
    grams = rolling(words.hash, gram)
    places = np.arange(len(grams), dtype=U)
    least = _sliding_min((grams >> PLACE_BITS << PLACE_BITS) | places, width - gram + 1)
    anchor_at = (least & ((U(1) << PLACE_BITS) - U(1))).astype(np.int64)
    counts = np.diff(words.first)
    text = np.repeat(np.arange(len(counts)), counts)[: len(hashes)]
    whole = np.arange(len(hashes)) + width <= words.first[1:][text]
    valid = np.flatnonzero(whole)
    if not len(valid):
        return valid, valid, valid, valid.astype(U), valid.astype(U), hashes
    new = np.ones(len(valid), dtype=bool)
    new[1:] = (np.diff(anchor_at[valid]) != 0) | (np.diff(text[valid]) != 0)
    heads = np.flatnonzero(new)
    size = np.diff(np.append(heads, len(valid)))
    first = valid[heads]
    last = first + size - 1
    run = mix(hashes[first] * U(3) + hashes[last] * U(0x9E3779B97F4A7C15) + size.astype(U))
    return text[first], first, size, grams[anchor_at[first]], run, hashes


def _settle(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    """Rows of the runs of a task: all of the smallest document of each run; of others, that they go."""
    doc, row, start, size, anchor, run = (np.concatenate(c) for c in zip(*parts, strict=True))
    order = np.lexsort((doc, run, anchor))
    a, r, d = anchor[order], run[order], doc[order]
    head = np.ones(len(a), dtype=bool)
    head[1:] = (a[1:] != a[:-1]) | (r[1:] != r[:-1])
    smallest = d[np.flatnonzero(head)][np.cumsum(head) - 1]
    goes = np.zeros(len(a), dtype=bool)
    goes[order] = d > smallest
    # Neighbouring runs that go make one row
    at = np.flatnonzero(goes)
    at = at[np.lexsort((start[at], row[at]))]
    stop = start[at] + size[at]
    joined = np.ones(len(at), dtype=bool)
    joined[1:] = (row[at][1:] != row[at][:-1]) | (start[at][1:] > stop[:-1])
    heads = np.flatnonzero(joined)
    stop = np.maximum.reduceat(stop, heads) if len(heads) else stop
    gone = at[heads]
    stay = np.flatnonzero(~goes)
    spread = mix(row[gone].astype(U) + start[gone].astype(U)).view(np.int64)
    columns = (
        np.concatenate([anchor[stay].view(np.int64), spread]),
        np.concatenate([run[stay].view(np.int64), spread]),
        np.concatenate([doc[stay], doc[gone]]),
        np.concatenate([row[stay], row[gone]]),
        np.concatenate([start[stay], start[gone]]),
        np.concatenate([size[stay], stop - start[gone]]),
        np.arange(len(stay) + len(gone)) >= len(stay),
    )
    arrays = [pa.array(c, f.type, safe=False) for c, f in zip(columns, _RUN_SCHEMA, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=_RUN_SCHEMA)


def _runs(batches: Iterator[pa.RecordBatch], width: int, gram: int) -> Iterator[pa.RecordBatch]:
    parts: list[tuple[np.ndarray, ...]] = []
    for words in words_of(batches):
        text, first, size, anchor, run, _ = window_runs(words, width, gram)
        doc = words.rows.column("doc_id").to_numpy(zero_copy_only=False)[text].astype(np.int64)
        row = words.rows.column("row_id").to_numpy(zero_copy_only=False)[text].astype(np.int64)
        parts.append((doc, row, first - words.first[text], size, anchor, run))
        if sum(len(p[0]) for p in parts) >= FLUSH_RUNS:
            yield _settle(parts)
            parts = []
    if parts:
        yield _settle(parts)


def _covered(spans: list[tuple[int, int]], n_words: int, width: int) -> np.ndarray:
    """Which words the windows cover; spans are (first window, number of windows)."""
    edge = np.zeros(n_words + 1, dtype=np.int64)
    for start, windows in spans:
        edge[start] += 1
        edge[start + windows + width - 1] -= 1
    return np.cumsum(edge[:-1]) > 0


_RESULT = (
    "row_id long, doc_id long, n_words long, n_removed long, kept_sha256 string, "
    "removed array<struct<start: int, end: int>>, kept_text string, "
    "text string, spans array<struct<start: int, windows: int>>, "
    "open array<struct<start: int, hash: long>>"
)
_SPAN = pa.list_(pa.struct([("start", pa.int32()), ("windows", pa.int32())]))
_RESULT_SCHEMA = pa.schema(
    [("row_id", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
     ("kept_sha256", pa.string()),
     ("removed", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
     ("kept_text", pa.string()), ("text", pa.string()), ("spans", _SPAN),
     ("open", pa.list_(pa.struct([("start", pa.int32()), ("hash", pa.int64())])))]
)


def _cut(data: bytes, start: np.ndarray, end: np.ndarray, gone: np.ndarray) -> str:
    """The text without the words that go and the blanks behind them."""
    keep, at = [], 0
    edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
    for a, b in zip(edges[::2], edges[1::2], strict=True):
        keep.append(data[at : start[a]])
        at = int(start[b]) if b < len(start) else len(data)
    return b"".join([*keep, data[at:]]).decode("utf-8", "replace")


def _resolve(batches: Iterator[pa.RecordBatch], width: int, gram: int, with_text: bool) -> Iterator[pa.RecordBatch]:
    """Result of each text from its spans; texts with open runs give those windows' hashes instead."""
    for words in words_of(batches):
        rows = words.rows.drop_columns(["text"]).to_pylist()
        texts = words.rows.column("text")
        byte_at = 0
        opened = any(s["open"] for r in rows for s in r["spans"] or ())
        hashes = rolling(words.hash, width) if opened else None
        out = []
        for i, row in enumerate(rows):
            a, b = int(words.first[i]), int(words.first[i + 1])
            settled = [(s["start"], s["windows"]) for s in row["spans"] or () if not s["open"]]
            asked = [(s["start"], s["windows"]) for s in row["spans"] or () if s["open"]]
            size = len(texts[i].as_buffer()) if texts[i].is_valid else 0
            raw = words.data[byte_at : byte_at + size]
            result = {"row_id": row["row_id"], "doc_id": row["doc_id"], "n_words": b - a}
            if asked:
                at = np.concatenate([np.arange(s, s + n) for s, n in asked])
                result |= {
                    "text": texts[i].as_py(),
                    "spans": [{"start": s, "windows": n} for s, n in settled],
                    "open": [
                        {"start": s, "hash": h}
                        for s, h in zip(at.tolist(), hashes[at + a].view(np.int64).tolist(), strict=True)
                    ],
                }
            else:
                gone = _covered(settled, b - a, width)
                starts, ends = words.start[a:b] - byte_at, words.end[a:b] - byte_at
                data = raw.tobytes()
                kept = np.flatnonzero(~gone)
                pieces = [data[s:e] for s, e in zip(starts[kept].tolist(), ends[kept].tolist(), strict=True)]
                edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
                result |= {
                    "n_removed": int(gone.sum()),
                    "kept_sha256": hashlib.sha256(b" ".join(pieces)).hexdigest(),
                    "removed": [
                        {"start": s, "end": e}
                        for s, e in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)
                    ],
                }
                if with_text and gone.any():
                    result["kept_text"] = _cut(data, starts, ends, gone)
            byte_at += size
            out.append(result)
        yield pa.RecordBatch.from_pylist(out, schema=_RESULT_SCHEMA)


def remove_repeats(
    documents: DataFrame, *, width: int = 50, gram: int = 8, with_text: bool = False
) -> DataFrame:
    """Per document: row_id, doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by one blank)
    and removed (word intervals, end excluded). with_text: also kept_text, the text with those words cut out
    and all other characters as they were, null where nothing goes. row_id tells rows with equal ids apart by
    their text."""
    work = WorkTables(documents.sparkSession, "substring-dedup")
    rows = documents.select("doc_id", "text").withColumn("row_id", F.xxhash64("doc_id", "text"))
    runs = rows.where(F.col("doc_id").isNotNull()).mapInArrow(
        lambda batches: _runs(batches, width, gram), _RUNS
    )
    by_anchor, by_run = Window.partitionBy("anchor"), Window.partitionBy("anchor", "run")
    judged = (
        runs.withColumn("first_of_run", F.min("doc_id").over(by_run))
        .withColumn("first_doc", F.min("doc_id").over(by_anchor))
        .withColumn("last_doc", F.max("doc_id").over(by_anchor))
        .withColumn("low", F.min("run").over(by_anchor))
        .withColumn("high", F.max("run").over(by_anchor))
    )
    goes = F.col("settled") | (F.col("doc_id") > F.col("first_of_run"))
    is_open = (F.col("first_doc") < F.col("last_doc")) & (F.col("low") < F.col("high"))
    found = (
        judged.where(goes | is_open)
        .groupBy("row_id")
        .agg(F.collect_set(F.struct("start", "windows", (~goes).alias("open"))).alias("spans"))
    )
    found = work.keep(found, "spans")
    first_pass = work.keep(
        rows.join(found, "row_id", "left").mapInArrow(
            lambda batches: _resolve(batches, width, gram, with_text), _RESULT
        ),
        "first-pass",
    )
    still_open = first_pass.where(F.col("text").isNotNull())
    windows = still_open.select("row_id", "doc_id", F.explode("open").alias("w")).select(
        "row_id", "doc_id", "w.start", "w.hash"
    )
    earliest = windows.groupBy("hash").agg(F.min("doc_id").alias("first_doc"))
    gone = (
        windows.join(earliest, "hash")
        .where(F.col("doc_id") > F.col("first_doc"))
        .groupBy("row_id")
        .agg(
            F.transform(
                F.collect_set("start"), lambda s: F.struct(s.alias("start"), F.lit(1).alias("windows"))
            ).alias("more")
        )
    )
    closed = F.transform(
        F.concat("spans", F.coalesce("more", F.array())),
        lambda s: F.struct(s.start.alias("start"), s.windows.alias("windows"), F.lit(False).alias("open")),
    )
    second_pass = (
        still_open.select("row_id", "doc_id", "text", "spans")
        .join(gone, "row_id", "left")
        .select("doc_id", "text", "row_id", closed.alias("spans"))
        .mapInArrow(lambda batches: _resolve(batches, width, gram, with_text), _RESULT)
    )
    columns = ["row_id", "doc_id", "n_words", "n_removed", "kept_sha256", "removed"]
    columns += ["kept_text"] * with_text
    return first_pass.where(F.col("text").isNull()).select(columns).unionByName(second_pass.select(columns))
