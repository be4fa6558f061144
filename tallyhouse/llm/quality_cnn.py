"""Quality score by a byte-level convolutional network in numpy.

Every byte has a learned vector. Filters of `WIDTH` bytes slide over the whole text in steps of half their width.
Each filter's largest response within a chunk of `CHUNK` bytes, chunks overlapping by half, is that chunk's
feature. The chunks' features are combined by their largest and their mean over all chunks of the text, and go
through a logistic layer to one probability.

The network is fitted with Adam on at most `sample_rows` labelled documents, those with the smallest digests
of their ids, whole texts; the bound keeps fitting on the driver small and does not grow with the corpus. The
gradient of a maximum goes to the window that had it. Scoring is one pass over all documents without a
shuffle, every whole text in pieces of bounded size.

Null and empty texts get the score of a text of zero bytes. Rows are scored each on its own, repeated or not,
so equal texts get equal scores. Labels that are null, and labels of absent documents, do not count; of repeated labels the
largest does. Without labels of both kinds, all scores are 0.5. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.text_arrays import Words, words_of
from tallyhouse.llm.work_tables import reach_workers

VECTOR, WIDTH, CHUNK, FILTERS = 8, 8, 256, 32
STEP = WIDTH // 2
#: Filter positions in half a chunk.
HALF = CHUNK // 2 // STEP


class Network(NamedTuple):
    """vectors: byte x VECTOR; filters: WIDTH * VECTOR x FILTERS; bias per filter; weights: 2 * FILTERS + 1."""

    vectors: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    weights: np.ndarray


class Signal(NamedTuple):
    """Texts as bytes, each padded with zeros to whole half chunks. first: half chunks of text i are first[i] to
    first[i + 1]."""

    data: np.ndarray
    first: np.ndarray


def signal_of(words: Words) -> Signal:
    """The input of a chunk of texts."""
    sizes = np.array([len(t.as_buffer()) if t.is_valid else 0 for t in words.rows.column("text")])
    begin = np.append(0, np.cumsum(sizes))
    halves = np.maximum(1, -(-(sizes + WIDTH) // (HALF * STEP)))
    first = np.append(0, np.cumsum(halves))
    data = np.zeros(int(first[-1]) * HALF * STEP, dtype=np.uint8)
    for i, size in enumerate(sizes.tolist()):
        to = int(first[i]) * HALF * STEP
        data[to : to + size] = words.data[begin[i] : begin[i] + size]
    return Signal(data, first)


def _inputs(net: Network, signal: Signal) -> np.ndarray:
    """A row for each step: STEP bytes of VECTOR numbers."""
    return net.vectors[signal.data].reshape(-1, STEP * VECTOR)


def _last_steps(first: np.ndarray) -> np.ndarray:
    """The last step of each text."""
    return first[1:] * HALF - 1


def _responses(net: Network, steps: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Filter responses at every step; the window is the step and the one behind it, none behind a text's last."""
    own, following = net.filters[: STEP * VECTOR], net.filters[STEP * VECTOR :]
    behind = steps[1:] @ following
    behind[last[last < len(behind)]] = 0
    out = steps @ own
    out[:-1] += behind
    return out


def _chunk_pairs(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Half chunks (left, right) of every chunk, and each text's first chunk. A text of one half is a chunk."""
    halves = np.diff(first)
    chunks = np.maximum(1, halves - 1)
    start = np.append(0, np.cumsum(chunks))
    left = np.arange(start[-1]) - np.repeat(start[:-1], chunks) + np.repeat(first[:-1], chunks)
    right = np.where(np.repeat(halves, chunks) > 1, left + 1, left)
    return left, right, start


def _forward(net: Network, signal: Signal) -> tuple[np.ndarray, ...]:
    steps = _inputs(net, signal)
    n_halves = int(signal.first[-1])
    half_max = np.empty((n_halves, FILTERS), dtype=np.float32)
    half_at = np.empty((n_halves, FILTERS), dtype=np.int64)
    responses = _responses(net, steps, _last_steps(signal.first)).reshape(n_halves, HALF, FILTERS)
    half_at = responses.argmax(axis=1)
    half_max = np.take_along_axis(responses, half_at[:, None, :], axis=1)[:, 0, :]
    left, right, start = _chunk_pairs(signal.first)
    higher = half_max[right] > half_max[left]
    chunk = np.maximum(half_max[left], half_max[right]) + net.bias
    hidden = np.maximum(chunk, 0)
    size = np.diff(start)[:, None]
    most = np.maximum.reduceat(hidden, start[:-1], axis=0)
    mean = np.add.reduceat(hidden, start[:-1], axis=0) / size
    features = np.concatenate([most, mean, np.ones((len(size), 1), np.float32)], axis=1)
    chosen = np.where(higher, right[:, None], left[:, None])
    place = chosen * HALF + half_at[chosen, np.arange(FILTERS)]
    return features, hidden, place, start, steps


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def scores_of(net: Network, signal: Signal) -> np.ndarray:
    """Probabilities of the texts. Long signals are taken in parts, with the same result."""
    n_halves, part = int(signal.first[-1]), 2048
    size, ends = HALF * STEP, _last_steps(signal.first)
    half_max = np.empty((n_halves, FILTERS), dtype=np.float32)
    for at in range(0, n_halves, part):
        stop = min(n_halves, at + part)
        # The window of the last step reaches into the next part
        piece = Signal(
            np.append(signal.data[at * size : stop * size], np.zeros(STEP, np.uint8)),
            signal.first,
        )
        if stop < n_halves:
            piece.data[-STEP:] = signal.data[stop * size : stop * size + STEP]
        last = ends[(ends >= at * HALF) & (ends < stop * HALF)] - at * HALF
        responses = _responses(net, _inputs(net, piece), last)[:-1]
        half_max[at:stop] = responses.reshape(stop - at, HALF, FILTERS).max(axis=1)
    left, right, start = _chunk_pairs(signal.first)
    hidden = np.maximum(np.maximum(half_max[left], half_max[right]) + net.bias, 0)
    most = np.maximum.reduceat(hidden, start[:-1], axis=0)
    mean = np.add.reduceat(hidden, start[:-1], axis=0) / np.diff(start)[:, None]
    return _sigmoid(np.concatenate([most, mean], axis=1) @ net.weights[:-1] + net.weights[-1])


def _gradients(net: Network, signal: Signal, labels: np.ndarray) -> list[np.ndarray]:
    features, hidden, place, start, steps = _forward(net, signal)
    error = (_sigmoid(features @ net.weights) - labels) / len(labels)
    text = np.repeat(np.arange(len(labels)), np.diff(start))
    number = np.arange(len(text))[:, None]
    at_most = np.where(hidden == features[:, :FILTERS][text], number, len(text))
    is_most = number == np.minimum.reduceat(at_most, start[:-1], axis=0)[text]
    by_text = error[:, None] * net.weights[None, :-1]
    d_hidden = by_text[:, FILTERS:][text] / np.diff(start)[text][:, None]
    d_hidden = d_hidden + np.where(is_most, by_text[:, :FILTERS][text], 0)
    d_chunk = np.where(hidden > 0, d_hidden, 0).astype(np.float32)
    d_filters = np.zeros_like(net.filters)
    d_vectors = np.zeros_like(net.vectors)
    is_last = np.zeros(len(steps), dtype=bool)
    is_last[_last_steps(signal.first)] = True
    for f in range(FILTERS):
        at = np.flatnonzero(d_chunk[:, f])
        if not len(at):
            continue
        g, p = d_chunk[at, f], place[at, f]
        ends = is_last[p]
        behind = np.where(ends[:, None], 0, steps[np.minimum(p + 1, len(steps) - 1)])
        window = np.concatenate([steps[p], behind], axis=1)
        d_filters[:, f] = g @ window
        spread = net.filters[:, f].reshape(WIDTH, VECTOR)
        bytes_at = np.minimum(p[:, None] * STEP + np.arange(WIDTH), len(signal.data) - 1)
        weight = np.zeros((256, WIDTH), dtype=np.float32)
        inside = np.where(ends[:, None] & (np.arange(WIDTH) >= STEP), 0, g[:, None])
        np.add.at(weight, (signal.data[bytes_at], np.arange(WIDTH)), inside)
        d_vectors += weight @ spread
    return [d_vectors, d_filters, d_chunk.sum(axis=0), (features.T @ error).astype(np.float32)]


def fit(
    texts: list[str], labels: np.ndarray, *, epochs: int = 14, least_steps: int = 600, batch: int = 64,
    rate: float = 0.01, seed: int = 7,
) -> Network:
    """The network fitted to 0/1 labels, in so many passes over the texts, or more if these are too few for
    least_steps; constant 0.5 unless both labels occur."""
    draw = np.random.default_rng(seed)
    net = Network(
        draw.normal(0, 0.5, (256, VECTOR)).astype(np.float32),
        draw.normal(0, 0.25, (WIDTH * VECTOR, FILTERS)).astype(np.float32),
        np.zeros(FILTERS, dtype=np.float32),
        np.zeros(2 * FILTERS + 1, dtype=np.float32),
    )
    if len(np.unique(labels)) < 2:
        return net
    net = net._replace(weights=draw.normal(0, 0.1, 2 * FILTERS + 1).astype(np.float32))
    moment = [np.zeros_like(p) for p in net]
    square = [np.zeros_like(p) for p in net]
    step = 0
    # Texts of like length together, so that a batch is no larger than it must be
    order = np.argsort([len(t) for t in texts], kind="stable")
    groups = [order[i : i + batch] for i in range(0, len(order), batch)]
    signals = []
    for group in groups:
        rows = pa.RecordBatch.from_pydict({"text": pa.array([texts[i] for i in group], pa.large_string())})
        signals += [(s, labels[group[a:b]]) for s, a, b in _signals(rows)]
    epochs = max(epochs, -(-least_steps // len(signals)))
    for epoch in range(epochs):
        pace = rate * (1 - epoch / epochs) + rate * 0.02
        for at in draw.permutation(len(signals)):
            signal, known = signals[at]
            step += 1
            for p, g, m, v in zip(net, _gradients(net, signal, known), moment, square, strict=True):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= pace * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)
    return net


def _signals(rows: pa.RecordBatch) -> Iterator[tuple[Signal, int, int]]:
    at = 0
    for words in words_of(iter([rows])):
        yield signal_of(words), at, at + words.rows.num_rows
        at += words.rows.num_rows


def is_held_out(doc_id: Column) -> Column:
    """Rows kept from fitting: crc32 of the id's text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def labelled_sample(documents: DataFrame, labels: DataFrame, sample_rows: int) -> tuple[list[str], np.ndarray]:
    """At most sample_rows texts with their labels, the smallest digests of ids first."""
    known = (
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
        .where(~is_held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample_rows)
    )
    chosen = documents.sparkSession.createDataFrame(known.collect(), known.schema)
    rows = (
        documents.select("doc_id", "text")
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "quality")
        .agg(F.min("text").alias("text"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .collect()
    )
    return [r["text"] or "" for r in rows], np.array([float(r["quality"] > 0) for r in rows], np.float32)


def quality_scores(
    documents: DataFrame, labels: DataFrame, *, sample_rows: int = 3000, threshold: float = 0.7
) -> DataFrame:
    """doc_id, held_out, score and predicted (1 from the threshold on) of every row of documents."""
    reach_workers(documents.sparkSession)
    net = fit(*labelled_sample(documents, labels, sample_rows))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words in words_of(batches):
            scores = scores_of(net, signal_of(words)).astype(np.float64)
            yield pa.RecordBatch.from_arrays(
                [words.rows.column("doc_id"), pa.array(scores)], names=["doc_id", "score"]
            )

    kind = documents.schema["doc_id"].dataType.simpleString()
    scored = documents.select("doc_id", "text").mapInArrow(score, f"doc_id {kind}, score double")
    return scored.select(
        "doc_id",
        is_held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
