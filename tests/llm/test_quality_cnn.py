from __future__ import annotations

import zlib

import cases
import numpy as np
import pyarrow as pa

from tallyhouse.llm import quality_cnn
from tallyhouse.llm.queries import op4_quality_cnn, table
from tallyhouse.llm.quality_cnn import _forward, _sigmoid, fit, quality_scores, scores_of, signal_of
from tallyhouse.llm.text_arrays import words_of

PATH = "/root/testdata/sf0.01"


def signal(texts):
    rows = pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.large_string())})
    (words,) = words_of(iter([rows]))
    return signal_of(words)


def test_gradients_are_those_of_the_loss():
    net = fit(["good text here " * 20, "BAD!! BAD!! " * 20], np.array([1.0, 0.0], np.float32), epochs=1, least_steps=1)
    net = type(net)(*(p.astype(np.float64) for p in net))
    held, labels = signal(["good text here", "BAD!! " * 200, ""]), np.array([1, 0, 1])

    def loss():
        p = _sigmoid(_forward(net, held)[0] @ net.weights)
        return -np.mean(labels * np.log(p) + (1 - labels) * np.log(1 - p))

    for part, gradient in zip(net, quality_cnn._gradients(net, held, labels), strict=True):
        at = np.unravel_index(np.abs(gradient).argmax(), gradient.shape)
        kept, step = part[at], 1e-5
        part[at] = kept + step
        above = loss()
        part[at] = kept - step
        slope = (above - loss()) / (2 * step)
        part[at] = kept
        assert abs(slope - gradient[at]) < 0.02 * abs(slope) + 1e-4


def brute(net, text):
    """The network by its definition, window by window and chunk by chunk, for one text."""
    data = text.encode()
    half = quality_cnn.CHUNK // 2
    halves = max(1, -(-(len(data) + quality_cnn.WIDTH) // half))
    data += bytes(halves * half + quality_cnn.STEP - len(data))
    chunks = []
    for first in range(max(1, halves - 1)):
        end = min(first + 2, halves) * half
        responses = [
            np.concatenate([net.vectors[b] for b in data[at : at + quality_cnn.WIDTH]]) @ net.filters
            for at in range(first * half, end, quality_cnn.STEP)
            if at + quality_cnn.WIDTH <= halves * half
        ]
        responses += [
            np.concatenate([net.vectors[b] for b in data[end - quality_cnn.STEP : end]])
            @ net.filters[: quality_cnn.STEP * quality_cnn.VECTOR]
        ] * (end == halves * half)
        chunks.append(np.maximum(np.max(responses, axis=0) + net.bias, 0))
    features = np.concatenate([np.max(chunks, axis=0), np.mean(chunks, axis=0)])
    return 1 / (1 + np.exp(-(features @ net.weights[:-1] + net.weights[-1])))


def test_forward_pass_by_brute_force():
    net = fit(["good text here " * 20, "BAD!! BAD!! " * 20], np.array([1.0, 0.0], np.float32), epochs=3, least_steps=3)
    draw = np.random.default_rng(2)
    texts = ["", "a", "é" * 130, "word " * 50, "x" * 248, "y" * 249, "z" * 256, "w" * 257]
    texts += ["".join(draw.choice(list("ab !é\n"), n)) for n in (100, 700, 3000)]
    assert np.allclose(scores_of(net, signal(texts)), [brute(net, t) for t in texts], atol=1e-4)
    alone = [scores_of(net, signal([t]))[0] for t in texts]
    assert np.allclose(scores_of(net, signal(texts[::-1]))[::-1], alone, atol=1e-5)


def test_scores_do_not_depend_on_how_texts_are_cut():
    texts = ["some words " * k for k in (0, 1, 30, 2000, 90_000)]
    net = fit([texts[2], "NO!! " * 80], np.array([1.0, 0.0], np.float32), epochs=2, least_steps=2)
    together = scores_of(net, signal(texts))
    features = _forward(net, signal(texts))[0]
    assert np.allclose(together, _sigmoid(features @ net.weights), atol=1e-4)


def test_held_out_accuracy(spark):
    scored = op4_quality_cnn(spark, PATH).toPandas()
    labels = table(spark, PATH, "labels").toPandas()
    assert scored["score"].between(0, 1).all()
    assert (scored["held_out"] == [zlib.crc32(str(i).encode()) % 4 == 2 for i in scored["doc_id"]]).all()
    both = scored[scored["held_out"]].merge(labels, on="doc_id")
    assert (both["predicted"] == both["quality"]).mean() > 0.9
    good, bad = (both[both["quality"] == q]["score"] for q in (1, 0))
    assert np.mean([(good > b).mean() for b in bad]) > 0.93


def test_edge_cases(spark):
    rows = cases.documents(9, 10)
    frame = cases.frame(spark, rows)
    labels = [(r[0], i % 2, 0) for i, r in enumerate(rows)] + [(None, 1, 0), (3, None, 0), (99999, 1, 0)]
    known = spark.createDataFrame(labels, "doc_id long, quality int, score int")
    scores = quality_scores(frame, known, sample_rows=20).collect()
    assert len(scores) == len(rows) and all(0 <= r.score <= 1 for r in scores)
    assert {r.score for r in quality_scores(frame, known.limit(0)).collect()} == {0.5}
    assert quality_scores(frame.limit(0), known).count() == 0
