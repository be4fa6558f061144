from __future__ import annotations

import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import topk_search
from tallyhouse.llm.oracles import OP7
from tallyhouse.llm.topk_search import max_score, top_k


@pytest.mark.parametrize("seed", range(4))
def test_max_score_equals_full_scores(monkeypatch, seed):
    monkeypatch.setattr(topk_search, "BLOCK_ROWS", 16)
    draw = np.random.default_rng(seed)
    sparse = draw.random((300, 40)) < (0.15 if seed % 2 else 1)
    rows = draw.integers(-9, 10, (300, 40)) * sparse * (draw.random(40) < 0.7)
    ids = draw.permutation(300)
    for q in range(20):
        query = draw.integers(-9, 10, 40)
        got_ids, got = max_score(query, int(ids[q]), ids, rows, 7)
        scores = rows @ query
        want = sorted(((-s, i) for s, i in zip(scores, ids, strict=True) if i != ids[q]))[:7]
        assert [(-s, i) for s, i in zip(got, got_ids, strict=True)] == want


def _ints(vector):
    return [math.floor(1024 * float(np.float32(x))) for x in vector]


def brute(rows, k):
    """Every row of every query id against every row of another id."""
    usable = [
        (i, _ints(v)) for i, v, _ in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)
    ]
    want = []
    for q in sorted({i for i, _ in usable if i % 100 == 0}):
        asked = [v for i, v in usable if i == q]
        scored = sorted(
            (-sum(a * b for a, b in zip(v, w, strict=False)), i) for v in asked for i, w in usable if i != q
        )
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return want


SCHEMA = "vec_id long, embedding array<float>, score int"


def test_query_with_unusable_vectors(spark):
    draw = random.Random(2)
    rows = [(i, [draw.uniform(-1, 1) for _ in range(6)], 1) for i in range(230)]
    rows += [(300, None, 1), (301, [], 1), (302, [1.0, None], 1), (303, [math.nan] * 6, 1), (304, [math.inf] * 6, 1)]
    rows += [(305, [0.5, 0.5], 1), (None, [1.0] * 6, 1), rows[3], rows[100]]
    vectors = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = top_k(vectors, F.col("vec_id") % 100 == 0, rows_per_shard=50, queries_per_block=2, k=5).collect()
    assert sorted(map(tuple, got)) == brute(rows, 5)
    assert top_k(vectors.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_rows_that_repeat_an_id(spark, tmp_path):
    """One id with several vectors, as candidate and as query, against a brute-force version and the SQL."""
    rows = [(0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (1, [2.0, 0.0], 1), (100, [0.5, 1.0], 1), (100, [-1.0, 3.0], 1)]
    rows += [(7, [3.0, -1.0], 1)] * 25 + [(200, [0.0, 1.0], 1)] * 3
    vectors = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = sorted(map(tuple, top_k(vectors, F.col("vec_id") % 100 == 0, rows_per_shard=4).collect()))
    assert got == brute(rows, 10)
    vectors.write.parquet(str(tmp_path / "embeddings"))
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings/*.parquet')")
    sql = connection.execute(f"SELECT query_id, rank, vec_id, score FROM ({OP7})").fetchall()
    assert got == sorted(sql)


def test_large_weights(spark):
    exact = spark.createDataFrame([(0, [2.0**40, 1.0], 1), (1, [2.0**1, 0.0], 1), (2, [-(2.0**1), 3.0], 1)], SCHEMA)
    got = top_k(exact, F.col("vec_id") == 0).collect()
    assert [(r.vec_id, r.score) for r in sorted(got, key=lambda r: r.rank)] == [(1, 2**61), (2, 3 * 2**20 - 2**61)]
    for too_large in (2.0**50, 1e17):
        with pytest.raises(Exception, match="64 bits|too large|OverflowError"):
            rows = [(0, [too_large, too_large], 1), (1, [too_large, too_large], 1)]
            top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") == 0).collect()
