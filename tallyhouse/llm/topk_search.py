"""Exact top-k by inner product with MaxScore over shards of the collection.

A vector is a set of postings (dimension, integer weight); the dimensions of a query are its terms. In a
shard every term has an upper bound of what it can add: the larger of 0, weight times the largest and weight
times the smallest posting. Terms are ordered by bound. Those whose bounds together cannot reach the
current k-th score are non-essential: a row that has none of the other, essential terms is never looked at.
The essential postings are traversed and summed; the non-essential ones are then probed, largest bound
first, only for rows whose sum plus all remaining bounds still reaches the k-th score. Each shard yields its
k best, which a ranking per query merges.

Queries and rows meet in cells of one block of queries and one shard, both of bounded size, so that neither
side is broadcast and no task holds more than a cell.

Vectors that are null, hold a null or a non-finite component, or have a null id take no part; neither do
empty ones. Shorter vectors lack the last terms. Rows are told apart by id and vector: every row is a
candidate, also where it repeats an id or another row, and rows of one id that ask are one query, answered by
the best scores of any of them. Candidates with the id of the query are left out. Equal scores go to the smaller
id. Weights and scores beyond 64 bits end the job with an error. No queries or no candidates give no rows.
Further columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.work_tables import reach_workers

#: Rows of a shard that share one threshold update, and non-essential terms probed at a time.
BLOCK_ROWS, PROBE_TERMS = 2048, 8
#: Below this a float64 holds every sum of products exactly.
EXACT = 2**53


def as_terms(vector: Column, scale: int) -> Column:
    """Integer weights floor(scale * x); null for a vector that takes no part."""
    values = F.transform(vector, lambda x: x.cast("double"))
    usable = F.forall(
        values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    )
    too_large = F.raise_error(F.lit("a weight beyond 64 bits")).cast("long")
    weights = F.transform(
        values,
        lambda x: F.when(F.abs(x * scale) < float(2**63), F.floor(F.lit(float(scale)) * x).cast("long")).otherwise(
            too_large
        ),
    )
    return F.when(usable & (F.size(vector) > 0), weights)


def _numbers(n: int) -> Column:
    return F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))


def _matrix(rows: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(rows), width), dtype=np.int64)
    for at, row in enumerate(rows):
        out[at, : len(row)] = row
    return out


def max_score(
    query: np.ndarray, own: int, ids: np.ndarray, postings: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray]:
    """The k best rows for one query: ids and scores, best first. postings: a column for each term."""
    low, high = postings.min(axis=0), postings.max(axis=0)
    bound = np.maximum(0, np.maximum(query * low, query * high))
    order = np.argsort(-bound, kind="stable")
    # rest[i]: what the terms from the i-th on can add
    rest = np.append(np.cumsum(bound[order][::-1])[::-1], 0)
    best_ids = np.empty(0, dtype=np.int64)
    best = np.empty(0, dtype=np.int64)
    for start in range(0, len(ids), BLOCK_ROWS):
        block = slice(start, start + BLOCK_ROWS)
        least = best[-1] if len(best) == k else None
        essential = len(order)
        if least is not None:
            essential = max(1, int(np.count_nonzero(rest[:-1] >= least)))
        terms = order[:essential]
        held = np.flatnonzero(ids[block] != own) + start
        if least is not None and least > 0 and essential < len(order):
            held = held[(postings[np.ix_(held, terms)] != 0).any(axis=1)]
        total = postings[np.ix_(held, terms)] @ query[terms]
        while essential < len(order):
            stay = total + rest[essential] >= least
            held, total = held[stay], total[stay]
            terms = order[essential : essential + PROBE_TERMS]
            total = total + postings[np.ix_(held, terms)] @ query[terms]
            essential += len(terms)
        best_ids = np.concatenate([best_ids, ids[held]])
        best = np.concatenate([best, total.astype(np.int64)])
        top = np.lexsort((best_ids, -best))[:k]
        best_ids, best = best_ids[top], best[top]
    return best_ids, best


def top_k(
    vectors: DataFrame,
    is_query: Column,
    *,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    scale: int = 1024,
    k: int = 10,
    queries_per_block: int = 4096,
    rows_per_shard: int = 16384,
) -> DataFrame:
    """query_id, rank from 1, id and score of the k best rows for each query id, rows of that id excluded.

    Equal rows are counted before they are dealt to cells, and at most k of them can be among the k best."""
    reach_workers(vectors.sparkSession)
    rows = (
        vectors.where(F.col(id_column).isNotNull())
        .select(
            F.col(id_column).cast("long").alias("id"),
            is_query.alias("asks"),
            as_terms(F.col(vector_column), scale).alias("terms"),
        )
        .where(F.col("terms").isNotNull())
        .groupBy("id", "terms")
        .agg(F.max("asks").alias("asks"), F.count("*").alias("n"))
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.least(F.col("n"), F.lit(k)).cast("int"))))
    )
    n_rows, n_queries, width = (
        vectors.where(F.col(id_column).isNotNull())
        .agg(
            F.count("*"),
            F.count_if(is_query),
            F.max(F.greatest(F.size(vector_column), F.lit(0))),
        )
        .first()
    )
    n_shards = max(1, math.ceil(n_rows / rows_per_shard))
    n_blocks = max(1, math.ceil(n_queries / queries_per_block))
    width = width or 0

    def search(_: tuple, asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        found = {"query_id": [], "vec_id": [], "score": []}
        if len(asked) and len(held):
            queries, postings = _matrix(asked["terms"], width), _matrix(held["terms"], width)
            ids = held["id"].to_numpy(dtype=np.int64)
            largest = float(np.abs(queries.astype(float)).max()) * float(np.abs(postings.astype(float)).max()) * width
            kind = np.float64 if largest < EXACT else np.int64 if largest < 2**62 else object
            queries, postings = queries.astype(kind), postings.astype(kind)
            for own, query in zip(asked["id"].to_numpy(), queries, strict=True):
                best_ids, best = max_score(query, own, ids, postings, k)
                found["query_id"].append(np.full(len(best), own))
                found["vec_id"].append(best_ids)
                found["score"].append(best)
        return pd.DataFrame(
            {n: np.concatenate([np.empty(0, dtype=np.int64), *v]) for n, v in found.items()}
        )

    asked = rows.where("asks").select(
        "id",
        "terms",
        F.pmod(F.xxhash64("id", "terms", "copy"), F.lit(n_blocks)).alias("block"),
        F.explode(_numbers(n_shards)).alias("shard"),
    )
    held = rows.select(
        "id",
        "terms",
        F.explode(_numbers(n_blocks)).alias("block"),
        F.pmod(F.xxhash64(F.lit(1), "id", "terms", "copy"), F.lit(n_shards)).alias("shard"),
    )
    cells = (
        asked.groupBy("block", "shard")
        .cogroup(held.groupBy("block", "shard"))
        .applyInPandas(search, "query_id long, vec_id long, score long")
    )
    best_first = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        cells.withColumn("rank", F.row_number().over(best_first))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", F.col("vec_id").alias(id_column), "score")
    )
