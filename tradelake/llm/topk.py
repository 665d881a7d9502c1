"""Exact top-k inner-product search by pivot-table elimination.

Vectors are scaled to whole numbers. One more coordinate gives all candidates the same
norm, so that the largest inner product is the smallest Euclidean distance. Distances
of every vector to a fixed set of pivots are computed once; for a query and a candidate
the largest difference of their distances to a pivot bounds their distance from below.
Within a block, candidates are evaluated in the order of that bound until it exceeds
the k-th best distance found, or the one that a fixed sample of all vectors allows.

Vectors that are null, or hold null or non-finite components, take no part, nor do
rows without an id. Vectors of different length are not compared. A query id that
occurs more than once is asked once, with its smallest vector; repeated candidates
count each. Ties go to the smaller id. An empty table gives an empty result.
Components are taken to be below 2**31 after scaling; sums are exact up to 2**63.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tradelake.llm.common import by_batch, stored

PIVOTS = 32
PIVOT_SAMPLE = 2000
QUERY_BLOCK = 2048
VECTOR_BLOCK = 8192
#: Candidates evaluated at first; each further step takes twice as many, up to a limit.
STEP, MOST = 128, 2048


def scaled(vectors: DataFrame, vec_id: str, embedding: str, scale: int = 256) -> DataFrame:
    """``vec_id, v`` of the vectors that take part, with whole-number components."""
    v = F.col(embedding)
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return (
        vectors.where(F.col(vec_id).isNotNull() & v.isNotNull() & ~F.coalesce(odd, F.lit(True)))
        .select(F.col(vec_id).cast("long").alias("vec_id"), F.transform(v, lambda x: F.floor(x.cast("double") * scale)).alias("v"))
    )


def spread_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Vectors far from each other, beginning with the longest."""
    if not len(sample):
        return sample
    chosen = [int(np.argmax((sample**2).sum(1)))]
    far = np.full(len(sample), np.inf)
    while len(chosen) < min(count, len(sample)):
        far = np.minimum(far, ((sample - sample[chosen[-1]]) ** 2).sum(1))
        if far.max() == 0:
            break
        chosen.append(int(np.argmax(far)))
    return sample[chosen]


def distances(vectors: np.ndarray, last: np.ndarray, pivots: np.ndarray, pivot_last: np.ndarray) -> np.ndarray:
    """Distance of each vector to each pivot, the added coordinate included."""
    squares = (vectors**2).sum(1)[:, None] + (pivots**2).sum(1) - 2 * vectors @ pivots.T
    return np.sqrt(np.maximum(squares, 0) + (last[:, None] - pivot_last) ** 2)


def product_kind(vectors: np.ndarray, queries: np.ndarray) -> type:
    """The number type in which inner products are exact."""
    largest = float(np.abs(vectors).max(initial=0)) * float(np.abs(queries).max(initial=0)) * max(1, vectors.shape[1])
    return np.float64 if largest < 2**53 else np.int64


def least_scores(q_ids: list[int], queries: np.ndarray, sample_ids: np.ndarray, sample: np.ndarray, k: int) -> list[int | None]:
    """For each query the ``k``-th best score in a sample, which its result reaches at least."""
    kind = product_kind(sample, queries)
    data, out = sample.astype(kind), []
    for one, query in zip(q_ids, queries):
        scores = (data @ query.astype(kind))[sample_ids != one]
        out.append(int(np.partition(scores, -k)[-k]) if len(scores) >= k else None)
    return out


def search_block(q_ids, queries, q_table, floors, x_ids, vectors, x_table, top_norm, k):
    """``query_id, vec_id, score`` of the best ``k`` of one block for each query.

    Candidates that cannot reach a query's floor, where it has one, may be left out.
    """
    kind = product_kind(vectors, queries)
    data = vectors.astype(kind)
    out: list[tuple[int, int, int]] = []
    for one, query, row, floor in zip(q_ids, queries, q_table, floors):
        bound = np.abs(x_table - row).max(1)
        order = np.argsort(bound, kind="stable")
        norm = float((query.astype(np.float64) ** 2).sum()) + top_norm
        slack = 1e-9 * norm + 1e-6
        ids, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        at, step, limit = 0, STEP, np.inf if floor is None else norm - 2.0 * floor + slack
        while at < len(order):
            if len(ids) == k:
                limit = min(limit, norm - 2.0 * float(scores[-1]) + slack)
            if bound[order[at]] ** 2 > limit:
                break
            chosen = order[at : at + step]
            at, step = at + step, min(2 * step, MOST)
            chosen = chosen[x_ids[chosen] != one]
            ids = np.concatenate([ids, x_ids[chosen]])
            scores = np.concatenate([scores, (data[chosen] @ query.astype(kind)).astype(np.int64)])
            best = np.lexsort((ids, -scores))[:k]
            ids, scores = ids[best], scores[best]
        out.extend((int(one), int(i), int(s)) for i, s in zip(ids, scores))
    return out


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = 5, vec_id: str = "vec_id", embedding: str = "embedding",
    scale: int = 256, query_block: int = QUERY_BLOCK, vector_block: int = VECTOR_BLOCK,
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` candidates with the largest inner product.

    Queries and candidates meet in blocks of about ``query_block`` and ``vector_block``
    rows; a block returns at most ``k`` rows per query. A query carries the ``k``-th best
    score of a bounded sample into every block, so that each begins with a bound. Only
    that sample, from which the pivots come, reaches the driver.
    """
    rows = stored(scaled(vectors, vec_id, embedding, scale), "vectors")
    asked = scaled(queries, vec_id, embedding, scale).groupBy("vec_id").agg(F.min("v").alias("v"))
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
    about = rows.agg(F.max(square).alias("norm"), F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("dim")).first()
    top_norm, dim = float(about.norm or 0.0), int(about.dim or 0)
    # A share that leaves about twice the sample goes to the sort, however many vectors there are.
    share = min(1.0, 2 * PIVOT_SAMPLE / max(1, int(about.n)))
    drawn = rows.where((F.size("v") == dim) & (F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30)) < int(share * (1 << 30))))
    taken = drawn.orderBy(F.xxhash64("vec_id"), "vec_id").limit(PIVOT_SAMPLE).collect()
    sample_ids = np.array([r.vec_id for r in taken], np.int64)
    sample = np.array([r.v for r in taken], np.int64).reshape(len(taken), dim)
    pivots = spread_pivots(sample.astype(np.float64), PIVOTS)
    pivot_last = np.sqrt(np.maximum(top_norm - (pivots**2).sum(1), 0))
    shared = rows.sparkSession.sparkContext.broadcast((sample_ids, sample))

    def floored(batch: pa.RecordBatch) -> dict[str, object]:
        ids, vs = batch.column("vec_id").to_pylist(), batch.column("v").to_pylist()
        floors: list[int | None] = [None] * len(ids)
        same = [i for i, v in enumerate(vs) if len(v) == dim]
        queries = np.array([vs[i] for i in same], np.int64).reshape(len(same), dim)
        for i, floor in zip(same, least_scores([ids[i] for i in same], queries, *shared.value, k)):
            floors[i] = floor
        return {"vec_id": ids, "v": vs, "floor": floors}

    asked = stored(by_batch(asked, floored, "vec_id long, v array<long>, floor long"), "queries")
    # How many blocks there are follows from the counts, so that each stays within memory.
    n_x = max(1, -(-int(about.n) // vector_block))
    n_q = max(1, -(-asked.count() // query_block))

    def dealt(key: str, count: int) -> Column:
        return F.pmod(F.xxhash64("vec_id", F.lit(key)), F.lit(count)).cast("long")

    def every(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long")))

    # Candidates with the same id would share a block; their number is that of repeated rows.
    left = asked.withColumn("q", dealt("q", n_q)).select("*", every(n_x).alias("x"))
    right = rows.withColumn("x", dealt("x", n_x)).select("*", every(n_q).alias("q"))
    # A cogroup does not cast its keys, and values of other types are dealt to other tasks.
    if any(left.schema[key].dataType != right.schema[key].dataType for key in ("q", "x")):
        raise TypeError("the block keys of both sides need one type")

    def meet(q: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int, int]] = []
        q_size, x_size = q.v.map(len), x.v.map(len)
        for size in sorted(set(q_size) & set(x_size)):
            a, b = q[q_size == size], x[x_size == size]
            qs = np.array(a.v.tolist(), np.int64).reshape(len(a), size)
            xs = np.array(b.v.tolist(), np.int64).reshape(len(b), size)
            p, p_last = (pivots, pivot_last) if size == dim else (pivots[:0, :size], pivot_last[:0])
            if not len(p):  # vectors of another length have the zero vector as their pivot
                p, p_last = np.zeros((1, size)), np.sqrt(np.array([top_norm]))
            xf, qf = xs.astype(np.float64), qs.astype(np.float64)
            x_table = distances(xf, np.sqrt(np.maximum(top_norm - (xf**2).sum(1), 0)), p, p_last)
            q_table = distances(qf, np.zeros(len(qf)), p, p_last)
            floors = [None if pd.isna(f) else int(f) for f in a.floor]
            out += search_block(a.vec_id.to_numpy(), qs, q_table, floors, b.vec_id.to_numpy(), xs, x_table, top_norm, k)
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype("int64")

    found = left.groupBy("q", "x").cogroup(right.groupBy("q", "x")).applyInPandas(meet, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
