"""Vector search: exact scores in the JVM, the k best by a heap per task."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siftwork.functions.values import dot, l2_normalize


def top_k(df: DataFrame, query: Sequence[float], k: int, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, score): the k rows of highest cosine with the query, ties by id. Sorted and cut in each task before the few
    survivors meet."""
    if k <= 0:
        raise ValueError("k must be positive")
    q = l2_normalize(F.array(*[F.lit(float(x)) for x in query]))
    return df.select(id_col, dot(l2_normalize(vector), q).alias("score")).orderBy(F.desc("score"), id_col).limit(k)


#: Query vectors of one block; each block is one pass over all rows.
BLOCK = 1_000


def top_k_many(df: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, id, score): for each query row the k rows of highest cosine among all of ``df``, ties by id.

    The queries are held in blocks of 1,000. Each task scores its batches against a block by one matrix product and keeps
    the k best of each query so far, so it emits k rows a query, whatever it reads; a window takes the k best of those.
    Rows with a null id or vector are left out; a zero vector scores 0.
    """
    if k <= 0:
        raise ValueError("k must be positive")
    kind = df.schema[id_col].dataType.simpleString()
    shape = f"query_id {kind}, {id_col} {kind}, score double"
    rows = df.select(id_col, vector).where(F.col(id_col).isNotNull() & F.col(vector).isNotNull())
    asked = queries.select(id_col, vector).where(F.col(id_col).isNotNull() & F.col(vector).isNotNull())
    block: list = []
    out = None

    def search(held: list) -> DataFrame:
        keys = [r[0] for r in held]
        q = np.array([r[1] for r in held], dtype=np.float64)
        q /= np.maximum(np.linalg.norm(q, axis=1, keepdims=True), 1e-12)
        shared = df.sparkSession.sparkContext.broadcast((keys, q))

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            names, unit = shared.value
            best = [(np.zeros(0), np.zeros(0, dtype=object)) for _ in names]
            for b in batches:
                if not len(b):
                    continue
                v = np.array(b[vector].tolist(), dtype=np.float64)
                v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
                scores, ids = unit @ v.T, b[id_col].to_numpy(dtype=object)
                for i, (old, who) in enumerate(best):
                    s, w = np.concatenate([old, scores[i]]), np.concatenate([who, ids])
                    if len(s) > k:  # all that reach the k-th score, then ties by id
                        some = np.flatnonzero(s >= np.partition(s, len(s) - k)[len(s) - k])
                        s, w = s[some], w[some]
                        order = sorted(range(len(s)), key=lambda j: (-s[j], w[j]))[:k]
                        s, w = s[order], w[order]
                    best[i] = (s, w)
            for name, (s, w) in zip(names, best):
                if len(s):
                    yield pd.DataFrame({"query_id": [name] * len(s), id_col: w, "score": s})

        return rows.mapInPandas(run, shape)

    for r in asked.toLocalIterator():
        block.append((r[0], r[1]))
        if len(block) == BLOCK:
            part = search(block)
            out, block = part if out is None else out.unionByName(part), []
    if block or out is None:
        part = search(block) if block else df.sparkSession.createDataFrame([], shape)
        out = part if out is None else out.unionByName(part)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), id_col))
    return out.withColumn("_r", rank).where(F.col("_r") <= k).drop("_r")


def norm_report(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """(n, least, most, mean, not_finite): norms of the vectors."""
    from siftwork.functions.values import norm

    n = norm(vector)
    return df.agg(F.count("*").alias("n"), F.min(n).alias("least"), F.max(n).alias("most"), F.avg(n).alias("mean"), F.count_if(F.isnan(n)).alias("not_finite"))
