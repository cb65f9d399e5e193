"""Vector-store algebra: differences, dimension checks, exact similarity search."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 2_000


def dimension_check(vectors: DataFrame, dimension: int) -> DataFrame:
    """Vectors of another dimension, with nulls or non-finite values, or of length zero."""
    v = F.col("embedding")
    bad = F.when(v.isNull(), "null").when(F.size(v) != dimension, "dimension").when(F.exists(v, lambda x: x.isNull() | F.isnan(x)), "not_finite").when(F.forall(v, lambda x: x == 0), "zero")
    return vectors.select("vec_id", bad.alias("problem")).where("problem is not null")


def cosine_topk(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """``query_id, vec_id, rank, similarity``: the exact k nearest of each query by cosine, itself left out.

    Queries and vectors are cut into blocks of about BLOCK rows by hash. Each
    vector block meets each query block once as one matrix product that leaves
    only k rows a query, and the k best of all blocks are kept. Vectors that
    are null or zero have no neighbours. Ties go by id.
    """
    n, m = (max(1, int(np.ceil(x.count() / BLOCK))) for x in (vectors, queries))
    usable = F.col("embedding").isNotNull() & ~F.forall("embedding", lambda x: x == 0)
    v = vectors.where(usable).select("vec_id", "embedding", F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int").alias("b")).withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(m - 1)))).withColumn("is_query", F.lit(False))
    q = queries.where(usable).select("vec_id", "embedding", F.pmod(F.xxhash64("vec_id"), F.lit(m)).cast("int").alias("q")).withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).withColumn("is_query", F.lit(True))

    def best(pdf: pd.DataFrame) -> pd.DataFrame:
        asked, held = pdf[pdf.is_query], pdf[~pdf.is_query]
        cols = ["query_id", "vec_id", "similarity"]
        if asked.empty or held.empty:
            return pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"), "similarity": pd.Series(dtype="float64")})
        unit = lambda e: (x := np.stack(e.to_numpy()).astype(np.float64)) / np.linalg.norm(x, axis=1, keepdims=True)
        ids, keys = held.vec_id.to_numpy(), asked.vec_id.to_numpy()
        s = unit(asked.embedding) @ unit(held.embedding).T
        s[keys[:, None] == ids[None, :]] = -np.inf
        order = np.lexsort((np.broadcast_to(ids, s.shape), -s), axis=1)[:, :k]
        out = pd.DataFrame({"query_id": np.repeat(keys, order.shape[1]), "vec_id": ids[order].ravel(), "similarity": np.take_along_axis(s, order, 1).ravel()})
        return out[np.isfinite(out.similarity)][cols]

    near = q.unionByName(v.select("vec_id", "embedding", "q", "b", "is_query")).groupBy("b", "q").applyInPandas(best, "query_id long, vec_id long, similarity double")
    from pyspark.sql.window import Window

    w = Window.partitionBy("query_id").orderBy(F.desc("similarity"), "vec_id")
    return near.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
