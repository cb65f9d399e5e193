"""Queries on embeddings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import catalog, vectors
from ..session import table
from .base import query


@query("""SELECT coalesce(a.vec_id, b.vec_id) AS vec_id, CASE WHEN a.vec_id IS NULL THEN 'insert' WHEN b.vec_id IS NULL THEN 'delete' WHEN a.label <> b.label THEN 'update' ELSE 'keep' END AS action
    FROM (SELECT vec_id, label FROM embeddings WHERE label <> 3) a FULL JOIN (SELECT vec_id, CASE WHEN label = 5 THEN 50 ELSE label END AS label FROM embeddings WHERE label <> 4) b ON a.vec_id = b.vec_id""")
def vector_diff(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings").select("vec_id", "label")
    return catalog.diff(e.where("label <> 3"), e.where("label <> 4").withColumn("label", F.when(F.col("label") == 5, 50).otherwise(F.col("label"))), "vec_id", ["label"])


@query("SELECT vec_id, 'dimension' AS problem FROM embeddings WHERE len(embedding) <> 64")
def vector_dimension_check(spark: SparkSession, d: str) -> DataFrame:
    return vectors.dimension_check(table(spark, d, "embeddings"), 64)


@query("""WITH q AS (SELECT vec_id AS query_id, embedding::DOUBLE[] AS e FROM embeddings WHERE vec_id % 20 = 0), s AS (SELECT query_id, vec_id, list_cosine_similarity(q.e, v.embedding::DOUBLE[]) AS similarity FROM q JOIN embeddings v ON query_id <> vec_id)
    SELECT query_id, vec_id, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, vec_id) AS rank FROM s) WHERE rank <= 10""")
def cosine_topk(spark: SparkSession, d: str) -> DataFrame:
    """The ten nearest of every vector whose id is divisible by 20, among all vectors."""
    e = table(spark, d, "embeddings")
    return vectors.cosine_topk(e, e.where("vec_id % 20 = 0"), 10).select("query_id", "vec_id", "rank")
