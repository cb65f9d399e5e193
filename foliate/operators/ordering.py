"""Global order without a single-task window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def with_global_index(df: DataFrame, keys: list[str], name: str = "index") -> DataFrame:
    """``df`` with its 0-based position in the order of ``keys``.

    Rows are range-partitioned by the keys; each partition's rank starts after
    the rows of the partitions before it, whose counts (one row a partition) are
    all that is gathered. Ties share no position but fall in any order.
    """
    from ..session import checkpointed

    parts = checkpointed(df.repartitionByRange(*keys).withColumn("__p", F.spark_partition_id()))
    starts = parts.groupBy("__p").count().withColumn("__s", F.coalesce(F.sum("count").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("__p", "__s")
    ranked = parts.withColumn("__r", F.row_number().over(Window.partitionBy("__p").orderBy(*keys)) - 1)
    return ranked.join(F.broadcast(starts), "__p").withColumn(name, F.col("__r") + F.col("__s")).drop("__p", "__r", "__s")
