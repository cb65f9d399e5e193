"""Sinks: inventories with their errors apart, JSON lines, upload plans, small driver files replaced as a whole."""

from __future__ import annotations

import json
import os
import tempfile

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import catalog


def write_table(df: DataFrame, path: str, csv: bool = False) -> None:
    """Parquet, and on request CSV with a header beside it. Spark's commit protocol makes the folder whole or absent."""
    df.write.mode("overwrite").parquet(path)
    if csv:
        flat = df.select(*[F.to_json(c).alias(c) if t.startswith(("array", "map", "struct")) else F.col(c) for c, t in df.dtypes])
        flat.write.mode("overwrite").option("header", True).option("escape", '"').csv(f"{path}.csv")


def write_inventory(inv: DataFrame, path: str) -> None:
    """Readable rows and errors apart, from one pass over a partitioned write."""
    inv.withColumn("part", F.when(F.col("status") == "ok", "inventory").otherwise("errors")).write.mode("overwrite").partitionBy("part").parquet(path)


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_json(value: object, path: str) -> None:
    """A small driver-side file, written beside its place and moved there."""
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    fd, temp = tempfile.mkstemp(dir=os.path.dirname(path) or ".")
    with os.fdopen(fd, "w", encoding="utf-8") as f:
        json.dump(value, f, ensure_ascii=False, sort_keys=True, indent=1)
        f.flush()
        os.fsync(f.fileno())
    os.replace(temp, path)


def upload_plan(wanted: DataFrame, existing: DataFrame) -> DataFrame:
    """Objects to send: those not there already with the same hash and size."""
    same = wanted["object_key"].eqNullSafe(existing["object_key"]) & wanted["sha256"].eqNullSafe(existing["sha256"]) & wanted["size"].eqNullSafe(existing["size"])
    return wanted.join(existing, same, "left_anti")


def download_conflicts(plan: DataFrame) -> DataFrame:
    """Destinations that more than one object would be written to."""
    return plan.groupBy("destination").agg(F.countDistinct("object_key").alias("n")).where("n > 1")


def vector_actions(existing: DataFrame, wanted: DataFrame) -> DataFrame:
    """Points to insert, update, delete or keep by chunk id."""
    return catalog.diff(existing, wanted, "chunk_id", ["content_hash"])
