"""Structured Streaming twins of the windowed operators; run with availableNow they end with the batch answer."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..session import drop_at_end, shared_folder

WATERMARK = "40 days"


def event_stream(spark: SparkSession, path: str) -> DataFrame:
    """The event table as a stream; event times become timestamps in UTC, which watermarks need. A single file is read through its folder."""
    schema = spark.read.parquet(path).schema
    folder, _, name = path.rpartition("/")
    reader = spark.readStream.schema(schema)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(hadoop).isDirectory():
        stream = reader.parquet(path)
    else:
        stream = reader.option("pathGlobFilter", name).parquet(folder)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def tumbling(events: DataFrame, size: str = "1 day", watermark: str = WATERMARK) -> DataFrame:
    g = events.withWatermark("ts", watermark).groupBy(F.window("ts", size).alias("w"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return g.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), "event_type", "n", "total")


def sliding(events: DataFrame, size: str = "1 day", slide: str = "6 hours", watermark: str = WATERMARK) -> DataFrame:
    g = events.withWatermark("ts", watermark).groupBy(F.window("ts", size, slide).alias("w"), "event_type").agg(F.count("*").alias("n"))
    return g.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), "event_type", "n")


def sessions(events: DataFrame, gap: str, watermark: str = WATERMARK) -> DataFrame:
    g = events.withWatermark("ts", watermark).groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count("*").alias("n"))
    return g.select("user_id", F.col("w.start").cast("timestamp_ntz").alias("session_start"), "n")


def outbox(events: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """Events of an at-least-once source (each sent twice) kept once by their key within the watermark."""
    twice = events.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    return twice.withWatermark("ts", watermark).dropDuplicatesWithinWatermark(["event_id"]).drop("copy")


def breaker(events: DataFrame, key: str, failed: Column, watermark: str = WATERMARK, **settings: float) -> DataFrame:
    """``key, at, state``: every change of each key's circuit breaker, from a state of four values a key that outlives the batches.

    Events of a key within one batch are taken in order of time; one that comes
    after later ones have been seen in an earlier batch is taken when it comes.
    """
    import pickle

    import pandas as pd

    from ..operators.runs import Breaker

    def run(keys, pdfs, state):
        b = Breaker(**settings)
        if state.exists:
            b.__dict__.update(pickle.loads(state.get[0]))
        rows = pd.concat(list(pdfs)).sort_values(["t", "failed"], kind="stable")
        out = [(keys[0], int(t), new) for t, bad in zip(rows["t"], rows["failed"]) if (new := b.see(t / 1e6, bool(bad)))]
        state.update((pickle.dumps(b.__dict__),))
        yield pd.DataFrame({"key": [x[0] for x in out], "t": pd.Series([x[1] for x in out], dtype="int64"), "state": [x[2] for x in out]})

    rows = events.withWatermark("ts", watermark).select(F.col(key).cast("string").alias("key"), F.unix_micros("ts").alias("t"), F.coalesce(failed, F.lit(False)).alias("failed")).where("key is not null and t is not null")
    made = rows.groupBy("key").applyInPandasWithState(run, "key string, t long, state string", "b binary", "append", "NoTimeout")
    return made.select("key", F.timestamp_micros("t").alias("at"), "state")


def drained(stream: DataFrame, mode: str, keys: list[str] | None = None) -> DataFrame:
    """Runs a streaming query over all available input into a table in the shared folder and reads it back.

    In complete mode every micro-batch replaces the table. In append and update
    mode each batch has its own folder, written whole or not at all, so a
    repeated batch after a failure changes nothing; in update mode the last batch
    of a key counts, and windows behind the watermark leave the state. Session
    windows know no update mode. The folder goes when the session ends.
    """
    spark = stream.sparkSession
    base = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/out/batch={0 if mode == 'complete' else number}")

    q = stream.writeStream.outputMode(mode).foreachBatch(put).option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start()
    q.awaitTermination()
    drop_at_end(spark, base)
    out = spark.read.schema(StructType([*stream.schema.fields, StructField("batch", IntegerType())])).option("basePath", f"{base}/out").parquet(f"{base}/out")
    if mode != "update":
        return out.drop("batch")
    rest = [c for c in stream.columns if c not in keys]
    return out.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("r")).select(*keys, "r.*")
