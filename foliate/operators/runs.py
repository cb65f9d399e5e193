"""Extraction runs: last runs, error classes, summaries, failure windows, breakers, leases, throughput.

A run sent twice, equal in all columns, counts once. Order is the instant of
``started_at``; null instants come first, ties go by document and position.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Parts of messages by class of error.
HARDWARE = ("cuda-capable device(s) is/are busy or unavailable", "cudaerrornodevice", "no cuda-capable device is detected", "nvidia driver is not loaded")
MEMORY = ("out of memory", "cuda oom", "cudaerroroutofmemory", "cannot allocate memory", "killed process")
# Time-outs, lost connections and answers of 500 and above.
RETRYABLE = r"timed? ?out|timeout|connection|network|worker lost|\b(?:http|status)(?: code)?:? 5\d\d\b"


def distinct_runs(runs: DataFrame) -> DataFrame:
    return runs.dropDuplicates()


def started() -> Column:
    return F.try_to_timestamp(F.col("started_at"))


def order() -> Column:
    return F.struct(started().alias("s"), F.col("document_id"), F.col("document_position"), F.xxhash64("log_path", "completed_at", "pod_number", "status", "error").alias("h"))


def _holds(message: Column, markers: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for m in markers:
        out = out | F.contains(message, F.lit(m))
    return out


def error_class(message: Column) -> Column:
    """hardware before memory before retryable before other, by markers in the lower-case message; null without a message."""
    low = F.lower(message)
    return F.when(_holds(low, HARDWARE), "hardware").when(_holds(low, MEMORY), "memory").when(low.rlike(RETRYABLE), "retryable").when(message.isNotNull(), "other")


def last_runs(runs: DataFrame) -> DataFrame:
    """The last run per document: a keyed maximum, combined before the shuffle."""
    cols = F.struct(*[F.col(c) for c in runs.columns])
    return runs.where("document_id is not null").groupBy("document_id").agg(F.max_by(cols, order()).alias("r")).select("r.*")


def latest_per_hash(runs: DataFrame) -> DataFrame:
    cols = F.struct("sha256", "document_id", "status", "started_at")
    return runs.where("sha256 is not null").groupBy("sha256").agg(F.max_by(cols, order()).alias("r")).select("r.*")


# Kinds of failure that decide an attempt's outcome.
IDENTITY, RECOVERY, DOWNLOAD, REQUEST = "identity", "recovery", "download", "request"


def outcome(status: Column, failure: Column, returned_id: Column, attempts: Column, retries: int) -> Column:
    """ok; identity_unresolved if the task's identity failed and no id came back; retry while attempts are left, unless
    the result's download or the request itself failed; recoverable if the download failed; else error."""
    left = (attempts <= retries) & ((failure == RECOVERY) | ~F.coalesce(failure, F.lit("")).isin(DOWNLOAD, REQUEST))
    return F.when(status == "ok", "ok").when((failure == IDENTITY) & returned_id.isNull(), "identity_unresolved").when(left, "retry").when(failure == DOWNLOAD, "recoverable").otherwise("error")


def seconds_per_page(seconds: Column, pages: Column) -> Column:
    return F.when(seconds.isNotNull() & ~F.isnan(seconds) & (pages > 0), seconds / pages)


def sliding_failures(events: DataFrame, key: str, ts: str, failed: Column, seconds: int = 60, least: int = 3) -> DataFrame:
    """Failures at which at least ``least`` of the key's failures lie within the last ``seconds``, itself included."""
    f = events.where(failed).withColumn("__t", F.unix_micros(F.col(ts).cast("timestamp")))
    w = Window.partitionBy(key).orderBy("__t").rangeBetween(-seconds * 1_000_000, 0)
    return f.withColumn("failures", F.count("*").over(w)).where(F.col("failures") >= least).drop("__t")


class Breaker:
    """closed, open for ``cooldown`` seconds after ``least`` failures within ``window`` seconds, then half open until ``successes`` in a row."""

    def __init__(self, window: float = 60, least: int = 3, cooldown: float = 30, successes: int = 2):
        self.window, self.least, self.cooldown, self.successes = window, least, cooldown, successes
        self.state, self.failures, self.until, self.good = "closed", [], 0.0, 0

    def see(self, t: float, failed: bool) -> str | None:
        """Takes one event; returns the new state if it changed."""
        before = self.state
        if self.state == "open" and t >= self.until:
            self.state, self.good = "half_open", 0
        if failed:
            self.failures = [x for x in self.failures if x > t - self.window] + [t]
            if self.state == "half_open" or (self.state == "closed" and len(self.failures) >= self.least):
                self.state, self.until = "open", t + self.cooldown
        elif self.state == "half_open":
            self.good += 1
            if self.good >= self.successes:
                self.state, self.failures = "closed", []
        return self.state if self.state != before else None


def breaker_transitions(events: DataFrame, key: str, ts: str, failed: Column, **settings: float) -> DataFrame:
    """``key, at, state``: every change of each key's circuit breaker.

    Keys' events stream in order of time through one state each, so a hot key
    costs time but no memory.
    """

    def run(batches):
        held, b = None, None
        for pdf in batches:
            out = []
            for k, t, bad in zip(pdf["key"], pdf["t"], pdf["failed"]):
                if b is None or k != held:
                    held, b = k, Breaker(**settings)
                state = b.see(t / 1e6, bool(bad))
                if state:
                    out.append((k, t, state))
            yield pd.DataFrame(out, columns=["key", "t", "state"]).astype({"t": "int64"})

    rows = events.select(F.col(key).cast("string").alias("key"), F.unix_micros(F.col(ts).cast("timestamp")).alias("t"), F.coalesce(failed, F.lit(False)).alias("failed")).where("key is not null and t is not null")
    made = rows.repartition("key").sortWithinPartitions("key", "t", "failed").mapInPandas(run, "key string, t long, state string")
    return made.select("key", F.timestamp_micros("t").alias("at"), "state")


class Lease:
    """Claims of one run: granted if new, of the same owner, or after the lease has expired; a takeover is a new attempt."""

    def __init__(self, seconds: float = 300):
        self.seconds, self.owner, self.until, self.attempt = seconds, None, 0.0, 0

    def claim(self, t: float, who: str) -> tuple[bool, int]:
        granted = self.owner is None or self.owner == who or t >= self.until
        if granted:
            self.attempt += self.owner != who
            self.owner, self.until = who, t + self.seconds
        return granted, self.attempt


def fold_leases(events: list[tuple], seconds: float = 300) -> list[tuple]:
    """``(t, owner, granted, attempt)`` of the claims ``(t, owner)`` of one run in order."""
    lease = Lease(seconds)
    return [(t, who, *lease.claim(t, who)) for t, who in events]


def lease_claims(events: DataFrame, key: str, owner: str, ts: str, seconds: float = 300) -> DataFrame:
    """``key, at, owner, granted, attempt`` of every claim, folded per key in order of time; a key's claims stream through one state of three values."""

    def run(batches):
        held, lease = None, None
        for pdf in batches:
            out = []
            for k, t, who in zip(pdf["key"], pdf["t"], pdf["owner"]):
                if lease is None or k != held:
                    held, lease = k, Lease(seconds)
                out.append((k, t, who, *lease.claim(t / 1e6, who)))
            yield pd.DataFrame(out, columns=["key", "t", "owner", "granted", "attempt"]).astype({"t": "int64"})

    rows = events.select(F.col(key).cast("string").alias("key"), F.unix_micros(F.col(ts).cast("timestamp")).alias("t"), F.col(owner).cast("string").alias("owner")).where("key is not null and t is not null and owner is not null")
    made = rows.repartition("key").sortWithinPartitions("key", "t", "owner").mapInPandas(run, "key string, t long, owner string, granted boolean, attempt int")
    return made.select("key", F.timestamp_micros("t").alias("at"), "owner", "granted", "attempt")


def throughput_epochs(events: DataFrame, key: str, ts: str, amount: str, seconds: float = 120, samples: int = 16, settle: float = 30) -> DataFrame:
    """``key, epoch, begin, n, amount, rate``: windows that close after ``seconds`` and ``samples`` completions; the
    ``settle`` seconds after each are left out."""

    def run(batches):
        held, start, n, total, epoch = None, None, 0, 0.0, 0
        for pdf in batches:
            out = []
            for k, t, x in zip(pdf["key"], pdf["t"] / 1e6, pdf["x"]):
                if k != held:
                    held, start, n, total, epoch = k, t, 0, 0.0, 0
                if t < start:
                    continue
                n += 1
                total += 0.0 if pd.isna(x) else x
                if t - start >= seconds and n >= samples:
                    out.append((k, epoch, int(start * 1e6), n, total, total / (t - start) * 60))
                    epoch, start, n, total = epoch + 1, t + settle, 0, 0.0
            yield pd.DataFrame(out, columns=["key", "epoch", "begin", "n", "amount", "rate"]).astype({"epoch": "int32", "begin": "int64", "n": "int64", "amount": "float64", "rate": "float64"})

    rows = events.select(F.col(key).cast("string").alias("key"), F.unix_micros(F.col(ts).cast("timestamp")).alias("t"), F.col(amount).cast("double").alias("x")).where("key is not null and t is not null")
    made = rows.repartition("key").sortWithinPartitions("key", "t", "x").mapInPandas(run, "key string, epoch int, begin long, n long, amount double, rate double")
    return made.withColumn("begin", F.timestamp_micros("begin"))
