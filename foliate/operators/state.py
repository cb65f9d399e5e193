"""State of catalogue and pipeline as tables: snapshots, plans, revalidation, manifests, packages, leases with fencing, reports."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import catalog


def create_if_absent(existing: DataFrame, wanted: DataFrame, key: str, content: list[str]) -> DataFrame:
    """``key, action`` per wanted row: insert, keep where the same contents stand already, conflict where others do."""
    h = F.xxhash64(*content)
    j = wanted.select(key, h.alias("b")).join(existing.select(key, h.alias("a")), key, "left")
    return j.select(key, F.when(F.col("a").isNull(), "insert").when(F.col("a") == F.col("b"), "keep").otherwise("conflict").alias("action"))


def insert_ignore(existing: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """Existing rows and those wanted ones whose key is new."""
    return existing.unionByName(wanted.join(existing.select(key), key, "left_anti"))


def promotion_candidates(latest: DataFrame, known: DataFrame, key: str, time: Column, since: Column) -> DataFrame:
    """The latest results not known yet, from a point in time on."""
    return latest.where(time >= since).join(known.select(key).distinct(), key, "left_anti")


def looked_up(wanted: DataFrame, listing: DataFrame, key: str) -> DataFrame:
    """All rows of ``wanted`` with ``found``: whether and how often its key is listed; a promoted inventory needs exactly one."""
    n = listing.groupBy(key).agg(F.count("*").alias("found"))
    return wanted.join(n, key, "left").withColumn("found", F.coalesce("found", F.lit(0)))


def revalidation(declared: DataFrame, previous: DataFrame, key: str, size: str) -> DataFrame:
    """Per package ``reuse``: whether the previous audit saw the same number of artefacts and of bytes."""
    now = declared.groupBy(key).agg(F.count("*").alias("artifacts"), F.sum(size).alias("bytes"))
    j = now.join(previous.select(key, F.col("artifacts").alias("a"), F.col("bytes").alias("b")), key, "left")
    return j.select(key, "artifacts", "bytes", F.coalesce((F.col("a") == F.col("artifacts")) & (F.col("b") == F.col("bytes")), F.lit(False)).alias("reuse"))


def merged_manifest(existing: DataFrame, replacements: DataFrame, document: str, key: str, value: str, position: str) -> DataFrame:
    """Entries of each manifest with those of ``replacements`` in their place, new ones after them in order of their key; ``duplicate`` marks keys that stand twice."""
    old = existing.select(document, key, F.col(value).alias("a"), F.col(position).alias("p"), (F.count("*").over(Window.partitionBy(document, key)) > 1).alias("duplicate"))
    j = old.join(replacements.select(document, key, F.col(value).alias("b"), F.lit(True).alias("new")), [document, key], "full")
    order = Window.partitionBy(document).orderBy(F.col("p").asc_nulls_last(), key)
    return j.select(document, key, F.when(F.col("new"), F.col("b")).otherwise(F.col("a")).alias(value), F.coalesce("duplicate", F.lit(False)).alias("duplicate"), (F.row_number().over(order) - 1).alias("place"))


def missing_references(references: DataFrame, package: DataFrame, keys: list[str]) -> DataFrame:
    """Referenced paths that are not in the package."""
    return references.select(*keys).distinct().join(package.select(*keys), keys, "left_anti")


def submission_errors(key: Column, files: Column, name: Column, declared: Column, actual: Column) -> Column:
    """What is wrong with a submission: the shape of its hashes, the number of files, the name of its file, its contents."""
    hexa = lambda c: F.lower(c).rlike("^[0-9a-f]{64}$")
    return F.array_compact(
        F.array(
            F.when(~F.coalesce(hexa(key), F.lit(False)), "key"), F.when(F.coalesce(files, F.lit(0)) != 1, "files"), F.when(~F.coalesce(hexa(declared), F.lit(False)), "declared_hash"),
            F.when(~F.coalesce(F.lower(name) == F.concat(F.lower(declared), F.lit(".pdf")), F.lit(False)), "name"), F.when(~F.lower(declared).eqNullSafe(F.lower(actual)), "content"),
        )
    )


def drift(before: DataFrame, after: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Per key how many rows of the two listings have no equal in the other; drift is any above zero."""
    h = F.xxhash64(*columns)
    both = before.select(key, h.alias("h"), F.lit(1).alias("d")).unionByName(after.select(key, h.alias("h"), F.lit(-1).alias("d")))
    per = both.groupBy(key, "h").agg(F.sum("d").alias("d"))
    return per.groupBy(key).agg(F.sum(F.abs("d")).cast("long").alias("different"))


def package_check(listing: DataFrame, hashes: DataFrame, package: str, path: str, value: str) -> DataFrame:
    """Per package whether files and hash map agree, and whether it holds an extraction JSON and a Markdown text."""
    j = listing.select(package, path, F.col(value).alias("a"), F.lit(1).alias("l")).join(hashes.select(package, path, F.col(value).alias("b"), F.lit(1).alias("r")), [package, path], "full")
    differs = F.col("l").isNull() | F.col("r").isNull() | ~F.col("a").eqNullSafe(F.col("b"))
    held = lambda suffix: F.count_if(F.col("l").isNotNull() & F.endswith(F.lower(path), F.lit(suffix)))
    g = j.groupBy(package).agg(F.count_if(differs).alias("different"), held("_middle.json").alias("json"), held(".md").alias("markdown"))
    return g.withColumn("valid", (F.col("different") == 0) & (F.col("json") == 1) & (F.col("markdown") >= 1))


def unused_ids(candidates: DataFrame, history: DataFrame, keys: list[str], terminal: Column) -> DataFrame:
    """Candidates that no history entry has closed for good."""
    return candidates.join(history.where(terminal).select(*keys).distinct(), keys, "left_anti")


def dump_report(listed: DataFrame, expected: DataFrame, key: list[str], size: str) -> DataFrame:
    """``key, verdict`` per file: ok, missing, extra or changed."""
    j = expected.select(*key, F.col(size).alias("a"), F.lit(1).alias("e")).join(listed.select(*key, F.col(size).alias("b"), F.lit(1).alias("l")), key, "full")
    return j.select(*key, F.when(F.col("l").isNull(), "missing").when(F.col("e").isNull(), "extra").when(~F.col("a").eqNullSafe(F.col("b")), "changed").otherwise("ok").alias("verdict"))


def duplicate_hashes(tasks: DataFrame, hash_: str, order: list[str]) -> DataFrame:
    """Tasks with ``duplicate``: whether an earlier task has their hash. Null hashes are none; keyed by hash, ordered as given."""
    w = Window.partitionBy(hash_).orderBy(*order)
    return tasks.withColumn("duplicate", F.col(hash_).isNotNull() & (F.row_number().over(w) > 1))


def last_after_reset(lines: DataFrame, key: str, position: str, reset: Column) -> DataFrame:
    """The last line of each key after the last line that resets the table; all lines if none does."""
    last = lines.agg(F.max(F.when(reset, F.col(position))).alias("__r"))
    after = lines.join(F.broadcast(last), F.col("__r").isNull() | (F.col(position) > F.col("__r"))).drop("__r")
    cols = [c for c in lines.columns if c != key]
    return after.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(F.struct(*cols), position).alias("r")).select(key, "r.*")


def snapshot_digests(inventory: DataFrame, group: str, line: Column, order: list[str]) -> DataFrame:
    """``group, n, sha256`` of each group's lines, each ended by a line feed, in order.

    A hash over a sequence has to see it in order; each group streams through
    one task from its sorted partition, and no line is held.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, h, out = None, 0, None, []
        for batch in batches:
            for g, x in zip(batch.column("g").to_pylist(), batch.column("x").to_pylist()):
                if h is None or g != held:
                    if h is not None:
                        out.append((held, n, h.hexdigest()))
                    held, n, h = g, 0, hashlib.sha256()
                n += 1
                h.update(f"{x}\n".encode())
        if h is not None:
            out.append((held, n, h.hexdigest()))
        cols = list(zip(*out)) or [()] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.string()))], ["g", "n", "sha256"])

    rows = inventory.select(F.col(group).alias("g"), line.alias("x"), *[F.col(c).alias(f"o{i}") for i, c in enumerate(order)]).where("x is not null")
    made = rows.repartition("g").sortWithinPartitions("g", *[f"o{i}" for i in range(len(order))], "x").select("g", "x").mapInArrow(run, "g string, n long, sha256 string")
    return made.select(F.col("g").alias(group), "n", "sha256")


# The states in which a run has ended.
TERMINAL = ("completed", "failed", "cancelled")


class Run:
    """One stage run under a lease: claims, heartbeats, transitions, completion and failure, fenced by owner and attempt."""

    def __init__(self, lease: float):
        self.lease, self.status, self.owner, self.attempt, self.until = lease, "accepted", None, 0, 0.0

    def see(self, t: float, owner: str, attempt: int | None, what: str) -> str:
        """``granted``, ``applied`` or ``no_op``, else why it is refused: ``held``, ``stale``, ``ended`` or ``invalid``."""
        if what == "claim":
            if self.status in TERMINAL:
                return "ended"
            if self.owner not in (None, owner) and t < self.until:
                return "held"
            self.attempt += self.owner != owner or t >= self.until
            self.owner, self.until = owner, t + self.lease
            return "granted"
        if self.owner != owner or attempt is not None and attempt != self.attempt:
            return "stale"
        if what == "heartbeat":
            if self.status in TERMINAL:
                return "ended"
            self.until = t + self.lease
            return "applied"
        if what in ("completed", "failed"):
            if self.status == what:
                return "no_op"
            if self.status in TERMINAL or what == "completed" and self.status != "cataloging":
                return "ended" if self.status in TERMINAL else "invalid"
            self.status, self.until = what, t
            return "applied"
        order = catalog.PROGRESS
        if self.status == what or what in order and (self.status == "completed" or self.status in order and order[what] < order[self.status]):
            return "no_op"
        if what not in catalog.TRANSITIONS.get(self.status, ()):
            return "invalid"
        self.status, self.until = what, t + self.lease
        if what == "orphaned":
            self.owner, self.until = None, t
        return "applied"


def fenced_runs(events: DataFrame, lease: float = 300) -> DataFrame:
    """``run, t, owner, what, verdict, status, attempt`` of every event ``run, t, owner, attempt, what`` (t in seconds).

    Events of a run stream in order of time through one ``Run``; a hot run costs time but no memory. Rows with a null run, time or owner are left out.
    """

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, state = None, None
        for pdf in batches:
            out = []
            for run, t, owner, attempt, what in zip(pdf["run"], pdf["t"], pdf["owner"], pdf["attempt"], pdf["what"]):
                if state is None or run != held:
                    held, state = run, Run(lease)
                verdict = state.see(t, owner, None if pd.isna(attempt) else int(attempt), what)
                out.append((run, t, owner, what, verdict, state.status, state.attempt))
            yield pd.DataFrame(out, columns=["run", "t", "owner", "what", "verdict", "status", "attempt"])

    rows = events.select("run", F.col("t").cast("double").alias("t"), "owner", F.col("attempt").cast("int").alias("attempt"), "what").where("run is not null and t is not null and owner is not null")
    return rows.repartition("run").sortWithinPartitions("run", "t", "owner", "what").mapInPandas(fold, "run string, t double, owner string, what string, verdict string, status string, attempt int")


def resolved_assets(references: DataFrame, listing: DataFrame, group: str, reference: str, path: str) -> DataFrame:
    """``group, reference, resolved``: the listed path of each reference: the reference itself, below images, by its name
    alone, else the first listed path of the group that ends with its name; null if there is none."""
    name = F.substring_index(reference, "/", -1)
    r = references.select(group, reference).distinct()
    tried = r.select(group, reference, F.posexplode(F.array(F.col(reference), F.concat(F.lit("images/"), name), name)).alias("rank", path))
    listed = listing.select(group, path).distinct()
    direct = tried.join(listed, [group, path]).select(group, reference, F.struct("rank", F.col(path).alias("p")).alias("hit"))
    below = r.withColumn("__n", name).join(listed.withColumn("__n", F.substring_index(path, "/", -1)), [group, "__n"]).select(group, reference, F.struct(F.lit(3).alias("rank"), F.col(path).alias("p")).alias("hit"))
    best = direct.unionByName(below).groupBy(group, reference).agg(F.min("hit")["p"].alias("resolved"))
    return r.join(best, [group, reference], "left")
