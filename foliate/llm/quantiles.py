"""Problem 4: percentiles of very large numeric columns.

Values are quantized to a bounded ordered universe of 2**LEVELS leaves (sign,
binary exponent, 20 bits of mantissa: relative width 2**-20). A summary holds
counts of nodes of the dyadic tree over the leaves (a q-digest). Summaries of
partitions, days or files are merged by adding counts node by node. Every inner
node of a summary of n values holds at most n/k of them, so a rank is off by at
most LEVELS * floor(n/k), whatever the order or grouping of the merges.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import checkpointed

LEVELS = 28
MANTISSA = 20
# Binary exponents from -64 to 62; smaller magnitudes count as zero, larger ones as the last leaf.
EXPONENT = 64
HALF = 1 << (LEVELS - 1)
LEAVES = 1 << LEVELS
# Leaves of one subtree are compressed together; this bounds what a task holds.
SUBTREE = 18
EPSILON = 0.01
PERCENTILES = (0.01, 0.05, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99)


def leaf(x: Column) -> Column:
    """Position of a finite double in the universe; monotone: x <= y gives leaf(x) <= leaf(y)."""
    a = F.abs(x)
    e = F.least(F.greatest(F.floor(F.log2(a)), F.lit(-EXPONENT)), F.lit(EXPONENT - 2))
    m = F.least(F.greatest(F.floor((a / F.pow(F.lit(2.0), e) - 1.0) * (1 << MANTISSA)), F.lit(0)), F.lit((1 << MANTISSA) - 1))
    size = F.when(a < 2.0**-EXPONENT, F.lit(0)).otherwise((e + EXPONENT) * (1 << MANTISSA) + m + 1)
    return F.when(x < 0, HALF - size).otherwise(HALF + size).cast("long")


def value(at: Column) -> Column:
    """The value at the lower edge (in magnitude) of a leaf; exact for values of at most 20 mantissa bits."""
    size = F.abs(at - HALF) - 1
    e = F.floor(size / (1 << MANTISSA))
    m = F.pmod(size, F.lit(1 << MANTISSA))
    a = F.when(size < 0, F.lit(0.0)).otherwise(F.pow(F.lit(2.0), e - EXPONENT) * (1.0 + m / float(1 << MANTISSA)))
    return F.when(at < HALF, -a).otherwise(a)


def _compress(node: np.ndarray, count: np.ndarray, limit: int, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Bottom up from level ``high`` to ``low``: siblings and parent that hold at most ``limit`` together become the parent."""
    done_n, done_c = [], []
    upper = node < (1 << high)
    rest_n, rest_c = node[upper], count[upper]
    node, count = node[~upper], count[~upper]
    for level in range(high, low, -1):
        own = rest_n >= (1 << (level - 1))  # nodes already standing one level up
        parents, where = np.unique(np.concatenate([node >> 1, rest_n[own]]), return_inverse=True)
        total = np.zeros(len(parents), np.int64)
        np.add.at(total, where, np.concatenate([count, rest_c[own]]))
        joins = total <= limit
        stay = ~joins[where[: len(node)]]
        done_n.append(node[stay])
        done_c.append(count[stay])
        keep_own = ~joins[where[len(node) :]]
        node = np.concatenate([parents[joins], rest_n[own][keep_own]])
        count = np.concatenate([total[joins], rest_c[own][keep_own]])
        rest_n, rest_c = rest_n[~own], rest_c[~own]
    return np.concatenate([*done_n, node, rest_n]), np.concatenate([*done_c, count, rest_c])


def _steps(keys: list[str], k: int, low: int, high: int):
    """Compresses groups of ``keys`` (and ``root``) of partitions sorted by them, from level ``high`` to ``low``; one group is held at a time.

    Rows that no compression can change, of keys of fewer than k values or above the subtrees, pass batch by batch.
    """

    def close(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        first = parts[0].slice(0, 1)
        node, count = (np.concatenate([p.column(c).to_numpy() for p in parts]) for c in ("node", "c"))
        node, count = _compress(node, count, first.column("n")[0].as_py() // k, low, high)
        same = np.zeros(len(node), np.int64)
        return pa.RecordBatch.from_arrays([pa.array(node) if f.name == "node" else pa.array(count) if f.name == "c" else first.column(f.name).take(pa.array(same)) for f in first.schema], schema=first.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, parts = None, []
        for batch in batches:
            live = (batch.column("n").to_numpy() >= k) & (batch.column("root").to_numpy() != 0)
            if not live.all():
                yield batch.filter(pa.array(~live))
                batch = batch.filter(pa.array(live))
            if not batch.num_rows:
                continue
            change = np.zeros(batch.num_rows, bool)
            for c in (*keys, "root"):
                x = batch.column(c).dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
                change[1:] |= x[1:] != x[:-1]
            starts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
            for a, b in zip(starts, starts[1:]):
                piece = batch.slice(a, b - a)
                key = tuple(piece.column(c)[0].as_py() for c in (*keys, "root"))
                if parts and key != held:
                    yield close(parts)
                    parts = []
                held = key
                parts.append(piece)
        if parts:
            yield close(parts)

    return run


def compress(nodes: DataFrame, keys: list[str], k: int) -> DataFrame:
    """Node counts per ``keys``, compressed: at most about 3 * k + 2**(LEVELS - SUBTREE) nodes a key.

    The counts are written once. Subtrees of 2**SUBTREE leaves are compressed on
    their own, then the few nodes left are compressed up to the root, so no task
    ever holds more than a subtree, however many values one key has. Nodes of
    keys of fewer than k values pass as they are.
    """
    nodes = checkpointed(nodes)
    size = nodes.groupBy(*keys).agg(F.sum("c").alias("n"))
    same = None
    for c in keys:
        one = F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
        same = one if same is None else same & one
    top = LEVELS - SUBTREE
    # the ancestor at the level where subtrees are rooted; 0 for nodes above it, which the first step passes
    root = F.expr(f"case when a.node < {1 << top} then 0 else shiftright(a.node, cast(floor(log2(cast(a.node as double)) + 1e-12) as int) - {top}) end")
    sized = nodes.alias("a").join(size.alias("b"), same).select(*[F.col(f"a.{c}").alias(c) for c in keys], root.cast("long").alias("root"), F.col("a.node").alias("node"), F.col("a.c").alias("c"), F.col("b.n").alias("n"))
    sub = sized.repartition(*keys, "root").sortWithinPartitions(*keys, "root").mapInArrow(_steps(keys, k, top, LEVELS), sized.schema)
    whole = sub.withColumn("root", F.lit(1).cast("long")).repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_steps(keys, k, 0, top), sized.schema)
    return whole.select(*keys, "node", "c")


def measurements(runs: DataFrame) -> DataFrame:
    """``pod_number, day, metric, x``: every finite value of every distinct run.

    A row sent twice, equal in all columns, counts once; nulls, NaN and
    infinities do not count; zero, negative and absurd values do. Two 64-bit
    hashes of the row travel in the de-duplicating shuffle instead of the row.
    """
    cols = [F.col(f"`{c}`") for c in runs.columns]
    day = F.to_date(F.try_to_timestamp(F.col("started_at")))
    one = runs.select(F.xxhash64(*cols).alias("h1"), F.xxhash64(F.lit(1), *cols).alias("h2"), "pod_number", day.alias("day"), F.col("duration_seconds").alias("a"), F.col("seconds_per_page").alias("b")).dropDuplicates(["h1", "h2"])
    long = one.select("pod_number", "day", F.inline(F.array(F.struct(F.lit("duration_seconds").alias("metric"), F.col("a").alias("x")), F.struct(F.lit("seconds_per_page").alias("metric"), F.col("b").alias("x")))))
    return long.where("x is not null and not isnan(x) and abs(x) < double('infinity')")


def summaries(values: DataFrame, keys: list[str], epsilon: float = EPSILON) -> DataFrame:
    """``keys, node, c``: one mergeable summary per distinct ``keys``; equal leaves are combined before the shuffle."""
    leaves = values.select(*keys, (leaf(F.col("x")) + LEAVES).alias("node")).groupBy(*keys, "node").agg(F.count("*").alias("c"))
    return compress(leaves, keys, int(LEVELS / epsilon))


def merge(parts: DataFrame, keys: list[str], epsilon: float = EPSILON) -> DataFrame:
    """Summaries of finer keys merged to ``keys`` by node addition."""
    return compress(parts.groupBy(*keys, "node").agg(F.sum("c").alias("c")), keys, int(LEVELS / epsilon))


def percentiles(summary: DataFrame, keys: list[str], qs: tuple[float, ...] = PERCENTILES, epsilon: float = EPSILON) -> DataFrame:
    """``keys, q, value, n, rank_error``: nearest-rank percentiles, off by at most ``rank_error`` ranks.

    Nodes are walked in post-order (right end, narrow before wide). A summary has
    a bounded number of nodes, so one window partition is bounded too. Ties in
    value share a leaf. Empty input gives no rows.
    """
    level = F.floor(F.log2(F.col("node").cast("double")) + 1e-12)
    width = F.pow(F.lit(2.0), F.lit(LEVELS) - level)
    right = ((F.col("node") + 1) * width - 1 - LEAVES).cast("long")
    w = Window.partitionBy(*keys)
    cum = summary.select(*keys, "c", right.alias("right"), width.alias("width")).select(
        *keys, "right", F.sum("c").over(w.orderBy("right", "width").rowsBetween(Window.unboundedPreceding, 0)).alias("cum"), F.sum("c").over(w).alias("n")
    )
    asked = cum.select(*keys, "right", "cum", "n", F.explode(F.array(*[F.lit(float(q)) for q in qs])).alias("q")).where("cum >= greatest(1, ceil(q * n))")
    k = int(LEVELS / epsilon)
    return asked.groupBy(*keys, "q").agg(F.min("right").alias("at"), F.max("n").alias("n")).select(*keys, "q", value(F.col("at")).alias("value"), "n", (F.floor(F.col("n") / k) * LEVELS).cast("long").alias("rank_error"))


def pod_percentiles(runs: DataFrame, epsilon: float = EPSILON) -> DataFrame:
    """Summaries per pod and day, merged per pod; null pods are a group of their own."""
    daily = summaries(measurements(runs), ["pod_number", "metric", "day"], epsilon)
    keys = ["pod_number", "metric"]
    return percentiles(merge(daily, keys, epsilon), keys, epsilon=epsilon)


def bound_check(runs: DataFrame, epsilon: float = EPSILON) -> DataFrame:
    """``pod_number, metric, q, n, within``: whether each estimate's true ranks lie within the stated error."""
    est = pod_percentiles(runs, epsilon)
    v = measurements(runs)
    joined = v.alias("v").join(est.alias("e"), F.col("v.pod_number").eqNullSafe(F.col("e.pod_number")) & (F.col("v.metric") == F.col("e.metric")))
    at, x = leaf(F.col("e.value")), leaf(F.col("v.x"))
    ranked = joined.groupBy(F.col("e.pod_number").alias("pod_number"), F.col("e.metric").alias("metric"), F.col("e.q").alias("q"), F.col("e.n").alias("n"), F.col("e.rank_error").alias("rank_error")).agg(
        F.sum((x < at).cast("long")).alias("below"), F.sum((x <= at).cast("long")).alias("upto")
    )
    rank = F.greatest(F.lit(1), F.ceil(F.col("q") * F.col("n")))
    return ranked.select("pod_number", "metric", "q", "n", ((F.col("below") - F.col("rank_error") < rank) & (rank <= F.col("upto") + F.col("rank_error"))).alias("within"))
