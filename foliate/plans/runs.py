"""Queries on extraction runs and on the event stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import inventory, runs
from ..session import table
from ..streaming import streams
from .base import query

_R = "(SELECT DISTINCT * FROM runs)"
_LAST = f"(SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY try_cast(started_at AS TIMESTAMPTZ) DESC NULLS LAST, document_position DESC NULLS LAST) AS rn FROM {_R} WHERE document_id IS NOT NULL) WHERE rn = 1)"
_X = "(duration_seconds IS NOT NULL AND NOT isnan(duration_seconds))"
_CLASS = """CASE WHEN regexp_matches(lower(error), 'cuda-capable device\\(s\\) is/are busy or unavailable|cudaerrornodevice|no cuda-capable device is detected|nvidia driver is not loaded') THEN 'hardware'
    WHEN regexp_matches(lower(error), 'out of memory|cuda oom|cudaerroroutofmemory|cannot allocate memory|killed process') THEN 'memory' WHEN regexp_matches(lower(error), 'timed? ?out|timeout|connection|network|worker lost|\\b(?:http|status)(?: code)?:? 5\\d\\d\\b') THEN 'retryable' WHEN error IS NOT NULL THEN 'other' END"""
# Messages as these classes of failure give them, dealt over the runs that failed.
_MESSAGES = ("CUDA error: no CUDA-capable device is detected", "torch.OutOfMemoryError: CUDA out of memory", "meeting room", "device code expired", "Killed process 17", "HTTP 503", "ReadTimeout")


def _r(spark: SparkSession, d: str) -> DataFrame:
    return runs.distinct_runs(table(spark, d, "runs"))


def _finite(c: str):
    return F.col(c).isNotNull() & ~F.isnan(c)


@query(f"SELECT coalesce(status, 'pending') AS status, backend, count(*) AS n, count(DISTINCT document_id) AS documents FROM {_R} GROUP BY 1, 2")
def status_histogram(spark: SparkSession, d: str) -> DataFrame:
    return _r(spark, d).groupBy(F.coalesce("status", F.lit("pending")).alias("status"), "backend").agg(F.count("*").alias("n"), F.countDistinct("document_id").alias("documents"))


@query(f"""SELECT pod_number, count(*) AS n, CAST(sum(CASE WHEN status = 'ok' THEN 1 ELSE 0 END) AS BIGINT) AS ok, CAST(sum(CASE WHEN status <> 'ok' THEN 1 ELSE 0 END) AS BIGINT) AS failed, CAST(sum(coalesce(page_count, 0)) AS DOUBLE) AS pages,
    round(sum(CASE WHEN status = 'ok' THEN coalesce(page_count, 0) END) / nullif(sum(CASE WHEN status = 'ok' AND {_X} AND duration_seconds > 0 THEN duration_seconds END), 0) * 60, 6) AS pages_per_minute FROM {_R} GROUP BY 1""")
def run_summary(spark: SparkSession, d: str) -> DataFrame:
    ok = F.col("status") == "ok"
    busy = F.sum(F.when(ok & _finite("duration_seconds") & (F.col("duration_seconds") > 0), F.col("duration_seconds")))
    return _r(spark, d).groupBy("pod_number").agg(
        F.count("*").alias("n"), F.count_if(ok).alias("ok"), F.count_if(F.col("status") != "ok").alias("failed"), F.sum(F.coalesce("page_count", F.lit(0.0))).alias("pages"),
        F.round(F.sum(F.when(ok, F.coalesce("page_count", F.lit(0.0)))) / F.nullif(busy, F.lit(0.0)) * 60, 6).alias("pages_per_minute"),
    )


@query(f"SELECT document_id, status, started_at, pod_number FROM {_LAST}")
def last_run(spark: SparkSession, d: str) -> DataFrame:
    return runs.last_runs(_r(spark, d)).select("document_id", "status", "started_at", "pod_number")


@query(f"SELECT sha256, document_id, status, started_at FROM (SELECT *, row_number() OVER (PARTITION BY sha256 ORDER BY try_cast(started_at AS TIMESTAMPTZ) DESC NULLS LAST, document_id DESC, document_position DESC) AS rn FROM {_R} WHERE sha256 IS NOT NULL) WHERE rn = 1")
def latest_per_hash(spark: SparkSession, d: str) -> DataFrame:
    return runs.latest_per_hash(_r(spark, d))


@query(f"SELECT pod_number, quantile_disc(duration_seconds, 0.95) AS p95, quantile_disc(duration_seconds, 0.5) AS p50, count(*) AS n FROM {_R} WHERE {_X} GROUP BY 1")
def latency_nearest_rank(spark: SparkSession, d: str) -> DataFrame:
    return _r(spark, d).where(_finite("duration_seconds")).groupBy("pod_number").agg(F.expr("percentile_disc(0.95) WITHIN GROUP (ORDER BY duration_seconds)").alias("p95"), F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY duration_seconds)").alias("p50"), F.count("*").alias("n"))


_MIXED = f"(SELECT status, CASE CAST(document_position % 8 AS INTEGER) {' '.join(f'WHEN {i} THEN {chr(39)}{m}{chr(39)}' for i, m in enumerate(_MESSAGES))} ELSE error END AS error FROM {_R} WHERE error IS NOT NULL)"


@query(f"SELECT error, {_CLASS} AS class, count(*) AS n FROM (SELECT error FROM {_MIXED} UNION ALL SELECT error FROM {_R} WHERE error IS NOT NULL) GROUP BY 1, 2")
def error_classes(spark: SparkSession, d: str) -> DataFrame:
    """Classes of the messages of failed runs as they are, and of such runs with messages of every class in their place."""
    r = _r(spark, d).where("error is not null")
    mixed = F.coalesce(F.get(F.array(*map(F.lit, _MESSAGES)), (F.col("document_position") % 8).cast("int")), F.col("error"))
    both = r.select(mixed.alias("error")).unionByName(r.select("error"))
    return both.groupBy("error", runs.error_class(F.col("error")).alias("class")).agg(F.count("*").alias("n"))


@query(f"""WITH a AS (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY try_cast(started_at AS TIMESTAMPTZ), document_position, log_path, completed_at) AS attempts, CASE error WHEN 'timed out' THEN 'download' WHEN 'HTTP 502 from worker' THEN 'recovery' WHEN 'worker lost' THEN 'identity' END AS failure FROM {_R})
    SELECT CASE WHEN status = 'ok' THEN 'ok' WHEN failure = 'identity' AND return_code IS DISTINCT FROM 1 THEN 'identity_unresolved' WHEN attempts <= 3 AND (failure = 'recovery' OR coalesce(failure, '') NOT IN ('download', 'request')) THEN 'retry' WHEN failure = 'download' THEN 'recoverable' ELSE 'error' END AS outcome, count(*) AS n FROM a GROUP BY 1""")
def attempt_outcomes(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql.window import Window

    n = F.row_number().over(Window.partitionBy("document_id").orderBy(runs.started(), "document_position", "log_path", "completed_at"))
    failure = F.when(F.col("error") == "timed out", runs.DOWNLOAD).when(F.col("error") == "HTTP 502 from worker", runs.RECOVERY).when(F.col("error") == "worker lost", runs.IDENTITY)
    returned = F.when(F.col("return_code") == 1, F.lit("id"))
    return _r(spark, d).withColumn("attempts", n).groupBy(runs.outcome(F.col("status"), failure, returned, F.col("attempts"), 3).alias("outcome")).agg(F.count("*").alias("n"))


@query(f"SELECT DISTINCT i.document_id, i.path FROM inventory i WHERE i.document_id IN (SELECT document_id FROM {_LAST} WHERE status <> 'ok')")
def retry_manifest(spark: SparkSession, d: str) -> DataFrame:
    failed = runs.last_runs(_r(spark, d)).where("status <> 'ok'").select("document_id")
    return table(spark, d, "inventory").select("document_id", "path").distinct().join(failed, "document_id", "left_semi")


@query(f"SELECT DISTINCT document_id, output_dir FROM {_R} WHERE document_id NOT IN (SELECT document_id FROM inventory WHERE document_id IS NOT NULL)")
def orphan_outputs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "runs").select("document_id", "output_dir").where("document_id is not null").distinct().join(table(spark, d, "inventory").select("document_id"), "document_id", "left_anti")


@query(f"""SELECT (SELECT count(DISTINCT document_id) FROM inventory) AS documents, count(*) AS with_runs, CAST(sum(CASE WHEN status = 'ok' AND generated_files > 0 THEN 0 ELSE 1 END) AS BIGINT) AS pending_or, CAST(sum(CASE WHEN status <> 'ok' AND coalesce(generated_files, 0) = 0 THEN 1 ELSE 0 END) AS BIGINT) AS pending_and FROM {_LAST}""")
def pending_counts(spark: SparkSession, d: str) -> DataFrame:
    """Both definitions of pending: not ok or nothing generated, and not ok and nothing generated."""
    last = runs.last_runs(_r(spark, d))
    done = (F.col("status") == "ok") & (F.col("generated_files") > 0)
    none = (F.col("status") != "ok") & (F.coalesce("generated_files", F.lit(0)) == 0)
    n = table(spark, d, "inventory").agg(F.countDistinct("document_id").alias("documents"))
    per = last.agg(F.count("*").alias("with_runs"), F.count_if(~F.coalesce(done, F.lit(False))).alias("pending_or"), F.count_if(none).alias("pending_and"))
    both = n.unionByName(per, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in ("documents", "with_runs", "pending_or", "pending_and")])


@query(f"SELECT document_id, log_path, CASE WHEN {_X} AND page_count > 0 THEN round(duration_seconds / page_count, 6) END AS per_page, greatest(0, round(epoch_us(try_cast(completed_at AS TIMESTAMPTZ)) / 1e6 - epoch_us(try_cast(started_at AS TIMESTAMPTZ)) / 1e6, 3)) AS wall_seconds FROM {_R}")
def run_durations(spark: SparkSession, d: str) -> DataFrame:
    end = F.try_to_timestamp(F.col("completed_at"))
    wall = F.greatest(F.lit(0.0), F.round(F.unix_micros(end) / 1e6 - F.unix_micros(runs.started()) / 1e6, 3))
    return _r(spark, d).select("document_id", "log_path", F.round(runs.seconds_per_page(F.col("duration_seconds"), F.col("page_count")), 6).alias("per_page"), wall.alias("wall_seconds"))


@query(f"SELECT pod_number FROM (SELECT pod_number, sum(CASE WHEN status <> 'ok' THEN 1 ELSE 0 END) / count(*) AS load, count(*) AS n FROM {_R} WHERE pod_number IS NOT NULL GROUP BY 1) ORDER BY load, n, pod_number LIMIT 1")
def least_loaded(spark: SparkSession, d: str) -> DataFrame:
    g = _r(spark, d).where("pod_number is not null").groupBy("pod_number").agg((F.count_if(F.col("status") != "ok") / F.count("*")).alias("load"), F.count("*").alias("n"))
    return g.orderBy("load", "n", "pod_number").limit(1).select("pod_number")


_AUD = f"""(SELECT document_id, CASE WHEN status <> 'ok' THEN 'FAIL' WHEN coalesce(generated_files, 0) < 8 THEN 'WARN' ELSE 'PASS' END AS audit_status, duration_seconds FROM {_LAST})"""


@query(f"""WITH a AS {_AUD}, o AS ((SELECT document_id FROM a WHERE duration_seconds IS NOT NULL AND NOT isnan(duration_seconds) ORDER BY duration_seconds, document_id LIMIT 10) UNION (SELECT document_id FROM a WHERE duration_seconds IS NOT NULL AND NOT isnan(duration_seconds) ORDER BY duration_seconds DESC, document_id LIMIT 10)),
    c AS (SELECT document_id, 0 AS k FROM a WHERE audit_status = 'FAIL' UNION ALL SELECT document_id, 1 FROM a WHERE audit_status = 'WARN' UNION ALL SELECT document_id, 2 FROM o),
    n AS (SELECT greatest(0, 75 - (SELECT count(*) FROM a WHERE audit_status <> 'PASS') - (SELECT count(*) FROM ((SELECT document_id FROM a WHERE duration_seconds IS NOT NULL AND NOT isnan(duration_seconds) ORDER BY duration_seconds, document_id LIMIT 10) UNION ALL (SELECT document_id FROM a WHERE duration_seconds IS NOT NULL AND NOT isnan(duration_seconds) ORDER BY duration_seconds DESC, document_id LIMIT 10)))) AS left_),
    p AS (SELECT document_id FROM (SELECT document_id, row_number() OVER (ORDER BY sha256('42:' || document_id)) AS rn FROM a WHERE audit_status = 'PASS') WHERE rn <= (SELECT left_ FROM n))
    SELECT DISTINCT document_id FROM (SELECT document_id FROM c UNION ALL SELECT document_id FROM p)""")
def review_sample(spark: SparkSession, d: str) -> DataFrame:
    """All failures and warnings, the outliers, and passes in hash order up to 75; the budget counts rows before they are de-duplicated."""
    status = F.when(F.col("status") != "ok", "FAIL").when(F.coalesce("generated_files", F.lit(0)) < 8, "WARN").otherwise("PASS")
    a = runs.last_runs(_r(spark, d)).select("document_id", status.alias("audit_status"), "duration_seconds")
    out = inventory.outliers(a, "document_id", ["duration_seconds"]).select("document_id")
    bad = a.where("audit_status <> 'PASS'").select("document_id")
    left = max(0, 75 - bad.count() - out.count())
    passes = a.where("audit_status = 'PASS'").orderBy(inventory.hash_order(42, "document_id")).limit(left).select("document_id")
    return bad.unionByName(out).unionByName(passes).distinct()


# ---- events ---------------------------------------------------------------------------------


@query("SELECT event_id FROM (SELECT e.event_id, (SELECT count(*) FROM events f WHERE f.event_type = 'error' AND f.user_id = e.user_id AND f.ts <= e.ts AND f.ts >= e.ts - INTERVAL 6 HOUR) AS n FROM events e WHERE e.event_type = 'error') WHERE n >= 3")
def sliding_failures(spark: SparkSession, d: str) -> DataFrame:
    return runs.sliding_failures(table(spark, d, "events"), "user_id", "ts", F.col("event_type") == "error", 6 * 3600, 3).select("event_id")


@query()
def circuit_breaker(spark: SparkSession, d: str) -> DataFrame:
    return runs.breaker_transitions(table(spark, d, "events"), "user_id", "ts", F.col("value") > 20, window=86400, cooldown=3600)


@query()
def stream_breaker(spark: SparkSession, d: str) -> DataFrame:
    """The same changes from the stream."""
    return streams.drained(streams.breaker(streams.event_stream(spark, f"{d}/events.parquet"), "user_id", F.col("value") > 20, window=86400, cooldown=3600), "append")


@query()
def lease_claims(spark: SparkSession, d: str) -> DataFrame:
    return runs.lease_claims(table(spark, d, "events"), "user_id", "event_type", "ts", 86400)


@query()
def throughput_epochs(spark: SparkSession, d: str) -> DataFrame:
    return runs.throughput_epochs(table(spark, d, "events"), "user_id", "ts", "value", 86400)


_TUMBLE = "SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2"


@query(_TUMBLE)
def tumbling_throughput(spark: SparkSession, d: str) -> DataFrame:
    """The streaming query, run to the end of its input."""
    return streams.drained(streams.tumbling(streams.event_stream(spark, f"{d}/events.parquet")), "update", ["window_start", "event_type"])


@query("""WITH g AS (SELECT user_id, ts, CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w >= INTERVAL 4 HOUR THEN 1 ELSE 0 END AS st FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
    s AS (SELECT user_id, ts, sum(st) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM g) SELECT user_id, min(ts) AS session_start, count(*) AS n FROM s GROUP BY user_id, k""")
def session_activity(spark: SparkSession, d: str) -> DataFrame:
    return streams.drained(streams.sessions(streams.event_stream(spark, f"{d}/events.parquet"), "4 hours"), "complete")


@query("SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def stream_outbox_dedup(spark: SparkSession, d: str) -> DataFrame:
    """Each event sent twice into the stream and kept once within the watermark."""
    return streams.drained(streams.outbox(streams.event_stream(spark, f"{d}/events.parquet")), "append").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))


@query("SELECT CAST(user_id AS VARCHAR) AS user_id, event_type, value AS last_value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1")
def log_last_state(spark: SparkSession, d: str) -> DataFrame:
    """key=value lines as a log scan reads them, the last state per key."""
    e = table(spark, d, "events")
    line = F.concat(F.lit("user="), F.col("user_id").cast("string"), F.lit(" type="), "event_type", F.lit(" id="), F.col("event_id").cast("string"))
    parsed = e.select("ts", "value", F.str_to_map(line, F.lit(" "), F.lit("=")).alias("kv"))
    last = F.max_by(F.struct(F.col("kv")["type"].alias("event_type"), F.col("value").alias("last_value")), F.struct("ts", F.col("kv")["id"].cast("long")))
    return parsed.groupBy(F.col("kv")["user"].alias("user_id")).agg(last.alias("r")).select("user_id", "r.event_type", "r.last_value")
