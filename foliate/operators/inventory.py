"""Inventory algebra: audit, merge, collisions, selection, fingerprints, buckets and samples.

Order matters in every keep-first and keep-last rule, so it is always an explicit
position: the instant of ``modified_at``, then the revision. Null positions come
first. Empty strings and nulls both count as missing ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import identity

# Columns without which an audit cannot run.
REQUIRED = ("document_id", "sha256", "path", "filename", "relative_path", "page_count", "status")
# Right-closed buckets of pages and of size.
PAGE_BUCKETS = ((2, "001_002"), (5, "003_005"), (10, "006_010"), (25, "011_025"), (50, "026_050"), (100, "051_100"), (250, "101_250"), (None, "251_plus"))
SIZE_BUCKETS = ((0.25, "000_025mb"), (1, "025_001mb"), (5, "001_005mb"), (20, "005_020mb"), (100, "020_100mb"), (None, "100mb_plus"))


class SelectionError(ValueError):
    """A selection that is contradictory or empty."""


def require_columns(df: DataFrame, columns=REQUIRED) -> DataFrame:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def conform(df: DataFrame, schema: list[tuple[str, str]]) -> DataFrame:
    """Exactly the given columns in order: missing ones as nulls, extra ones dropped."""
    return df.select(*[(F.col(f"`{c}`").cast(t) if c in df.columns else F.lit(None).cast(t)).alias(c) for c, t in schema])


def position() -> Column:
    return F.struct(F.try_to_timestamp(F.col("modified_at")).alias("m"), F.col("revision_id").alias("r"))


def missing(c: str) -> Column:
    return F.coalesce(F.trim(F.col(c)), F.lit("")) == ""


def is_invalid() -> Column:
    return missing("document_id") | missing("sha256") | (F.coalesce("status", F.lit("")) != "ok") | (F.coalesce(F.col("page_count"), F.lit(0)) <= 0)


def keep(df: DataFrame, keys: list[str], last: bool) -> DataFrame:
    """One row per key: the first or last by position, ties by content hash.

    A keyed minimum or maximum of whole rows, combined before the shuffle, so a
    key that holds a third of all rows costs one row a partition.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    order = F.struct(position().alias("p"), F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).alias("h"))
    pick = F.max_by(row, order) if last else F.min_by(row, order)
    return df.groupBy(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]).agg(pick.alias("__r")).select("__r.*")


def extraction_manifest(inv: DataFrame) -> DataFrame:
    return keep(require_columns(inv).where(~is_invalid()), ["document_id"], last=False)


def audit(inv: DataFrame) -> DataFrame:
    """One row of counters; one pass with conditional counts, the kept rows by one aggregation per document."""
    ok = ~is_invalid()
    per = inv.groupBy(F.when(ok, F.col("document_id")).alias("id"), ok.alias("ok")).agg(F.count("*").alias("n"), F.min_by("page_count", position()).alias("pages"))
    return per.agg(
        F.sum("n").alias("inventory_rows"), F.coalesce(F.sum(F.when(F.col("ok"), F.col("n"))), F.lit(0)).alias("valid_rows"), F.coalesce(F.sum(F.when(~F.col("ok"), F.col("n"))), F.lit(0)).alias("invalid_rows"),
        F.count_if("ok").alias("unique_documents"), F.coalesce(F.sum(F.when(F.col("ok"), F.col("n") - 1)), F.lit(0)).alias("duplicate_rows"), F.coalesce(F.sum(F.when(F.col("ok"), F.col("pages"))), F.lit(0)).cast("long").alias("expected_pages"),
    )


def duplicates(inv: DataFrame) -> DataFrame:
    """All rows whose hash stands in more than one row; two keyed passes instead of a window over hot hashes."""
    many = inv.where(~missing("sha256")).groupBy("sha256").count().where("count > 1").select("sha256")
    return inv.join(many, "sha256", "left_semi")


def projection(inv: DataFrame) -> DataFrame:
    """Recomputed identities of every row."""
    s = identity.slug(F.col("collection"))
    doc = identity.document_id(s, identity.relative_path(F.col("collection_relative_path")))
    return inv.select("path", s.alias("slug"), identity.collection_id(s).alias("collection_uuid"), doc.alias("document_uuid"), identity.revision_id(doc, F.col("sha256")).alias("revision_uuid"), F.round(F.col("size_bytes") / 1024 / 1024, 4).alias("mb"), identity.is_sha256(F.col("sha256")).alias("sha_ok"))


def logical_collisions(inv: DataFrame) -> DataFrame:
    """Document ids that stand for more than one revision, with the sorted list."""
    g = inv.where(~missing("document_id")).groupBy("document_id").agg(F.array_sort(F.collect_set("revision_id")).alias("revisions"))
    return g.where(F.size("revisions") > 1).select("document_id", F.array_join("revisions", ",").alias("revisions"))


def physical_collisions(inv: DataFrame) -> DataFrame:
    """Paths, regardless of case, with more than one document id."""
    return inv.groupBy(F.lower("path").alias("path_key")).agg(F.countDistinct("document_id").alias("ids")).where("ids > 1")


def merge(old: DataFrame, new: DataFrame) -> DataFrame:
    """Union; valid rows keep the last per document, invalid rows the last per path."""
    both = old.unionByName(new, allowMissingColumns=True)
    return keep(both.where(~is_invalid()), ["document_id"], True).unionByName(keep(both.where(is_invalid()), ["path"], True))


def select(inv: DataFrame, collection: str | None = None, path: str | None = None) -> DataFrame:
    """Valid rows of one collection (by name, regardless of case, or slug) or at or below one path; the selectors exclude each other."""
    if collection is not None and path is not None:
        raise SelectionError("collection and path exclude each other")
    ok = inv.where(F.col("status") == "ok")
    if collection is not None:
        ok = ok.where((F.lower("collection") == collection.lower()) | (F.col("collection_slug") == collection))
    if path is not None:
        ok = ok.where((F.col("relative_path") == path) | F.startswith(F.col("relative_path"), F.lit(path.rstrip("/") + "/")))
    return ok


def stored_fingerprint(inv: DataFrame) -> DataFrame:
    """``fingerprint, n``: SHA-256 of the JSON list of the identities of readable rows, sorted.

    A hash over a sequence has to see it in order: sorted partitions stream one
    after the other through one task that holds no more than the hash. Rows
    without an identity are left out. ``fingerprint`` needs no such task.
    """
    import hashlib

    import pyarrow as pa

    keys = ("document_id", "revision_id", "sha256")
    rows = inv.where("status = 'ok'").na.drop(subset=list(keys)).select(*keys, identity.canonical_json({c: F.col(c) for c in keys}).alias("j"))

    def run(batches):
        h, n = hashlib.sha256(b"["), 0
        for batch in batches:
            for x in batch.column("j").to_pylist():
                h.update((b"," if n else b"") + x.encode())
                n += 1
        h.update(b"]")
        yield pa.RecordBatch.from_arrays([pa.array([h.hexdigest()]), pa.array([n], pa.int64())], ["fingerprint", "n"])

    return rows.orderBy(*keys).select("j").coalesce(1).mapInArrow(run, "fingerprint string, n long")


def fingerprint(inv: DataFrame) -> DataFrame:
    """``fingerprint, n``: a hash of the set of all identities that no partitioning changes.

    Identities are hashed in 4,096 groups by the first digits of their hash, and
    the group hashes together, so that no task gathers the whole inventory.
    """
    one = inv.select(identity.canonical_json({"document_id": F.col("document_id"), "revision_id": F.col("revision_id"), "sha256": F.col("sha256")}).alias("j")).distinct().withColumn("h", F.sha2("j", 256))
    parts = one.groupBy(F.substring("h", 1, 3).alias("p")).agg(F.sha2(F.array_join(F.array_sort(F.collect_list("h")), ","), 256).alias("g"), F.count("*").alias("n"))
    return parts.agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p", "g"))), lambda x: x["g"]), ","), 256).alias("fingerprint"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"))


def bucket(c: Column, buckets) -> Column:
    out = None
    for top, label in buckets:
        if top is None:
            out = out.when(c.isNotNull(), label)
        else:
            out = (F if out is None else out).when(c <= top, label)
    return out


def stratified_frame(inv: DataFrame) -> DataFrame:
    """The newest valid row of each hash with its buckets and stratum; null buckets read nan in the stratum."""
    one = keep(inv.where(~is_invalid()), ["sha256"], True)
    b = one.withColumn("page_bucket", bucket(F.col("page_count"), PAGE_BUCKETS)).withColumn("size_bucket", bucket(F.col("size_mb"), SIZE_BUCKETS))
    return b.withColumn("stratum", F.concat_ws("|", F.coalesce("page_bucket", F.lit("nan")), F.coalesce("size_bucket", F.lit("nan")), F.coalesce(F.col("encrypted").cast("string"), F.lit("nan"))))


def hash_order(seed: int, c: str = "sha256") -> Column:
    return F.sha2(F.concat(F.lit(f"{seed}:"), F.col(c)), 256)


def seeded_sample(inv: DataFrame, size: int, seed: int = 42) -> DataFrame:
    """A sample that no partitioning changes: the ``size`` documents first in hash order (a top-k, no global sort)."""
    return extraction_manifest(inv).orderBy(hash_order(seed, "document_id"), "document_id").limit(size)


def strata(frame: DataFrame, size: int) -> DataFrame:
    """Rows to take per stratum: one each, the rest in proportion, rounded half to even, never above the stratum."""
    s = frame.groupBy("stratum").agg(F.count("*").alias("population"))
    # at most 9 x 7 x 3 strata: one small window holds them
    w = Window.partitionBy(F.lit(1))
    joined = s.withColumn("total", F.sum("population").over(w)).withColumn("n_strata", F.count("*").over(w))
    slots = F.greatest(F.lit(0), F.lit(size) - F.col("n_strata"))
    return joined.select("stratum", "population", F.least(F.col("population"), 1 + F.bround(F.col("population") / F.col("total") * slots).cast("long")).alias("quota"))


def stratified_sample(inv: DataFrame, size: int, seed: int = 42) -> DataFrame:
    """Quota rows per stratum in hash order; rows beyond the size are trimmed and missing ones filled in hash order."""
    frame = stratified_frame(inv).withColumn("h", hash_order(seed))
    q = strata(frame, size)
    # the literal bound lets each partition keep its first rows of a stratum before the exchange
    ranked = frame.withColumn("__r", F.row_number().over(Window.partitionBy("stratum").orderBy("h"))).where(F.col("__r") <= size).join(q, "stratum")
    return ranked.orderBy((F.col("__r") > F.col("quota")).cast("int"), (F.col("__r") > 1).cast("int"), "h").limit(size).drop("__r", "h", "quota", "population")


def edge_cases(inv: DataFrame, sample: DataFrame, k: int = 10) -> DataFrame:
    """Largest, longest, smallest and encrypted documents, once each, without those of the sample."""
    f = stratified_frame(inv)
    parts = [f.orderBy(F.desc("size_bytes"), "sha256").limit(k), f.orderBy(F.desc("page_count"), "sha256").limit(k), f.orderBy("size_bytes", "sha256").limit(k), f.where("encrypted").orderBy(hash_order(42)).limit(k)]
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    return union.dropDuplicates(["sha256"]).join(sample.select("sha256"), "sha256", "left_anti")


def outliers(df: DataFrame, key: str, metrics: list[str], k: int = 10) -> DataFrame:
    """``key, metric, side, value``: the k least and greatest values of each metric; nulls and NaN take no part, ties go by key.

    Each side is a top-k per metric (k rows a partition before the exchange), not a sort.
    """
    out = None
    for m in metrics:
        v = df.select(F.col(key).alias("key"), F.col(m).cast("double").alias("value")).where("value is not null and not isnan(value)")
        for side, order in (("smallest", F.col("value").asc()), ("largest", F.col("value").desc())):
            part = v.orderBy(order, "key").limit(k).select(F.col("key").alias(key), F.lit(m).alias("metric"), F.lit(side).alias("side"), "value")
            out = part if out is None else out.unionByName(part)
    return out


# Lengths of the windows by which names are looked up within filenames: the longest that a name fills.
WINDOWS = (1, 2, 4, 8, 16, 32)


def window_keys(c: str, w: str) -> Column:
    """The distinct keys of all windows of ``w`` characters in ``c``, which has as many: a window's key is the least hash of its pieces of half its length (of 3 characters at least, if it has them).

    Neighbouring windows mostly share their key, so a text has a few of them; all keys of a text are among those of any text that contains it.
    """
    g = f"least({w}, greatest(3, shiftright({w}, 1)))"
    hashes = f"transform(sequence(1, length({c}) - {g} + 1), i -> xxhash64(substring({c}, i, {g})))"
    return F.expr(f"array_distinct(flatten(transform(array({hashes}), h -> transform(sequence(1, length({c}) - {w} + 1), i -> array_min(slice(h, i, {w} - {g} + 1))))))")


def file_matches(files: DataFrame, targets: DataFrame) -> DataFrame:
    """``file, outcome, n``: ``file, name`` rows (all candidate names of a file) against ``path, stem, filename`` of the targets.

    Exact names first (``exact``, ``multiple_exact``); files without one by targets whose filename contains one of
    their names (``fuzzy``, ``multiple_fuzzy``), else ``not_found``; n counts the targets. All are compared in lower
    case, and files of the same names once. Containment is an equi join on the key of one of the name's windows, the one
    that the fewest filenames have, checked exactly; filenames have keys only for window lengths that such names need.
    Exploded rows are many more than Spark expects of them, so the joins are hinted: only those lengths are broadcast.
    """
    t = targets.select(F.col("path").alias("__p"), F.lower("stem").alias("__stem"), F.lower("filename").alias("__file")).where("__p is not null").distinct()
    named = files.groupBy("file").agg(F.array_sort(F.collect_set(F.nullif(F.lower("name"), F.lit("")))).alias("names"))
    names = named.select("names").distinct().select("names", F.explode("names").alias("name"))
    exact = names.join(t.select("__p", F.col("__stem").alias("name")).hint("merge"), "name").groupBy("names").agg(F.countDistinct("__p").alias("exact"))
    longest = F.array_max(F.filter(F.array(*map(F.lit, WINDOWS)), lambda w: w <= F.length("name")))
    rest = names.join(exact.hint("merge"), "names", "left_anti").withColumn("__w", longest)
    filenames = t.where("__file <> ''").select("__file").distinct()
    fit = filenames.select("__file", F.explode(F.filter(F.array(*map(F.lit, WINDOWS)), lambda w: w <= F.length("__file"))).alias("__w"))
    pieces = fit.join(F.broadcast(rest.select("__w").distinct()), "__w", "left_semi").select("__file", F.explode(window_keys("__file", "__w")).alias("__key"))
    counts = pieces.groupBy("__key").agg(F.count("*").alias("__n"))
    wanted = rest.select("name", "__w").distinct().select("name", F.explode(window_keys("name", "__w")).alias("__key"))
    rarest = wanted.join(counts.hint("merge"), "__key", "left").groupBy("name").agg(F.min_by("__key", F.struct(F.coalesce("__n", F.lit(0)), "__key")).alias("__key"))
    hits = rarest.join(pieces.hint("merge"), "__key").where(F.contains(F.col("__file"), F.col("name"))).select("name", "__file")
    paths = hits.distinct().join(t.select("__p", "__file").distinct().hint("merge"), "__file").select("name", "__p")
    fuzzy = rest.select("names", "name").join(paths.hint("merge"), "name").groupBy("names").agg(F.countDistinct("__p").alias("fuzzy"))
    j = named.join(exact.hint("merge"), "names", "left").join(fuzzy.hint("merge"), "names", "left")
    outcome = F.when(F.col("exact") == 1, "exact").when(F.col("exact") > 1, "multiple_exact").when(F.col("fuzzy") == 1, "fuzzy").when(F.col("fuzzy") > 1, "multiple_fuzzy").otherwise("not_found")
    return j.select("file", outcome.alias("outcome"), F.coalesce("exact", "fuzzy", F.lit(0)).alias("n"))


def layouts(inv: DataFrame) -> DataFrame:
    """The twelve places of each document's files, and ``valid``: a relative path below its root that names a PDF."""
    name = F.regexp_replace(F.regexp_replace("relative_path", "^.*/", ""), "\\.[^.]*$", "")
    folder = F.concat(F.regexp_replace("path", "[^/]*$", ""), F.regexp_replace(name, "[ .]+$", ""))
    at = lambda *parts: F.concat(folder, *map(F.lit, parts))
    valid = ~F.startswith(F.col("relative_path"), F.lit("/")) & ~F.col("relative_path").rlike("(^|/)\\.\\.(/|$)") & F.endswith(F.lower("relative_path"), F.lit(".pdf"))
    return inv.where("relative_path is not null and path is not null").select(
        "document_id", "revision_id", F.col("relative_path").alias("relative_pdf_path"), F.col("path").alias("pdf_path"), folder.alias("document_dir"), at("/intermediate").alias("intermediate_dir"), at("/intermediate/results").alias("results_dir"), at("/canonical").alias("canonical_dir"),
        at("/manifest.json").alias("manifest_path"), *[at(f"/canonical/{f}").alias(c) for c, f in (("ir_path", "document_ir.json"), ("structure_path", "structure.json"), ("metadata_path", "metadata.json"), ("markdown_path", "document.md"), ("render_path", "render.json"))], valid.alias("valid"),
    )
