"""Deterministic ids as column expressions: name-based UUIDs, slugs, normal paths, content hashes."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Fixed value: the namespace of all catalogue ids.
NAMESPACE = "013fd0c1-9d33-5036-96dd-2909b78b59e1"


def uuid5(namespace: Column | str, name: Column) -> Column:
    """RFC 4122 name-based UUID (version 5) computed in the JVM; null if either part is null."""
    ns = F.lit(namespace) if isinstance(namespace, str) else namespace
    h = F.sha1(F.concat(F.unhex(F.replace(ns, F.lit("-"), F.lit(""))), F.encode(name, "UTF-8")))
    variant = F.substring(F.lit("89ab"), F.conv(F.substring(h, 17, 1), 16, 10).cast("int") % 4 + 1, F.lit(1))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)), F.concat(variant, F.substring(h, 18, 3)), F.when(h.isNotNull(), F.substring(h, 21, 12)))


@F.pandas_udf(StringType())
def _unaccented(s: pd.Series) -> pd.Series:
    def one(x):
        return None if x is None else "".join(c for c in unicodedata.normalize("NFKD", x) if not unicodedata.combining(c)).casefold()

    return s.map(one)


def unaccented(c: Column) -> Column:
    """NFKD without combining marks, case-folded; ASCII values never leave the JVM's hands changed but for case."""
    return F.coalesce(_unaccented(F.when(F.length(c) != F.octet_length(c), c)), F.lower(c))


def slug(c: Column) -> Column:
    """Runs of other characters become one hyphen; null where nothing is left."""
    s = F.regexp_replace(F.regexp_replace(unaccented(c), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.when(s != "", s)


def relative_path(c: Column) -> Column:
    """Slashes only, none at the ends; null for empty paths and paths with . or .. parts."""
    p = F.regexp_replace(F.replace(c, F.lit("\\"), F.lit("/")), "^/+|/+$", "")
    p = F.regexp_replace(p, "/+", "/")
    return F.when((p != "") & ~p.rlike("(^|/)\\.{1,2}(/|$)"), p)


def collection_id(slugged: Column) -> Column:
    return uuid5(NAMESPACE, F.concat(F.lit("collection:"), slugged))


def document_id(slugged: Column, path: Column) -> Column:
    return uuid5(NAMESPACE, F.concat(F.lit("document:"), slugged, F.lit(":"), path))


def revision_id(document: Column, sha256: Column) -> Column:
    return uuid5(document, F.concat(F.lit("revision:"), F.lower(F.trim(sha256))))


def artifact_id(revision: Column, key: Column) -> Column:
    return uuid5(revision, F.concat(F.lit("artifact:"), key))


def is_sha256(c: Column) -> Column:
    return F.lower(F.trim(c)).rlike("^[0-9a-f]{64}$")


def canonical_json(fields: dict[str, Column]) -> Column:
    """A JSON object with sorted keys and no spaces; restricted to strings, whole numbers and arrays of strings."""
    return F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)]), {"ignoreNullFields": "false"})


def idempotency_key(revision: Column, stage: Column, processor: Column, version: Column, config: Column, inputs: Column) -> Column:
    return F.sha2(canonical_json({"revision_id": revision, "stage": F.lower(F.trim(stage)), "processor": F.lower(F.trim(processor)), "processor_version": F.trim(version), "config_hash": config, "input_hashes": F.array_sort(inputs)}), 256)
