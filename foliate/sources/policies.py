"""Policies and overrides from YAML or JSON files, checked on the driver and turned into small tables."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from ..operators import chunking

# What a policy may do with a role, and the kinds of splitter.
ACTIONS = ("embed", "payload", "placeholder", "exclude")
SPLITTERS = ("recursive", "character", "token")


def load(path: str) -> dict:
    """The mapping in a YAML or JSON file; anything else is an error. YAML needs PyYAML, JSON nothing."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    try:
        import yaml
    except ImportError:
        yaml = None
    value = yaml.safe_load(text) if yaml is not None and not path.endswith(".json") else json.loads(text)
    if not isinstance(value, dict):
        raise ValueError(f"{path} holds no mapping")
    return value


def role_actions(spark: SparkSession, policy: dict) -> DataFrame:
    """``role, action``, one row a role: the policy's, else the default."""
    unknown = {r: a for r, a in (policy.get("roles") or {}).items() if r not in chunking.ACTIONS or a not in ACTIONS}
    if unknown:
        raise ValueError(f"unknown roles or actions: {sorted(unknown.items())}")
    made = {**chunking.ACTIONS, **(policy.get("roles") or {})}
    if "embed" not in made.values():
        raise ValueError("no role is embedded")
    return spark.createDataFrame(sorted(made.items()), "role string, action string")


def splitters(spark: SparkSession, policy: dict) -> DataFrame:
    """``collection_slug, kind, tokenizer, chunk_size, chunk_overlap``, one row a collection."""
    rows = []
    for slug, s in sorted((policy.get("collections") or {}).items()):
        kind, size, overlap = s.get("kind", "recursive"), s.get("chunk_size"), s.get("chunk_overlap", 0)
        if kind not in SPLITTERS or not isinstance(size, int) or not isinstance(overlap, int) or not 0 <= overlap < size:
            raise ValueError(f"{slug}: a splitter needs a kind, a size, and an overlap below it")
        rows.append((slug, kind, s.get("tokenizer"), size, overlap))
    return spark.createDataFrame(rows, "collection_slug string, kind string, tokenizer string, chunk_size int, chunk_overlap int")


def overrides(spark: SparkSession, content: dict) -> DataFrame:
    """``path, source, authors, corporate`` of human decisions by path; a path needs authors of one kind or a note that there are none."""
    rows = []
    for path, o in sorted((content.get("documents") or {}).items()):
        authors, corporate = list(o.get("authors") or []), list(o.get("corporate_authors") or [])
        if not authors and not corporate and not o.get("no_personal_author"):
            raise ValueError(f"{path}: an override needs authors")
        rows.append((path, o.get("source", "human"), authors, corporate))
    return spark.createDataFrame(rows, "path string, source string, authors array<string>, corporate array<string>")
