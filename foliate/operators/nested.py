"""Problem 6: deeply nested semi-structured records as related flat tables.

Every object of a payload is a node with a key made of its parent's key, a
letter for its kind and its position. Objects are canonicalised and hashed
bottom-up (the hash of a node covers its own fields and the hashes of its
children), identical objects are stored once, and bridge rows keep every
occurrence with its parent and ordinal.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from ..functions import deepjson
from ..functions.text import html_to_text_of
from ..session import spread

# Names of the page list, and per kind of node the lists below it with the letter and kind of their entries.
PAGE_LISTS = ("pdf_info", "pages", "page_info")
CHILDREN = {
    "page": (("para_blocks", "b", "block"), ("discarded_blocks", "d", "block")),
    "block": (("blocks", "b", "block"), ("lines", "l", "line")),
    "line": (("spans", "s", "span"),),
    "span": (),
}
_KIND = "record_id long, parent string, node string, kind string, ordinal int, object_id string, fields string"


def parse(payload: str | None) -> object:
    """The payload's value, or None if it is null or not valid JSON (NaN and infinities are not). Nesting may have any depth."""
    if payload is None:
        return None
    try:
        return deepjson.loads(payload)
    except ValueError:
        return None


@F.pandas_udf(BooleanType())
def _is_json(s):
    def valid(x):
        try:
            deepjson.loads(x)
        except ValueError:
            return False
        return True

    return s.map(lambda x: False if x is None else valid(x))


def is_json(payload: Column) -> Column:
    """Whether a payload is valid JSON; what the JVM's parser refuses, perhaps only for its depth, is parsed again without that limit."""
    refused = F.try_parse_json(payload).isNull()
    return payload.isNotNull() & (~refused | _is_json(F.when(refused, payload)))


def _entries(value: object) -> list:
    """A list as it is, an object as a list of one, anything else as no entries."""
    return value if isinstance(value, list) else [value] if isinstance(value, dict) else []


def pages_of(root: dict) -> list:
    for name in PAGE_LISTS:
        if root.get(name) is not None:
            return _entries(root[name])
    return [root]


def _own(obj: dict, kind: str) -> dict:
    """An object with each of its child nodes replaced by an empty object: every key stays, and so do entries that are no nodes."""
    own = dict(obj)
    for name, _, _ in CHILDREN[kind]:
        if isinstance(x := obj.get(name), dict):
            own[name] = {}
        elif isinstance(x, list):
            own[name] = [{} if isinstance(e, dict) else e for e in x]
    return own


def walk(root: object) -> list[list]:
    """``[parent's place, parent, node, kind, ordinal, object, places of children]`` of every node, parents first.

    The walk keeps its own stack, so the depth of nesting is not limited by it.
    """
    if not isinstance(root, dict):
        return []
    order: list[list] = []
    stack = [(None, "root", f"p{i:04d}", "page", i, p) for i, p in enumerate(pages_of(root)) if isinstance(p, dict)][::-1]
    while stack:
        above, parent, key, kind, ordinal, obj = stack.pop()
        me = len(order)
        order.append([above, parent, key, kind, ordinal, obj, []])
        if above is not None:
            order[above][6].append(me)
        below = [(me, key, f"{key}:{letter}{i:04d}", child, i, x) for name, letter, child in CHILDREN[kind] for i, x in enumerate(_entries(obj.get(name))) if isinstance(x, dict)]
        stack += below[::-1]
    return order


# What stands for equations and images in texts that are embedded, and block types that are assets of their own.
EQUATION, FIGURE = "[EQUAÇÃO]", "[FIGURA]"
ASSET_TYPES = ("image", "table", "chart", "interline_equation", "equation", "code", "algorithm")
VARIANTS = ("structure", "reconcile", "chunk", "profile")


def _filled(obj: dict, *names: str) -> list[str]:
    return [x for x in map(obj.get, names) if isinstance(x, str) and x]


def _chunk_text(obj: dict) -> str:
    own = _filled(obj, "text", "content")
    if own:
        return html_to_text_of(own[0]) if "<" in own[0] and ">" in own[0] else own[0]
    return "".join(html_to_text_of(x) for x in _filled(obj, "html"))


def texts(block: dict, variant: str) -> list[str]:
    """The parts of a block's text, its nested blocks included, in one of four orders of its fields.

    structure: text and content, then the first of these of each span. reconcile:
    text, content, html and latex, then the first of these of each span. profile:
    the first of content, text, latex and html, else the first of these of each
    span, without nested blocks. chunk: lines with marks for equations and
    figures, else the block's own text, then nested blocks that are no assets.
    """
    out: list[str] = []
    todo = [block]
    while todo:
        b = todo.pop()
        lines = [[s for s in _entries(line.get("spans")) if isinstance(s, dict)] for line in _entries(b.get("lines")) if isinstance(line, dict)]
        children = [c for c in _entries(b.get("blocks")) if isinstance(c, dict)]
        if variant == "chunk":
            made = ["".join(EQUATION if s.get("type") in ("inline_equation", "interline_equation") or _filled(s, "latex") else FIGURE if _filled(s, "image_path") else _chunk_text(s) for s in line) for line in lines]
            whole = ("\n".join(made) if lines else _chunk_text(b)).strip()
            out += [whole] if whole else []
            children = [c for c in children if (c.get("type") or c.get("block_type")) not in ASSET_TYPES]
        elif variant == "profile":
            own = [x.strip() for x in _filled(b, "content", "text", "latex", "html") if x.strip()]
            out += own[:1] or [x[0] for line in lines for s in line if (x := _filled(s, "content", "text", "latex", "html"))]
            children = []
        else:
            names = ("text", "content") if variant == "structure" else ("text", "content", "html", "latex")
            out += _filled(b, *names) + [x[0] for line in lines for s in line if (x := _filled(s, *names))]
        todo += reversed(children)
    return out


def block_text(block: dict, variant: str) -> str:
    parts = texts(block, variant)
    return "\n\n".join(parts) if variant == "chunk" else " ".join(" ".join(parts).split()) if variant == "structure" else " ".join(parts)


def nodes_of(root: object, fields: bool = True) -> list[tuple[str, str, str, int, str, str | None]]:
    """``(parent, node, kind, ordinal, object id, own fields as canonical JSON)`` of every node, parents first."""
    order = walk(root)
    hashes: list[str] = [""] * len(order)
    out: list = [None] * len(order)
    for me in range(len(order) - 1, -1, -1):
        _, parent, key, kind, ordinal, obj, children = order[me]
        own = deepjson.dumps(_own(obj, kind))
        # the position within the list belongs to the parent's identity, the key does not
        below = "".join(f"{order[c][2][len(key) + 1 :]}{hashes[c]}" for c in children)
        hashes[me] = blake2b(f"{kind}\n{own}\n{below}".encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()
        out[me] = (parent, key, kind, ordinal, hashes[me], own.encode("utf-8", "replace").decode() if fields else None)
    return out


def _walk(fields: bool):
    names = ["record_id", "parent", "node", "kind", "ordinal", "object_id", "fields"]
    kinds = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.string(), pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []

            def out():
                cols = list(zip(*rows)) or [()] * len(names)
                return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names)

            for record, payload in zip(batch.column("record_id").to_pylist(), batch.column("payload").to_pylist()):
                rows += [(record, *n) for n in nodes_of(parse(payload), fields)]
                if len(rows) >= 20_000:  # bounds what a task holds, however large the payloads are
                    yield out()
                    rows = []
            yield out()

    return run


def occurrences(records: DataFrame, fields: bool = False) -> DataFrame:
    """The bridge table: ``record_id, parent, node, kind, ordinal, object_id`` (and ``fields``).

    Null payloads, payloads that are not valid JSON and roots that are no object
    give no rows; a record sent again gives the same rows again, which
    ``distinct_nodes`` drops. Missing, null and empty lists have no entries.
    Nothing is shuffled.
    """
    made = spread(records.select("record_id", "payload").where("payload is not null")).mapInArrow(_walk(fields), _KIND)
    return made if fields else made.drop("fields")


def distinct_nodes(records: DataFrame) -> DataFrame:
    return occurrences(records).distinct()


def objects(records: DataFrame) -> DataFrame:
    """The object store: ``object_id, kind, fields, n_occurrences``, one row for all identical subtrees of all records."""
    nodes = occurrences(records, fields=True)
    return nodes.groupBy("object_id").agg(F.min("kind").alias("kind"), F.min("fields").alias("fields"), F.count("*").alias("n_occurrences"))


# The typed columns of each level's flat table.
COLUMNS = {
    "page": "page int, page_idx int, page_no int, page_number int, width double, height double, page_size array<double>",
    "block": "type string, block_type string, index string, text string, content string, bbox array<double>, score double, level string, cross_page string, image_path string, latex string, html string",
    "line": "bbox array<double>, score double",
    "span": "type string, text string, content string, bbox array<double>, score double, latex string, html string, image_path string",
}


# Opening brackets up to which fields go to the JVM's parser as they are; it refuses nesting of 1,000.
JVM_BRACKETS = 500


def _typed(kind: str):
    """Fields that may be too deep for the JVM's parser, reduced to typed ones that hold no objects or lists of lists."""
    names = {c.split()[0] for c in COLUMNS[kind].split(", ")}

    def flat(v) -> bool:
        return not isinstance(v, dict) and not (isinstance(v, list) and any(isinstance(x, (dict, list)) for x in v))

    def reduce(s):
        return s.map(lambda x: None if x is None else deepjson.dumps({k: v for k, v in deepjson.loads(x).items() if k in names and flat(v)}))

    return F.pandas_udf(reduce, "string")


def level_table(records: DataFrame, kind: str) -> DataFrame:
    """The flat table of one level: every distinct node with its own and its parent's key and typed fields; ``fields`` keeps the rest.

    Fields nested beyond what the JVM reads keep their typed columns too.
    """
    nodes = occurrences(records, fields=True).where(F.col("kind") == kind).dropDuplicates(["record_id", "node", "object_id"])
    deep = F.length(F.regexp_replace("fields", r"[^\[{]", "")) > JVM_BRACKETS
    plain = F.coalesce(_typed(kind)(F.when(deep, F.col("fields"))), F.col("fields"))
    return nodes.withColumn("f", F.from_json(plain, COLUMNS[kind])).select("record_id", "parent", "node", "ordinal", "object_id", "fields", "f.*")


def record_key_counts(records: DataFrame) -> DataFrame:
    """``document_id, record_id, kind, key, n``: how often each key stands in the nodes of each kind of one record, with the payload's root as a kind of its own.

    All keys count, also those of the lists below. Rows of a record sent again add up.
    """
    parsed = spread(records.select("document_id", "record_id", "payload").where("payload is not null"))
    kinds = "document_id string, record_id long, kind string, key string, n long"
    return parsed.mapInArrow(_keys, kinds).groupBy("document_id", "record_id", "kind", "key").agg(F.sum("n").alias("n"))


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows: list[tuple] = []
        for document, record, payload in zip(*(batch.column(c).to_pylist() for c in ("document_id", "record_id", "payload"))):
            root = parse(payload)
            counts: Counter = Counter(("root", k) for k in root) if isinstance(root, dict) else Counter()
            for _, _, _, kind, _, obj, _ in walk(root):
                counts.update((kind, k) for k in obj)
            rows += [(document, record, kind, key.encode("utf-8", "replace").decode(), n) for (kind, key), n in counts.items()]
        cols = list(zip(*rows)) or [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()))], ["document_id", "record_id", "kind", "key", "n"])


def key_counts(records: DataFrame) -> DataFrame:
    """``kind, key, n, documents``: the keys of all records, mergeable by addition, and the documents that have them."""
    return record_key_counts(records).groupBy("kind", "key").agg(F.sum("n").alias("n"), F.countDistinct("document_id").alias("documents"))


def collection_key_counts(records: DataFrame, inventory: DataFrame) -> DataFrame:
    """``collection_slug, kind, key, n, documents``: the same by the collections of the documents, null for documents of none."""
    at = inventory.select("document_id", "collection_slug").where("document_id is not null").distinct()
    return record_key_counts(records).join(at, "document_id", "left").groupBy("collection_slug", "kind", "key").agg(F.sum("n").alias("n"), F.countDistinct("document_id").alias("documents"))


def found(records: DataFrame) -> DataFrame:
    return distinct_nodes(records).select("record_id", "parent", "node").distinct()
