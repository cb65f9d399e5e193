"""Problem 8: encoding of a whole corpus with a public tokenizer.

Byte-level BPE treats every pre-token on its own, so each distinct pre-token of
the corpus is encoded once: blocks of documents are split into pre-tokens with
positions, the distinct pre-tokens are gathered in one shuffle and encoded,
their ids are joined back, and each document is put together by position.

Within a block the positions are held as codes of the block's own distinct
words, so what travels is a word per block, not a word per occurrence.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.tokenizer import PATTERN, VOCABULARY, load_ranks, tokenizer_folder  # noqa: F401  (the folder is part of this module's interface)
from ..session import spread, written

BLOCK_CHARS = 2_000_000
# Rows of one word that meet in one task, at most, in the join of the ids.
SALT_BLOCKS = 20_000


_BLOCK = "block binary, words array<string>, docs array<bigint>, codes binary, ends binary"


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ``block, words, docs, codes, ends``: the block's distinct words and each document as codes of them.

    A block's id is its own; it is drawn once, as the blocks are written before they are used.
    """
    find = regex.compile(PATTERN).findall

    def close(docs, chunks, ends, seen):
        codes = np.fromiter((c for chunk in chunks for c in chunk), np.uint32, ends[-1])
        return pa.RecordBatch.from_arrays(
            [
                pa.array([uuid.uuid4().bytes], pa.binary()),
                pa.array([list(seen)], pa.list_(pa.string())),
                pa.array([docs], pa.list_(pa.int64())),
                pa.array([codes.tobytes()], pa.binary()),
                pa.array([np.array(ends, np.int64).tobytes()], pa.binary()),
            ],
            ["block", "words", "docs", "codes", "ends"],
        )

    docs, chunks, ends, seen, chars = [], [], [], {}, 0
    for batch in batches:
        for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            words = find(text) if text else []
            chunks.append([seen.setdefault(w, len(seen)) for w in words])
            docs.append(doc)
            ends.append((ends[-1] if ends else 0) + len(words))
            chars += len(text or "") + 64
            if chars >= BLOCK_CHARS:
                yield close(docs, chunks, ends, seen)
                docs, chunks, ends, seen, chars = [], [], [], {}, 0
    if docs:
        yield close(docs, chunks, ends, seen)


def _encoder(name: str, folder: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        # a word is a pre-token already: the whole of it is one piece
        enc = tiktoken.Encoding(name, pat_str="(?s:.+)", mergeable_ranks=load_ranks(name, folder), special_tokens={})
        for batch in batches:
            ids = [enc.encode_ordinary(w) for w in batch.column("word").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("salts"), pa.array(ids, pa.list_(pa.int32()))], ["word", "salts", "ids"])

    return run


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            docs, ends = batch.column("docs")[row].values, np.frombuffer(batch.column("ends")[row].as_py(), np.int64)
            codes = np.frombuffer(batch.column("codes")[row].as_py(), np.uint32)
            table = batch.column("table")[row]
            if table.is_valid and len(table):
                structs = table.values
                at, lists = structs.field("i").to_numpy(), structs.field("ids")
                flat, offsets = lists.flatten().to_numpy(), lists.offsets.to_numpy()
                offsets = offsets - offsets[0]
                begin, size = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
                begin[at], size[at] = offsets[:-1], np.diff(offsets)
                n = size[codes]
                total = np.cumsum(n)
                out = flat[np.arange(total[-1] if len(total) else 0) + np.repeat(begin[codes] - (total - n), n)]
                stop = np.concatenate([[0], total])[ends]
            else:
                out, stop = np.zeros(0, np.int32), np.zeros(len(ends), np.int64)
            yield pa.RecordBatch.from_arrays([docs, pa.ListArray.from_arrays(pa.array(np.concatenate([[0], stop]), pa.int32()), pa.array(out, pa.int32()))], ["doc_id", "ids"])


def encode_corpus(documents: DataFrame, name: str = VOCABULARY, folder: str | None = None) -> DataFrame:
    """``doc_id, ids``: one row per row of ``documents``.

    Empty, blank and null texts are defined: null and empty give an empty list,
    blank ones the ids of their white space. Strings of special tokens are
    ordinary text. Null ids and repeated rows come out as they came in, also rows
    of one id with different texts; other columns are not read. A very long text
    makes a block of its own. The split blocks are written once to the cluster's
    shared folder, so that the corpus is split once and a lost executor costs no
    second pass; the folder is dropped when the session ends.

    A frequent word stands in nearly every block: its rows are dealt to salts, one
    for each SALT_BLOCKS blocks, so that no key of the join outgrows a task. The
    word is still encoded once; its ids are copied to the salts that ask for them.
    """
    spark = documents.sparkSession
    path = written(spread(documents.select("doc_id", "text")).mapInArrow(_split, _BLOCK), "blocks")
    blocks = spark.read.schema(_BLOCK).parquet(path)
    salts = 1 + blocks.select("block").count() // SALT_BLOCKS
    used = blocks.select("block", F.pmod(F.xxhash64("block"), F.lit(salts)).cast("int").alias("salt"), F.posexplode("words").alias("i", "word"))
    asked = used.groupBy("word").agg(F.collect_set("salt").alias("salts"))
    ids = asked.mapInArrow(_encoder(name, folder), "word string, salts array<int>, ids array<int>").select("word", F.explode("salts").alias("salt"), "ids")
    tables = used.join(ids, ["word", "salt"]).groupBy("block").agg(F.collect_list(F.struct("i", "ids")).alias("table"))
    return blocks.select("block", "docs", "codes", "ends").join(tables, "block", "left").select("docs", "codes", "ends", "table").mapInArrow(_assemble, "doc_id long, ids array<int>")


def decode_corpus(encoded: DataFrame, name: str = VOCABULARY, folder: str | None = None) -> DataFrame:
    """``doc_id, text``: ids joined with the token-byte table and put together by position.

    The table has one row per id of the vocabulary, a fixed number. Rows must
    have distinct doc_ids; an empty list gives an empty text, a null list null.
    """
    spark = encoded.sparkSession
    table = spark.createDataFrame([(i, bytearray(b)) for b, i in load_ranks(name, folder).items()], "id int, b binary")
    parts = encoded.select("doc_id", F.posexplode("ids").alias("pos", "id")).join(F.broadcast(table), "id")
    whole = parts.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("pos", "b"))).alias("a")).select("doc_id", F.decode(F.unhex(F.array_join(F.transform("a", lambda x: F.hex(x["b"])), "")), "UTF-8").alias("__t"))
    return encoded.select("doc_id", F.col("ids").isNull().alias("__null")).join(whole, "doc_id", "left").select("doc_id", F.when(~F.col("__null"), F.coalesce("__t", F.lit(""))).alias("text"))
