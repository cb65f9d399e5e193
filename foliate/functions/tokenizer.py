"""Vocabularies of public tokenizers and the length of a text in their tokens."""

from __future__ import annotations

import base64
import importlib
import os
from functools import lru_cache

# Fixed value: the public pre-token pattern of the vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
VOCABULARY = "byte_bpe_50k"


def tokenizer_folder(folder: str | None = None) -> str:
    """The folder of the vocabularies: the one given, of FOLIATE_TOKENIZERS, or of the installed package."""
    return folder or os.environ.get("FOLIATE_TOKENIZERS") or ("/opt/tokenizers" if os.path.isdir("/opt/tokenizers") else os.path.dirname(importlib.import_module("public_tokenizers").__file__))


def load_ranks(name: str = VOCABULARY, folder: str | None = None) -> dict[bytes, int]:
    with open(os.path.join(tokenizer_folder(folder), f"{name}.tiktoken"), "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@lru_cache(maxsize=2)
def _encoding(name: str, folder: str | None):
    import tiktoken

    return tiktoken.Encoding(name, pat_str=PATTERN, mergeable_ranks=load_ranks(name, folder), special_tokens={})


def token_length(text: str, name: str = VOCABULARY, folder: str | None = None) -> int:
    return len(_encoding(name, folder).encode_ordinary(text))
