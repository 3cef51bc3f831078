"""Byte-level BPE ids from a tokenizers JSON file.

The ids are those of the tokenizers library with ``add_special_tokens=False`` and special strings
read as ordinary text (a test compares both). The merge table is run by tiktoken, which is about four
times as fast on one core; texts it refuses (megabytes of one run of white space overflow its
regular expression's stack) are encoded by the tokenizers library itself.
"""

from __future__ import annotations

import json
from functools import lru_cache

# The published pre-tokenisation pattern of this vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _letters() -> dict[str, int]:
    """Byte-level vocabularies write a byte as itself where Latin-1 prints it, and else as the next
    free code point from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(maxsize=2)
def encoder(path: str):
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = {t["content"] for t in spec.get("added_tokens", [])}
    letters = _letters()
    ranks = {bytes(letters[c] for c in word): i for word, i in spec["model"]["vocab"].items() if word not in special}
    return tiktoken.Encoding("from_json", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=2)
def slow_encoder(path: str):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return t


def encode(path: str, text: str) -> list[int]:
    """Ids of a whole text."""
    try:
        return encoder(path).encode_ordinary(text)
    except BaseException as e:  # pyo3's panic is no Exception
        if type(e).__name__ != "PanicException" and not isinstance(e, ValueError):
            raise
        return slow_encoder(path).encode(text, add_special_tokens=False).ids


def decode(path: str, ids) -> str:
    return encoder(path).decode_bytes(list(ids)).decode("utf-8")
