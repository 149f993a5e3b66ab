"""Small helpers shared by the tokenizer operators (run inside Spark tasks)."""

from __future__ import annotations

import ctypes
import json
import re
import weakref
from collections.abc import Iterable, Iterator
from functools import lru_cache

import regex

# A text made of these characters only is split the same way by Python's
# regular expressions and by the tokenizers library: no combining marks, no
# characters whose lower case or class differs between Unicode versions, no
# exotic white space.  Any other text is split by the library itself.
_UNSAFE = re.compile("[^\\t\\n\\r -~¡-įĲ-ſ‐-‧€]")

#: Coarse white-space split of byte-level pre-tokenization: every pre-token
#: lies inside one chunk.
BYTE_CHUNKS = re.compile(r" ?\S+|\s+(?!\S)|\s+")
#: The published pre-tokenization patterns of the two vocabularies.
BYTE_PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
WORD_PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")

#: Entries of a per-process cache.  Python workers outlive a stage, so the caches
#: of several operators add up beside the executor's heap.
CACHE_ENTRIES = 300_000
#: Code points handled together inside a task.
SLICE_CHARS = 2_000_000


def is_plain(text: str) -> bool:
    return _UNSAFE.search(text) is None


def slices(texts: Iterable[str | None], chars: int = SLICE_CHARS) -> Iterator[list[str]]:
    """Null becomes the empty text; a slice ends once it holds ``chars`` code points."""
    part, held = [], 0
    for text in texts:
        text = text or ""
        part.append(text)
        held += len(text)
        if held >= chars:
            yield part
            part, held = [], 0
    if part:
        yield part


_forgettable: list[weakref.ref] = []


def forgettable(owner) -> None:
    """``owner.forget()`` gives up what it has cached in this worker."""
    _forgettable.append(weakref.ref(owner))


def keep_only(*owners) -> None:
    """Empties the caches of all other owners: workers are used again by later
    stages and would hold those of earlier ones beside their own."""
    for ref in _forgettable:
        owner = ref()
        if owner is not None and not any(owner is o for o in owners):
            owner.forget()
    try:  # glibc keeps freed memory until it is told not to
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass


class Cache(dict):
    """``make(key)`` on a miss.  When it reaches its bound the entries become the
    old generation, from which those still in use come back without being made again."""

    def __init__(self, make, bound: int = CACHE_ENTRIES):
        super().__init__()
        self.make, self.bound, self.old = make, bound, {}
        forgettable(self)

    def forget(self) -> None:
        self.clear()
        self.old = {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.bound:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


@lru_cache(maxsize=1)
def byte_symbols() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: printable
    Latin-1 bytes stand for themselves, the others follow from code point 256 on."""
    table, spare = [], 256
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            table.append(chr(b))
        else:
            table.append(chr(spare))
            spare += 1
    return table


@lru_cache(maxsize=4)
def tokenizer_spec(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


@lru_cache(maxsize=4)
def library_tokenizer(path: str):
    import os
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


def special_tokens(path: str) -> dict[str, int]:
    return {t["content"]: t["id"] for t in tokenizer_spec(path)["added_tokens"]}


def special_pattern(path: str) -> re.Pattern:
    """Splits a text at its special strings, which the library never normalises."""
    found = sorted(special_tokens(path), key=len, reverse=True)
    return re.compile("(" + "|".join(map(re.escape, found)) + ")")
