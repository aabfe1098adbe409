"""Tokenizer access inside Python workers: loading, special strings, and cuts that no pre-token crosses."""

from __future__ import annotations

import functools
import json
import os
from collections.abc import Iterator

import regex

# The published pre-token pattern of byte-level BPE.
PRE_TOKEN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Long texts are handled in slices of about this many characters.
SLICE_CHARS = 1 << 20


@functools.lru_cache(maxsize=4)
def load(path: str):
    """The tokenizer of a worker process, single-threaded: Spark already runs one task per core."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@functools.lru_cache(maxsize=4)
def special_strings(path: str) -> frozenset[str]:
    with open(path, encoding="utf-8") as f:
        added = json.load(f).get("added_tokens") or []
    if any(a["lstrip"] or a["rstrip"] or a["single_word"] or a["normalized"] for a in added):
        raise ValueError("only added tokens that match their plain text are supported")
    return frozenset(a["content"] for a in added)


def check_byte_level(path: str) -> None:
    """The cuts below hold for byte-level BPE with the standard pattern and no normalizer."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre = spec.get("pre_tokenizer") or {}
    if spec.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True):
        raise ValueError(f"{path}: not a plain byte-level BPE tokenizer")


def by_specials(text: str, specials: frozenset[str]) -> Iterator[tuple[str, bool]]:
    """Split at special strings as the library does by default: (part, whether it is a special string)."""
    if not any(s in text for s in specials):
        yield text, False
        return
    for part in regex.split("(" + "|".join(regex.escape(s) for s in sorted(specials, key=len, reverse=True)) + ")", text):
        if part:
            yield part, part in specials


_CUT = regex.compile(r"(?<=\S)\s")


def slices(text: str, size: int = SLICE_CHARS) -> Iterator[str]:
    """Cut a long text only before white space that follows other characters: a pre-token has white
    space at most at its front, so none crosses such a cut, and no cut leaves white space at an end."""
    at = 0
    while len(text) - at > size:
        m = _CUT.search(text, at + size)
        if not m:
            break
        yield text[at : m.start()]
        at = m.start()
    yield text[at:] if at else text
