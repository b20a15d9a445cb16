"""Byte-level BPE vocabularies: ranks from either file format, and an encoder per worker."""

from __future__ import annotations

import base64
import json
import os
import sys
from collections.abc import Callable, Iterator
from functools import lru_cache

import regex
import tiktoken
from public_tokenizers import PATTERN
from tokenizers import Tokenizer


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a ``.tiktoken`` file, or of a byte-level BPE definition whose ids follow its merges."""
    if not path.endswith(".json"):
        with open(path, "rb") as lines:
            pairs = (line.split() for line in lines if line.strip())
            return {base64.b64decode(token): int(rank) for token, rank in pairs}
    with open(path, encoding="utf-8") as file:
        definition = json.load(file)
    model, special = definition["model"], {token["content"] for token in definition["added_tokens"]}
    merges = [pair if isinstance(pair, list) else pair.split(" ") for pair in model["merges"]]
    merged = [model["vocab"]["".join(pair)] for pair in merges]
    if model["type"] != "BPE" or definition["pre_tokenizer"]["type"] != "ByteLevel" or merged != sorted(merged):
        raise ValueError(f"{path} is no byte-level BPE whose ids follow its merges")
    # Printable bytes stand for themselves; the others are written as letters from 256 on, in order.
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [byte for byte in range(256) if byte not in own]
    byte_of = {chr(byte): byte for byte in own} | {chr(256 + i): byte for i, byte in enumerate(others)}
    return {
        bytes(byte_of[letter] for letter in token): number
        for token, number in model["vocab"].items()
        if token not in special
    }


def added_tokens(path: str) -> dict[str, int]:
    """Texts that a definition reads as one token wherever they stand; a ``.tiktoken`` file has none."""
    if not path.endswith(".json"):
        return {}
    with open(path, encoding="utf-8") as file:
        added = json.load(file)["added_tokens"]
    if any(token[rule] for token in added for rule in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError(f"{path} has added tokens that are not read as they stand")
    return {token["content"]: token["id"] for token in added}


@lru_cache(maxsize=2)
def encoding(path: str) -> tiktoken.Encoding:
    """The encoder of a vocabulary, read once by each worker; added tokens are text to ``encode_ordinary``."""
    return tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=read_ranks(path), special_tokens=added_tokens(path))


@lru_cache(maxsize=2)
def library(path: str, special_as_text: bool = True) -> Tokenizer:
    """A definition in its own library, read once by each worker, one thread for each task."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    found = Tokenizer.from_file(path)
    found.encode_special_tokens = special_as_text
    return found


@lru_cache(maxsize=2)
def odd_characters(path: str) -> frozenset[str]:
    """The characters that the definition's library splits otherwise than ``PATTERN`` does.

    Their Unicode versions differ, so the library takes younger letters and digits for other signs.  Takes
    some seconds; meant for the driver, which hands the some thousand characters to the tasks.
    """
    known = regex.findall(r"[^\p{Cn}\p{Co}\p{Cs}]", "".join(map(chr, range(sys.maxunicode + 1))))
    splitter, pattern, odd = library(path).pre_tokenizer, regex.compile(PATTERN), set()

    def differ(characters: list[str]) -> bool:
        text = "".join(f"a!{character}" for character in characters) + "a"
        return [span for _, span in splitter.pre_tokenize_str(text)] != [match.span() for match in pattern.finditer(text)]

    waiting = [known[begin : begin + 512] for begin in range(0, len(known), 512)]
    while waiting:
        some = waiting.pop()
        if differ(some):
            half = len(some) // 2
            if half:
                waiting += [some[:half], some[half:]]
            else:
                odd.add(some[0])
    return frozenset(odd)


def pre_tokens(path: str, odd: frozenset[str]) -> Callable[[str], Iterator[str]]:
    """A function from a text to its pre-tokens as the definition's library splits it.

    ``odd`` is that of ``odd_characters``: only texts that hold such a character are split by the library
    itself, the others by the pattern, which is several times faster.
    """
    pattern = regex.compile(PATTERN)
    splitter = library(path).pre_tokenizer

    def split(text: str) -> Iterator[str]:
        if not text.isascii() and not odd.isdisjoint(text):
            return (text[begin:end] for _, (begin, end) in splitter.pre_tokenize_str(text))
        if len(text) < 1 << 20:
            return iter(pattern.findall(text))
        return (match.group() for match in pattern.finditer(text))

    return split


def ids_of(path: str, odd: frozenset[str], special_as_text: bool = True) -> Callable[[str], list[int]]:
    """A function from a text to its ids as the definition's library gives them.

    Texts without an ``odd`` character go to the faster merge library.
    """
    slow, coder = library(path, special_as_text), encoding(path)

    def encode(text: str) -> list[int]:
        if not text.isascii() and not odd.isdisjoint(text):
            return slow.encode(text, add_special_tokens=False).ids
        return coder.encode_ordinary(text) if special_as_text else coder.encode(text, allowed_special="all")

    return encode
