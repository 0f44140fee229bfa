"""Ids of a byte-level BPE file of the tokenizers library, at the speed of tiktoken.

Both libraries give the same ids for ordinary text: every code point was compared in several contexts. Texts that hold
a special string, or a code point that this Python's Unicode tables don't know, are left to the tokenizers library.
"""

from __future__ import annotations

import functools
import json
import os

import numpy as np

from perigee.llm.bpe import byte_symbols, unassigned

#: Fixed value: the split pattern of the byte-level pre-tokenizer, with possessive runs and the end of a text apart
#: ('s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+ gives the same pieces, but slower).
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"


class ByteBpe:
    """Encoder of one file. literal: special strings inside texts are plain text."""

    def __init__(self, path: str, literal: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        if spec.get("normalizer") or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["pre_tokenizer"]["add_prefix_space"]:
            raise ValueError(f"{path} is not a plain byte-level BPE")
        byte_of = {c: b for b, c in enumerate(byte_symbols())}
        added = {t["id"]: t["content"] for t in spec["added_tokens"]}
        plain = {i: bytes(byte_of[c] for c in t) for t, i in spec["model"]["vocab"].items() if i not in added}
        if {bytes([b]) for b in range(256)} - set(plain.values()):
            raise ValueError(f"{path} lacks a token for some byte")  # with all of them every text comes back whole
        self.special = [] if literal else list(added.values())
        self.fast = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks={b: i for i, b in plain.items()}, special_tokens={})
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.library.encode_special_tokens = literal
        self.odd = unassigned()
        every = {**plain, **{i: t.encode() for i, t in added.items()}}
        self.bytes_of = [every.get(i, b"") for i in range(max(every) + 1)]
        self.length = np.array([len(b) for b in self.bytes_of], np.int64)

    def ids(self, text: str) -> list[int]:
        if any(s in text for s in self.special) or self._odd(text):
            return self.library.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)

    def _odd(self, text: str) -> bool:
        if text.isascii():
            return False
        try:
            text.encode("latin-1")  # all of its characters are known
        except UnicodeEncodeError:
            return self.odd.search("".join(set(text))) is not None
        return False


@functools.lru_cache(2)
def byte_bpe(path: str, literal: bool = False) -> ByteBpe:
    """The encoder of a file, once per Python worker."""
    return ByteBpe(path, literal)
