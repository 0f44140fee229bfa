"""BPE encoding and decoding with a backtracking encoder.

Text becomes words as the tokenizer file says (special strings, NFC, lower case, split pattern). A word is
covered from the left by its longest token (matches of an Aho-Corasick automaton); a token may follow another
only if merging their joined symbols by rank would end in exactly this pair, else a shorter token is tried, and
where none is left the position is marked dead and the last token is taken back. Every position dies at most
once, so the work is linear and the result is that of the merges. Decoding reads an offset table over one string
of all token texts.
"""

from __future__ import annotations

import functools
import itertools
import json
import re
import unicodedata

import ahocorasick
import numpy as np
import regex
from pyspark.sql import DataFrame, SparkSession

from perigee.llm.common import map_rows, sha256, table, tokenizer_path

WORD_BPE = tokenizer_path("word_bpe_49k.json")
#: Words and pairs a task remembers; both memories start anew when full, which changes no result.
REMEMBERED = 300_000


def byte_symbols() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    extra = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(extra)) for b in range(256)]


@functools.cache
def unassigned() -> re.Pattern:
    """Code points this Python knows nothing of; newer Unicode versions have letters among them."""
    runs = itertools.groupby(range(0x110000), lambda c: unicodedata.category(chr(c)) == "Cn")
    spans = [(r[0], r[-1]) for odd, r in ((odd, list(r)) for odd, r in runs) if odd]
    return re.compile("[" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in spans) + "]")


def latin_pattern(pattern: str) -> str:
    """The split pattern for texts below U+0100, where the classes are short enough for the faster module."""
    marks = {"\\p{L}": "L", "\\p{N}": "N", "\\s": "Z"}
    members: dict[str, str] = {}
    for mark, first in marks.items():
        inside = [c for c in map(chr, range(256)) if unicodedata.category(c).startswith(first)]
        if first == "Z":
            inside += map(chr, [*range(9, 14), 0x85])
        members[mark] = "".join(map(re.escape, inside))
    for mark, inside in members.items():
        pattern = pattern.replace(mark, inside)
    return pattern


class BacktrackingEncoder:
    """Exact encoder and decoder of a word BPE file with an end-of-word suffix."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        suffix = model.get("end_of_word_suffix") or ""
        byte_of = {c: b for b, c in enumerate(byte_symbols())}
        vocab: dict[str, int] = model["vocab"]

        def symbols(token: str) -> str:
            """One character per base token: a byte, or 256 + byte for the last byte of a word."""
            if suffix and token.endswith(suffix) and len(token) > len(suffix):
                body = [byte_of[c] for c in token[: -len(suffix)]]
                body[-1] += 256
            else:
                body = [byte_of[c] for c in token]
            return "".join(map(chr, body))

        specials = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.id_of = {symbols(t): i for t, i in vocab.items() if t not in specials}
        self.length = {i: len(s) for s, i in self.id_of.items()}
        self.most = max(self.length.values())
        self.text_of = {i: s for s, i in self.id_of.items()}
        self.rank_of: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.rank: dict[int, int] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            whole = vocab[left + right]
            self.rank_of.setdefault((vocab[left], vocab[right]), rank)
            if whole not in self.parts:
                self.parts[whole], self.rank[whole] = (vocab[left], vocab[right]), rank
        self.matches = ahocorasick.Automaton()
        self.longest: dict[str, int] = {}  # of each state of the automaton, the longest token that begins its string
        for s, i in sorted(self.id_of.items(), key=lambda x: len(x[0])):
            self.matches.add_word(s, i)
            for n in range(1, len(s)):
                self.longest.setdefault(s[:n], self.longest.get(s[: n - 1], -1))
            self.longest[s] = i
        self.matches.make_automaton()
        self.shorter: dict[int, int] = {}
        self.compatible: dict[tuple[int, int], bool] = {}
        self.path = path
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.split = regex.compile(pattern)
        self.split_latin = re.compile(latin_pattern(pattern))
        self.specials = specials
        self.special_split = regex.compile("(" + "|".join(map(regex.escape, sorted(specials, key=len, reverse=True))) + ")") if specials else None
        # decoding: text of token i and the blank after it is joined[offsets[i]:offsets[i + 1]]
        names = {i: t for t, i in vocab.items()} | {i: t for t, i in specials.items()}
        texts = [names.get(i, "").encode() + b" " for i in range(max(names) + 1)]
        self.offsets = np.cumsum([0, *map(len, texts)])
        self.joined = np.frombuffer(b"".join(texts), np.uint8)
        self.words = _Words(self)

    def _shorter(self, token: int) -> int:
        """The longest token that is a proper prefix of this one, -1 if there is none."""
        found = self.shorter.get(token)
        if found is None:
            s = self.text_of[token]
            found = next((self.id_of[s[:n]] for n in range(len(s) - 1, 0, -1) if s[:n] in self.id_of), -1)
            self.shorter[token] = found
        return found

    def _pair(self, left: int, right: int) -> bool:
        """Whether merging by rank leaves this pair as it is."""
        known = self.compatible.get((left, right))
        if known is None:
            if len(self.compatible) > REMEMBERED:
                self.compatible.clear()
            known = self.compatible[(left, right)] = self._stays(left, right)
        return known

    def _stays(self, a: int, b: int) -> bool:
        # Undo the merges of both sides from the last one back; a merge across the border must never come first.
        before = len(self.rank_of)
        while True:
            rank = self.rank_of.get((a, b))
            if rank is not None and rank < before:
                return False
            # Take the later of the two merges back; among equal ranks the left one was done first.
            ra, rb = self.rank.get(a, -1), self.rank.get(b, -1)
            if ra < 0 and rb < 0:
                return True
            if ra > rb:
                before, a = ra, self.parts[a][1]
            else:
                before, b = rb + 1, self.parts[b][0]

    def _longest(self, text: str, at: int) -> int:
        ahead = text[at : at + self.most]
        return self.longest[ahead[: self.matches.longest_prefix(ahead)]]

    def encode_word(self, word: str) -> list[int]:
        raw = word.encode()
        text = raw[:-1].decode("latin-1") + chr(raw[-1] + 256)
        n = len(text)
        alive = bytearray(b"\x01") * (n + 1)
        out: list[int] = []
        at, token = 0, self._longest(text, 0)
        while at < n:
            while True:
                end = at + self.length[token]
                if alive[end] and (not out or self._pair(out[-1], token)):
                    out.append(token)
                    at = end
                    token = self._longest(text, at) if at < n else -1
                    break
                token = self._shorter(token)
                if token < 0:
                    alive[at] = 0
                    token = out.pop()
                    at -= self.length[token]
                    break
        return out

    @functools.cached_property
    def _library(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def _split(self, text: str) -> list[str]:
        # Lower case is taken one character at a time, so no final sigma.
        plain = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        try:
            plain.encode("latin-1")
            return self.split_latin.findall(plain)
        except UnicodeEncodeError:
            pass
        if not text.replace("\n", " ").isprintable() and unassigned().search(text):  # the library may know these code points
            text = self._library.normalizer.normalize_str(text)
            return [text[a:b] for _, (a, b) in self._library.pre_tokenizer.pre_tokenize_str(text)]
        return self.split.findall(plain)

    def _plain(self, text: str) -> bytes:
        return b"".join(map(self.words.__getitem__, self._split(text)))

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        if self.special_split is None or not any(s in text for s in self.specials):
            return np.frombuffer(self._plain(text), "<u4")
        parts = [np.array([self.specials[p]], "<u4").tobytes() if k % 2 else self._plain(p)
                 for k, p in enumerate(self.special_split.split(text))]
        return np.frombuffer(b"".join(parts), "<u4")

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 of the decoded text: the tokens' texts with blanks between them."""
        ids = np.asarray(ids, np.int64)
        if not len(ids):
            return b""
        starts, sizes = self.offsets[ids], self.offsets[ids + 1] - self.offsets[ids]
        ends = np.cumsum(sizes)
        return self.joined[np.arange(ends[-1]) + np.repeat(starts - (ends - sizes), sizes)].tobytes()[:-1]


class _Words(dict):
    """Ids, as bytes, of the words seen last."""

    def __init__(self, encoder: BacktrackingEncoder):
        super().__init__()
        self.encoder = encoder

    def __missing__(self, word: str) -> bytes:
        if len(self) > REMEMBERED:
            self.clear()
        ids = np.array(self.encoder.encode_word(word), "<u4").tobytes()
        if len(word) <= 64:
            self[word] = ids
        return ids


def encode_documents(docs: DataFrame, path: str = WORD_BPE, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Token ids of every whole text: key, ids (array<int>), decoded (binary, UTF-8 of the decoded text).

    A null or empty text gives no ids. Rows are independent: repeated and null keys stay as they are, other
    columns are left out. The ids of one text are the only thing whose size follows a text.
    """

    def task():
        encoder = BacktrackingEncoder(path)

        def work(columns):
            ids = [encoder.encode(t or "") for t in columns[1]]
            return {"key": columns[0], "ids": [i.tolist() for i in ids], "decoded": [encoder.decode(i) for i in ids]}

        return work

    kind = docs.schema[key].dataType.simpleString()
    return map_rows(docs.select(key, text), task, f"key {kind}, ids array<int>, decoded binary").withColumnRenamed("key", key)


def digest_documents(docs: DataFrame, path: str = WORD_BPE) -> DataFrame:
    """encode_documents folded to counts and digests inside the same task, so that ids never leave it."""

    def task():
        encoder = BacktrackingEncoder(path)

        def work(columns):
            out = {"doc_id": columns[0], "n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
            for text in columns[1]:
                ids = encoder.encode(text or "")
                out["n_tokens"].append(len(ids))
                out["ids_sha256"].append(sha256(ids.tobytes()))
                out["decoded_sha256"].append(sha256(encoder.decode(ids)))
            return out

        return work

    return map_rows(docs.select("doc_id", "text"), task, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode every whole text of documents and decode it again; counts and digests per document."""
    return digest_documents(table(spark, sf_dir, "documents"), WORD_BPE)
