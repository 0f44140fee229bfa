"""Token counts with overlap resynchronisation for huge documents.

A text of more than CHUNK characters is encoded in overlapping chunks with offsets. Two neighbours are spliced
at a position where both begin a pre-token and which lies at least MARGIN characters before the left chunk's
end. Such a position is proven: the left chunk's pre-tokens were cut without seeing its end, and what follows a
pre-token start depends only on the text after it, so the right chunk is exact from there on. Where the overlap
holds no such position (one enormous word, say) it is doubled, up to the last proven position.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from perigee.llm.common import map_rows, table, tokenizer_path

BYTE_BPE = tokenizer_path("byte_bpe_50k.json")
#: Characters of a chunk, of the first overlap, and between a splice and the left chunk's end. The margin is
#: longer than any special string and any lookahead of the split pattern.
CHUNK, OVERLAP, MARGIN = 32_768, 512, 64
TOKEN_LIMIT = 1024


def _starts(encoding, offset: int) -> dict[int, int]:
    """Position of each pre-token's start in the whole text, and how many tokens lie before it."""
    words, places = encoding.word_ids, encoding.offsets
    return {
        offset + places[i][0]: i
        for i in range(len(words))
        if i == 0 or words[i] is None or words[i] != words[i - 1]
    }


def spliced_count(tokenizer, text: str, chunk: int = CHUNK, overlap: int = OVERLAP, margin: int = MARGIN) -> int:
    """Number of tokens of a text of any length, never encoding more than a widened chunk at once."""

    def encode(begin: int, end: int):
        return tokenizer.encode(text[begin:end], add_special_tokens=False)

    size, total, proven = len(text), 0, 0
    left_begin, left_end = 0, min(size, chunk)
    left = encode(left_begin, left_end)
    while left_end < size:
        at = _starts(left, left_begin)
        width = overlap
        while True:
            begin = max(proven, left_end - width)
            end = min(size, max(left_end, begin) + chunk + (width if begin == proven else 0))
            right = encode(begin, end)
            if begin == proven:  # widened as far as the last proven position: nothing is left to align
                splice = proven
                break
            common = [p for p in _starts(right, begin).keys() & at.keys() if begin < p <= left_end - margin]
            if common:
                splice = min(common)
                break
            width *= 2
        total += at[splice] - at[proven]
        proven, left, left_begin, left_end = splice, right, begin, end
    at = _starts(left, left_begin)
    return total + len(left) - (at[proven] if len(left) else 0)


def count_tokens(
    docs: DataFrame, path: str = BYTE_BPE, limit: int = TOKEN_LIMIT, chunk: int = CHUNK, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """Bytes, tokens and whether they pass the limit, of every whole text.

    Null and empty texts have 0 of both. Repeated rows and null keys stay as they are; other columns are left
    out. Special strings inside texts are handled as the library does by default.
    """

    def task():
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()

        def work(columns):
            texts = [t or "" for t in columns[1]]
            short = [i for i, t in enumerate(texts) if len(t) <= chunk]
            counts = [0] * len(texts)
            for i, e in zip(short, tokenizer.encode_batch_fast([texts[i] for i in short], add_special_tokens=False), strict=True):
                counts[i] = len(e)
            for i, t in enumerate(texts):
                if len(t) > chunk:
                    counts[i] = spliced_count(tokenizer, t, chunk)
            return {
                "key": columns[0],
                "n_bytes": [len(t.encode()) for t in texts],
                "n_tokens": counts,
                "over_limit": [c > limit for c in counts],
            }

        return work

    kind = docs.schema[key].dataType.simpleString()
    out = map_rows(docs.select(key, text), task, f"key {kind}, n_bytes long, n_tokens long, over_limit boolean")
    return out.withColumnRenamed("key", key)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every whole text of documents."""
    return count_tokens(table(spark, sf_dir, "documents"), BYTE_BPE)
