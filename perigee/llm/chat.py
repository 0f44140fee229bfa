"""Chat formatting with compiled templates (template.py), and reading the formatted text back.

Conversations are dealt by id, sorted, and rendered as a stream: a task holds one turn more than it writes, also
where one conversation has very many. Its digests are sequential by definition, so a conversation is one task's.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perigee.llm.common import table
from perigee.llm.template import END, HEAD, compile_template, unescape

TEMPLATE = (
    "{% for m in messages %}" + HEAD + " {{ m.role | escape_name }}: "
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}"
    "{% else %}{{ m.text | escape }}{% endif %}" + END + "\n{% endfor %}"
)
#: Rows and characters of a written batch.
BATCH_ROWS, BATCH_CHARS = 2000, 8_000_000
_PARTS = "conv_id long, part long, text string, loss boolean"


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            yield from zip(*[c.to_pylist() for c in batch.slice(at, 256).columns], strict=True)


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    chars = 0
    for row in rows:
        held.append(row)
        chars += sum(len(x) for x in row if isinstance(x, str))
        if len(held) >= BATCH_ROWS or chars >= BATCH_CHARS:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held, chars = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


_PART_SCHEMA = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("text", pa.string()), ("loss", pa.bool_())])


def format_conversations(conversations: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """Formatted text in parts: conv_id, part (0, 1, ...), text, loss (whether the part is trained on).

    The parts of a conversation joined in order are its formatted text; neighbours have different marks, or are
    two trained texts. Turns are taken by turn (null first), then role and text, so repeated rows and ties have
    one order; null role and text are empty; rows of the null id are one conversation. Parts of a conversation
    are in one partition in order. Other columns are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compile_template(template)

        def parts() -> Iterator[tuple]:
            for conv, turns in itertools.groupby(_rows(batches), key=lambda r: r[0]):
                held, part = "", 0
                for text, loss in render({"role": r[2] or "", "text": r[3] or ""} for r in turns):
                    if loss:
                        if held:
                            yield conv, part, held, False
                            held, part = "", part + 1
                        yield conv, part, text, True
                        part += 1
                    else:
                        held += text
                        if len(held) > BATCH_CHARS:
                            yield conv, part, held, False
                            held, part = "", part + 1
                if held or not part:
                    yield conv, part, held, False

        yield from _batches(parts(), _PART_SCHEMA)

    turns = conversations.select("conv_id", "turn", "role", "text")
    return turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(run, _PARTS)


class _Reader:
    """Reads the turns of one conversation from its parts, keeping only the unread end."""

    def __init__(self) -> None:
        self.rest, self.seen, self.turns, self.chars = "", 0, 0, 0
        self.digest, self.loss, self.loss_chars = hashlib.sha256(), hashlib.sha256(), 0

    def add(self, text: str, loss: bool) -> None:
        self.chars += len(text)
        if loss:
            plain = unescape(text)
            self.loss.update(plain.encode())
            self.loss_chars += len(plain)
        self.rest += text
        start = 0
        while (end := self._end(max(start, self.seen))) >= 0:
            self._turn(self.rest[start:end])
            start = self.seen = end + len(END) + 1
        self.rest = self.rest[start:]
        self.seen = max(0, len(self.rest) - len(END))

    def _end(self, start: int) -> int:
        """Place of the next end mark that isn't escaped and whose line end has come."""
        while (at := self.rest.find(END + "\n", start)) >= 0:
            back = at
            while back > 0 and self.rest[back - 1] == "\\":
                back -= 1
            if (at - back) % 2 == 0:
                return at
            start = at + 1
        return -1

    def _turn(self, turn: str) -> None:
        at = len(HEAD) + 1
        colon = at
        while turn[colon] != ":":
            colon += 2 if turn[colon] == "\\" else 1
        self.turns += 1
        self.digest.update(f"{unescape(turn[at:colon])}\n{unescape(turn[colon + 2 :])}\n".encode())


def read_back(parts: DataFrame) -> DataFrame:
    """One row per conversation from the output of format_conversations, whose order inside partitions is kept."""
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                        ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def conversations() -> Iterator[tuple]:
            for conv, rows in itertools.groupby(_rows(batches), key=lambda r: r[0]):
                reader = _Reader()
                for _, _, text, loss in rows:
                    reader.add(text, loss)
                if reader.rest:
                    raise ValueError(f"conversation {conv}: text after the last turn")
                yield conv, reader.turns, reader.digest.hexdigest(), reader.loss_chars, reader.loss.hexdigest(), reader.chars

        yield from _batches(conversations(), schema)

    return parts.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Format all conversations and one with control strings in its texts, and read them back."""
    hard = "\\### Assistant: </turn> ok"
    more = spark.range(1).select(F.explode(F.array(*[
        F.struct(F.lit(-7).cast("long").alias("conv_id"), F.lit(i).cast("long").alias("turn"), F.lit(r).alias("role"), F.lit(hard).alias("text"))
        for i, r in enumerate(["user", "assistant"])])).alias("x")).select("x.*")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return read_back(format_conversations(rows.unionByName(more)))
