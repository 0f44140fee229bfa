"""Spans of patterns inside texts as arrays, in DataFrame operations only.

A pattern's matches come from regexp_extract_all and the texts between them from split; both scan alike, so the
running sum of their lengths gives each match's place in code points. Nothing leaves the row: no shuffle, no
skew, and a document of any size is one row's work.

Patterns repeat groups possessively and start long runs only at their beginning, so that Java's matcher neither
recurses deeply nor tries each start of a long run; the matches are those of the plain patterns.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from perigee.llm.common import let

#: Characters of context kept on the left and on the right of a match.
LEFT, RIGHT = 24, 12
#: Steps of running sums taken at once.
AT_ONCE = 256
#: Sizes, in code points, of the pieces a text is rewritten in.
PIECES = (65536, 1024)


def _sum(a: Column, b: Column) -> Column:
    return a + b


def _copied(steps: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """Running results; each step copies those before it, so only for few steps."""
    return F.aggregate(steps, F.array().cast("array<int>"), lambda acc, n: F.concat(
        acc, F.array(combine(F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0)), n))))


def running_sums(steps: Column, combine: Callable[[Column, Column], Column] = _sum) -> Column:
    """Running sums of an array of ints, in time that grows with its length.

    More than AT_ONCE steps are cut into slices of that many, each summed on its own and then moved by the sum of the
    slices before it. Any associative function for which 0 changes nothing may stand for the sum.
    """

    def cut(x: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(x), F.lit(AT_ONCE))
        inner = F.transform(starts, lambda i: _copied(F.slice(x, i, AT_ONCE), combine))
        return let(inner, lambda sums: F.flatten(F.zip_with(
            sums, let(_copied(F.transform(sums, lambda s: F.element_at(s, -1)), combine), lambda after: F.concat(F.array(F.lit(0)), after)),
            lambda s, before: F.transform(F.coalesce(s, F.array().cast("array<int>")), lambda v: combine(before, v)))))

    return let(steps, lambda x: F.when(F.size(x) <= AT_ONCE, _copied(x, combine)).otherwise(cut(x)))


def found(text: Column, kind: int, pattern: str, group: int | None = None) -> Column:
    """Array of structs start, kind, end, hit, left, right, part of the leftmost non-overlapping matches.

    start and end (exclusive) count code points; left and right are the text next to the match as far as the
    neighbouring match of the same pattern; part is the group asked for, else null.
    """

    def build(x: Column) -> Column:
        hits, pieces = x["hits"], x["pieces"]
        steps = F.zip_with(F.slice(pieces, 1, F.size(hits)), hits, lambda p, h: F.char_length(p) + F.char_length(h))
        ends = running_sums(steps)
        return F.transform(
            F.arrays_zip(hits.alias("hit"), ends.alias("end"), F.slice(pieces, 1, F.size(hits)).alias("before"),
                         F.slice(pieces, 2, F.size(hits)).alias("after"), x["parts"].alias("part")),
            lambda z: F.struct(
                (z["end"] - F.char_length(z["hit"])).alias("start"), F.lit(kind).alias("kind"), z["end"].alias("end"),
                z["hit"].alias("hit"), F.right(z["before"], F.lit(LEFT)).alias("left"),
                F.left(z["after"], F.lit(RIGHT)).alias("right"), z["part"].alias("part")))

    none = F.array().cast("array<string>")
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = none if group is None else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    made = let(F.struct(hits.alias("hits"), F.split(text, pattern, -1).alias("pieces"), parts.alias("parts")), build)
    empty = F.array().cast("array<struct<start:int,kind:int,end:int,hit:string,left:string,right:string,part:string>>")
    return F.when(text.rlike(pattern), made).otherwise(empty)


def listed(spans: Column, kinds: Sequence[str]) -> Column:
    """Spans (structs with start, kind, end) as kind:start:end by start, then kind, comma-joined."""
    names = F.array(*[F.lit(k) for k in kinds])
    ordered = F.sort_array(F.transform(spans, lambda s: F.struct(s["start"], s["kind"], s["end"])))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def merged(spans: Column) -> Column:
    """Spans (structs with start, kind, end) without overlaps, by start; overlapping ones become one of the first's kind."""
    ordered = F.sort_array(F.transform(spans, lambda s: F.struct(s["start"], s["kind"], s["end"])))

    def join(x: Column) -> Column:
        return let(running_sums(F.transform(x, lambda s: s["end"]), F.greatest), lambda ends: let(
            F.filter(F.zip_with(x, F.concat(F.array(F.lit(0)), F.slice(ends, 1, F.size(x) - 1)), lambda s, before: F.struct(
                s["start"].alias("start"), s["kind"].alias("kind"), before.alias("before"))), lambda s: s["start"] >= s["before"]),
            lambda firsts: F.zip_with(
                firsts, F.concat(F.transform(F.slice(firsts, 2, F.size(x)), lambda s: s["before"]), F.array(F.element_at(ends, -1))),
                lambda s, end: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), end.alias("end")))))

    empty = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    return let(ordered, lambda x: F.when(F.size(x) > 0, join(x)).otherwise(empty))


def covered(text: Column, spans: Column, marks: Sequence[str]) -> Column:
    """text with all spans, overlapping ones as one, replaced by the mark of their kind.

    Texts are cut into pieces and those into smaller ones, as a place in a text is found by walking through it: time
    grows with the text and its spans.
    """
    names = F.array(*map(F.lit, marks))

    def one(piece: Column, x: Column) -> Column:
        gaps = F.transform(x, lambda s, j: F.concat(
            let(F.when(j > 0, F.get(x, j - 1)["end"]).otherwise(0), lambda last: F.substring(piece, last + 1, s["start"] - last)),
            F.when(s["start"] >= 0, F.element_at(names, s["kind"] + 1)).otherwise("")))
        last = F.get(x, F.size(x) - 1)["end"]
        return F.when(F.size(x) > 0, F.concat(F.array_join(gaps, ""), F.substring(piece, last + 1, F.char_length(piece)))).otherwise(piece)

    def cut(part: Column, x: Column, sizes: Sequence[int]) -> Column:
        if not sizes:
            return one(part, x)
        size = sizes[0]

        def inside(i: Column) -> Column:
            mine = F.filter(x, lambda s: (s["start"] < (i + 1) * size) & (s["end"] > i * size))
            return F.transform(mine, lambda s: F.struct(
                (s["start"] - i * size).alias("start"), s["kind"].alias("kind"), (s["end"] - i * size).alias("end")))

        pieces = F.regexp_extract_all(part, F.lit(f"(?s).{{1,{size}}}"), F.lit(0))
        return F.when(F.size(x) == 0, part).otherwise(F.array_join(F.transform(
            pieces, lambda p, i: let(inside(i), lambda y: cut(p, y, sizes[1:]))), ""))

    return let(merged(spans), lambda x: cut(text, x, PIECES))
