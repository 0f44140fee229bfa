"""Quality rules by distribution divergence, in DataFrame operations only.

A document's histogram over character classes and its histogram over the common words of its language are held
against the language's references with the Jensen-Shannon distance. The references are sums over all documents
that pass the base rules, one reference for each value of lang. A histogram is judged only above a least size, as
short texts diverge by chance, and only where the language is known.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perigee.llm.common import let, packed, table, written
from perigee.session import stable

#: Frequent words of each language that has a reference of its own.
COMMON_WORDS = {
    "en": ["the", "of", "and", "to", "in", "is", "that", "for", "on", "with"],
    "de": ["der", "die", "und", "den", "das", "von", "zu", "mit", "ist", "für"],
    "fr": ["le", "la", "de", "les", "des", "et", "du", "que", "en", "une"],
    "es": ["de", "la", "que", "el", "en", "los", "del", "las", "un", "para"],
}
#: Bounds of the base rules.
LEAST_WORDS, MOST_REPEATED_PERCENT = 50, 50
#: Guards: least characters and words before a histogram is judged. Limits: largest distance of a kept document.
LEAST_CHARS_JUDGED, LEAST_WORDS_JUDGED = 200, 50
MOST_CHAR_DISTANCE, MOST_WORD_DISTANCE = 0.155, 0.45
#: Lang (in lower case) that names no single language; null is one more.
UNIDENTIFIED = ["", "und", "unknown", "mul", "mis", "zxx", "other"]
#: Most languages whose references are broadcast; beyond, they are joined.
BROADCAST_LANGS = 20_000
#: Parts a table of references is saved in.
REFERENCE_PARTS = 8

SPACES = " \t\n\x0b\x0c\r"
CHAR_CLASSES = ["[a-z]+", "[^\\x00-\\x7F]+", "[A-Z]+", "[.,;:?'\"()-]+", "[0-9]+"]  # the rest of a word's characters: symbols
CHARS, COMMON = len(CHAR_CLASSES) + 2, 10  # with symbols and white space
_Q, _V = "__quality", "__verdict"


def _language(lang: Column) -> Column:
    """The document's own lang, null where it names no single language."""
    return F.when(~F.lower(F.btrim(lang, F.lit(SPACES))).isin(*UNIDENTIFIED), lang)


#: Low bits of a sorting key that hold a window's place.
PLACE_BITS = 24


def _tail(x: Column, start: int) -> Column:
    return F.slice(x, start, F.greatest(F.size(x) - (start - 1), F.lit(0)))


def _repeated_words(w: Column) -> Column:
    """Words in 3-word windows that occur twice or more, by 64-bit fingerprints of the windows.

    One sort of plain numbers (upper bits of the fingerprint, place) finds the windows that may be repeated; the
    full fingerprints of these alone are then compared.
    """
    n = F.greatest(F.size(w) - 2, F.lit(0))
    pairs = F.zip_with(w, _tail(w, 2), lambda a, b: F.xxhash64(a, b))
    windows = F.zip_with(F.slice(pairs, 1, n), _tail(w, 3), lambda h, c: F.xxhash64(h, c))
    low = F.lit((1 << PLACE_BITS) - 1).cast("long")

    def covered(s: Column) -> Column:
        """Distinct words covered by equal neighbours of a sorted array of (fingerprint, place)."""
        twice = F.filter(F.zip_with(F.slice(s, 1, F.size(s) - 1), _tail(s, 2), lambda a, b: F.when(
            a["h"] == b["h"], F.array(a["i"], a["i"] + 1, a["i"] + 2, b["i"], b["i"] + 1, b["i"] + 2))), lambda x: x.isNotNull())
        return F.size(F.array_distinct(F.flatten(twice)))

    def all_sorted(g: Column) -> Column:
        return F.sort_array(F.transform(g, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def suspects(g: Column, keys: Column) -> Column:
        places = F.flatten(F.zip_with(F.slice(keys, 1, F.size(keys) - 1), _tail(keys, 2), lambda a, b: F.when(
            F.shiftright(a, PLACE_BITS) == F.shiftright(b, PLACE_BITS),
            F.array(a.bitwiseAND(low).cast("int"), b.bitwiseAND(low).cast("int"))).otherwise(F.array().cast("array<int>"))))
        return F.sort_array(F.transform(F.array_distinct(places), lambda i: F.struct(F.get(g, i).alias("h"), i.alias("i"))))

    def sorted_windows(g: Column) -> Column:
        keys = F.sort_array(F.transform(g, lambda h, i: F.shiftleft(F.shiftright(h, PLACE_BITS), PLACE_BITS).bitwiseOR(i.cast("long"))))
        few = let(keys, lambda k: suspects(g, k))
        return F.when(F.size(g) < (1 << PLACE_BITS), few).otherwise(all_sorted(g))

    def counted(g: Column) -> Column:
        return F.when(F.size(F.array_distinct(g)) < F.size(g), let(sorted_windows(g), covered)).otherwise(F.lit(0))

    return F.when(F.size(w) >= 3, let(windows, counted)).otherwise(F.lit(0)).cast("long")


def _chain(first: Column, steps: list[Callable[[Column], Column]], last: Callable[[Column], Column]) -> Column:
    """Characters of the first value and of what each step leaves of it, then last() of the remainder."""
    if not steps:
        return F.array(F.char_length(first), last(first))
    return F.concat(F.array(F.char_length(first)), let(steps[0](first), lambda x: _chain(x, steps[1:], last)))


def measured(docs: DataFrame) -> DataFrame:
    """docs with one more column: a struct of everything the rules need, computed inside the row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lang = _language(F.col("lang"))
    trimmed = F.btrim(text, F.lit(SPACES))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "[\\x20\\x09-\\x0D]+"))
    own = F.create_map(*[x for k, v in COMMON_WORDS.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])[lang]
    usual = F.coalesce(own, F.array().cast("array<string>"))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")

    def fields(w: Column) -> Column:
        joined = F.array_join(w, "")
        # characters of the words, less one class after the other; then words less one common word after the other
        strip = [lambda x, p=p: F.regexp_replace(x, p, "") for p in CHAR_CLASSES]
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            _repeated_words(w).alias("n_repeat_words"),
            _chain(joined, strip, lambda x: F.regexp_count(x, F.lit("[#*$%&|<>]"))).alias("lefts"),
            let(F.filter(w, lambda x: F.array_contains(usual, x)), lambda f: F.transform(
                usual, lambda c: F.size(F.filter(f, lambda x: x == c)).cast("long"))).alias("common"))

    def result(m: Column) -> Column:
        sizes = [m["lefts"][i] for i in range(len(CHAR_CLASSES) + 1)]
        chars = [a - b for a, b in zip(sizes, sizes[1:])] + [sizes[-1], F.char_length(text) - sizes[0]]
        return F.struct(
            m["n_words"].alias("n_words"), sizes[0].cast("long").alias("word_chars"), m["lefts"][len(CHAR_CLASSES) + 1].cast("long").alias("n_symbols"),
            let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            m["n_repeat_words"].alias("n_repeat_words"), lang.alias("lang"),
            F.array(*[c.cast("long") for c in chars]).alias("chars"),
            F.when(F.size(m["common"]) > 0, m["common"]).otherwise(F.array(*[F.lit(0).cast("long")] * COMMON)).alias("common"))

    return docs.withColumn(_Q, let(let(words, fields), result))


def base_failed(q: Column) -> Column:
    return (q["n_words"] < LEAST_WORDS) | (100 * q["n_repeat_words"] > MOST_REPEATED_PERCENT * q["n_words"])


def references(profiles: DataFrame) -> DataFrame:
    """One row per known language: summed histograms of all documents that pass the base rules, then once more of
    those among them that are near the first sums, so that junk doesn't blur the reference.

    Where a language without a list of common words has no document near its first sums (much junk), the half that
    is nearest takes their place.
    """
    q, v = F.col(_Q), F.col(_V)

    def sums(rows: DataFrame, near: Column) -> DataFrame:
        """Sums of the near rows of each language: nulls where it has none."""
        def total(x: Column) -> Column:
            return F.sum(F.when(near, x))

        return rows.groupBy(q["lang"].alias("__ref_lang")).agg(
            F.array(*[total(q["chars"][i]) for i in range(CHARS)]).alias("__ref_chars"),
            F.array(*[total(q["common"][i]) for i in range(COMMON)]).alias("__ref_common"),
            total(q["n_words"]).alias("__ref_words")).coalesce(REFERENCE_PARTS)

    sound = profiles.filter(~base_failed(q) & q["lang"].isNotNull()).select(_Q)
    first = stable(sums(sound, F.lit(True)))
    second = stable(sums(judged(sound, first), v["kept"]))
    lost = second.filter(F.col("__ref_words").isNull() & ~F.col("__ref_lang").isin(*COMMON_WORDS)).select("__ref_lang")
    if lost.isEmpty():
        return second
    far = stable(first.join(lost, "__ref_lang"))
    middle = judged(sound, far).filter(F.col("__ref_lang").isNotNull()).groupBy("__ref_lang").agg(
        F.percentile_approx(v["char_distance"], 0.5).alias("__middle"))
    halves = judged(sound, stable(far.join(middle, "__ref_lang"))).filter(F.col("__ref_lang").isNotNull())
    nearest = sums(halves, v["char_distance"] <= F.col("__middle"))
    return stable(second.join(lost, "__ref_lang", "left_anti").union(nearest))


def _distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two histograms (arrays of counts), in base 2, between 0 and 1."""

    def total(x: Column) -> Column:
        return F.aggregate(x, F.lit(0).cast("long"), lambda a, b: a + b)

    def part(a: Column, b: Column) -> Column:
        return F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(F.lit(0.0))

    def distance(z: Column) -> Column:
        shares = F.zip_with(p, q, lambda x, y: F.struct((x / z["p"]).alias("a"), (y / z["q"]).alias("b")))
        halves = F.transform(shares, lambda v: part(v["a"], v["b"]) + part(v["b"], v["a"]))
        summed = F.aggregate(halves, F.lit(0.0), lambda a, b: a + b)
        return F.when((z["p"] > 0) & (z["q"] > 0), F.sqrt(F.greatest(summed / 2, F.lit(0.0)))).otherwise(F.lit(0.0))

    return let(F.struct(total(p).alias("p"), total(q).alias("q")), distance)


def judged(profiles: DataFrame, reference: DataFrame) -> DataFrame:
    """Adds the verdict and distances as a struct column; without a language nothing but the base rules counts.

    The reference, a saved table of one row per language, is counted and broadcast where it is small.
    """
    q = F.col(_Q)
    if reference.limit(BROADCAST_LANGS + 1).count() <= BROADCAST_LANGS:
        df = profiles.join(F.broadcast(reference), q["lang"] == F.col("__ref_lang"), "left")
    else:  # documents without a language are spread
        spread = F.coalesce(q["lang"], F.concat(F.lit("\0"), F.pmod(F.xxhash64(q), F.lit(4096)).cast("string")))
        df = profiles.join(reference.hint("merge"), spread == F.col("__ref_lang"), "left")

    def with_rest(common: Column, words: Column) -> Column:
        used = F.aggregate(common, F.lit(0).cast("long"), lambda a, b: a + b)
        return F.concat(common, F.array(F.greatest(words - used, F.lit(0).cast("long"))))

    chars = let(q["chars"], lambda c: F.when(F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + x) >= LEAST_CHARS_JUDGED,
                                             F.coalesce(_distance(c, F.col("__ref_chars")), F.lit(0.0))).otherwise(F.lit(0.0)))
    words = F.when((q["n_words"] >= LEAST_WORDS_JUDGED) & q["lang"].isin(*COMMON_WORDS), F.coalesce(_distance(
        with_rest(q["common"], q["n_words"]), with_rest(F.col("__ref_common"), F.col("__ref_words"))), F.lit(0.0))).otherwise(F.lit(0.0))

    def verdict(d: Column) -> Column:
        near = (d["chars"] <= MOST_CHAR_DISTANCE) & (d["words"] <= MOST_WORD_DISTANCE)
        return F.struct(d["chars"].alias("char_distance"), d["words"].alias("word_distance"),
                        base_failed(q).alias("base_failed"), (~base_failed(q) & near).alias("kept"))

    return df.withColumn(_V, let(F.struct(chars.alias("chars"), words.alias("words")), verdict))


def quality(docs: DataFrame) -> DataFrame:
    """Counts, distances and verdict of every document (columns doc_id, text and lang are read).

    A null or empty text has no words and fails the base rules. Every value of lang has its own reference; without a
    list of common words only characters are judged, and a lang that is null or names no single language is held to
    the base rules alone. Repeated rows and null keys are judged like any row.
    """
    profiles = stable(measured(docs.select("doc_id", "text", "lang")).select("doc_id", _Q))  # a few numbers a row
    q, v = F.col(_Q), F.col(_V)
    return judged(profiles, references(profiles)).select(
        "doc_id", *[q[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        *[v[c].alias(c) for c in ("base_failed", "kept", "char_distance", "word_distance")])


def keep_good(docs: DataFrame) -> DataFrame:
    """Rows of docs, all columns, that quality() keeps; shuffled only beyond BROADCAST_LANGS languages.

    Rows and their measures are written once as Parquet; the references are summed from the measures alone.
    """
    rows = written(measured(packed(docs, F.col("text"), F.col("lang"))).select("row", _Q), "measured")
    return judged(rows, references(rows)).filter(f"{_V}.kept").select("row.*")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdict of every whole text of documents."""
    return quality(table(spark, sf_dir, "documents")).drop("char_distance", "word_distance")
