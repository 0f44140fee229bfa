"""Personal data: candidate gradient boosting over generated spans, in DataFrame operations only.

Generators of high recall propose spans, which may overlap. Those of the base kinds that pass their checks always
stay. The further ones are scored by gradient-boosted trees over format and context features; a span is taken
where the margin passes its kind's threshold, calibrated on held-out labelled samples for a wanted precision.
The trees are fitted by MLlib on a bounded table of samples that Spark generates, and applied as one expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perigee.llm.common import boosted_margin, fit_boosted, let, table
from perigee.llm.spans import LEFT, found, listed
from perigee.session import stable

KINDS = ["email", "ip", "card", "phone", "email_spelled", "phone_local", "national_id", "iban", "ip6"]
BASE = 4
_LOCAL = "A-Za-z0-9._%+-"
#: The base patterns, as found() wants them.
PATTERNS = [
    f"(?:(?<![{_LOCAL}])|\\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++",
    "(?:(?<![0-9])|\\G)[0-9]++\\.[0-9]++\\.[0-9]++\\.[0-9]++",
    "[0-9](?:[\\x20-]?+[0-9])++",
    "\\+[0-9][\\x20().0-9-]+[0-9]",
    # proposals of the method
    f"(?<![{_LOCAL}])[{_LOCAL}]{{1,64}}+\\x20?[\\[({{]\\x20?at\\x20?[\\])}}]\\x20?[A-Za-z0-9-]{{1,63}}"
    "(?:(?:\\x20?[\\[({]\\x20?dot\\x20?[\\])}]\\x20?|\\.)[A-Za-z0-9-]{1,63})++",
    "(?<![0-9+.,(-])(?<!\\+[0-9]{1,3}[\\x20-])\\(?[0-9]{3}\\)?[\\x20.-][0-9]{3}[\\x20.-][0-9]{4}(?![0-9])",
    "(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\\x20?[A-Z0-9]{4}){2,7}(?:\\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){3,7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
]
#: Labelled samples, trees, depth, and the precision thresholds are calibrated for.
SAMPLES, TREES, DEPTH, PRECISION = 4000, 24, 4, 0.97

FEATURES = ["kind", "length", "digits", "letters", "separators", "first_digit", "valid", "hex_letters", "friendly", "technical", "leads",
            "glued_left", "glued_right"]
#: Words before personal data and before other numbers.
_FRIENDLY = ("call phone tel mobile cell fax mail email contact write reach whatsapp text ring dial ssn social insurance tax passport "
             "national citizen iban bank account transfer konto compte cuenta pay host address client visitor login from").split()
_TECHNICAL = ("order version part sku lot isbn serial build item model range score time clock ref batch meet lunch room figure column "
              "row table page chapter section line see code case draw position step ratio port street box gate").split()
_NEUTRAL = "the of and then so now here it was with on that day they said also we she he you again".split()
#: A place farther off than any word in the context.
_FAR = LEFT + 1


def _size_of(text: Column, pattern: str) -> Column:
    return F.char_length(F.regexp_replace(text, pattern, ""))


def _mod97(account: Column) -> Column:
    """Remainder of an account number with its first four characters moved to the end and letters as 10 to 35."""
    plain = F.regexp_replace(account, "\\x20", "")
    moved = F.concat(F.substring(plain, 5, 99), F.left(plain, F.lit(4)))
    values = F.transform(F.slice(F.split(moved, ""), 1, F.char_length(moved)), lambda c: F.instr(F.lit(_DIGITS36), c) - 1)
    return F.aggregate(values, F.lit(0), lambda r, v: (F.when(v < 10, r * 10).otherwise(r * 100) + v) % 97)


_DIGITS36 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _valid(kind: Column, hit: Column) -> Column:
    """Whether the candidate is well formed: known endings of hosts, area codes, number ranges, check digits, eight groups."""
    return (F.when(kind == 4, hit.rlike("(?i)(com|org|net|edu|gov|info|io|de|fr|es|uk|eu)$"))
            .when(kind == 5, hit.rlike("^\\(?[2-9][0-9]{2}"))
            .when(kind == 6, hit.rlike("^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$"))
            .when(kind == 7, _mod97(hit) == 1)
            .otherwise(hit.rlike("^(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}$")))


def _distance(left: Column, words: list[str]) -> Column:
    """Characters between the last of these words in the left context and the candidate; _FAR without one."""
    pattern = f"(?is)^.*(?<![a-z])(?:{'|'.join(words)})s?(?![a-z])(.*)$"
    return F.when(left.rlike(pattern), F.char_length(F.regexp_extract(left, pattern, 1))).otherwise(_FAR)


def features(kind: Column, hit: Column, left: Column, right: Column) -> list[Column]:
    """Numbers for the trees, in the order of FEATURES; words count by their distance, and which kind of word is nearer."""

    def flag(x: Column) -> Column:
        return F.when(x, 1.0).otherwise(0.0)

    length = F.char_length(hit)
    digits, letters = _size_of(hit, "[^0-9]"), _size_of(hit, "[^A-Za-z]")
    friendly, technical = _distance(left, _FRIENDLY), _distance(left, _TECHNICAL)
    return [
        kind.cast("double"), length.cast("double"), digits.cast("double"), letters.cast("double"), (length - digits - letters).cast("double"),
        F.coalesce(F.regexp_extract(hit, "[0-9]", 0).try_cast("double"), F.lit(-1.0)), flag(_valid(kind, hit)),
        flag(hit.rlike("[a-fA-F]")), friendly.cast("double"), technical.cast("double"), (technical - friendly).cast("double"),
        flag(left.rlike("[A-Za-z0-9_/#.=-]$")), flag(right.rlike("^[A-Za-z0-9_/#=-]")),
    ]


def labelled_samples(spark: SparkSession, samples: int = SAMPLES, seed: int = 5) -> DataFrame:
    """Columns kind, hit, left, right, label (1.0 personal, 0.0 not) and held_out; formats follow the proposals.

    Neither format nor context tells the label alone. Personal: well formed, and the nearest telling word, if there is
    one, is friendly. Not personal: well formed after a technical word or glued to other characters, or ill formed
    in any context. Words of the other side may stand farther off in both. Held-out rows use other telling words (the
    second half of each list).
    """
    i = F.col("id")

    def draw(size: int, *salt) -> Column:
        return F.pmod(F.xxhash64(i, F.lit(seed), *map(F.lit, salt)), F.lit(size))

    def pick(values: list[str], *salt) -> Column:
        return F.element_at(F.array(*map(F.lit, values)), (draw(len(values), *salt) + 1).cast("int"))

    def code(alphabet: str, size: int, *salt) -> Column:
        return F.concat(*[pick(list(alphabet), *salt, j) for j in range(size)])

    held = draw(3, "held") == 0
    label = draw(2, "label") == 1
    # what is wrong with a row that isn't personal: 0 its context, 1 its format, 2 characters glued to it
    fault = F.when(label, -1).otherwise(F.when(draw(8, "fault") < 4, 0).when(draw(8, "fault") < 7, 1).otherwise(2))

    def word(words: list[str], *salt) -> Column:
        half = len(words) // 2
        return F.when(held, pick(words[half:], *salt)).otherwise(pick(words[:half], *salt))

    digit, sep = "0123456789", pick([" ", "-", "."], "s")
    name = F.concat(pick(["anna", "j.doe", "maria", "info", "p_smith", "kontakt"], "n"), code("abcde12", 2, "n2"))
    host = F.concat(pick(["mail", "example", "corp", "post"], "h"), code("abc", 1, "h2"))
    mark = pick(["[", "(", "{"], "m")
    closing = F.translate(mark, "[({", "])}")
    country, account = pick(["DE", "FR", "ES", "GB", "NL"], "g"), F.concat(*[code(digit, 4, "g3", j) for j in range(4)])
    check = F.lpad((98 - _mod97(F.concat(country, F.lit("00"), account))).cast("string"), 2, "0")
    spoilt_check = F.lpad(F.pmod(check.cast("int") + 1 + draw(95, "check"), F.lit(97)).cast("string"), 2, "0")
    grouped = F.regexp_replace(account, "(.{4})", " $1")
    hexes = [pick(["2001", "fe80", "2a02", "fd00"], "i"), *[code("0123456789abcdef", 4, "i2", j) for j in range(7)]]
    clocks = F.concat_ws(":", *[code("012345", 2, "q", j) for j in range(4)], F.when(draw(2, "q5") == 0, code(digit, 2, "q6")))
    made = {
        4: F.concat(name, F.lit(" "), mark, F.lit("at"), closing, F.lit(" "), host, F.lit(" "), mark, F.lit("dot"), closing, F.lit(" "), pick(["com", "org", "net", "de"], "t")),
        5: F.concat(code("23456789", 1, "a"), code(digit, 2, "a2"), sep, code(digit, 3, "b"), sep, code(digit, 4, "c")),
        6: F.concat(code("12345", 1, "d"), code(digit, 1, "d2"), code("123456789", 1, "d3"), F.lit("-"), code("123456789", 2, "e"), F.lit("-"), code("123456789", 4, "f")),
        7: F.concat(country, check, grouped),
        8: F.concat_ws(":", *hexes),
    }
    spoilt = {  # formats that the generators take but that are nothing personal
        4: F.concat(pick(["noon", "lunch", "2pm", "we"], "x"), F.lit(" (at) "), pick(["hall", "gate", "home"], "y"), F.lit(" (dot) "), pick(["plan", "list", "then", "x"], "z")),
        5: F.concat(code("01", 1, "a"), code(digit, 2, "a2"), sep, code(digit, 3, "b"), sep, code(digit, 4, "c")),
        6: F.concat(pick(["000", "666", "912", "987"], "d"), F.lit("-"), code(digit, 2, "e"), F.lit("-"), code(digit, 4, "f")),
        7: F.when(draw(2, "iban") == 0, F.concat(country, spoilt_check, grouped)).otherwise(F.concat(
            code("ABQXZ", 2, "g4"), code(digit, 2, "g2"), F.lit(" "), code("ABCDEFGH", 4, "k"), F.lit(" "), code("ABCXYZ01", 4, "k2"))),
        8: F.when(draw(2, "short") == 0, clocks).otherwise(F.concat_ws(":", *hexes[:4], F.when(draw(3, "more") == 0, hexes[4]))),
    }
    kind = (F.lit(BASE) + draw(len(KINDS) - BASE, "kind")).cast("int")
    hit = F.lit("")
    for k in range(BASE, len(KINDS)):
        hit = F.when(kind == k, F.when(fault == 1, spoilt[k]).otherwise(made[k])).otherwise(hit)
    filler = F.concat(pick(_NEUTRAL, "w"), F.lit(" "))
    join = pick([" ", ": ", " no ", " is ", " "], "join")
    far = F.when(draw(3, "far") == 0, word(_TECHNICAL, "far t")).when(draw(3, "far") == 1, word(_FRIENDLY, "far f")).otherwise("")
    near = (F.when(fault == 0, word(_TECHNICAL, "near t")).when(draw(4, "lead") == 0, "")
            .otherwise(word(_FRIENDLY, "near f")))
    # without a telling word near a span, none stands farther off either
    left = F.when(near == "", F.concat(filler, pick(_NEUTRAL, "w2"), F.lit(" "))).otherwise(F.concat(far, F.lit(" "), filler, near, join))
    # gluing is a fault by itself only where it joins the span to a longer token
    left = F.when(fault == 2, F.concat(left, pick(["/", "#", "=", "x-", "ref_"], "glue"))).otherwise(left)
    right = F.when(fault == 2, pick(["-x", "/2", "_a", "#"], "wrong")).otherwise(pick([" ", ".", ",", "\n", ""], "right"))
    return spark.range(samples, numPartitions=2).select(
        kind.alias("kind"), hit.alias("hit"), F.right(left, F.lit(LEFT)).alias("left"), right.alias("right"),
        label.cast("double").alias("label"), held.alias("held_out"))


class PiiModel:
    """Fitted trees and a threshold for each proposed kind."""

    _fitted: dict[tuple, PiiModel] = {}

    def __init__(self, trees: list[tuple], thresholds: dict[int, float]):
        self.trees, self.thresholds = trees, thresholds

    @classmethod
    def fit(cls, spark: SparkSession, samples: int = SAMPLES, seed: int = 5) -> PiiModel:
        known = (spark.sparkContext.applicationId, samples, seed)
        if known in cls._fitted:
            return cls._fitted[known]
        rows = labelled_samples(spark, samples, seed)
        numbers = features(F.col("kind"), F.col("hit"), F.col("left"), F.col("right"))
        known_rows = stable(rows.select(*[c.alias(f) for c, f in zip(numbers, FEATURES, strict=True)], "label", "held_out"))
        trees = fit_boosted(known_rows.filter("not held_out"), FEATURES, TREES, DEPTH)
        margin = boosted_margin(trees, [F.col(f) for f in FEATURES])
        counts = (known_rows.filter("held_out").groupBy(F.col("kind").cast("int").alias("kind"), F.round(margin, 1).alias("m"))
                  .agg(F.sum("label").alias("good"), F.count("*").alias("n")).collect())  # a few margins a kind
        thresholds = {}
        for k in range(BASE, len(KINDS)):
            good = total = 0.0
            best = float("inf")
            for r in sorted((r for r in counts if r["kind"] == k), key=lambda r: -r["m"]):
                good, total = good + r["good"], total + r["n"]
                if good >= PRECISION * total:
                    best = r["m"] - 0.05
            thresholds[k] = max(best, 0.0)
        model = cls._fitted[known] = cls(trees, thresholds)
        return model

    def takes(self, kind: int, span: Column) -> Column:
        numbers = F.array(*features(F.lit(kind), span["hit"], span["left"], span["right"]))
        return let(numbers, lambda x: boosted_margin(self.trees, [F.get(x, F.lit(j)) for j in range(len(FEATURES))])) > self.thresholds[kind]


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    places = F.reverse(F.slice(F.split(digits, ""), 1, F.char_length(digits)))
    doubled = F.transform(places, lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
        F.when(c.cast("int") > 4, 2 * c.cast("int") - 9).otherwise(2 * c.cast("int"))))
    return F.aggregate(doubled, F.lit(0), lambda a, b: a + b) % 10 == 0


def _passes(kind: int, hit: Column) -> Column:
    """The checks of the base kinds."""
    if kind == 1:
        part = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{0,2})"
        return hit.rlike(f"^{part}(?:\\.{part}){{3}}$")
    if kind == 2:
        return let(_digits(hit), lambda d: F.when(F.char_length(d).between(12, 19), _luhn(d)).otherwise(F.lit(False)))
    if kind == 3:
        return F.char_length(_digits(hit)).between(9, 15)
    return F.lit(True)


def scan(docs: DataFrame, model: PiiModel | None = None) -> DataFrame:
    """Spans of personal data in every whole text: doc_id, base and method (arrays of start, kind, end, hit, ...).

    A null or empty text has none. Repeated rows and null keys stay as they are; other columns are left out.
    """
    model = model or PiiModel.fit(docs.sparkSession)
    text = F.coalesce(F.col("text"), F.lit(""))

    def kind(k: int) -> Column:
        return F.filter(found(text, k, PATTERNS[k]), lambda s: _passes(k, s["hit"]) if k < BASE else model.takes(k, s))

    return docs.select("doc_id", F.concat(*map(kind, range(BASE))).alias("base"),
                       F.concat(*map(kind, range(BASE, len(KINDS)))).alias("method"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every whole text of documents."""
    spans = scan(table(spark, sf_dir, "documents"))
    base = F.col("base")

    def count(kind: int) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long")

    return spans.select(
        "doc_id", *[count(k).alias(f"n_{KINDS[k]}") for k in range(BASE)], F.sha2(listed(base, KINDS), 256).alias("base_sha256"),
        listed(F.concat("base", "method"), KINDS).alias("spans"))
