"""Secret scans: fixed patterns, and character Markov models of random strings and ordinary identifiers.

Two first-order models are counted from labelled samples that Spark generates: random strings over the usual
key alphabets, and identifiers and words joined as people join them. A token of the text is a secret where the
log-likelihood ratio per transition passes a threshold calibrated on held-out samples. DataFrame operations only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perigee.llm.common import let, table
from perigee.llm.spans import covered, found, listed

KINDS = ["assign", "access", "hex", "random"]
#: The base patterns.
ASSIGN = "((?i)password|passwd|secret|token|api_?key)[\"']?\\x20*+[:=]\\x20*+[\"']?([A-Za-z0-9+/_.=-]++)"
ACCESS = "AKIA[A-Z0-9]{16,}+"
HEX = "[0-9a-f]{24,}+"
#: Tokens the models judge, and the labelled strings they are counted from and calibrated on.
LEAST = 10
TOKEN = f"(?=[A-Za-z0-9+/_=~!$.-]{{{LEAST}}})[A-Za-z0-9+/_=~!$-]++(?:\\.[A-Za-z0-9+/_=~!$-]++)*+"
SAMPLES = 4000
#: Share of held-out identifiers below the threshold of their length; a length's class begins at these.
QUIET = 0.999
LENGTHS = [LEAST, 14, 20]

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-~!$."
KEY_ALPHABETS = [ALPHABET[:62] + "!$~.", "0123456789abcdef", "0123456789ABCDEF", ALPHABET[:62], ALPHABET[:64], "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
                 "abcdefghijklmnopqrstuvwxyz0123456789"]
#: Parts of ordinary identifiers, and frequent syllables of four languages.
PARTS = ("get set user name file path value index count list item data type code test page view model table query result "
         "error message service client server config option handler manager request response session account order "
         "price total date time start end first last next left right width height color image text string number "
         "the and ing tion ment ent ati for her ter hat tha ere con res ver all ons nce men ith ted ers pro thi wit are "
         "ess not ive was ect rea com eve per int est sta cti ica ist ear ain one our iti rat sch ein ich der die und che "
         "den ung gen ver ine heit keit lich que les des ant eur ait ous par ais eau aux oir ado ida ción mente los las "
         "del esta para 1 2 10 2020 v2 id").replace("ción", "cion").split()


def _pick(values: Column, size: int, *seeds: Column) -> Column:
    return F.element_at(values, (F.pmod(F.xxhash64(*seeds), F.lit(size)) + 1).cast("int"))


def labelled_samples(spark: SparkSession, samples: int = SAMPLES, seed: int = 11) -> DataFrame:
    """Columns token, random (boolean) and held_out (boolean); half of the samples of each label are held out."""
    i, s = F.col("id"), F.lit(seed)
    alphabet = _pick(F.array(*map(F.lit, KEY_ALPHABETS)), len(KEY_ALPHABETS), i, s)
    length = (LEAST + F.pmod(F.xxhash64(i, s, F.lit("length")), F.lit(45)) * F.when(i % 4 < 2, 1.0).otherwise(0.25)).cast("int")
    key = let(alphabet, lambda a: F.array_join(F.transform(F.sequence(F.lit(1), length), lambda j: F.substring(
        a, (F.pmod(F.xxhash64(i, j, s), F.char_length(a)) + 1).cast("int"), F.lit(1))), ""))
    parts = F.transform(F.sequence(F.lit(1), F.lit(12)), lambda j: _pick(F.array(*map(F.lit, PARTS)), len(PARTS), i, j, s))
    style = F.pmod(F.xxhash64(i, s, F.lit("style")), F.lit(9))
    number = F.pmod(F.xxhash64(i, s, F.lit("number")), F.lit(3000)).cast("string")
    name = (F.when(style == 0, F.array_join(parts, "_")).when(style == 1, F.array_join(parts, "-"))
            .when(style == 2, F.array_join(F.transform(parts, F.initcap), "")).when(style == 3, F.upper(F.array_join(parts, "_")))
            .when(style == 4, F.array_join(parts, "/")).when(style == 5, F.array_join(parts, "."))
            .when(style == 6, F.concat(number, F.lit("-"), F.array_join(parts, "-")))
            .when(style == 7, F.concat(F.array_join(F.slice(parts, 1, 2), ""), number, F.lit("_"), F.array_join(F.slice(parts, 3, 10), "")))
            .otherwise(F.array_join(parts, "")))
    rows = spark.range(samples, numPartitions=2).select(
        F.explode(F.array(F.struct(key.alias("token"), F.lit(True).alias("random")),
                          F.struct(F.left(name, length).alias("token"), F.lit(False).alias("random")))).alias("x"), "id")
    return rows.select("x.*", (F.col("id") % 2 == 1).alias("held_out"))


def _places(token: Column) -> Column:
    return F.transform(F.slice(F.split(token, ""), 1, F.char_length(token)), lambda c: F.instr(F.lit(ALPHABET), c))


def mean_ratio(token: Column, ratios: Column) -> Column:
    """Log-likelihood ratio per transition; linear in the token's length."""
    k = len(ALPHABET)

    def total(p: Column) -> Column:
        steps = F.zip_with(F.slice(p, 1, F.size(p) - 1), F.slice(p, 2, F.size(p) - 1),
                           lambda a, b: F.element_at(ratios, ((a - 1) * k + b).cast("int")))
        return F.aggregate(steps, F.lit(0.0), lambda x, y: x + y) / F.size(steps)

    return F.when(F.char_length(token) > 1, let(_places(token), total)).otherwise(F.lit(0.0))


def _length_class(token: Column) -> Column:
    return sum((F.char_length(token) >= n).cast("int") for n in LENGTHS[1:])


class SecretModel:
    """Log ratios of all transitions (a bounded table: the alphabet squared) and the calibrated threshold of each length."""

    _fitted: dict[tuple, SecretModel] = {}

    def __init__(self, ratios: list[float], thresholds: list[float]):
        self.numbers, self.thresholds = ratios, thresholds

    @property
    def ratios(self) -> Column:
        return F.split(F.lit(",".join(f"{x:.5f}" for x in self.numbers)), ",").cast("array<double>")

    @classmethod
    def fit(cls, spark: SparkSession, samples: int = SAMPLES, seed: int = 11) -> SecretModel:
        known = (spark.sparkContext.applicationId, samples, seed)
        if known in cls._fitted:
            return cls._fitted[known]
        rows, k = labelled_samples(spark, samples, seed), len(ALPHABET)
        pairs = rows.filter("not held_out").select("random", _places(F.col("token")).alias("p"))
        pairs = pairs.select("random", F.explode(F.zip_with(
            F.slice("p", 1, F.size("p") - 1), F.slice("p", 2, F.size("p") - 1), lambda a, b: (a - 1) * k + b)).alias("pair"))
        counts = {True: [1.0] * (k * k), False: [1.0] * (k * k)}  # one is added to each count
        for r in pairs.groupBy("random", "pair").count().collect():
            counts[r["random"]][int(r["pair"]) - 1] += r["count"]
        def logs(c: list[float]) -> list[float]:
            return [math.log(c[a * k + b] / sum(c[a * k : a * k + k])) for a in range(k) for b in range(k)]

        model = cls([x - y for x, y in zip(logs(counts[True]), logs(counts[False]), strict=True)], [0.0] * len(LENGTHS))
        ordinary = rows.filter("held_out and not random").select(
            _length_class(F.col("token")).alias("length"), mean_ratio(F.col("token"), model.ratios).alias("r"))
        for r in ordinary.groupBy("length").agg(F.percentile("r", F.lit(QUIET)).alias("r")).collect():  # a row a class
            model.thresholds[r["length"]] = max(0.0, float(r["r"]))
        cls._fitted[known] = model
        return model

    def is_random(self, token: Column) -> Column:
        """Random by the models, long enough, and with a digit or a capital after a small letter, as words alone aren't keys."""
        mixed = (F.char_length(token) >= LEAST) & token.rlike("[0-9]|[a-z][^a-z]*[A-Z]")
        limit = F.element_at(F.array(*map(F.lit, self.thresholds)), _length_class(token) + 1)
        return mixed & (mean_ratio(token, self.ratios) > limit)


def _spans(text: Column, model: SecretModel) -> tuple[Column, Column]:
    """Base and method spans of a text."""
    assign = F.filter(found(text, 0, ASSIGN, group=2), lambda s: F.char_length(s["part"]) >= 6)
    base = F.concat(assign, found(text, 1, ACCESS), found(text, 2, HEX))
    random = F.filter(found(text, 3, TOKEN), lambda s: model.is_random(s["hit"]))
    return base, random


def scan(docs: DataFrame, model: SecretModel | None = None) -> DataFrame:
    """Spans of secrets in every whole text: doc_id, base and method (arrays of start, kind, end, hit, ...).

    A null or empty text has none. Repeated rows and null keys stay as they are; other columns are left out.
    """
    model = model or SecretModel.fit(docs.sparkSession)
    base, method = _spans(F.coalesce(F.col("text"), F.lit("")), model)
    return docs.select("doc_id", base.alias("base"), method.alias("method"))


def redact(docs: DataFrame, model: SecretModel | None = None) -> DataFrame:
    """docs with the spans of scan() in text replaced by a mark of their kind, and n_chars, where there is one, counted anew.

    Overlapping spans become one mark, of the kind of the first, so no part of a secret stays. A null text stays null,
    an empty one empty; repeated rows stay; an empty table stays empty; all further columns are kept.
    """
    model = model or SecretModel.fit(docs.sparkSession)
    text = F.col("text")
    clean = let(F.concat(*_spans(F.coalesce(text, F.lit("")), model)), lambda s: covered(text, s, [f"[{k.upper()}]" for k in KINDS]))
    out = docs.withColumn("text", F.when(text.isNotNull(), clean))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every whole text of documents."""
    spans = scan(table(spark, sf_dir, "documents"))
    base, everything = F.col("base"), F.concat("base", "method")

    def count(kind: int) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long")

    return spans.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(listed(base, KINDS), 256).alias("base_sha256"), listed(everything, KINDS).alias("spans"))
