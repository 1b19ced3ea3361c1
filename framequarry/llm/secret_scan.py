"""Secrets in texts: patterns for known forms, and Markov models for random-looking strings. DataFrame functions only.

Two models of neighbouring characters, one of random strings and one of
ordinary identifiers, are trained by aggregation from labelled samples. A long
run of token characters is a secret where the log-likelihood ratio of the two
models, in all and a character, is high enough.

Spans are in code points, the end exclusive. A match's place is found from the
lengths of the pieces between matches, as ``split`` and ``regexp_extract_all``
cut a text at the same places. What lies before a match is added up from sums
of blocks and of blocks of blocks, so the work is linear in a text's matches.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framequarry.llm._shared import table

#: Known forms: kind, pattern, group whose length counts, least length.
FORMS = (
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
)
RANDOM_KIND = "random"
#: What the models look at, the least ratio in all, and the least ratio a character (natural logarithms).
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"
LEAST_TOTAL = 20.0
LEAST_EACH = 0.6

#: Characters that the models tell apart; all others are one more class.
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_-+/="
_CLASSES = len(ALPHABET) + 1
_CODES = [ALPHABET.find(chr(c)) if chr(c) in ALPHABET else _CLASSES - 1 for c in range(128)]

#: Ordinary identifiers that the models are trained on, joined from these words by the usual styles.
WORDS = (
    "account active address admin agent amount archive array async attribute author average backup balance batch between binary block branch buffer build button cache calendar "
    "callback category channel character client cluster column command comment commit compare component config connection constant container content context control controller "
    "counter create current customer database default delete delivery description destination device dictionary direct display document domain download duration dynamic element "
    "employee enable encoding endpoint engine entity error estimate event example exception execute expected export expression external factory failure feature field filter final "
    "folder format forward function gateway generate global group handler header height history horizontal identifier image import include index initial input instance integer "
    "interface internal invoice iterator journal keyboard language latest layout length level library license limit linked listener local location logger machine manager mapping "
    "master matrix maximum measure member memory message metadata method minimum model module monitor mutable network notification number object offset operation optional order "
    "original output overview package parameter parent parser partition password pattern payment percent performance permission pipeline platform pointer policy position prefix "
    "previous primary printer priority private process product profile program project property protocol provider public quantity query queue random range reader receive record "
    "recursive reference register relation release remote render report request required reserve resource response result return revision router sample schedule schema scheduler "
    "search second section segment selection sequence serial server service session setting shadow signal signature simple single snapshot socket source standard start statement "
    "static status storage stream string structure summary support switch symbol system table target template temporary terminal thread threshold timeout timestamp token total "
    "transaction transfer transform trigger tuple unique update upload username utility validate value variable vector version vertical virtual visible volume warning widget "
    "window worker wrapper writer"
).split()


def labelled_samples(spark: SparkSession) -> DataFrame:
    """The built-in samples: (text, is_random). Identifiers are words joined in common styles, random strings come from a fixed hash chain."""
    plain = []
    for k, word in enumerate(WORDS):
        a, b, c = word, WORDS[(7 * k + 3) % len(WORDS)], WORDS[(13 * k + 5) % len(WORDS)]
        plain += [f"{a}_{b}_{c}", a + b.title() + c.title(), f"{a}-{b}-{c}", f"{a.title()}{b.title()}", f"{a}/{b}/{c}", f"{a.upper()}_{b.upper()}", f"{a}{b}{c}", f"{a}_{b}_{k % 10}{k % 7}"]
    random = []
    for k in range(len(plain)):
        digest = hashlib.sha256(b"sample %d" % k).digest()
        letters = (ALPHABET[:62], ALPHABET[:62], ALPHABET[:62] + "+/", ALPHABET[26:62], ALPHABET[:26] + ALPHABET[52:62], "0123456789abcdef")[k % 6]
        random.append("".join(letters[x % len(letters)] for x in digest))
    lines = lambda x: spark.range(1).select(F.explode(F.split(F.lit("\n".join(x)), "\n")).alias("text"))
    return lines(plain).withColumn("is_random", F.lit(False)).unionByName(lines(random).withColumn("is_random", F.lit(True)))


#: Entries of a list in a block when running sums are taken.
BLOCK = 64


def _code(char: Column, codes: Column) -> Column:
    return F.coalesce(F.get(codes, F.ascii(char)), F.lit(_CLASSES - 1))


def train(samples: DataFrame) -> list[float]:
    """Log-likelihood ratio of each pair of character classes, random against ordinary, from (text, is_random).

    Pairs are counted on the executors; as many counts as there are pairs of
    classes come to the driver. Every pair counts half once more than seen.
    """
    at = F.explode(F.sequence(F.lit(2), F.length("text"))).alias("k")
    pairs = samples.where(F.length("text") >= 2).select("text", "is_random", at)
    codes = F.lit(np.array(_CODES, np.int32))
    pairs = pairs.select("is_random", _code(F.expr("substring(text, k - 1, 1)"), codes).alias("a"), _code(F.expr("substring(text, k, 1)"), codes).alias("b"))
    counts = {(r.is_random, r.a, r.b): r["count"] for r in pairs.groupBy("is_random", "a", "b").count().collect()}
    out = []
    rows = {(kind, a): sum(counts.get((kind, a, b), 0) + 0.5 for b in range(_CLASSES)) for kind in (True, False) for a in range(_CLASSES)}
    for a in range(_CLASSES):
        for b in range(_CLASSES):
            p, q = ((counts.get((kind, a, b), 0) + 0.5) / rows[kind, a] for kind in (True, False))
            out.append(round(math.log(p / q), 6))
    return out


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda total, x: total + x)


def _greatest(values: Column) -> Column:
    return F.coalesce(F.array_max(values), F.lit(0))


def _blocks(values: Column, fold) -> Column:
    """What ``fold`` makes of each block of a list; nothing of an empty list."""
    starts = F.sequence(F.lit(0), F.ceil(F.size(values) / BLOCK).cast("int"))
    return F.transform(F.slice(starts, F.lit(1), F.size(starts) - 1), lambda k: fold(F.slice(values, k * BLOCK + 1, F.lit(BLOCK))))


def _before(rows: DataFrame, values: str, out: str, fold, join) -> DataFrame:
    """``rows`` with a list ``out``: ``fold`` of all entries of the list ``values`` before each; ``join`` puts two folds together."""
    one, two, last = f"{out}_1", f"{out}_2", f"{out}_last"
    rows = rows.withColumn(one, _blocks(F.col(values), fold))
    rows = rows.withColumn(two, _blocks(F.col(one), fold))
    rows = rows.withColumn(last, F.transform(two, lambda _, k: fold(F.slice(two, F.lit(1), k))))

    def at(_, k):
        block, large = F.floor(k / BLOCK).cast("int"), F.floor(k / BLOCK**2).cast("int")
        own = fold(F.slice(values, block * BLOCK + 1, k - block * BLOCK))
        # named twice, as the planner folds a list that is named once into the lambda and makes it anew for every entry
        head = F.when(F.size(last) > 0, F.get(F.col(last), large))
        return join(join(head, fold(F.slice(one, large * BLOCK + 1, block - large * BLOCK))), own)

    return rows.withColumn(out, F.transform(values, at)).drop(one, two, last)


def _places(rows: DataFrame, kind: str, wanted) -> DataFrame:
    """``rows`` with spans_<kind>: (start, size) of each match, from the pieces between matches; ``wanted(match, group)`` drops some."""
    pieces, matches, groups, steps, starts = (f"{x}_{kind}" for x in ("pieces", "matches", "groups", "steps", "starts"))
    rows = rows.withColumn(steps, F.zip_with(F.slice(pieces, F.lit(1), F.size(matches)), matches, lambda p, m: F.length(p) + F.length(m)))
    rows = _before(rows, steps, starts, _total, lambda x, y: x + y)
    each = F.arrays_zip(F.col(starts).alias("start"), F.slice(pieces, F.lit(1), F.size(matches)).alias("piece"), F.col(matches).alias("match"), F.col(groups).alias("group"))
    spans = F.transform(each, lambda z: F.struct((z["start"] + F.length(z["piece"])).alias("start"), F.length(z["match"]).alias("size"), wanted(z["match"], z["group"]).alias("wanted")))
    return rows.withColumn(f"spans_{kind}", F.filter(spans, lambda s: s["wanted"])).drop(pieces, matches, groups, steps, starts)


def _named(spans: Column, kind: str, order: int) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(order).alias("kind_order"), (s["start"] + s["size"]).alias("end"), F.lit(kind).alias("kind")))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _ratio(token: Column, ratios: Column, codes: Column) -> Column:
    chars = F.transform(F.split(token, ""), lambda c: _code(c, codes))
    size = F.length(token) - 1
    each = F.zip_with(F.slice(chars, F.lit(1), size), F.slice(chars, F.lit(2), size), lambda a, b: F.get(ratios, a * _CLASSES + b))
    return F.aggregate(each, F.lit(0.0), lambda total, x: total + x)


def find_secrets(docs: DataFrame, ratios: list[float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, counts of known forms, their digest, and all spans as text.

    Spans from the models are of kind "random" and never overlap a known
    form's. A null text counts as empty; null ids and repeated rows stay.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    every = [(*form, k) for k, form in enumerate(FORMS)] + [(RANDOM_KIND, CANDIDATE, 0, 0, len(FORMS))]
    none = F.array().cast("array<string>")
    table_of, codes = F.lit(np.array(ratios)), F.lit(np.array(_CODES, np.int32))
    # texts without a match are settled by one search each
    cut = rows
    for kind, pattern, _, _, _ in every:
        cut = cut.withColumn(f"has_{kind}", F.col("text").rlike(pattern))
    for kind, pattern, group, _, _ in every:
        whole = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
        cut = cut.withColumn(f"pieces_{kind}", F.when(F.col(f"has_{kind}"), F.split("text", pattern, -1)).otherwise(none))
        cut = cut.withColumn(f"matches_{kind}", F.when(F.col(f"has_{kind}"), whole).otherwise(none))
        cut = cut.withColumn(f"groups_{kind}", F.when(F.col(f"has_{kind}"), F.regexp_extract_all("text", F.lit(pattern), F.lit(group))).otherwise(none) if group else F.col(f"matches_{kind}"))
    cut = cut.drop("text")
    for kind, _, group, least, order in every:
        if kind == RANDOM_KIND:
            ratio = lambda m: _ratio(m, table_of, codes)
            wanted = lambda m, g, ratio=ratio: ratio(m) >= F.greatest(F.lit(LEAST_TOTAL), LEAST_EACH * F.length(m))
        else:
            wanted = lambda m, g, least=least: F.length(g) >= least
        cut = _places(cut, kind, wanted)
        cut = cut.withColumn(f"spans_{kind}", _named(F.col(f"spans_{kind}"), kind, order))
    known = F.concat(*(F.col(f"spans_{kind}") for kind, *_ in FORMS))
    cut = cut.withColumn("known", F.array_sort(known)).withColumn("every", F.array_sort(F.concat("known", f"spans_{RANDOM_KIND}")))
    # of the known spans, one that starts before a random one overlaps it by its end; one that starts within it comes right after it
    is_known = lambda s: s["kind_order"] < len(FORMS)
    cut = _before(cut.withColumn("ends", F.transform("every", lambda s: F.when(is_known(s), s["end"]).otherwise(0))), "ends", "reach", _greatest, F.greatest)

    def stays(z):
        s, reach, after = z["span"], z["reach"], z["after"]
        covered = (reach > s["start"]) | F.coalesce(is_known(after) & (after["start"] < s["end"]), F.lit(False))
        return is_known(s) | ~covered

    around = F.arrays_zip(F.col("every").alias("span"), F.col("reach").alias("reach"), F.slice("every", F.lit(2), F.size("every")).alias("after"))
    spans = F.transform(F.filter(around, stays), lambda z: z["span"])
    # never false, but no condition on a result may pass it: pushed down, it would repeat all the steps above many times over
    own = lambda column: F.when(F.monotonically_increasing_id() >= 0, column)
    return cut.select(
        "doc_id",
        *(own(F.size(f"spans_{kind}").cast("long")).alias(f"n_{kind}") for kind, *_ in FORMS),
        own(F.sha2(_joined(F.col("known")), 256)).alias("base_sha256"),
        own(_joined(spans)).alias("spans"),
    )


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(table(spark, sf_dir, "documents"), train(labelled_samples(spark)))
