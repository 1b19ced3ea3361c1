"""URL verdicts: explicit rules first, then a Bloom filter cascade over hosts. DataFrame functions only.

The cascade gives exact membership of every key of a known universe. Its first
filter encodes the listed keys; the second encodes the keys of the universe
that the first takes wrongly; the third the listed keys that the second takes;
and so on, until a filter takes nothing wrongly. A key is listed if the first
filter that doesn't take it stands at an even place. The universe is complete:
every host of the corpus and every parent domain of it.

Only the last labels of a host, as many as a listed domain has at most, can be
listed, so a host has a bounded number of keys however many labels it has.

Filters are arrays of 64-bit words that are built by aggregation, written as
one-row tables and read by scalar subqueries. Their size follows the list, not
the corpus; it is checked against ``MAX_FILTER_BYTES``, room for some 13
million listed domains, and a larger list is refused.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framequarry.llm._shared import materialize, table

#: Production rules of the query, as (verdict, rule); a rule is a host and a path.
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)
#: Production list of the query: domains that are blocked with all their subdomains.
BLOCKED = tuple(f"{name}.example.{top}" for name in ("ads-track", "casino-win", "cheap-pills", "spam-farm") for top in ("com", "net", "org"))

BITS_PER_KEY = 10
HASHES = 4
MAX_FILTER_BYTES = 16 << 20
#: Labels that a domain name can have.
MAX_LABELS = 127
#: Words of a filter that are gathered at a time.
WORDS = 1024
MAX_LEVELS = 40


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path: the host is lower-cased (A-Z) and ends at the first of / ? #, the path at the first of ? #; both empty without "://"."""
    url = F.coalesce(url, F.lit(""))
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"\A([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def rule_for(host: Column, path: Column, rules: tuple[tuple[str, str], ...]) -> Column:
    """The longest fitting rule as a struct (rule, verdict), null where none fits."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda x: len(x[1])):
        at = rule.index("/")
        domain, prefix = rule[:at], rule[at:]
        fits = ((host == domain) | F.endswith(host, F.lit("." + domain))) & F.startswith(path, F.lit(prefix))
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def labels(host: Column) -> Column:
    """How many labels a host has."""
    return F.length(host) - F.length(F.translate(host, ".", "")) + 1


def domains(host: Column, depth: int) -> list[Column]:
    """A host's last 1, 2, ..., ``depth`` labels; the whole host where it has no more."""
    return [F.substring_index(host, ".", -k) for k in range(1, depth + 1)]


def _bit(key: Column, level: int, k: int, bits: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(1000 * level + k)), F.lit(bits))


def _filter(keys: DataFrame, level: int, bits: int) -> DataFrame:
    """One row ``words``: the filter of ``keys`` (key) as an array of 64-bit words."""
    bit = F.explode(F.array(*(_bit(F.col("key"), level, k, bits) for k in range(HASHES))))
    words = keys.select(bit.alias("bit")).select(F.shiftright("bit", 6).alias("word"), F.expr("shiftleft(1L, cast(bit & 63 as int))").alias("mask"))
    words = words.unionByName(keys.sparkSession.range(bits // 64).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("mask"))).groupBy("word").agg(F.bit_or("mask").alias("mask"))
    gather = lambda name, value: F.transform(F.array_sort(F.collect_list(F.struct(name, value))), lambda x: x[value])
    parts = words.groupBy(F.floor(F.col("word") / WORDS).alias("part")).agg(gather("word", "mask").alias("words"))
    return parts.agg(F.flatten(gather("part", "words")).alias("words"))


def _takes(words: Column, key: Column, level: int, bits: int) -> Column:
    out = F.lit(True)
    for k in range(HASHES):
        bit = _bit(key, level, k, bits)
        word = F.get(words, F.shiftright(bit, 6).cast("int"))
        # the wanted bit is brought to the sign by shifting left: a shift by a column needs SQL's own function
        out = out & (F.call_function("shiftleft", word, (F.lit(63) - bit.bitwiseAND(F.lit(63))).cast("int")) < 0)
    return out


class Cascade:
    """Filters of a cascade: (one-row table of words, bits) by level."""

    def __init__(self, levels: list[tuple[DataFrame, int]]):
        self.levels = levels

    def listed(self, key: Column) -> Column:
        """Whether a key of the universe is listed."""
        out = F.lit(len(self.levels) % 2 == 1)
        for level in range(len(self.levels), 0, -1):
            words, bits = self.levels[level - 1]
            out = F.when(~_takes(words.scalar(), key, level, bits), F.lit(level % 2 == 0)).otherwise(out)
        return out


def build(universe: DataFrame) -> Cascade:
    """The cascade of ``universe`` (key, listed), each key once; ValueError where its filters would be too large."""
    levels: list[tuple[DataFrame, int]] = []
    inside = universe.where("listed").select("key")
    outside = universe.where("not listed").select("key")
    while True:
        count = inside.count()
        if not count:
            return Cascade(levels)
        if len(levels) == MAX_LEVELS:
            raise RuntimeError("the cascade doesn't end")
        bits = 64 * math.ceil(count * BITS_PER_KEY / 64)
        if bits // 8 + sum(b // 8 for _, b in levels) > MAX_FILTER_BYTES:
            raise ValueError(f"the list's filters need more than {MAX_FILTER_BYTES} bytes")
        level = len(levels) + 1
        words = materialize(_filter(inside, level, bits), "filter")
        levels.append((words, bits))
        wrong = materialize(outside.where(_takes(words.scalar(), F.col("key"), level, bits)), "cascade")
        inside, outside = wrong, inside


def judge(pages: DataFrame, rules=RULES, blocked: DataFrame | tuple[str, ...] = BLOCKED, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict of every row.

    ``blocked`` lists domains (a tuple, or a DataFrame with a column ``key``);
    a page is blocked if its host or a parent of it is listed, unless a rule
    decides. Null urls, or urls without "://", have an empty host, fit no rule
    and are allowed; repeated rows repeat, an empty table gives none. Null and
    empty keys of the list are ignored; one of more labels than a domain name
    can have is an error.
    """
    spark = pages.sparkSession
    host, path = url_parts(F.col(url_col).cast("string"))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    fitting = rule_for(F.col("host"), F.col("path"), rules)
    if not isinstance(blocked, DataFrame):
        blocked = spark.range(1).select(F.explode(F.array(*(F.lit(x) for x in blocked)).cast("array<string>")).alias("key"))
    blocked = blocked.where("key is not null and key <> ''").select("key")
    depth = blocked.agg(F.max(labels(F.col("key")))).first()[0] or 0
    if depth > MAX_LABELS:
        raise ValueError(f"a listed domain has {depth} labels")
    keys = F.array(*domains(F.col("host"), depth)).cast("array<string>")
    universe = rows.select("host").distinct().select(F.explode(keys).alias("key")).where("key <> ''").select("key", F.lit(False).alias("listed")).unionByName(blocked.select("key", F.lit(True).alias("listed")))
    universe = materialize(universe.groupBy("key").agg(F.max("listed").alias("listed")), "hosts")
    cascade = build(universe)
    hit = F.lit(False)
    for key in domains(F.col("host"), depth):
        hit = hit | ((key != "") & cascade.listed(key))
    judged = rows.withColumn("hit", hit)
    judged = judged.withColumn("fit", fitting)
    return judged.select("page_id", "host", "path", F.col("fit.rule").alias("rule"), F.coalesce(F.col("fit.verdict"), F.when(F.col("hit"), "block").otherwise("allow")).alias("verdict"))


def op1_url_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))


def _sql_rules() -> str:
    out = []
    for verdict, rule in sorted(RULES, key=lambda x: -len(x[1])):
        at = rule.index("/")
        out.append(f"WHEN ('.' || host) LIKE '%.{rule[:at]}' AND starts_with(path, '{rule[at:]}') THEN '{verdict} {rule}'")
    return " ".join(out)


#: Rows of ``op1_url_cascade``.
OP1_SQL = f"""
WITH u AS (
  SELECT page_id, CASE WHEN contains(coalesce(url, ''), '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), h AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u
), f AS (SELECT *, CASE {_sql_rules()} END AS fit FROM h)
SELECT page_id, host, path, nullif(split_part(coalesce(fit, ''), ' ', 2), '') AS rule,
  coalesce(split_part(fit, ' ', 1), CASE WHEN {" OR ".join(f"('.' || host) LIKE '%.{x}'" for x in BLOCKED)} THEN 'block' ELSE 'allow' END) AS verdict
FROM f
"""
