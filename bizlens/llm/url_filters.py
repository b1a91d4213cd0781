"""URL rules and an exact block list by a cascade of Bloom filters, in DataFrame functions only.

The list's keys are known, and so are all keys of the corpus (the universe).  Level 1 encodes
the listed keys; the other keys that pass it are its false positives.  Level 2 encodes those;
the listed keys that pass it are its false positives, which level 3 encodes; and so on until a
level has none.  A key of the universe is listed if the first level that it fails has an even
number, or, if it passes all, their number is odd.  The answer is exact and takes no join.

A level is one row: an array of 64-bit words, at most ``MAX_BITS`` bits, read by the queries as a scalar
subquery.  A universe that needs larger levels is divided by a hash of the key into as many parts as keep
every level under the cap; each part has a cascade of its own and judges its own pages, one pass a part.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bizlens.llm.common import materialize, table

MAX_BITS = 1 << 26
FALSE_RATE = 1 / 8  # of levels after the first
FULL_RATE = 0.5  # of the first level, at most
ROOM = 0.8  # share of the cap that a part's levels are planned to fill: parts differ in size
MAX_LEVELS = 64
PART_SEED = 7
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rules of the query: host, path, verdict.
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]
#: Pages whose keys are listed: runs of three equal marks, as left by broken templates.
JUNK = r"%%%|\*\*\*|###|\$\$\$|&&&"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.char_length(url))).otherwise(F.lit(""))


def rule_column(host: Column, path: Column, rules: list[tuple[str, str, str]] = RULES) -> Column:
    """struct<rule, verdict> of the longest rule that fits, else null."""
    found = None
    for rule_host, rule_path, verdict in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r)):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        value = F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits, value) if found is None else found.when(fits, value)
    return F.lit(None).cast("struct<rule:string,verdict:string>") if found is None else found


@dataclass
class Level:
    """One Bloom filter: a table of one row with its words, its bits and its number of hashes."""

    words: DataFrame
    bits: int
    hashes: int
    seed: int

    def places(self, key: Column) -> list[Column]:
        return [F.pmod(F.xxhash64(F.lit(self.seed * 64 + i), key), F.lit(self.bits).cast("long")) for i in range(self.hashes)]

    def holds(self, key: Column) -> Column:
        words, found = self.words.scalar(), F.lit(True)
        for place in self.places(key):
            found = found & (F.getbit(F.get(words, F.shiftright(place, 6).cast("int")), F.pmod(place, F.lit(64)).cast("int")) == 1)
        return found


def _build(keys: DataFrame, n: int, rate: float, seed: int, max_bits: int) -> Level:
    """A filter of the ``n`` rows of ``keys``, about as wide as the rate of false positives asks."""
    bits = min(max_bits, max(64, -(-math.ceil(n * math.log(1 / rate) / math.log(2) ** 2) // 64) * 64))
    level = Level(keys, bits, max(1, min(16, round(bits / max(n, 1) * math.log(2)))), seed)
    places = keys.select(F.explode(F.array(*level.places(F.col("key")))).alias("place"))
    one = F.expr("shiftleft(1L, cast(pmod(place, 64L) AS int))")
    every = places.select(F.shiftright("place", 6).alias("w"), one.alias("v")).unionByName(
        keys.sparkSession.range(bits // 64).select(F.col("id").alias("w"), F.lit(0).cast("long").alias("v")))
    words = every.groupBy("w").agg(F.bit_or("v").alias("v"))
    row = words.agg(F.transform(F.array_sort(F.collect_list(F.struct("w", "v"))), lambda x: x["v"]).alias("words"))
    level.words = materialize(row, "bloom")
    return level


def first_rate(n: int, m: int) -> float:
    """Rate of false positives of the first level for ``n`` listed and ``m`` other keys."""
    return min(FULL_RATE, max(2.0 ** -10, n / max(m, 1) * math.sqrt(0.5)))


def parts_of(n: int, m: int, max_bits: int) -> int:
    """Number of parts whose levels all stay under ``max_bits``."""
    bits = lambda keys, rate: keys * math.log(1 / rate) / math.log(2) ** 2
    largest = max(bits(n, first_rate(n, m)), bits(m * first_rate(n, m), FALSE_RATE), bits(n * FALSE_RATE, FALSE_RATE))
    return max(1, math.ceil(largest / (ROOM * max_bits)))


def part_of(key: Column, parts: int) -> Column:
    """The part that a key belongs to."""
    return F.pmod(F.xxhash64(F.lit(PART_SEED), key), F.lit(parts).cast("long"))


def build_cascade(universe: DataFrame, max_bits: int = MAX_BITS) -> list[Level]:
    """Levels for ``universe`` (key, listed; one row per key).  No listed key: no level."""
    counts = universe.agg(F.count("*").alias("n"), F.count_if("listed").alias("listed")).first()
    encode, others = universe.where("listed").select("key"), universe.where("NOT listed").select("key")
    n, m, levels = counts.listed, counts.n - counts.listed, []
    while n:
        if len(levels) == MAX_LEVELS:
            raise RuntimeError("the cascade doesn't end: the filters are too small for the keys")
        rate = FALSE_RATE if levels else first_rate(n, m)
        level = _build(encode, n, rate, len(levels) + 1, max_bits)
        levels.append(level)
        passed = materialize(others.where(level.holds(F.col("key"))), "passed")
        encode, others = passed, encode
        n, m = passed.count(), n
    return levels


def is_listed(key: Column, levels: list[Level]) -> Column:
    """If a key of the universe is listed."""
    answer = F.lit(len(levels) % 2 == 1)
    for number in range(len(levels), 0, -1):
        answer = F.when(levels[number - 1].holds(key), answer).otherwise(F.lit(number % 2 == 0))
    return answer


def judge_urls(pages: DataFrame, listed: Column, rules: list[tuple[str, str, str]] = RULES, page_col: str = "page_id",
               url_col: str = "url", max_bits: int = MAX_BITS) -> DataFrame:
    """One row per input row: id, host, path, rule, verdict.

    ``listed`` says of a row that its key (host and path) goes on the block list; a key is listed
    if any row says so.  Null urls and urls without ``://`` have the empty key, which is never
    listed; a null ``listed`` is false; null ids stay; repeated rows each get a row; other columns
    are ignored; an empty table gives an empty result.
    """
    key = F.concat(host_of(F.col(url_col)), path_of(F.col(url_col)))
    universe = (pages.select(key.alias("key"), F.coalesce(listed, F.lit(False)).alias("listed")).groupBy("key")
                .agg((F.max("listed") & (F.col("key") != "")).alias("listed")))
    universe = materialize(universe, "universe")
    counts = universe.agg(F.count("*").alias("n"), F.count_if("listed").alias("listed")).first()
    parts = parts_of(counts.listed, counts.n - counts.listed, max_bits)
    split = pages.select(F.col(page_col), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    ruled = split.withColumn("_rule", rule_column(F.col("host"), F.col("path"), rules))
    if parts > 1:
        universe = materialize(universe.withColumn("part", part_of(F.col("key"), parts)), "universe-parts")
        ruled = materialize(ruled.withColumn("_part", part_of(F.concat("host", "path"), parts)), "url-parts")
    found = None
    for part in range(parts):
        levels = build_cascade(universe if parts == 1 else universe.where(F.col("part") == part).select("key", "listed"), max_bits)
        own = ruled if parts == 1 else ruled.where(F.col("_part") == part)
        verdict = F.coalesce(F.col("_rule.verdict"), F.when(is_listed(F.concat("host", "path"), levels), "block").otherwise("allow"))
        judged = own.select(page_col, "host", "path", F.col("_rule.rule").alias("rule"), verdict.alias("verdict"))
        found = judged if found is None else found.unionByName(judged)
    return found


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url; keys of pages with junk marks are listed."""
    return judge_urls(table(spark, sf_dir, "pages").select("page_id", "url", "html"), F.col("html").rlike(JUNK))


ORACLE_OP10 = r"""
WITH split AS (
  SELECT page_id, html, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, html, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM split
), listed AS (
  SELECT DISTINCT host || path AS key FROM parts WHERE host || path <> '' AND regexp_matches(html, '%%%|\*\*\*|###|\$\$\$|&&&')
), rules(rule, rule_host, rule_path, rule_verdict) AS (
  VALUES ('org/', 'org', '/', 'allow'), ('example.org/es/', 'example.org', '/es/', 'block'), ('example.org/en/1', 'example.org', '/en/1', 'block'),
         ('com/fr/', 'com', '/fr/', 'allow'), ('com/de/', 'com', '/de/', 'block')
)
SELECT page_id, host, path,
       (SELECT arg_max(rule, length(rule)) FROM rules WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)) AS rule,
       coalesce((SELECT arg_max(rule_verdict, length(rule)) FROM rules WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)),
                CASE WHEN host || path IN (SELECT key FROM listed) THEN 'block' ELSE 'allow' END) AS verdict
FROM parts
"""
