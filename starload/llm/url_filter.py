"""URL rules by Bloom filter cascades.

A rule is a host and a path prefix. A url's candidate keys are its host and
parent domains, each with the prefixes of its path, at the label counts and
path lengths that occur among the rules: few per url, whatever its length.
The distinct candidates of the corpus are the complete key universe.

A cascade encodes which keys of that universe are listed. Level 1 is a Bloom
filter of the listed keys; level 2 one of the unlisted keys that level 1 lets
through; level 3 one of the listed keys that level 2 lets through; and so on
until a level lets nothing wrong through. A key is listed if the first level
that rejects it is an even one. Over the universe the answer is exact.

Filters are bit arrays held as literals of the plan, so a url is judged in its
own task by built-in functions, without a join. Their size follows the number
of listed keys; above ``literal_bytes`` the keys are looked up by an ordinary
join instead, which has no such bound.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starload.llm.common import ascii_lower, staged

#: (host, path prefix, verdict) of the default rules.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"),
         ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
BITS_PER_KEY = 10
HASHES = 4
LITERAL_BYTES = 1 << 20


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    at = F.locate("://", F.coalesce(url, F.lit("")))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    head = F.split(rest, "[?#]", 2)[0]
    host = F.split(head, "/", 2)[0]
    return ascii_lower(host), F.substring(head, F.length(host) + 1, F.length(head))


def candidate_keys(host: Column, path: Column, labels: list[int], lengths: list[int]) -> Column:
    """Keys under which a rule could be listed that fits this host and path."""
    keys = [F.when((F.length(path) >= n) & (F.size(F.split(host, r"\.")) >= k),
                   F.concat(F.substring_index(host, ".", -k), F.substring(path, 1, n)))
            for k in labels for n in lengths]
    return F.array_distinct(F.array_compact(F.array(*keys)))


@dataclass(frozen=True)
class Level:
    """One Bloom filter: its number in the cascade and its bit array."""
    number: int
    bits: bytes

    def holds(self, key: Column) -> Column:
        return reduce(lambda a, b: a & b, (self._bit(p) for p in positions(key, self.number, len(self.bits) * 8)))

    def _bit(self, position: Column) -> Column:
        byte = F.substring(F.lit(self.bits), (F.shiftright(position, 3) + 1).cast("int"), F.lit(1))
        return F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), position.bitwiseAND(7).cast("int")) == 1


def positions(key: Column, number: int, n_bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(number), F.lit(i)), F.lit(n_bits)) for i in range(HASHES)]


def level(keys: DataFrame, n_keys: int, number: int) -> Level:
    """The filter of ``keys`` (key); its bits are set by a distributed aggregate."""
    n_bytes = max(8, -(-n_keys * BITS_PER_KEY // 8))
    hits = keys.select(F.explode(F.array(*positions(F.col("key"), number, n_bytes * 8))).alias("p"))
    by_byte = hits.groupBy(F.shiftright("p", 3).alias("at")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1), F.col("p").bitwiseAND(7).cast("int"))).alias("byte"))
    bits = bytearray(n_bytes)
    for row in by_byte.toLocalIterator():
        bits[row["at"]] = row["byte"]
    return Level(number, bytes(bits))


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Level, ...]

    def listed(self, key: Column) -> Column:
        """Whether a key of the universe is listed."""
        passed = F.lit(bool(len(self.levels) % 2))
        for lv in reversed(self.levels):
            passed = F.when(lv.holds(key), passed).otherwise(F.lit(lv.number % 2 == 0))
        return passed


def cascade(listed: DataFrame, universe: DataFrame, literal_bytes: int = LITERAL_BYTES) -> Cascade | None:
    """The cascade of ``listed`` (key) over ``universe`` (key, distinct).

    None if a level would exceed ``literal_bytes``. Listed keys outside the
    universe cannot be asked for, but are encoded all the same. Each level is
    smaller than the one before it by the false positive rate, so few follow.
    """
    inside, outside = listed, universe.join(listed, "key", "left_anti")
    levels: list[Level] = []
    while n := inside.count():
        if n * BITS_PER_KEY > literal_bytes * 8:
            return None
        lv = level(inside, n, len(levels) + 1)
        levels.append(lv)
        inside, outside = outside.filter(lv.holds(F.col("key"))), inside
    return Cascade(tuple(levels))


def filter_urls(pages: DataFrame, rules=RULES, default: str = "allow",
                literal_bytes: int = LITERAL_BYTES) -> DataFrame:
    """A verdict for every url of pages (page_id, url).

    One row per input row: page_id, host, path, rule (the longest rule that
    fits, as host and path; else null) and verdict (the rule's, else
    ``default``). A rule fits its host and all subdomains of it if the url's
    path starts with its path. ``rules`` is a list of (host, path, verdict) or
    a DataFrame of those columns; of rules with one key, block wins. A null
    url has an empty host and path, which no rule fits.
    """
    spark = pages.sparkSession
    table = rules if isinstance(rules, DataFrame) else spark.createDataFrame(
        list(rules), "host string, path string, verdict string")
    table = table.select(F.concat(ascii_lower(F.col("host")), F.col("path")).alias("key"),
                         F.size(F.split("host", r"\.")).alias("labels"), F.length("path").alias("n"), "verdict")
    table = table.groupBy("key", "labels", "n").agg(F.max("verdict").alias("verdict"))  # block > allow
    # the shapes of rules, bounded by the longest host and path, not by their number
    labels = sorted(r[0] for r in table.select("labels").distinct().collect())
    lengths = sorted(r[0] for r in table.select("n").distinct().collect())
    host, path = url_parts(F.col("url"))
    rows = pages.select(F.col("page_id"), host.alias("host"), path.alias("path"))
    if not labels:
        return rows.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"),
                           F.lit(default).alias("verdict"))
    rows = rows.withColumn("keys", candidate_keys(F.col("host"), F.col("path"), labels, lengths))
    universe = staged(rows.select(F.explode("keys").alias("key")).distinct(), "url_keys")
    verdicts = {v: cascade(table.filter(F.col("verdict") == v).select("key"), universe, literal_bytes)
                for v in ("allow", "block")}
    if None in verdicts.values():
        return _joined(rows, table, default)
    longest = F.lit(None).cast("struct<n:int,key:string,verdict:string>")
    found = [_hits(c, v) for v, c in verdicts.items() if c.levels]
    if found:
        longest = F.array_max(F.concat(*found))
    return rows.withColumn("best", longest).select(
        "page_id", "host", "path", F.col("best.key").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"))


def _hits(c: Cascade, verdict: str) -> Column:
    """The url's keys that a cascade lists, with their lengths and the verdict."""
    return F.transform(F.filter("keys", c.listed), lambda k: F.struct(
        F.length(k).alias("n"), k.alias("key"), F.lit(verdict).alias("verdict")))


def _joined(rows: DataFrame, table: DataFrame, default: str) -> DataFrame:
    """The same judgement by a join, for lists beyond the bound: distinct
    (host, path) pairs meet the rules, so a hot url is looked up once."""
    pairs = rows.select("host", "path", "keys").distinct()
    hits = pairs.select("host", "path", F.explode("keys").alias("key")).join(table.select("key", "verdict"), "key")
    best = hits.groupBy("host", "path").agg(F.max(F.struct(F.length("key").alias("n"), "key", "verdict")).alias("best"))
    return rows.join(best, ["host", "path"], "left").select(
        "page_id", "host", "path", F.col("best.key").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
