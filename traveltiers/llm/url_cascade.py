"""Operator 2: URL rules by a Bloom filter cascade, in DataFrame functions alone.

A rule is a host (it fits the host and its subdomains) followed by a path prefix; the
longest rule that fits a url decides. For every number of labels and length of path prefix
that occurs in the rules, a url has at most one candidate key, so its rules are found by
membership tests. Membership is exact and needs no join:

* the key universe is every distinct candidate key of the corpus;
* level 1 encodes the listed keys of the universe, level 2 the unlisted keys that level 1
  lets through, level 3 the listed keys that level 2 lets through, and so on until a level
  lets nothing wrong through;
* a key is listed if the first level that rejects it has an even number (or the last level
  has an odd one).

A filter has BITS_PER_KEY bits for each key that its level encodes. Up to MAX_FILTER_BYTES its words
are a literal in the plan. A larger level is cut by key hash into shards of SHARD_KEYS keys, each a filter of
its own: one row of words, which the candidate keys of the shard (salted, for keys that many urls share)
meet in a shuffle on the shard. It is the same cascade with the same rows, and nothing of its size is broadcast
or brought to the driver. Only then do urls explode into their keys, and a join by host and path brings the rules back.

A null url, or one without ``://``, has an empty host and path and no rule. Rows repeat as
in the input; an empty table gives an empty result and further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from traveltiers.llm.common import cut, table

#: The rules of the query, as action and host with path prefix (fixed values).
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))
BITS_PER_KEY, HASHES = 16, 4
MAX_FILTER_BYTES = 8 << 20
SHARD_KEYS, SALTS = 4096, 16

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path, both empty without ``://``."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    return F.translate(host, UPPER, LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def shapes(rules: DataFrame) -> list[tuple[int, int]]:
    """(labels of the host, characters of the path) that occur in the listed keys: as many as there are such pairs, not rules."""
    at = F.instr("key", "/")
    host = F.when(at > 0, F.substring_index("key", "/", 1)).otherwise(F.col("key"))
    path = F.when(at > 0, F.length("key") - at + 1).otherwise(0)
    got = rules.where("key IS NOT NULL").select(F.size(F.split(host, r"\.")).alias("n"), path.cast("int").alias("m")).distinct()
    return sorted((r["n"], r["m"]) for r in got.collect())


def candidates(host: Column, path: Column, of: list[tuple[int, int]]) -> Column:
    """The keys under which a url could be listed."""
    labels = F.size(F.split(host, r"\."))
    return F.filter(F.array(*[
        F.when((labels >= n) & (F.length(path) >= m) & (host != ""),
               F.concat(F.substring_index(host, ".", -n), F.substring(path, 1, m) if m else F.lit("")))
        for n, m in of] or [F.lit(None).cast("string")]), lambda k: k.isNotNull())


def positions(key: Column, level: int, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(level * 64 + i)), F.lit(bits)) for i in range(HASHES)]


def bit(words: Column, at: Column) -> Column:
    return F.getbit(F.get(words, (at / 64).cast("int")), (at % 64).cast("int")) == 1


class Level:
    """One Bloom filter over ``keys``: its 64-bit words as text for a literal in the plan, or as a table of shards."""

    def __init__(self, number: int, keys: DataFrame, n_keys: int):
        self.number = number
        whole = n_keys * BITS_PER_KEY // 8 <= MAX_FILTER_BYTES
        self.shards = 0 if whole else -(-n_keys // SHARD_KEYS)
        self.bits = 64 * max(1, -(-(n_keys if whole else SHARD_KEYS) * BITS_PER_KEY // 64))
        key = F.col("key")
        at = keys.select(self.shard(key).alias("s"), F.explode(F.array(*positions(key, number, self.bits))).alias("p"))
        words = at.groupBy("s", F.expr("p div 64").alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p % 64 as int))")).alias("v"))
        if whole:
            got = {r["w"]: r["v"] for r in words.collect()}
            self.words = ",".join(str(got.get(i, 0)) for i in range(self.bits // 64))
            return
        n = self.bits // 64
        none = keys.sparkSession.range(self.shards * n).select(F.expr(f"id div {n}").alias("s"), F.expr(f"id % {n}").alias("w"), F.lit(0).cast("bigint").alias("v"))
        full = words.unionByName(none).groupBy("s", "w").agg(F.bit_or("v").alias("v"))
        row = F.transform(F.array_sort(F.collect_list(F.struct("w", "v"))), lambda x: x.v)  # one shard's words: a fixed number
        self.table = cut(full.groupBy("s").agg(row.alias("words")))

    def shard(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key, F.lit(-self.number)), F.lit(max(1, self.shards)))

    def holds(self, key: Column, words: Column | None = None) -> Column:
        own = F.split(F.lit(self.words), ",").cast("array<bigint>") if words is None else words
        return reduce(Column.__and__, [bit(own, p) for p in positions(key, self.number, self.bits)])

    def test(self, rows: DataFrame, key: str, out: str) -> DataFrame:
        """``rows`` with a boolean column ``out``: whether the filter lets their key through."""
        if not self.shards:
            return rows.withColumn(out, self.holds(F.col(key)))
        salt = F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)).cast("int")
        words = self.table.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        met = rows.withColumn("__s", self.shard(F.col(key))).withColumn("__salt", salt).join(words.withColumnRenamed("s", "__s"), ["__s", "__salt"])
        return met.withColumn(out, self.holds(F.col(key), F.col("words"))).drop("__s", "__salt", "words")


class Cascade:
    """Exact membership of the universe's keys in a list."""

    def __init__(self, universe: DataFrame, listed: DataFrame):
        """``universe``: distinct ``key``; ``listed``: ``key``. Listed keys outside the universe are left out."""
        both = universe.select("key", F.lit(1).alias("u"), F.lit(0).alias("l")).unionByName(
            listed.select("key", F.lit(0).alias("u"), F.lit(1).alias("l")))
        flags = cut(both.groupBy("key").agg(F.max("u").alias("u"), F.max("l").alias("l")).filter("u = 1").select("key", (F.col("l") == 1).alias("in_list")))
        self.levels: list[Level] = []
        inside, outside = flags.filter("in_list").select("key"), flags.filter("not in_list").select("key")
        n = inside.count()
        while n:
            level = Level(len(self.levels) + 1, inside, n)
            self.levels.append(level)
            inside, outside = cut(level.test(outside, "key", "__in").filter("__in").select("key")), inside
            n = inside.count()

    @property
    def sharded(self) -> bool:
        return any(level.shards for level in self.levels)

    def verdict(self, holds: list[Column]) -> Column:
        """Whether a key of the universe is listed, from what each level says of it."""
        out = F.lit(len(self.levels) % 2 == 1)
        for level, held in reversed(list(zip(self.levels, holds))):
            out = F.when(held, out).otherwise(F.lit(level.number % 2 == 0))
        return out

    def listed(self, key: Column) -> Column:
        """The same as an expression, where every filter is a literal."""
        return self.verdict([level.holds(key) for level in self.levels])

    def mark(self, rows: DataFrame, key: str, out: str) -> DataFrame:
        """``rows`` with a boolean column ``out``: whether their key is listed."""
        names = [f"__level{level.number}" for level in self.levels]
        for level, name in zip(self.levels, names):
            rows = level.test(rows, key, name)
        return rows.withColumn(out, self.verdict([F.col(n) for n in names])).drop(*names)


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", key: str = "page_id") -> DataFrame:
    """Per row: key, host, path, rule, verdict. ``rules``: (action, key); a key that is both blocked and allowed is blocked."""
    host, path = split_url(F.col(f"`{url}`"))
    rows = pages.select(F.col(f"`{key}`").alias(key), host.alias("host"), path.alias("path"))
    found = rows.withColumn("__keys", candidates(F.col("host"), F.col("path"), shapes(rules)))
    universe = cut(found.select(F.explode("__keys").alias("key")).distinct())
    block = Cascade(universe, rules.filter("action = 'block'").select("key"))
    allow = Cascade(universe, rules.filter("action = 'allow'").select("key").join(rules.filter("action = 'block'").select("key"), "key", "left_anti"))
    if block.sharded or allow.sharded:
        return _by_shards(found, block, allow, key)

    def best(which: Cascade) -> Column:
        fit = F.filter("__keys", lambda k: which.listed(k))
        return F.array_max(F.transform(fit, lambda k: F.struct(F.length(k).alias("n"), k.alias("k"))))

    both = found.withColumn("__b", best(block)).withColumn("__a", best(allow))
    longer = F.coalesce(F.col("__a.n"), F.lit(0)) > F.coalesce(F.col("__b.n"), F.lit(0))
    rule = F.when(longer, F.col("__a.k")).otherwise(F.col("__b.k"))
    verdict = F.when(rule.isNotNull() & ~longer, "block").otherwise("allow")
    return both.select(key, "host", "path", rule.alias("rule"), verdict.alias("verdict"))


def _by_shards(found: DataFrame, block: Cascade, allow: Cascade, key: str) -> DataFrame:
    """Filters beyond the literal's bound: each distinct url's keys meet the shards, then fold by url."""
    urls = found.select("host", "path", "__keys").distinct().select("host", "path", F.explode("__keys").alias("__key"))
    marked = allow.mark(block.mark(urls, "__key", "__block"), "__key", "__allow").where("__block OR __allow")
    hit = marked.groupBy("host", "path").agg(F.max(F.struct(F.length("__key").alias("n"), F.col("__block").alias("b"), F.col("__key").alias("k"))).alias("__r"))
    return found.join(hit, ["host", "path"], "left").select(
        key, "host", "path", F.col("__r.k").alias("rule"), F.when(F.col("__r.b"), "block").otherwise("allow").alias("verdict"))


def rule_table(spark, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """The rules as a DataFrame without leaving the JVM."""
    rows = F.explode(F.array(*[F.struct(F.lit(a).alias("action"), F.lit(k).alias("key")) for a, k in rules])).alias("r")
    return spark.range(1).select(rows).select("r.*")


def query(spark, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"), rule_table(spark))


ORACLE_SQL = r"""
WITH r(action, rhost, rpath) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
                                        ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
u AS (SELECT page_id, regexp_extract(coalesce(url, ''), '^.*?://(.*)$', 1, 's') AS rest FROM pages),
p AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
m AS (SELECT page_id, host, path, rhost || rpath AS rule, action FROM p JOIN r
      ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)),
b AS (SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(action, length(rule)) AS action FROM m GROUP BY page_id)
SELECT p.page_id, p.host, p.path, b.rule, coalesce(b.action, 'allow') AS verdict FROM p LEFT JOIN b USING (page_id)
"""
