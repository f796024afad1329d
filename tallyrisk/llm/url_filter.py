"""URL filters: a Bloom filter cascade for exact listed-or-not answers without a join, plus host/path rules.

A cascade over a *complete* key universe U holds a list L exactly.  Level 1 is a Bloom filter of L; level 2
holds the keys of U - L that level 1 wrongly accepts; level 3 holds the keys of L that level 2 wrongly accepts; and
so on until no key is left over.  A key is listed if the first level that rejects it is even (or all levels accept it and
their number is odd).  Each level is about a quarter of the one two levels above, so the whole cascade takes a few bits a
key.  It answers for keys of U only; U is the corpus's own distinct keys, so every row's key is in it.

Keys enter as two 64-bit hashes made by Spark (``xxhash64`` with two salts); the filter bits are positions
h1 + i * h2.  Two keys of different kind that agree in all 128 bits would never be told apart; the build raises
if that happens.  Levels are built by grouped aggregation; the driver gets only the bit words.

Size: bits grow with the list, so the key space is cut into ``shards`` by hash until no shard's cascade exceeds
``max_filter_bytes``.  One shard's filter is broadcast at a time; with several shards the rows are judged by one
scan for each shard, and each row lies in exactly one of them.

Defined results: null urls and urls without ``://`` have an empty host and path, match no rule and get the method's
verdict of the empty key (allow unless listed); repeated rows are judged alike; empty tables give empty results; all
input columns are kept, and inputs whose names clash with result columns are replaced by them.
"""
from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, column

MAX_FILTER_BYTES = 32 << 20
BITS_A_KEY = 5.0      # first levels: false positive rate about 0.09 with 3 hashes
HASHES = 3
MAX_LEVELS = 64


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def best_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """Struct (rule, verdict) of the longest rule whose host is the url's host or a parent of it and whose path starts the
    url's path; null if none fits."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: len(r.text)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def key_hashes(key: Column) -> tuple[Column, Column]:
    return F.xxhash64(key), F.xxhash64(F.lit(1), key)


@dataclass
class Level:
    bits: int
    words: np.ndarray


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _positions(h1: np.ndarray, h2: np.ndarray, level: int, bits: int) -> np.ndarray:
    """Bit positions (rows x HASHES) of keys at a level; the level salts the second hash."""
    salt = np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & (2**64 - 1))
    a, b = (_mixed(h.astype(np.int64).view(np.uint64) + salt) for h in (h1, h2))
    steps = np.arange(HASHES, dtype=np.uint64)
    return ((a[:, None] + steps * (b | np.uint64(1))[:, None]) >> np.uint64(11)) % np.uint64(bits)


def _accepts(level: Level, at: int, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    if level.bits == 0:
        return np.zeros(len(h1), dtype=bool)
    pos = _positions(h1, h2, at, level.bits)
    return ((level.words[(pos >> np.uint64(6)).astype(np.int64)] >> (pos & np.uint64(63))) & np.uint64(1)).all(axis=1)


def member(levels: list[Level], h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Exact membership for keys of the universe."""
    listed = np.full(len(h1), len(levels) % 2 == 1)
    open_ = np.arange(len(h1))
    for at, level in enumerate(levels):
        ok = _accepts(level, at, h1[open_], h2[open_])
        listed[open_[~ok]] = at % 2 == 1
        open_ = open_[ok]
        if not len(open_):
            break
    return listed


def _level(keys: DataFrame, at: int, n: int) -> Level:
    """One Bloom filter of the keys (h1, h2): positions are made in the tasks, equal words meet by grouped OR."""
    bits = max(64, int(np.ceil(n * BITS_A_KEY / 64)) * 64)

    def words(batches):
        for pdf in batches:
            pos = _positions(pdf.h1.to_numpy(), pdf.h2.to_numpy(), at, bits).ravel()
            yield pd.DataFrame({"word": (pos >> np.uint64(6)).astype(np.int64),
                                "bit": (np.uint64(1) << (pos & np.uint64(63))).view(np.int64)})

    got = keys.mapInPandas(words, "word long, bit long").groupBy("word").agg(F.bit_or("bit").alias("bit")).toArrow()
    out = np.zeros(bits // 64, dtype=np.uint64)
    out[column(got, "word")] = column(got, "bit").astype(np.int64).view(np.uint64)
    return Level(bits, out)


def _accepted_by(spark: SparkSession, levels: list[Level], at: int) -> Column:
    sent = spark.sparkContext.broadcast(levels[at])

    @F.pandas_udf("boolean")
    def accepts(h1: pd.Series, h2: pd.Series) -> pd.Series:
        return pd.Series(_accepts(sent.value, at, h1.to_numpy(), h2.to_numpy()))

    return accepts("h1", "h2")


def _member_of(spark: SparkSession, levels: list[Level]) -> Column:
    sent = spark.sparkContext.broadcast(levels)

    @F.pandas_udf("boolean")
    def is_listed(h1: pd.Series, h2: pd.Series) -> pd.Series:
        return pd.Series(member(sent.value, h1.to_numpy(), h2.to_numpy()))

    return is_listed("_h1", "_h2")


def build_cascade(universe: DataFrame, scratch: Scratch, name: str) -> list[Level]:
    """Levels of the cascade of universe (h1, h2, listed).  Each level halves the two sets that remain."""
    spark = universe.sparkSession
    inside, outside = universe.filter("listed").select("h1", "h2"), universe.filter("not listed").select("h1", "h2")
    levels: list[Level] = []
    while True:
        n = inside.count()
        if n == 0:
            return levels
        if len(levels) >= MAX_LEVELS:
            raise ValueError("two keys, one listed and one not, agree in 128 hash bits")
        at = len(levels)
        levels.append(_level(inside, at, n))
        wrong = scratch.write(outside.filter(_accepted_by(spark, levels, at)), f"{name}-{at}")
        inside, outside = wrong, inside


def judge(df: DataFrame, listed: DataFrame, key: Column, max_filter_bytes: int = MAX_FILTER_BYTES) -> DataFrame:
    """``df`` with ``is_listed``: whether ``key`` (null counts as the empty key) is among ``listed.key``.

    ``listed`` may hold keys that no row has; only the list's part inside the corpus's keys is encoded.
    """
    spark = df.sparkSession
    scratch = Scratch(spark, "url-filter")
    h1, h2 = key_hashes(F.coalesce(key, F.lit("")))
    rows = df.withColumns({"_h1": h1, "_h2": h2})
    keys = rows.select(F.col("_h1").alias("h1"), F.col("_h2").alias("h2")).distinct().withColumn("listed", F.lit(False))
    l1, l2 = key_hashes(F.coalesce(F.col("key"), F.lit("")))
    named = listed.select(l1.alias("h1"), l2.alias("h2")).distinct().withColumn("listed", F.lit(True))
    # one grouping marks the universe: seen in the corpus, and listed
    marked = (keys.withColumn("seen", F.lit(True)).unionByName(named.withColumn("seen", F.lit(False)))
              .groupBy("h1", "h2").agg(F.max("listed").alias("listed"), F.max("seen").alias("seen")).filter("seen"))
    universe = scratch.write(marked.select("h1", "h2", "listed"), "universe")
    n = universe.filter("listed").count()
    # all levels together take less than twice the first level's bits, and no less than a quarter of the list's outside matches
    outside = universe.count() - n
    need = (n * BITS_A_KEY * 1.4 + outside * 0.1 * BITS_A_KEY * 1.4) / 8
    shards = max(1, int(np.ceil(need / max_filter_bytes)))
    parts = []
    for s in range(shards):
        of_shard = universe.filter(F.pmod(F.col("h1"), F.lit(shards)) == s) if shards > 1 else universe
        levels = build_cascade(of_shard, scratch, f"level-{s}")
        part = rows.filter(F.pmod(F.col("_h1"), F.lit(shards)) == s) if shards > 1 else rows
        parts.append(part.withColumn("is_listed", _member_of(spark, levels)))
    return reduce(DataFrame.unionByName, parts).drop("_h1", "_h2")


def filter_urls(df: DataFrame, rules: list[Rule], listed: DataFrame, url: str = "url") -> DataFrame:
    """``df`` with host, path, rule, verdict and is_listed: the longest fitting rule decides, else the list of blocked hosts."""
    rows = df.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    judged = judge(rows, listed, F.col("host"))
    best = best_rule(F.col("host"), F.col("path"), rules)
    return (judged.withColumn("_best", best)
            .withColumn("rule", F.col("_best.rule"))
            .withColumn("verdict", F.coalesce(F.col("_best.verdict"),
                                              F.when(F.col("is_listed"), "block").otherwise("allow"))).drop("_best"))
