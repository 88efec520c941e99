"""URL filters: exact membership in a key list through a cascade of Bloom filters.

A rule is a key, host and path written together. Every url offers a bounded number of candidate keys: the suffixes of
its host that have no more labels than the longest rule, each with the prefixes of its path that are as long as some
rule's path. The universe is the set of all candidate keys of the corpus.

Level 1 of a cascade encodes the listed keys; the keys of the universe that it takes for listed wrongly are encoded in level 2;
the listed keys that level 2 hits wrongly in level 3, and so on until a level has no false positive. Asking
the levels in turn is then exact for every key of the universe, with no join: only bitmaps travel with the plan.
Level 1 is sized so that its false positives are about as many as the listed keys, so all levels together hold
about ``1.5 * (log2(universe / listed) + 4)`` bits per listed key. ``max_bits`` bounds it; a larger list is an error.

Defined results: a null url, or one without ``://``, has an empty host and path; no rule fits it. A key in both lists is allowed.
A url that no rule fits gets ``default``. Without rules every url gets it. Repeated rows are judged one by one.
Rows keep their other columns only where the caller selects them.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trolley.llm.common import longs
from trolley.session import stage

ALLOW, BLOCK = "allow", "block"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def key(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Level:
    words: list[int]
    bits: int
    hashes: int
    seed: int


def host_and_path(df: DataFrame, url: str = "url") -> DataFrame:
    """Adds ``host`` and ``path``."""
    whole = F.coalesce(F.col(url).cast("string"), F.lit(""))
    at = F.instr(whole, "://")
    rest = F.when(at > 0, F.expr("substring(__url, __at + 3)")).otherwise("")
    df = df.withColumns({"__url": whole, "__at": at}).withColumn("__rest", rest)
    df = df.withColumn("__host", F.regexp_extract("__rest", "^[^/?#]*", 0))
    path = F.regexp_extract(F.expr("substring(__rest, length(__host) + 1)"), "^[^?#]*", 0)
    return df.withColumns({"path": path, "host": F.translate("__host", UPPER, LOWER)}).drop("__url", "__at", "__rest", "__host")


def candidate_keys(host: Column, path: Column, rules: list[Rule]) -> Column:
    """Keys that a rule could have and still fit, longest first."""
    most = max(r.host.count(".") + 1 for r in rules)
    lengths = sorted({len(r.path) for r in rules}, reverse=True)
    labels = F.split(host, r"\.")
    n = F.size(labels)
    suffixes = F.transform(F.sequence(F.greatest(F.lit(1), n - most + 1), n), lambda i: F.array_join(F.slice(labels, i, n), "."))
    prefixes = F.filter(F.array(*(F.when(F.length(path) >= k, F.substring(path, 1, k)) for k in lengths)), lambda p: p.isNotNull())
    pairs = F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p))))
    by_length = F.array_sort(pairs, lambda a, b: F.length(b) - F.length(a))
    return F.when(host != "", by_length).otherwise(F.array().cast("array<string>"))


def _positions(key: Column, bits: int, hashes: int, seed: int) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(seed * 64 + i), key), F.lit(bits)) for i in range(hashes)]


def in_level(key: Column, level: Level) -> Column:
    words = longs(level.words)
    hit = F.lit(True)
    for p in _positions(key, level.bits, level.hashes, level.seed):
        hit = hit & (F.getbit(F.element_at(words, (F.shiftright(p, 6) + 1).cast("int")), p.bitwiseAND(F.lit(63)).cast("int")) == 1)
    return hit


def encode(keys: DataFrame, count: int, rate: float, seed: int, max_bits: int) -> Level:
    """Bloom filter of column ``key``, built by a bitwise aggregate per word of the bitmap."""
    hashes = max(1, round(-math.log2(rate)))
    bits = max(64, 64 * math.ceil(count * hashes / math.log(2) / 64))
    if bits > max_bits:
        raise ValueError(f"{count} keys need {bits} bits, more than {max_bits}")
    p = keys.select(F.explode(F.array(*_positions(F.col("key"), bits, hashes, seed))).alias("p"))
    found = p.groupBy(F.shiftright("p", 6).alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("v")).collect()
    words = [0] * (bits // 64)
    for r in found:
        words[r["w"]] = r["v"]
    return Level(words, bits, hashes, seed)


def build_cascade(listed: DataFrame, universe: DataFrame, max_bits: int = 1 << 27) -> list[Level]:
    """Levels that tell exactly which keys of ``universe`` are in ``listed``; both have a column ``key``, repeats allowed."""
    listed = stage(listed.select("key").where("key is not null").distinct(), "cascade-listed")
    inside = listed.count()
    if not inside:
        return []
    size = universe.agg(F.approx_count_distinct("key")).first()[0]
    levels: list[Level] = []
    # encoded by the next level, and the keys that it must not hit
    own, other, count = listed, universe, inside
    rate = min(0.5, math.sqrt(0.5) * inside / max(size, 1))
    while count:
        level = encode(own, count, rate, len(levels), max_bits)
        levels.append(level)
        wrong = other.where(in_level(F.col("key"), level))
        if len(levels) == 1:
            wrong = wrong.join(listed, "key", "left_anti").select("key").distinct()
        wrong = stage(wrong, "cascade-level")
        own, other, count, rate = wrong, own, wrong.count(), 0.5
    return levels


def is_listed(key: Column, levels: list[Level]) -> Column:
    """Exact for keys of the universe: the first level that misses decides, else the parity of the last."""
    answer = F.lit(len(levels) % 2 == 1)
    for i in reversed(range(len(levels))):
        answer = F.when(~in_level(key, levels[i]), F.lit(i % 2 == 1)).otherwise(answer)
    return answer


def filter_urls(pages: DataFrame, rules: list[Rule], url: str = "url", default: str = ALLOW) -> DataFrame:
    """Adds host, path, rule (null where none fits) and verdict to ``pages``; columns of these names are replaced."""
    df = host_and_path(pages, url)
    if not rules:
        return df.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    spark = pages.sparkSession
    df = df.withColumn("__keys", candidate_keys(F.col("host"), F.col("path"), rules))
    universe = df.select(F.explode("__keys").alias("key"))
    lists = {v: sorted({r.key for r in rules if r.verdict == v}) for v in (ALLOW, BLOCK)}
    cascades = {
        v: build_cascade(spark.createDataFrame([(k,) for k in keys], "key string"), universe) for v, keys in lists.items()}
    fits = F.filter("__keys", lambda k: is_listed(k, cascades[ALLOW]) | is_listed(k, cascades[BLOCK]))
    df = df.withColumn("rule", F.try_element_at(fits, F.lit(1)))
    verdict = (F.when(F.col("rule").isNull(), F.lit(default))
               .when(is_listed(F.col("rule"), cascades[ALLOW]), F.lit(ALLOW)).otherwise(F.lit(BLOCK)))
    return df.withColumn("verdict", verdict).drop("__keys")
