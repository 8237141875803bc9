"""URL filter by a Bloom filter cascade: exact membership without joins.

Rules name a host (and all its subdomains) and a path beginning.  The keys that
can match a url are its host's suffixes joined to its path's beginnings, taken
only at label counts and lengths that occur among the rules.  All such keys of
the whole table are the key universe.  Level 1 of a cascade is a Bloom filter
of the listed keys; level 2 one of the universe keys that level 1 passes by
mistake; level 3 one of the listed keys that level 2 passes, and so on until no
mistake is left.  A key's answer is the parity of the first level it fails, and
that is exact for every key of the universe.  The levels' sizes depend on the
number of rules and the logarithm of the universe, so they are broadcast behind
a size check (``MAX_FILTER_BYTES``, some 100 million rules).

Filters are built by partial bit-ors inside tasks, and mistakes are found by a
row-local pass, so no key of the universe ever reaches the driver.

Defined results: a null url, or one without ``://``, has empty host and path and
no rule; no rule fits: rule null, verdict ``allow`` (it is not listed); of rules
of equal length the one with the longer host wins; repeated rows are judged each;
an empty table or rule list works; a key listed with both verdicts is an error.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii, materialise

MAX_FILTER_BYTES = 256 << 20
DEFAULT_VERDICT = "allow"


class BloomFilter:
    """Bits and the positions of a key, from two 64-bit hashes of it."""

    def __init__(self, n: int, rate: float, level: int):
        self.bits = max(64, math.ceil(n * math.log2(1 / rate) / math.log(2)))
        self.hashes = max(1, round(math.log2(1 / rate)))
        self.level = level
        if self.bits > 8 * MAX_FILTER_BYTES:
            raise ValueError(f"a filter of {n} keys exceeds {MAX_FILTER_BYTES} bytes: filter by parts of the rules")
        self.words = np.zeros(self.bits // 64 + 1, np.uint64)

    def positions(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        a, b = h1.astype(np.uint64), h2.astype(np.uint64) | np.uint64(1)
        with np.errstate(over="ignore"):
            a = a ^ (np.uint64(self.level) * np.uint64(0x9E3779B97F4A7C15))
            a = (a ^ (a >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
            at = a[:, None] + np.arange(self.hashes, dtype=np.uint64)[None, :] * b[:, None]
        return (at ^ (at >> np.uint64(32))) % np.uint64(self.bits)

    def holds(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        at = self.positions(h1, h2)
        return ((self.words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)).all(axis=1)

    def fill(self, keys: DataFrame) -> BloomFilter:
        """Set the bits of all ``keys (h1, h2)``: tasks or the bits of a word,
        Spark ors the words of tasks."""
        empty = self

        def part(batches):
            mine = np.zeros_like(empty.words)
            for b in batches:
                at = empty.positions(b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False)).ravel()
                np.bitwise_or.at(mine, at >> np.uint64(6), np.uint64(1) << (at & np.uint64(63)))
            some = np.flatnonzero(mine)
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(mine[some].view(np.int64))], ["word", "bits"])

        rows = keys.select("h1", "h2").mapInArrow(part, "word bigint, bits bigint").groupBy("word").agg(F.bit_or("bits").alias("bits"))
        for r in rows.toLocalIterator():  # at most bits / 64 rows
            self.words[r["word"]] = np.int64(r["bits"]).view(np.uint64)
        return self


class Cascade:
    def __init__(self, levels: list[BloomFilter]):
        self.levels = levels

    def listed(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        answer = np.full(len(h1), len(self.levels) % 2 == 1)
        open_ = np.ones(len(h1), bool)
        for k, level in enumerate(self.levels):
            at = np.flatnonzero(open_)
            fails = at[~level.holds(h1[at], h2[at])]
            answer[fails] = k % 2 == 1
            open_[fails] = False
        return answer


def passing(keys: DataFrame, level: BloomFilter) -> DataFrame:
    shared = keys.sparkSession.sparkContext.broadcast(level)

    @F.pandas_udf("boolean")
    def holds(h1: pd.Series, h2: pd.Series) -> pd.Series:
        return pd.Series(shared.value.holds(h1.to_numpy(), h2.to_numpy()))

    return keys.where(holds("h1", "h2"))


def hashed(keys: DataFrame) -> DataFrame:
    return keys.select("key", F.xxhash64("key").alias("h1"), F.xxhash64("key", F.lit(1)).alias("h2"))


def build_cascade(listed: DataFrame, universe: DataFrame) -> Cascade:
    """A cascade exact for all keys of ``universe`` and ``listed (key, h1, h2)``."""
    inside = materialise(listed, "listed")
    outside = universe.join(F.broadcast(inside.select("key")) if inside.count() < 100_000 else inside.select("key"), "key", "left_anti")
    outside = materialise(outside, "unlisted")
    levels: list[BloomFilter] = []
    n_in, n_out = inside.count(), outside.count()
    while n_in:
        rate = 0.5 if levels else min(0.5, max(1e-6, math.sqrt(0.5) * n_in / max(1, n_out)))
        level = BloomFilter(n_in, rate, len(levels)).fill(inside)
        levels.append(level)
        wrong = materialise(passing(outside, level), f"wrong{len(levels)}")
        inside, outside = wrong, inside
        n_in = wrong.count()
    return Cascade(levels)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Lower-cased host and path; both empty without ``://``."""
    u = F.coalesce(url, F.lit(""))
    host = lower_ascii(F.regexp_extract(u, r"(?s)^.*?://([^/?#]*)", 1))
    path = F.regexp_extract(u, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return host, path


def candidates(host: Column, path: Column, labels: list[int], lengths: list[int]) -> Column:
    """Keys of a url that a rule could have, longest first."""
    parts = F.split(host, r"\.")
    pairs = []
    for n in labels:
        suffix = F.array_join(F.slice(parts, F.greatest(F.size(parts) - n, F.lit(0)) + 1, n), ".")
        for k in lengths:
            fits = (F.size(parts) >= n) & (F.char_length(path) >= k)
            key = F.concat(suffix, F.substring(path, 1, k))
            pairs.append(F.when(fits, F.struct((-F.char_length(key)).alias("l"), (-F.char_length(suffix)).alias("h"), key.alias("key"))))
    if not pairs:
        return F.array().cast("array<string>")
    return F.transform(F.array_sort(F.array_compact(F.array(*pairs))), lambda c: c["key"])


def judge(pages: DataFrame, rules: DataFrame, url_col: str = "url") -> DataFrame:
    """``pages`` with columns ``host, path, rule, verdict`` added (an input
    column of one of these names is replaced).  ``rules``: ``host`` (lower
    case), ``path``, ``verdict`` (block or allow)."""
    spark = pages.sparkSession
    keyed = materialise(rules.select(F.concat("host", "path").alias("key"), "verdict", F.size(F.split("host", r"\.")).alias("n"), F.char_length("path").alias("k")).distinct(), "rules")
    if not keyed.groupBy("key").count().where("count > 1").isEmpty():
        raise ValueError("a rule is listed with both verdicts")
    shape = keyed.agg(F.collect_set("n").alias("n"), F.collect_set("k").alias("k")).first()
    host, path = url_parts(F.col(f"`{url_col}`"))
    keys = pages.select(candidates(host, path, sorted(shape["n"]), sorted(shape["k"])).alias("keys"))
    universe = materialise(hashed(keys.select(F.explode("keys").alias("key")).distinct()), "universe")
    cascades = {v: build_cascade(hashed(keyed.where(F.col("verdict") == v).select("key")), universe) for v in ("block", "allow")}
    shared = spark.sparkContext.broadcast(cascades)

    @F.pandas_udf("int")
    def first_listed(h1: pd.Series, h2: pd.Series) -> pd.Series:
        """2 i for a block rule, 2 i + 1 for an allow rule: candidate i."""
        sizes = h1.map(len).to_numpy()
        out = np.full(len(h1), -1, np.int32)
        if not sizes.sum():
            return pd.Series(out)
        a, b = np.concatenate(h1.tolist()), np.concatenate(h2.tolist())
        row = np.repeat(np.arange(len(h1)), sizes)
        nth = np.arange(len(a)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        allow, block = shared.value["allow"].listed(a, b), shared.value["block"].listed(a, b)
        hit = np.flatnonzero(allow | block)[::-1]  # backwards: the first candidate is written last
        out[row[hit]] = 2 * nth[hit] + allow[hit]
        return pd.Series(out)

    made = pages.withColumns({"host": host, "path": path})
    keys = candidates(F.col("host"), F.col("path"), sorted(shape["n"]), sorted(shape["k"]))
    found = first_listed(F.transform(keys, lambda c: F.xxhash64(c)), F.transform(keys, lambda c: F.xxhash64(c, F.lit(1))))
    made = made.withColumn("verdict", found)
    rule = F.when(F.col("verdict") >= 0, F.get(keys, F.shiftright("verdict", 1)))
    verdict = F.when(F.col("verdict") < 0, F.lit(DEFAULT_VERDICT)).when(F.col("verdict") % 2 == 1, F.lit("allow")).otherwise(F.lit("block"))
    return made.withColumns({"rule": rule, "verdict": verdict})
