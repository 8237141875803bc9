"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The test strings are the 13-word windows of the benchmark items (an item of
fewer words is one shorter window).  Words are the symbols.  For windows of one
length L a table gives, for the block of the last two words under the window's
end, how far the end can move: a block that no window holds moves it L - 1
words, so most of a clean text is never looked at; a block at distance d from
the nearest window end moves it d; distance 0 opens the bucket of the windows
that end with the block, in which the first two words select the test strings
and a direct comparison of all words confirms an occurrence.

Search is row-local: texts are neither shuffled nor joined.  The tables are
broadcast, so their size is checked: a benchmark beyond ``BLOCK_BYTES`` is
searched in blocks of items, one pass each, and the occurrences are merged.

Defined results: a null or empty text has no words, no occurrence and is not
contaminated; benchmark rows without words (null, empty) are no items; rows
that share an item_id are one item, a null item_id is the empty id; repeated
document rows are judged each on their own; an empty benchmark hits nothing.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keep_rows, materialise, row_sha, text_or_empty

WINDOW = 13
MIN_SHARE = 20  # contaminated: at least one word in twenty is hit
BLOCK_BYTES = 1 << 20  # benchmark text per broadcast table; tables take about 150 times their text

# words are runs of 0-9, a-z and all bytes beyond ASCII
TO_WORDS = bytes(
    b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 0x20 if 0x41 <= b <= 0x5A else 0x20
    for b in range(256)
)

FOUND = "n_words bigint, n_hit bigint, spans array<struct<first:bigint,last:bigint>>, items array<string>"


def words_of(text: bytes) -> list[bytes]:
    return text.translate(TO_WORDS).split()


class WindowTable:
    """Shift table and buckets of the windows of one length."""

    def __init__(self, length: int):
        self.length = length
        self.block = min(2, length)
        self.leap = length - self.block + 1
        self.shift: dict[tuple, int] = {}
        self.buckets: dict[tuple, dict[tuple, dict[tuple, set[str]]]] = {}

    def add(self, window: tuple, item: str) -> None:
        for end in range(self.block, self.length + 1):
            at = window[end - self.block : end]
            self.shift[at] = min(self.length - end, self.shift.get(at, self.leap))
        bucket = self.buckets.setdefault(window[-self.block :], {})
        bucket.setdefault(window[: self.block], {}).setdefault(window, set()).add(item)

    def occurrences(self, words: list[bytes]):
        """``(first word, items)`` of every occurrence of a window."""
        length, block, leap, shift = self.length, self.block, self.leap, self.shift
        end, n = length, len(words)
        while end <= n:
            tail = tuple(words[end - block : end])
            move = shift.get(tail, leap)
            if not move:
                first = end - length
                tests = self.buckets[tail].get(tuple(words[first : first + block]))
                if tests and (items := tests.get(tuple(words[first:end]))):
                    yield first, items
                move = 1
            end += move


def window_tables(items: list[tuple[str, bytes]], window: int) -> list[WindowTable]:
    tables: dict[int, WindowTable] = {}
    for item, text in items:
        words = words_of(text)
        length = min(window, len(words))
        if length:
            t = tables.setdefault(length, WindowTable(length))
            for i in range(len(words) - length + 1):
                t.add(tuple(words[i : i + length]), item)
    return list(tables.values())


def search(text: bytes, tables: list[WindowTable]) -> tuple[int, int, list, list]:
    words = words_of(text)
    hit, items = None, set()
    for t in tables:
        for first, owners in t.occurrences(words):
            if hit is None:
                hit = np.zeros(len(words) + 2, np.int8)
            hit[first + 1 : first + 1 + t.length] = 1
            items |= owners
    if hit is None:
        return len(words), 0, [], []
    edge = np.flatnonzero(np.diff(hit))
    spans = [{"first": int(a), "last": int(b) - 1} for a, b in zip(edge[::2], edge[1::2], strict=True)]
    return len(words), int(hit.sum()), spans, sorted(items)


def pattern_blocks(benchmark: DataFrame, window: int, id_col: str, text_col: str, block_bytes: int) -> list:
    """One broadcast per block of items whose texts sum to about ``block_bytes``."""
    src = benchmark.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("item"), text_or_empty(F.col(f"`{text_col}`")).cast("binary").alias("text"))
    size = src.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    n = max(1, math.ceil(size / block_bytes))
    sc = benchmark.sparkSession.sparkContext
    for k in range(n):
        rows = src.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k) if n > 1 else src
        yield sc.broadcast(window_tables([(r[0], bytes(r[1])) for r in rows.collect()], window))


def found_by(tables, text: Column) -> Column:
    """Struct FOUND of each text for one broadcast block of windows."""

    @F.pandas_udf(FOUND)
    def of(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([search(t, tables.value) for t in texts], columns=["n_words", "n_hit", "spans", "items"])

    return of(text_or_empty(text).cast("binary"))


def merged(parts: Column) -> Column:
    """Struct FOUND from the FOUND structs of several blocks of one text."""

    @F.pandas_udf(FOUND)
    def of(many: pd.Series) -> pd.DataFrame:
        out = []
        for blocks in many:
            n = int(blocks[0]["n_words"])
            hit = np.zeros(n + 2, np.int8)
            items: set[str] = set()
            for b in blocks:
                items.update(b["items"])
                for s in b["spans"]:
                    hit[s["first"] + 1 : s["last"] + 2] = 1
            edge = np.flatnonzero(np.diff(hit))
            spans = [{"first": int(a), "last": int(z) - 1} for a, z in zip(edge[::2], edge[1::2], strict=True)]
            out.append((n, int(hit.sum()), spans, sorted(items)))
        return pd.DataFrame(out, columns=["n_words", "n_hit", "spans", "items"])

    return of(parts)


def is_contaminated(found: Column) -> Column:
    return (found["n_hit"] > 0) & (found["n_hit"] * MIN_SHARE >= found["n_words"])


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per document row: ``doc_id, row_sha, n_words, n_hit, spans``
    (word numbers of maximal hit runs), ``items`` (sorted), ``contaminated``."""
    text = F.col(f"`{text_col}`")
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), row_sha(text).alias("row_sha"), text.alias("text"))
    blocks = pattern_blocks(benchmark, window, item_col, item_text_col, block_bytes)
    passes = []
    first = next(blocks)
    for block in blocks:
        passes = passes or [materialise(found_of_texts(rows, first), "found")]
        passes.append(materialise(found_of_texts(rows, block), "found"))
        block.unpersist()
    if not passes:
        found = rows.select("doc_id", "row_sha", found_by(first, F.col("text")).alias("f"))
    else:
        every = passes[0]
        for p in passes[1:]:
            every = every.unionByName(p)
        lists = every.groupBy("row_sha").agg(F.collect_list("f").alias("fs"))  # one entry per block
        per_text = lists.select("row_sha", merged(F.col("fs")).alias("f"))
        found = rows.select("doc_id", "row_sha").join(materialise(per_text, "found"), "row_sha")
    return found.select("doc_id", "row_sha", "f.*", is_contaminated(F.col("f")).alias("contaminated"))


def found_of_texts(rows: DataFrame, tables) -> DataFrame:
    """Results of one block per distinct text (they depend on nothing else)."""
    made = rows.select("row_sha", found_by(tables, F.col("text")).alias("f"))
    return made.groupBy("row_sha").agg(F.first("f").alias("f"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, all columns kept; with
    one block of windows a row-local filter."""
    blocks = pattern_blocks(benchmark, WINDOW, "item_id", "text", block_bytes)
    first = next(blocks)
    if next(blocks, None) is None:
        return docs.where(~is_contaminated(found_by(first, F.col(f"`{text_col}`"))))
    decided = contamination(docs, benchmark, id_col=id_col, text_col=text_col, block_bytes=block_bytes)
    return keep_rows(docs, decided.select("doc_id", "row_sha", (~F.col("contaminated")).alias("kept")), id_col, text_col, repeats=True)
