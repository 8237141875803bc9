"""SimHash near-dedup by multi-index hashing.

A fingerprint has 64 bits; bit b is set when more than half of the document's
shingle hashes have it set.  To find all fingerprints within ``max_bits``, the
64 bits are cut into segments with radii r_i whose (r_i + 1) sum to
``max_bits + 1``: two fingerprints that differ by more than r_i in every
segment i differ by more than ``max_bits`` in all, so a linked pair agrees
within r_i in some segment.  Each distinct fingerprint is filed once per
segment under the segment's value; each looks up every value in the r_i-ball
round its own (22 + 22 + 1 look-ups for the default 3 segments and 4 bits, radii
1, 1, 0), and the join condition verifies the complete distance, so only true
links leave the join.  This is exact, with no cap on buckets.

Rows of equal fingerprints meet only in a partial aggregate: a group of copies,
however large, is one fingerprint.  The number of links of one fingerprint is
bounded by the fingerprints that lie within ``max_bits`` of it, not by rows.

Defined results: a text without words (null, empty, blank) has fingerprint 0
and links like any other; fewer words than a shingle make one shingle of them
all; a null id is no candidate for a component's smallest id (a component of
null ids alone has component_id null).
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER_BLANK, keep_rows, materialise, row_sha, text_or_empty
from .components import connected_components

BLOCK = 1 << 16  # shingles hashed at a time: bounds memory for very long texts
SEED = 42


def fingerprint_bytes(text: bytes, shingle: int) -> int:
    """The 64-bit fingerprint of a UTF-8 text, as a signed integer."""
    words = b" ".join(text.translate(LOWER_BLANK).split())
    if not words:
        return 0
    blanks = np.flatnonzero(np.frombuffer(words, np.uint8) == 0x20)
    starts = np.concatenate(([0], blanks + 1))
    ends = np.concatenate((blanks, [len(words)]))
    n = max(1, len(starts) - shingle + 1)
    ends = ends[shingle - 1 :] if len(ends) >= shingle else ends[-1:]
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, n, BLOCK):
        spans = zip(starts[at : min(at + BLOCK, n)].tolist(), ends[at : at + BLOCK].tolist(), strict=True)
        hashes = np.array([digest(words[s:e], SEED) for s, e in spans], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprint(text: Column, shingle: int) -> Column:
    @F.pandas_udf("bigint")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint_bytes(t, shingle) for t in texts], dtype="int64")

    return of(text_or_empty(text).cast("binary"))


def hex64(col: Column) -> Column:
    return F.lower(F.lpad(F.hex(col), 16, "0"))


def segment_plan(max_bits: int, segments: int) -> list[tuple[int, int, int]]:
    """``(shift, width, radius)`` of each segment; radius -1 is never needed."""
    widths = [64 // segments + (i < 64 % segments) for i in range(segments)]
    radii = [(max_bits + 1) // segments + (i < (max_bits + 1) % segments) - 1 for i in range(segments)]
    shifts = [sum(widths[:i]) for i in range(segments)]
    return list(zip(shifts, widths, radii, strict=True))


def ball(width: int, radius: int) -> list[int]:
    """Every mask of ``width`` bits with at most ``radius`` set."""
    return [sum(1 << b for b in bits) for r in range(radius + 1) for bits in combinations(range(width), r)]


def links_within(fps: DataFrame, max_bits: int, segments: int = 3) -> DataFrame:
    """``(a, b)``, a < b: all pairs of the distinct fingerprints ``fps (fp
    bigint)`` that differ in at most ``max_bits`` bits, each at least once."""
    plan = [p for p in segment_plan(max_bits, segments) if p[2] >= 0]

    def value(shift: int, width: int) -> Column:
        v = F.shiftrightunsigned("fp", shift)
        return v.bitwiseAND(F.lit((1 << width) - 1)) if width < 64 else v

    filed = F.array(*[F.struct(F.lit(i).alias("seg"), value(s, w).alias("key")) for i, (s, w, _) in enumerate(plan)])
    def probes(i: int, shift: int, width: int, radius: int) -> Column:
        masks = F.array(*[F.lit(m).cast("bigint") for m in ball(width, radius)])
        return F.transform(masks, lambda m: F.struct(F.lit(i).alias("seg"), value(shift, width).bitwiseXOR(m).alias("key")))

    asked = F.flatten(F.array(*[probes(i, *p) for i, p in enumerate(plan)]))
    entries = fps.select(F.col("fp").alias("b"), F.explode(filed).alias("e")).select("b", "e.seg", "e.key")
    asks = fps.select(F.col("fp").alias("a"), F.explode(asked).alias("e")).select("a", F.col("e.seg").alias("s"), F.col("e.key").alias("k"))
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    on = (F.col("seg") == F.col("s")) & (F.col("key") == F.col("k")) & (F.col("a") < F.col("b")) & close
    return asks.join(entries, on).select("a", "b")


def near_duplicates(
    docs: DataFrame, shingle: int = 4, max_bits: int = 4, segments: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document row: ``doc_id, fingerprint, component_id, first,
    row_sha``; ``first`` marks one row of each component, of smallest id."""
    rows = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        F.monotonically_increasing_id().alias("row"),
        row_sha(F.col(f"`{text_col}`")).alias("row_sha"),
        fingerprint(F.col(f"`{text_col}`"), shingle).alias("fp"),
    )
    rows = materialise(rows, "fingerprints")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")
    fps = materialise(rows.groupBy("fp").agg(F.min(order).alias("first")), "distinct_fp")
    roots = connected_components(links_within(fps.select("fp"), max_bits, segments))
    rooted = fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("least"))
    per_fp = rooted.join(smallest, "root").select("fp", "least")
    return rows.join(per_fp, "fp").select(
        "doc_id",
        F.col("fp").alias("fingerprint"),
        F.col("least.doc_id").alias("component_id"),
        (F.col("row") == F.col("least.row")).alias("first"),
        "row_sha",
    )


def drop_near_copies(docs: DataFrame, shingle: int = 4, max_bits: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The document rows that stay, all columns kept: one of each component."""
    made = near_duplicates(docs, shingle, max_bits, id_col=id_col, text_col=text_col)
    return keep_rows(docs, made.select("doc_id", "row_sha", F.col("first").alias("kept")), id_col, text_col)
