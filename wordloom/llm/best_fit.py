"""Best-fit packing of whole documents by large-item matching.

A document is cut only where it is longer than a sequence.  A piece above a
third of the capacity is large: a sequence holds at most two of them.  Going
down from the longest, each large piece is matched with the longest other large
piece that still fits; the smaller pieces then go, longest first, into the
smallest gap that holds them, and open a new sequence when there is none.

Only lengths decide, and there are no more of them than the capacity.  So the
packing is computed on the counts per length: equal bins are one group, a run
of equal pieces fills a run of equal bins in one step, and the result is a list
of segments ("the pieces of this length from this rank on lie in the bins from
here on") whose number is bounded by the capacity, not by the table.  Every
piece then finds its place from its rank among the pieces of its length:

1. each task tokenises its documents and numbers its pieces per length;
2. the counts per (task, length) are summed up to each task's first rank;
3. the counts per length (at most ``seq_tokens`` rows) go to the driver, the
   segments come back as a broadcast, and every row looks up its place.

No piece of text and no row is shuffled for a hot length: the only exchange is
of counts.  The written table of step 1 fixes the numbering, so a task that
runs again later reads the same ranks.

Defined results: a null or empty text is the end token alone; repeated rows are
packed each; null ids are kept; an empty table gives no piece; a text of any
length is tokenised whole; other columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, text_or_empty
from .token_units import BlankUnitCodes, coder_of

SEQ_TOKENS = 4096
END_ID = 1
SLICE = 128  # documents encoded together

PIECES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids", pa.binary()),
        ("ids_crc32", pa.int64()),
        ("task", pa.int32()),
        ("number", pa.int64()),
    ]
)
DDL = {"doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint", "ids": "binary", "ids_crc32": "bigint", "task": "int", "number": "bigint"}


@dataclass(frozen=True)
class Segment:
    """Pieces of one length, ranks ``rank`` to ``rank + count - 1``: ``each`` to
    a bin, in the bins from ``bin`` on, the first at ``offset`` there."""

    length: int
    rank: int
    count: int
    each: int
    bin: int
    offset: int


def plan(counts: dict[int, int], capacity: int) -> tuple[list[Segment], int]:
    """The segments that place ``counts`` (pieces per length), and the number
    of bins.  Gaps are kept as groups of neighbouring bins alike in fill."""
    left, used = dict(counts), Counter()
    segments: list[Segment] = []
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap -> [(first bin, bins)]
    open_gaps: list[int] = []  # the keys of ``gaps`` in order
    bins = 0

    def put(length: int, n: int, each: int, first: int, offset: int) -> None:
        segments.append(Segment(length, used[length], n, each, first, offset))
        used[length] += n

    def leave(gap: int, first: int, n: int) -> None:
        if not n or not gap:
            return
        if gap not in gaps:
            gaps[gap] = []
            insort(open_gaps, gap)
        gaps[gap].append((first, n))

    large = sorted((x for x in left if 3 * x > capacity), reverse=True)
    for k, long in enumerate(large):
        partners = [x for x in large[k:] if long + x <= capacity]  # longest first
        while left[long]:
            short = next((x for x in partners if left[x] > (x == long)), None)
            n = left[long] if short is None else left[long] // 2 if short == long else min(left[long], left[short])
            if short is None:
                put(long, n, 1, bins, 0)
                leave(capacity - long, bins, n)
            elif short == long:
                put(long, 2 * n, 2, bins, 0)
                leave(capacity - 2 * long, bins, n)
                left[long] -= n
            else:
                put(long, n, 1, bins, 0)
                put(short, n, 1, bins, long)
                leave(capacity - long - short, bins, n)
                left[short] -= n
            left[long] -= n
            bins += n

    for length in sorted((x for x in left if 3 * x <= capacity), reverse=True):
        n = left[length]
        while n:
            at = bisect_left(open_gaps, length)
            if at < len(open_gaps):
                gap = open_gaps[at]
                first, held = gaps[gap].pop()
                if not gaps[gap]:
                    del open_gaps[at], gaps[gap]
            else:
                gap, first, held = capacity, bins, -(-n // (capacity // length))
                bins += held
            fit = gap // length  # a bin is filled up before the next one is begun
            full = min(held, n // fit)
            if full:
                put(length, full * fit, fit, first, capacity - gap)
                leave(gap - fit * length, first, full)
                n -= full * fit
            rest = 0
            if full < held and n:
                rest = 1
                put(length, n, n, first + full, capacity - gap)
                leave(gap - n * length, first + full, 1)
                n = 0
            leave(gap, first + full + rest, held - full - rest)
    return segments, bins


class Places:
    """Segments as arrays, sorted by length and rank."""

    def __init__(self, segments: list[Segment]):
        rows = np.array(sorted((s.length, s.rank, s.count, s.each, s.bin, s.offset) for s in segments), dtype=np.int64).reshape(-1, 6)
        self.length, self.rank, self.count, self.each, self.bin, self.offset = rows.T.copy()
        self.key = (self.length << 48) + self.rank

    def of(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bin and offset of the pieces of these lengths and ranks."""
        k = np.searchsorted(self.key, (length << 48) + rank, side="right") - 1
        i = rank - self.rank[k]
        if len(i) and (i.min() < 0 or (i >= self.count[k]).any() or (self.length[k] != length).any()):
            raise ValueError("a piece has no place: its rank is not among the counted ones")
        return self.bin[k] + i // self.each[k], self.offset[k] + i % self.each[k] * length


def cut_pieces(docs: DataFrame, tokenizer_path: str, id_col: str, text_col: str, seq_tokens: int, end_id: int, with_ids: bool) -> DataFrame:
    """One row per piece, numbered per task and length."""
    with open(tokenizer_path, encoding="utf-8") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())
    src = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), text_or_empty(F.col(f"`{text_col}`")).alias("text"))
    end = np.array([end_id], dtype="<u4").tobytes()
    kept = [f for f in PIECES if with_ids or f.name != "ids"]

    def run(batches):
        from pyspark import TaskContext

        task, numbers, coder = TaskContext.get().partitionId(), Counter(), coder_of(BlankUnitCodes, shared.value)
        for batch in batches:
            for lo in range(0, batch.num_rows, SLICE):
                part = batch.slice(lo, SLICE)
                rows = []
                for doc, ids in zip(part.column(0).to_pylist(), coder.encode(part.column(1).to_pylist()), strict=True):
                    ids += end
                    for piece, at in enumerate(range(0, len(ids), 4 * seq_tokens)):
                        cut = ids[at : at + 4 * seq_tokens]
                        n = len(cut) // 4
                        rows.append((doc, piece, at // 4, n, cut, zlib.crc32(cut), task, numbers[n]))
                        numbers[n] += 1
                columns = dict(zip(PIECES.names, zip(*rows, strict=True), strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in kept], schema=pa.schema(kept))

    return src.mapInArrow(run, ", ".join(f"{f.name} {DDL[f.name]}" for f in kept))


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    seq_tokens: int = SEQ_TOKENS,
    end_id: int = END_ID,
    with_ids: bool = True,
) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids, ids_crc32,
    sequence_id, offset``; ``ids`` (little-endian unsigned 32-bit) only
    ``with_ids``.  The tokenizer must drop blanks between words (see
    ``BlankUnitCodes``)."""
    if not 1 <= seq_tokens < 1 << 15:
        raise ValueError("a sequence holds between 1 and 32767 tokens")
    pieces = materialise(cut_pieces(docs, tokenizer_path, id_col, text_col, seq_tokens, end_id, with_ids), "pieces")
    counts = materialise(pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    # at most one row per possible length
    per_length = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    segments, _ = plan(per_length, seq_tokens)
    places = docs.sparkSession.sparkContext.broadcast(Places(segments))

    before = F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")
    first = counts.select("task", "length", before.alias("first_rank"))

    @F.arrow_udf("struct<sequence_id: bigint, offset: bigint>")
    def place(length: pa.Array, rank: pa.Array) -> pa.Array:
        found = places.value.of(length.to_numpy(zero_copy_only=False), rank.to_numpy(zero_copy_only=False))
        return pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in found], names=["sequence_id", "offset"])

    ranked = pieces.join(first, ["task", "length"]).withColumn("place", place("length", F.col("first_rank") + F.col("number")))
    kept = ["doc_id", "piece", "start", "length", *(["ids"] if with_ids else []), "ids_crc32"]
    return ranked.select(*kept, "place.sequence_id", "place.offset")
