"""Hard negatives from Hilbert-ordered candidate blocks with zone maps.

1. Vectors become integers (``floor(scale * x)``).  Their key is the place on a
   Hilbert curve through the ``HILBERT_DIMS`` dimensions of largest spread, cut
   into ``2^HILBERT_BITS`` steps each.  Rows are range-partitioned and sorted by
   label, key and id, cut into blocks of at most ``BLOCK`` rows of one label, and
   written as Parquet, one row per block: its ids, its vectors, and per
   dimension the least and the largest value (the zone map).
2. Anchors are packed by ``PACK`` into rows of their own.  An anchor's score of
   any row of a block lies between the sums, over the dimensions, of the smaller
   and of the larger of ``q * low`` and ``q * high``.  These bounds are two
   matrix products per pack and bundle of zone maps, and a block is read for an
   anchor only when its interval meets one of the anchor's windows.
3. First each anchor reads the one block of largest upper bound; the score of
   its k-th best row there raises the window's lower end, and then all blocks
   whose interval still meets the window are read.  So the result is exact.
4. Positives are one window (all scores, same label).  Each positive then gives
   a window of negative scores (other labels), and the same search runs again.

Packs meet zone maps (a few hundred bytes a block, in bundles) by an equi-join
on the pack's number, and the chosen blocks by one on the block's number: one
block, one pack and their scores are in memory at a time.  Every block gives at
most k rows per anchor and window; the rest is a ranking per window.  Nothing
is collected but the spread of each dimension and three counts.

Defined results: rows with a null label, a null vector, or a null or non-finite
component take no part; a null id takes no part either (it can be neither
anchor nor negative of a defined rank); vectors of different length are compared
over the dimensions both have; repeated rows each count, also as each other's
positives; an anchor without positives, or a window without negatives, gives no
row; empty tables give none; extra columns are ignored.  Components are held as
64-bit integers and scores must fit 64 bits.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

SCALE = 256
BLOCK = 512  # rows of a candidate block
PACK = 512  # anchors of a pack, about
BUNDLE = 256  # zone maps tested together
PARTITION_ROWS = 1 << 17  # rows of a sorted partition
HILBERT_DIMS = 12
HILBERT_BITS = 5  # dims * bits must stay below 64
LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1

BLOCKS = "block_id bigint, label bigint, n int, dims int, ids binary, rows binary, vectors binary, low binary, high binary"
BUNDLES = "bundle int, dims int, block_ids binary, labels binary, sizes binary, low binary, high binary"
PACKS = "pack int, dims int, ids binary, rows binary, labels binary, vectors binary, lows binary, highs binary"
CHOSEN = "pack int, block_id bigint, anchors binary, bounds binary"
FOUND = "anchor_row bigint, anchor_id bigint, at int, vec_id bigint, vec_row bigint, score bigint"


# ---- Hilbert order ---------------------------------------------------------


def hilbert_key(steps: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of rows of coordinates below ``2^bits``."""
    x = [steps[:, k].astype(np.uint64) for k in range(steps.shape[1])]
    n, one = len(x), np.uint64(1)
    q = one << np.uint64(bits - 1)
    while q > one:  # undo the turns and mirrorings of each level, the coarsest first
        low = q - one
        for k in range(n):
            turned = (x[k] & q) != 0
            swap = np.where(turned, np.uint64(0), (x[0] ^ x[k]) & low)
            x[0] = np.where(turned, x[0] ^ low, x[0] ^ swap)
            x[k] ^= swap
        q >>= one
    for k in range(1, n):
        x[k] ^= x[k - 1]
    flip = np.zeros_like(x[0])
    q = one << np.uint64(bits - 1)
    while q > one:
        flip ^= np.where((x[-1] & q) != 0, q - one, np.uint64(0))
        q >>= one
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for k in range(n):
            key = key << one | ((x[k] ^ flip) >> np.uint64(b)) & one
    return key


@dataclass(frozen=True)
class Grid:
    """The dimensions the curve runs through and their ranges."""

    dims: tuple[int, ...]
    low: tuple[int, ...]
    high: tuple[int, ...]

    def keys(self, vectors: np.ndarray) -> np.ndarray:
        if not self.dims:
            return np.zeros(len(vectors), np.int64)
        x = vectors[:, self.dims].astype(np.float64)
        low, high = np.array(self.low, float), np.array(self.high, float)
        cells = 1 << HILBERT_BITS
        steps = np.clip((x - low) / np.maximum(high - low, 1) * cells, 0, cells - 1)
        return hilbert_key(steps.astype(np.int64), HILBERT_BITS).astype(np.int64)


# ---- tables ----------------------------------------------------------------


def as_matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of integers, shorter ones filled up with zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if len(lengths) and (lengths == dims).all():
        return flat.reshape(-1, dims)
    out = np.zeros((len(lengths), dims), np.int64)
    at = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[np.repeat(np.arange(len(lengths)), lengths), at] = flat
    return out


def whole_vectors(vectors: DataFrame, id_col: str, vector_col: str, label: Column, scale: int) -> DataFrame:
    """``vec_id, label, v`` (integers) of the rows that take part."""
    x = F.col(f"`{vector_col}`").cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    src = vectors.select(F.col(f"`{id_col}`").cast("bigint").alias("vec_id"), label.cast("bigint").alias("label"), x.alias("x"), finite.alias("whole"))
    src = src.where("vec_id IS NOT NULL AND label IS NOT NULL AND x IS NOT NULL AND whole")
    return src.select("vec_id", "label", F.transform("x", lambda c: F.floor(F.lit(float(scale)) * c)).alias("v"))


def grid_of(rows: DataFrame, dims: int) -> Grid:
    """The dimensions of largest spread: one row per dimension is collected."""
    per = rows.select(F.posexplode("v").alias("d", "x")).groupBy("d")
    spread = per.agg(F.min("x").alias("low"), F.max("x").alias("high"), F.var_pop("x").alias("var")).collect()
    widest = sorted(spread, key=lambda r: (-r["var"], r["d"]))[: min(dims, HILBERT_DIMS)]
    return Grid(tuple(r["d"] for r in widest), tuple(r["low"] for r in widest), tuple(r["high"] for r in widest))


def candidate_blocks(rows: DataFrame, n: int, dims: int) -> DataFrame:
    """The blocks with their zone maps, in order of label and curve."""
    grid = grid_of(rows, dims)

    @F.arrow_udf("bigint")
    def key(v: pa.Array) -> pa.Array:
        return pa.array(grid.keys(as_matrix(v, dims)))

    least = min(rows.sparkSession.sparkContext.defaultParallelism, math.ceil(n / (2 * BLOCK)))
    partitions = max(1, least, math.ceil(n / PARTITION_ROWS))
    ordered = rows.withColumn("key", key("v")).repartitionByRange(partitions, "label", "key", "vec_id").sortWithinPartitions("label", "key", "vec_id")

    def cut(batches):
        from pyspark import TaskContext

        number = base = TaskContext.get().partitionId() << 32
        row = base
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def block():
            ids, vectors = np.concatenate([h[0] for h in held]), np.concatenate([h[2] for h in held])
            at = np.arange(row, row + len(ids))
            low, high = vectors.min(axis=0), vectors.max(axis=0)
            values = [number, int(held[0][1][0]), len(ids), dims, ids.tobytes(), at.tobytes(), vectors.tobytes(), low.tobytes(), high.tobytes()]
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(values, [pa.int64(), pa.int64(), pa.int32(), pa.int32(), *[pa.binary()] * 5], strict=True)], names=[c.split()[0] for c in BLOCKS.split(", ")])

        for batch in batches:
            ids, labels, vectors = batch.column(0).to_numpy(), batch.column(1).to_numpy(), as_matrix(batch.column(2), dims)
            lo = 0
            while lo < len(ids):
                size = sum(len(h[0]) for h in held)
                if held and (held[0][1][0] != labels[lo] or size == BLOCK):
                    yield block()
                    number, row, held, size = number + 1, row + size, [], 0
                other = np.flatnonzero(labels[lo:] != labels[lo])
                hi = min(len(ids), lo + BLOCK - size, lo + int(other[0]) if len(other) else len(ids))
                held.append((ids[lo:hi], labels[lo:hi], vectors[lo:hi]))
                lo = hi
        if held:
            yield block()

    return materialise(ordered.select("vec_id", "label", "v").mapInArrow(cut, BLOCKS), "blocks")


def zone_bundles(blocks: DataFrame) -> DataFrame:
    """Zone maps, some ``BUNDLE`` to a row; the vectors are not read."""

    def bundle(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        for batch in batches:
            for lo in range(0, batch.num_rows, BUNDLE):
                b = batch.slice(lo, BUNDLE)
                numbers = [b.column(k).to_numpy().astype(np.int64).tobytes() for k in (0, 1, 2)]
                zones = [b"".join(b.column(k).to_pylist()) for k in (4, 5)]
                row = [part, b.column(3)[0].as_py(), *numbers, *zones]
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, [pa.int32(), pa.int32(), *[pa.binary()] * 5], strict=True)], names=[c.split()[0] for c in BUNDLES.split(", ")])

    return blocks.select("block_id", "label", "n", "dims", "low", "high").mapInArrow(bundle, BUNDLES)


def anchor_packs(anchors: DataFrame, packs: int, dims: int) -> DataFrame:
    """Anchors ``vec_row, vec_id, label, v, lows, highs`` (windows as arrays),
    about ``PACK`` to a row, numbered from 0."""

    def pack(batches):
        from pyspark import TaskContext

        tables = [pa.Table.from_batches([b]) for b in batches if b.num_rows]
        if not tables:
            return
        t = pa.concat_tables(tables).combine_chunks().to_batches()[0]
        windows = max(len(x) for x in t.column(4))
        lows, highs = np.full((t.num_rows, windows), HIGHEST), np.full((t.num_rows, windows), LOWEST)  # empty ones fill up
        for k, (lo, hi) in enumerate(zip(t.column(4).to_pylist(), t.column(5).to_pylist(), strict=True)):
            lows[k, : len(lo)], highs[k, : len(hi)] = lo, hi
        arrays = [t.column(1).to_numpy(), t.column(0).to_numpy(), t.column(2).to_numpy(), as_matrix(t.column(3), dims), lows, highs]
        row = [TaskContext.get().partitionId(), dims, *[a.astype(np.int64).tobytes() for a in arrays]]
        yield pa.RecordBatch.from_arrays([pa.array([x], y) for x, y in zip(row, [pa.int32(), pa.int32(), *[pa.binary()] * 6], strict=True)], names=[c.split()[0] for c in PACKS.split(", ")])

    src = anchors.select("vec_row", "vec_id", "label", "v", "lows", "highs").repartition(packs, "vec_row")
    return materialise(src.mapInArrow(pack, PACKS), "packs")


# ---- bounds and scores -----------------------------------------------------


def numbers(cell, width: int = 0) -> np.ndarray:
    a = np.frombuffer(cell, np.int64)
    return a.reshape(-1, width) if width else a


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b.T`` of integers, exactly: by floats where every sum fits them."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    size = float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1]
    if size < 2.0**53:
        return np.rint(a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


def bounds(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest possible score of each anchor with each block."""
    up, down = np.maximum(q, 0), np.minimum(q, 0)
    return product(up, low) + product(down, high), product(up, high) + product(down, low)


class Pack:
    """Anchors of a row of PACKS."""

    def __init__(self, row: dict):
        dims = row["dims"]
        self.ids, self.rows, self.labels = numbers(row["ids"]), numbers(row["rows"]), numbers(row["labels"])
        self.vectors = numbers(row["vectors"], dims) if dims else np.zeros((len(self.ids), 0), np.int64)
        self.lows, self.highs = (numbers(row[c]).reshape(len(self.ids), -1) for c in ("lows", "highs"))


def best_of(pack: Pack, anchors: np.ndarray, block: dict, k: int):
    """Per anchor and window the k best rows of a block: rows of FOUND."""
    dims = block["dims"]
    ids, rows = numbers(block["ids"]), numbers(block["rows"])
    vectors = numbers(block["vectors"], dims) if dims else np.zeros((len(ids), 0), np.int64)
    order = np.lexsort((rows, ids))
    ids, rows, vectors = ids[order], rows[order], vectors[order]
    scores = product(pack.vectors[anchors], vectors)
    others = pack.rows[anchors][:, None] != rows[None, :]  # an anchor is none of its own
    for w in range(pack.lows.shape[1]):
        fits = others & (scores >= pack.lows[anchors, w][:, None]) & (scores <= pack.highs[anchors, w][:, None])
        for a in np.flatnonzero(fits.any(axis=1)):
            at = np.flatnonzero(fits[a])
            at = at[np.argsort(-scores[a, at], kind="stable")[:k]]  # ties: smaller id first
            yield pack.rows[anchors[a]], pack.ids[anchors[a]], w, ids[at], rows[at], scores[a, at]


def choose(packs: DataFrame, n_packs: int, bundles: DataFrame, same: bool, first: bool) -> DataFrame:
    """``(pack, block_id, anchors, bounds)``: the blocks whose interval meets a
    window of some anchors, of equal label or of other labels; with ``first``
    only each anchor's block of largest upper bound in the bundle."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                p, d = Pack(row["p"]), row["p"]["dims"]
                z = row["z"]
                ids, labels, sizes = (numbers(z[c]) for c in ("block_ids", "labels", "sizes"))
                low, high = ((numbers(z[c], d) if d else np.zeros((len(ids), 0), np.int64)) for c in ("low", "high"))
                least, most = bounds(p.vectors, low, high)
                alike = p.labels[:, None] == labels[None, :]
                open_ = (alike if same else ~alike) & (sizes > 0)[None, :]
                meets = np.zeros_like(open_)
                for w in range(p.lows.shape[1]):
                    meets |= (most >= p.lows[:, w][:, None]) & (least <= p.highs[:, w][:, None]) & (p.lows[:, w] <= p.highs[:, w])[:, None]
                open_ &= meets
                if first:
                    top = np.where(open_, most, LOWEST).argmax(axis=1)
                    mine = np.zeros_like(open_)
                    mine[np.arange(len(top)), top] = True
                    open_ &= mine
                blocks = np.flatnonzero(open_.any(axis=0))
                anchors = [np.flatnonzero(open_[:, b]) for b in blocks]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["p"]["pack"]] * len(blocks), pa.int32()),
                        pa.array(ids[blocks], pa.int64()),
                        pa.array([a.astype(np.int64).tobytes() for a in anchors], pa.binary()),
                        pa.array([most[a, b].astype(np.int64).tobytes() for a, b in zip(anchors, blocks, strict=True)], pa.binary()),
                    ],
                    names=["pack", "block_id", "anchors", "bounds"],
                )

    every = bundles.withColumn("pack", F.explode(F.sequence(F.lit(0), F.lit(n_packs - 1))))
    z, p = F.struct(*[c for c in bundles.columns]).alias("z"), F.struct(*packs.columns).alias("p")
    return every.select("pack", z).join(packs.select("pack", p), "pack").select("z", "p").mapInArrow(run, CHOSEN)


def read_blocks(chosen: DataFrame, packs: DataFrame, blocks: DataFrame, k: int) -> DataFrame:
    """The k best rows per anchor, window and chosen block."""

    def run(batches):
        last: tuple[int, Pack] | None = None
        for batch in batches:
            for row in batch.to_pylist():
                if last is None or last[0] != row["p"]["pack"]:
                    last = row["p"]["pack"], Pack(row["p"])
                found = list(best_of(last[1], numbers(row["anchors"]), row["b"], k))
                if not found:
                    continue
                n = [len(f[3]) for f in found]
                own = [np.repeat([f[j] for f in found], n) for j in range(3)]
                cols = [*own, *(np.concatenate([f[j] for f in found]) for j in (3, 4, 5))]
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c.astype(t.to_pandas_dtype()), t) for c, t in zip(cols, kinds, strict=True)], names=[c.split()[0] for c in FOUND.split(", ")])

    b = blocks.select("block_id", F.struct("dims", "ids", "rows", "vectors").alias("b"))
    p = packs.select("pack", F.struct(*packs.columns).alias("p"))
    met = chosen.select("pack", "block_id", "anchors").join(b, "block_id").join(p, "pack")
    return met.select("anchors", "b", "p").mapInArrow(run, FOUND)


def top(found: DataFrame, k: int) -> DataFrame:
    """The k first rows of each anchor and window, with ``rank`` from 1."""
    order = Window.partitionBy("anchor_row", "at").orderBy(F.desc("score"), "vec_id", "vec_row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest(anchors: DataFrame, n: int, blocks: DataFrame, bundles: DataFrame, dims: int, k: int, same: bool) -> DataFrame:
    """``FOUND`` with ``rank``: the k best rows of each window of each anchor,
    among rows of its label or among those of other labels."""
    packs = max(1, math.ceil(n / PACK))
    first = anchor_packs(anchors, packs, dims)
    best = choose(first, packs, bundles, same, True).select("pack", "block_id", "anchors", "bounds")

    def spread(batches):  # one row per anchor of a choice
        for batch in batches:
            for row in batch.to_pylist():
                a, u = numbers(row["anchors"]), numbers(row["bounds"])
                yield pa.RecordBatch.from_arrays([pa.array([row["pack"]] * len(a), pa.int32()), pa.array(a), pa.array(u), pa.array([row["block_id"]] * len(a), pa.int64())], names=["pack", "anchor", "bound", "block_id"])

    singly = best.mapInArrow(spread, "pack int, anchor bigint, bound bigint, block_id bigint")
    one = singly.groupBy("pack", "anchor").agg(F.max(F.struct("bound", "block_id")).alias("m")).select("pack", "anchor", "m.block_id")
    again = one.groupBy("pack", "block_id").agg(F.sort_array(F.collect_list("anchor")).alias("a"))  # at most a pack's anchors

    @F.arrow_udf("binary")
    def as_numbers(a: pa.Array) -> pa.Array:
        return pa.array([np.array(x.as_py(), np.int64).tobytes() for x in a], pa.binary())

    seeds = top(read_blocks(again.select("pack", "block_id", as_numbers("a").alias("anchors")), first, blocks, k), k)
    kth = seeds.where(F.col("rank") == k).select("anchor_row", "at", "score")
    raised = kth.groupBy("anchor_row").agg(F.map_from_entries(F.collect_list(F.struct("at", "score"))).alias("m"))
    joined = anchors.join(raised.withColumnRenamed("anchor_row", "vec_row"), "vec_row", "left")
    lows = F.transform("lows", lambda x, i: F.greatest(x, F.coalesce(F.try_element_at("m", i.cast("int")), x)))
    second = anchor_packs(joined.withColumn("lows", lows), packs, dims)
    return top(read_blocks(choose(second, packs, bundles, same, False), second, blocks, k), k)


# ---- the operator ----------------------------------------------------------


def mine(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label: Column | None = None,
    anchors: Column | None = None,
    positives: int = 5,
    negatives: int = 5,
    share: tuple[int, int] = (80, 100),
    scale: int = SCALE,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score``: for each anchor (a condition on ``vec_id``) and each of
    its first ``positives`` rows of equal label, the first ``negatives`` rows of
    other labels with ``share[0] * positive <= share[1] * negative <= share[1]
    * positive`` in scores."""
    if positives < 1 or negatives < 1 or share[1] < 1:
        raise ValueError("at least one positive and negative, and a share of a positive number")
    label = F.col("label") if label is None else label
    rows = materialise(whole_vectors(vectors, id_col, vector_col, label, scale), "vectors")
    facts = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("dims")).first()
    n, dims = facts["n"], facts["dims"] or 0
    blocks = candidate_blocks(rows, n, dims)
    bundles = materialise(zone_bundles(blocks), "zones")
    own = anchor_rows(blocks, F.col("vec_id") % 100 == 0 if anchors is None else anchors)
    own = materialise(own, "anchors")
    n_anchors = own.count()

    everything = own.withColumn("lows", F.array(F.lit(LOWEST).cast("bigint"))).withColumn("highs", F.array(F.lit(HIGHEST).cast("bigint")))
    near = nearest(everything, n_anchors, blocks, bundles, dims, positives, True)
    near = materialise(near.select("anchor_row", "anchor_id", F.col("rank").alias("at"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")

    part, whole = share
    scaled = f"(CAST({part} AS DECIMAL(10,0)) * positive_score)"  # rounded up to the next score
    least = F.expr(f"CASE WHEN {scaled} > 0 THEN ({scaled} + {whole - 1}) div {whole} ELSE {scaled} div {whole} END")
    window = F.struct("at", least.alias("low"), F.col("positive_score").alias("high"))
    of = near.groupBy("anchor_row").agg(F.sort_array(F.collect_list(window)).alias("w"))  # at most ``positives``
    windows = own.join(of.withColumnRenamed("anchor_row", "vec_row"), "vec_row")
    windows = windows.select("vec_row", "vec_id", "label", "v", F.col("w.low").alias("lows"), F.col("w.high").alias("highs"))
    hard = nearest(windows, n_anchors, blocks, bundles, dims, negatives, False)
    hard = hard.select("anchor_row", (F.col("at") + 1).alias("at"), "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return near.join(hard, ["anchor_row", "at"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def anchor_rows(blocks: DataFrame, which: Column) -> DataFrame:
    """``vec_row, vec_id, label, v`` of the rows that ``which`` picks, by the
    rows' numbers in the blocks."""

    def rows(batches):
        for batch in batches:
            for b in batch.to_pylist():
                ids, at, dims = numbers(b["ids"]), numbers(b["rows"]), b["dims"]
                flat = pa.array(numbers(b["vectors"]))
                v = pa.ListArray.from_arrays(pa.array(np.arange(len(ids) + 1, dtype=np.int32) * dims), flat)
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(ids), pa.array([b["label"]] * len(ids), pa.int64()), v], names=["vec_row", "vec_id", "label", "v"])

    src = blocks.select("label", "dims", "ids", "rows", "vectors")
    return src.mapInArrow(rows, "vec_row bigint, vec_id bigint, label bigint, v array<bigint>").where(which)
