"""Interpolated modified Kneser-Ney n-gram model, counted in Spark, stored as
sorted arrays and memory-mapped by the workers that score texts.

Counting.  Words are counted first and get ids, their places in the order of
their hashes.  Then a task counts n-grams of ids per few million tokens and
emits them packed by shard, a range of context hashes; shards grow in number
with the text (``SHARD_BYTES``), each merged by a task of its own.  The task that
merges a shard of order k writes its arrays to the shared model folder and emits,
for every distinct k-gram, one count for its suffix of order k - 1: continuation
counts, which are written and shuffled on in the same way down to order 1; the
shuffle files of an order are released before the next one is merged.  A context's
followers meet in one task as distinct words with counts (at most the
vocabulary), never as occurrences; packed rows are compressed steps between
sorted ids.  Files are written under a temporary name and renamed, with the same
bytes by any attempt.

Model, per order: the sorted contexts, where each one's followers start, the
followers' ids in order, and their counts as bytes (the few large ones apart).
Totals and numbers of followers seen once, twice and more often are kept for
contexts of more than ``FEW`` followers and summed up for the others.
Discounts follow from the numbers of n-grams seen 1..4 times,
summed in Spark.  With a(.) the count (top order) or continuation count,

    p(w | h) = max(a(hw) - D(a(hw)), 0) / a(h.) + gamma(h) p(w | h')

down to the uniform 1 / (V + 1) below order 1; a context never seen passes on.

Scoring is row-local.  The arrays are opened as memory maps: from the folder
itself where it is mounted (``file:``), else from the copy that ``addFile``
puts at each executor.  Words are known by 64-bit hashes; for 10^8 distinct
words two of them share one with probability 3 in 10^4.

Defined results: a null or empty text is the end token alone (no known word but
the end); repeated rows count and are scored each; a null id counts as empty text for
the held-out rule; with an empty training set every probability is uniform
(base: c = N = V = 0); extra columns are not read.
"""

from __future__ import annotations

import math
import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import LOWER_BLANK, crc32_of_id, materialise, shuffles_released, text_or_empty

ORDER = 3
SHARD_BYTES = 24 << 20  # training text per shard
BLOCK_TOKENS = 2_000_000  # tokens a task counts at a time
SCORE_TOKENS = 500_000  # tokens a task scores at a time
FEW = 8  # followers whose counts are summed up when scoring

# neither can be a word
START, END = xxhash.xxh64_intdigest(b" "), xxhash.xxh64_intdigest(b"\n")

PACKED = "shard int, kind string, vocab binary, planes binary, stats array<bigint>"
PACKED_SCHEMA = pa.schema(
    [("shard", pa.int32()), ("kind", pa.string())]
    + [(c, pa.binary()) for c in ("vocab", "planes")]
    + [("stats", pa.list_(pa.int64()))]
)


# ---- hashing ---------------------------------------------------------------


def token_hashes(text: bytes) -> np.ndarray:
    """Word hashes of a text and the end token's."""
    digest = xxhash.xxh64_intdigest
    return np.array([*map(digest, text.translate(LOWER_BLANK).split()), END], dtype=np.uint64)


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of pairs of hashes."""
    with np.errstate(over="ignore"):
        x = (a ^ (b * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(29)) ^ b) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(32))


def context_key(cols: list[np.ndarray]) -> np.ndarray:
    """Key of each context of word ids, oldest first: the ids themselves for
    one or two, a hash of more."""
    key = cols[-1].astype(np.uint64)
    if len(cols) == 2:
        return cols[0].astype(np.uint64) << np.uint64(32) | key
    for c in cols[-2::-1]:
        key = mix(c.astype(np.uint64), key)
    return key


def key_shard(key: np.ndarray, shards: int) -> np.ndarray:
    return shard_of(mix(key, np.full(1, END, np.uint64)), shards)


def shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int32)


def histories(docs: list[np.ndarray], order: int, start: int = START) -> tuple[np.ndarray, np.ndarray]:
    """All tokens of some documents and, per token, the ``order - 1`` tokens
    before it (start tokens before a document's first)."""
    pad = np.full(order - 1, start, docs[0].dtype)
    line = np.concatenate([x for d in docs for x in (pad, d)])
    lengths = np.array([len(d) for d in docs])
    # a token's place in the line: starts pushed in for its and earlier documents
    at = np.arange(lengths.sum()) + np.repeat(np.arange(1, len(docs) + 1), lengths) * (order - 1)
    before = [line[at - j] for j in range(order - 1, 0, -1)]
    return line[at], np.column_stack(before) if before else np.zeros((len(at), 0), line.dtype)


# ---- counting --------------------------------------------------------------


def distinct_grams(cols: list[np.ndarray], size: int, counts: np.ndarray | None = None):
    """Distinct rows of the id columns (ids below ``size``), sorted, with counts."""
    bits = max(1, int(size).bit_length())
    key, used, ranked = cols[0].astype(np.uint64), bits, {}
    for j, c in enumerate(cols[1:], 1):
        if used + bits > 64:  # a row no longer is one number: rank what there is
            ranked[j], key = np.unique(key, return_inverse=True)
            key, used = key.astype(np.uint64), max(1, len(ranked[j]).bit_length())
        key, used = key << np.uint64(bits) | c.astype(np.uint64), used + bits
    if counts is None:
        key.sort()
    else:
        order = np.argsort(key)
        key, counts = key[order], counts[order]
    start = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    n = np.diff(np.append(start, len(key))) if counts is None else np.add.reduceat(counts.astype(np.int64), start)
    key, mask, out = key[start], np.uint64((1 << bits) - 1), []
    for j in range(len(cols) - 1, 0, -1):
        out.append((key & mask).astype(np.uint32))
        key = key >> np.uint64(bits)
        if j in ranked:
            key = ranked[j][key]
    return [key.astype(np.uint32), *out[::-1]], n.astype(np.int64)


def starts(cols: list[np.ndarray]) -> np.ndarray:
    """Where a row of sorted columns differs from the one before."""
    new = np.zeros(len(cols[0]), bool)
    new[:1] = True
    for c in cols:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def steps(x: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Differences inside groups of sorted numbers, their first ones kept."""
    d = np.diff(x.astype(np.int64), prepend=0)
    d[start] = x[start]
    return d


def unsteps(d: np.ndarray, start: np.ndarray) -> np.ndarray:
    x = np.cumsum(d.astype(np.int64))
    return x - np.repeat(x[start] - d[start], np.diff(np.append(start, len(x))))


def planes(*arrays: np.ndarray) -> bytes:
    """Numbers below 2^32, byte by byte of their significance, compressed."""
    raw = b"".join(np.ascontiguousarray(x.astype(np.uint32)).view(np.uint8).reshape(-1, 4).T.tobytes() for x in arrays)
    return pa.compress(raw, codec="zstd", asbytes=True)


def from_planes(packed: bytes, lengths: list[int]) -> list[np.ndarray]:
    raw, at, out = pa.decompress(packed, 4 * sum(lengths), codec="zstd", asbytes=True), 0, []
    for n in lengths:
        out.append(np.frombuffer(raw, np.uint8, 4 * n, at).reshape(4, n).T.copy().view(np.uint32).ravel())
        at += 4 * n
    return out


def packed(cols: list[np.ndarray], counts: np.ndarray, shards: int):
    """Rows of PACKED, one per shard, from sorted distinct rows of word ids:
    contexts once, followers after them, all as steps."""
    first = starts(cols[:-1]) if len(cols) > 1 else np.arange(len(counts))
    to = key_shard(context_key([c[first] for c in cols[:-1] or cols]), shards)
    to = np.repeat(to.astype(np.int16 if shards < 1 << 15 else np.int32), np.diff(np.append(first, len(counts))))
    order = np.argsort(to, kind="stable")
    cuts = np.searchsorted(to[order], np.arange(shards + 1))
    for s in range(shards):
        at = order[cuts[s] : cuts[s + 1]]
        if len(at):
            own = [c[at] for c in cols]
            first = starts(own[:-1]) if len(own) > 1 else np.zeros(1, np.int64)
            ctx = [c[first] for c in own[:-1]]
            ids = [steps(c, starts(ctx[:j]) if j else np.zeros(1, np.int64)) for j, c in enumerate(ctx)]
            data = planes(*ids, np.diff(np.append(first, len(at))), steps(own[-1], first), counts[at])
            yield (s, "gram", None, data, [len(first), len(at)])


def as_table(rows: list[tuple]) -> pa.Table:
    cols = list(zip(*rows, strict=True)) if rows else [[]] * len(PACKED_SCHEMA)
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(cols, PACKED_SCHEMA, strict=True)], schema=PACKED_SCHEMA)


def blocks(batches):
    """Texts as word hashes, some ``BLOCK_TOKENS`` at a time."""
    docs, size = [], 0
    for batch in batches:
        for text in batch.column(0):
            docs.append(token_hashes(text.as_py()))
            size += len(docs[-1])
            if size >= BLOCK_TOKENS:
                yield docs
                docs, size = [], 0
    if docs:
        yield docs


def word_counter(shards: int):
    """Map side: texts -> packed counts of words."""

    def run(batches):
        for docs in blocks(batches):
            u, n = np.unique(np.concatenate(docs), return_counts=True)
            cuts = np.searchsorted(shard_of(u, shards), np.arange(shards + 1))
            rows = [(s, "word", u[i:j].tobytes(), planes(n[i:j]), None) for s, (i, j) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if i < j]
            yield from as_table(rows).to_batches()

    return run


def word_merger(folder: str):
    """Reduce side: the words of a shard, sorted, with their counts."""

    def run(key, table):
        rows = table.to_pylist()
        hashes = [np.frombuffer(r["vocab"], np.uint64) for r in rows]
        counts = [from_planes(r["planes"], [len(h)])[0] for r, h in zip(rows, hashes, strict=True)]
        u, inv = np.unique(np.concatenate(hashes), return_inverse=True)
        n = np.bincount(inv, weights=np.concatenate(counts)).astype(np.uint64)
        put(folder, f"word-{key[0].as_py()}.key", u)
        put(folder, f"word-{key[0].as_py()}.total", n)
        return as_table([(key[0].as_py(), "stat0", None, None, [int(n.sum()), len(u)])])

    return run


def counter(words: Words, order: int):
    """Map side: texts -> packed counts of n-grams."""

    def run(batches):
        for docs in blocks(batches):
            u, ids = np.unique(np.concatenate(docs), return_inverse=True)
            # numbers of this block's words first: smaller, in the order of the ids
            line, ctx = histories(np.split(ids, np.cumsum([len(d) for d in docs])[:-1]), order, len(u))
            cols, n = distinct_grams([*ctx.T, line], len(u) + 1)
            known = np.append(words.look_up(u)[0], words.start).astype(np.uint32)
            yield from as_table(list(packed([known[c] for c in cols], n, words.shards))).to_batches()

    return run


def unpacked(rows: list[dict], width: int):
    """Id columns and counts of packed rows."""
    cols: list[list[np.ndarray]] = [[] for _ in range(width + 2)]
    for r in rows:
        n_ctx, n = r["stats"]
        *ids, sizes, followers, counts = from_planes(r["planes"], [n_ctx] * width + [n_ctx, n, n])
        ctx: list[np.ndarray] = []
        for d in ids:
            ctx.append(unsteps(d, starts(ctx) if ctx else np.zeros(1, np.int64)).astype(np.uint32))
        for j, c in enumerate(ctx):
            cols[j].append(np.repeat(c, sizes))
        cols[-2].append(unsteps(followers, np.cumsum(sizes, dtype=np.int64) - sizes).astype(np.uint32))
        cols[-1].append(counts)
    *ids, counts = [np.concatenate(c) for c in cols]
    return ids, counts


LISTED = "_files"  # names of a complete folder's arrays


def put(folder: str, name: str, array: np.ndarray) -> None:
    """Write an array under its final name only when complete."""
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(folder)
    tmp = f"{path}/.{name}-{uuid.uuid4().hex}"
    with store.open_output_stream(tmp) as out:
        out.write(np.ascontiguousarray(array).tobytes())
    store.move(tmp, f"{path}/{name}")


def put_counts(folder: str, name: str, counts: np.ndarray) -> None:
    """Write counts as bytes; those of 255 or more are 255 there and are
    written in full, by position, to two more files."""
    big = np.flatnonzero(counts >= 255)
    put(folder, f"{name}.n", np.minimum(counts, 255).astype(np.uint8))
    if len(big):
        put(folder, f"{name}.at", big.astype(np.uint64))
        put(folder, f"{name}.big", counts[big].astype(np.uint64))


def merger(k: int, words: Words, folder: str):
    """Reduce side of order k: merge a shard, write its arrays, emit the
    continuation counts of order k - 1."""

    def run(key, table):
        shard = key[0].as_py()
        rows = table.to_pylist()
        out = [(r["shard"], r["kind"], None, None, r["stats"]) for r in rows if r["kind"].startswith("stat")]
        grams = [r for r in rows if r["kind"] == "gram"]
        del rows, table
        if grams:
            cols, n = distinct_grams(*of_rows(grams, k - 1, words.start))
            if k > 1:
                start = starts(cols[:-1])
                own, sizes = context_key([c[start] for c in cols[:-1]]), np.diff(np.append(start, len(n)))
                if k > 3:  # keys are hashes then
                    order = np.argsort(np.repeat(own, sizes), kind="stable")
                    cols, n, order = [c[order] for c in cols], n[order], np.argsort(own, kind="stable")
                    own, sizes = own[order], sizes[order]
                    start = np.cumsum(sizes) - sizes
                put(folder, f"ctx{k}-{shard}.key", own if k > 2 else own.astype(np.uint32))
                put(folder, f"ctx{k}-{shard}.start", np.append(start, len(n)).astype(np.uint32))
                some = [np.add.reduceat((n == c).astype(np.int64) if c < 3 else (n >= 3).astype(np.int64), start) for c in (1, 2, 3)]
                many = np.flatnonzero(sizes > FEW)
                put(folder, f"ctx{k}-{shard}.many", many.astype(np.uint64))
                put(folder, f"ctx{k}-{shard}.stats", np.column_stack([np.add.reduceat(n, start), *some])[many].astype(np.uint64))
            put(folder, f"gram{k}-{shard}.key", cols[-1])
            put_counts(folder, f"gram{k}-{shard}", n)
            seen = [int((n == c).sum()) for c in (1, 2, 3, 4)]
            out.append((shard, f"stat{k}", None, None, [int(n.sum()), *seen, int((n >= 3).sum())]))
            if k > 1:
                out.extend(packed(*distinct_grams(cols[1:], words.start + 1), words.shards))
        return as_table(out)

    return run


def of_rows(grams: list[dict], width: int, start: int):
    """Arguments of ``distinct_grams`` for packed rows."""
    ids, counts = unpacked(grams, width)
    return ids, start + 1, counts


def discounts(seen: list[int]) -> list[float]:
    """D(0..3+) from the numbers of n-grams seen 1, 2, 3 and 4 times; where a
    number is 0 the discount falls back to an in-range one."""
    n1, n2, n3, n4 = seen
    if not n1 or not n2:
        return [0.0, 0.5, 0.75, 1.0]
    y = n1 / (n1 + 2 * n2)
    d = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return [0.0, *[min(max(x, 0.05), c) for x, c in zip(d, (1.0, 2.0, 3.0), strict=True)]]


class Arrays:
    """Memory maps of a folder's files."""

    def __init__(self, folder: str):
        self.folder = folder

    def path(self) -> str:
        if self.folder.startswith(("file:", "/")):
            return self.folder.removeprefix("file://").removeprefix("file:")
        return SparkFiles.get(self.folder.rsplit("/", 1)[1])

    def array(self, name: str, dtype, width: int = 1) -> np.ndarray:
        """The named array; empty if the folder's list of files lacks it.  A
        missing list (a folder that is not mounted here) or file is an error."""
        at = f"{self.folder}/{name}"
        if at not in _maps:
            if self.folder not in _listed:
                with open(f"{self.path()}/{LISTED}", encoding="utf-8") as f:
                    _listed[self.folder] = set(f.read().split())
            m = np.memmap(f"{self.path()}/{name}", dtype=dtype, mode="r") if name in _listed[self.folder] else np.zeros(0, dtype)
            _maps[at] = m.reshape(-1, width) if width > 1 else m
        return _maps[at]

    def place(self, name: str, dtype, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(found, position)`` of numbers in a sorted file."""
        keys = self.array(name, dtype)
        if not len(keys):
            return np.zeros(len(wanted), bool), np.zeros(len(wanted), np.int64)
        wanted = wanted.astype(dtype)
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return keys[at] == wanted, at

    def counts(self, name: str, at: np.ndarray) -> np.ndarray:
        n = self.array(f"{name}.n", np.uint8)[at].astype(np.int64)
        full = np.flatnonzero(n == 255)
        if len(full):
            n[full] = self.array(f"{name}.big", np.uint64)[self.place(f"{name}.at", np.uint64, at[full])[1]]
        return n


class Words(Arrays):
    """Ids of words: places among all words sorted by hash.  The number of
    words is the id of the start, one more that of unknown words."""

    def __init__(self, folder: str, sizes: list[int]):
        super().__init__(folder)
        self.shards, self.start = len(sizes), sum(sizes)
        self.offsets = np.cumsum([0, *sizes[:-1]])
        if self.start >= (1 << 32) - 2:
            raise ValueError("more than 2^32 distinct words are not supported")

    def look_up(self, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and counts of sorted hashes."""
        ids, counts = np.full(len(u), self.start + 1, np.int64), np.zeros(len(u), np.int64)
        cuts = np.searchsorted(shard_of(u, self.shards), np.arange(self.shards + 1))
        for s in np.flatnonzero(np.diff(cuts)):
            hit, at = self.place(f"word-{s}.key", np.uint64, u[cuts[s] : cuts[s + 1]])
            rows = np.arange(cuts[s], cuts[s + 1])[hit]
            ids[rows] = self.offsets[s] + at[hit]
            counts[rows] = self.array(f"word-{s}.total", np.uint64)[at[hit]]
        return ids, counts


class Model(Arrays):
    """Where the arrays are and the few numbers that go with them."""

    def __init__(self, folder: str, order: int, words: Words, stats: dict[str, list[int]]):
        super().__init__(folder)
        self.words, self.order, self.shards = words, order, words.shards
        self.tokens, self.vocabulary = (stats.get("stat0") or [0, 0])[:2]
        none = [0, 0, 0, 0, 0, 0]
        self.totals = {k: (stats.get(f"stat{k}") or none) for k in range(1, order + 1)}
        self.discount = {k: discounts(self.totals[k][1:5]) for k in self.totals}
        # order 1 has one context, the empty one
        total, n1, n2, _, _, more = self.totals[1]
        d = self.discount[1]
        self.gamma1 = (d[1] * n1 + d[2] * n2 + d[3] * more) / total if total else 1.0

    # -- on workers --

    def by_shard(self, shard: np.ndarray):
        """``(shard, rows)`` of the shards that occur."""
        order = np.argsort(shard.astype(np.int16 if self.shards < 1 << 15 else np.int32), kind="stable")
        cuts = np.searchsorted(shard[order], np.arange(self.shards + 1))
        return [(s, order[cuts[s] : cuts[s + 1]]) for s in np.flatnonzero(np.diff(cuts))]

    def contexts(self, k: int, s: int, keys: np.ndarray):
        """``(first, last, stats)`` of contexts of a shard: where their followers
        lie; total, followers seen once, twice and more (0 for a context never seen)."""
        stats = np.zeros((len(keys), 4), np.int64)
        hit, at = self.place(f"ctx{k}-{s}.key", np.uint64 if k > 2 else np.uint32, keys)
        if not hit.any():
            return at, at, stats
        start = self.array(f"ctx{k}-{s}.start", np.uint32)
        first, last = start[at].astype(np.int64), start[at + 1].astype(np.int64)
        size = np.where(hit, last - first, 0)
        for j in range(FEW):
            rows = np.flatnonzero((size > j) & (size <= FEW))
            if not len(rows):
                break
            n = self.counts(f"gram{k}-{s}", first[rows] + j)
            stats[rows, 0] += n
            stats[rows, np.minimum(n, 3)] += 1
        rows = np.flatnonzero(size > FEW)
        if len(rows):
            stats[rows] = self.array(f"ctx{k}-{s}.stats", np.uint64, 4)[self.place(f"ctx{k}-{s}.many", np.uint64, at[rows])[1]]
        return first, first + size, stats

    def followers(self, k: int, s: int, first: np.ndarray, last: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Counts of words among the followers between two places."""
        keys, ids = self.array(f"gram{k}-{s}.key", np.uint32), ids.astype(np.uint32)
        lo, end = first.copy(), last
        active, hi = np.flatnonzero(lo < end), last.copy()
        while len(active):  # lo: the first follower that is not smaller
            mid = (lo[active] + hi[active]) >> 1
            less = keys[mid] < ids[active]
            lo[active[less]] = mid[less] + 1
            hi[active[~less]] = mid[~less]
            active = active[lo[active] < hi[active]]
        out = np.zeros(len(ids), np.int64)
        rows = np.flatnonzero(lo < end)
        rows = rows[keys[lo[rows]] == ids[rows]]
        out[rows] = self.counts(f"gram{k}-{s}", lo[rows])
        return out

    def score(self, docs: list[np.ndarray]) -> list[tuple[int, int, float, float]]:
        """``(tokens, known, base, log10 probability)`` of documents."""
        ends = np.cumsum([len(x) for x in docs])
        begins = ends - [len(x) for x in docs]
        u, inv = np.unique(np.concatenate(docs), return_inverse=True)
        ids, c = self.words.look_up(u)
        base = np.log10((c + 0.1) / (self.tokens + 0.1 * (self.vocabulary + 1)))
        a = np.zeros(len(u), np.int64)
        for s, rows in self.by_shard(key_shard(ids.astype(np.uint64), self.shards)):
            hit, at = self.place(f"gram1-{s}.key", np.uint32, ids[rows])
            a[rows[hit]] = self.counts(f"gram1-{s}", at[hit])
        p = np.full(len(u), 1 / (self.vocabulary + 1))
        total = self.totals[1][0]
        if total:
            p = np.maximum(a - np.array(self.discount[1])[np.minimum(a, 3)], 0) / total + self.gamma1 * p
        p = p[inv]
        words, ctx = histories(np.split(ids[inv], ends[:-1]), self.order, self.words.start)
        for k in range(2, self.order + 1):
            uk, ik = np.unique(context_key([*ctx[:, ctx.shape[1] - k + 1 :].T]), return_inverse=True)
            d, shard = np.array(self.discount[k]), key_shard(uk, self.shards)
            first, last, st = np.zeros(len(uk), np.int64), np.zeros(len(uk), np.int64), np.zeros((len(uk), 4), np.int64)
            for s, rows in self.by_shard(shard):
                first[rows], last[rows], st[rows] = self.contexts(k, s, uk[rows])
            a = np.zeros(len(words), np.int64)
            seen = np.flatnonzero((st[:, 0] > 0)[ik])
            for s, rows in self.by_shard(shard[ik[seen]]):
                rows = seen[rows]
                a[rows] = self.followers(k, s, first[ik[rows]], last[ik[rows]], words[rows])
            tot = np.maximum(st[:, 0], 1)
            gamma = np.where(st[:, 0] > 0, (st[:, 1:] @ d[1:]) / tot, 1.0)
            p = np.maximum(a - d[np.minimum(a, 3)], 0) / tot[ik] + gamma[ik] * p
        known, base, logp = (c > 0).astype(np.int64)[inv], base[inv], np.log10(p)
        sums = [np.add.reduceat(x, begins) for x in (known, base, logp)]
        return [(int(e - s), int(q), float(b), float(v)) for s, e, q, b, v in zip(begins, ends, *sums, strict=True)]


_maps: dict[str, np.ndarray] = {}
_listed: dict[str, set[str]] = {}


def merged(rows: DataFrame, shards: int, merge) -> DataFrame:
    """PACKED rows merged shard by shard, a task for each."""
    return rows.repartitionById(shards, "shard").groupBy("shard").applyInArrow(merge, PACKED)


def train(docs: DataFrame, text_col: str = "text", order: int = ORDER, shard_bytes: int = SHARD_BYTES) -> Model:
    """Count all rows of ``docs`` and write the model to the shared folder."""
    if order < 1:
        raise ValueError("order must be at least 1")
    spark = docs.sparkSession
    from pyarrow import fs

    def new_folder(name):
        folder = scratch_path(spark, name)
        store, path = fs.FileSystem.from_uri(folder)
        store.create_dir(path, recursive=True)
        return folder

    def share(folder):
        """Write the list of the folder's arrays; a shard without entries has none."""
        store, path = fs.FileSystem.from_uri(folder)
        files = [f.base_name for f in store.get_file_info(fs.FileSelector(path)) if f.size and not f.base_name.startswith(".")]
        put(folder, LISTED, np.frombuffer("\n".join(sorted(files)).encode(), np.uint8))
        if not folder.startswith(("file:", "/")):
            spark.sparkContext.addFile(folder, recursive=True)

    texts = docs.select(text_or_empty(F.col(f"`{text_col}`")).cast("binary").alias("text"))
    size = texts.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    shards = max(1, math.ceil(size / shard_bytes))
    folder = new_folder("kn_words")
    with shuffles_released(spark):
        made = materialise(merged(texts.mapInArrow(word_counter(shards), PACKED), shards, word_merger(folder)), "kn_words_made")
    of_shard = {r["shard"]: r["stats"] for r in made.select("shard", "stats").collect()}
    share(folder)
    words = Words(folder, [of_shard.get(s, [0, 0])[1] for s in range(shards)])
    folder = new_folder("kn_grams")
    made = texts.mapInArrow(counter(words, order), PACKED)
    for k in range(order, 0, -1):
        with shuffles_released(spark):
            made = materialise(merged(made, shards, merger(k, words, folder)), f"kn_grams{k}")
    at = range(6)
    sums = made.where(F.col("kind").startswith("stat")).groupBy("kind")
    stats = {r["kind"]: [r[f"s{i}"] or 0 for i in at] for r in sums.agg(*[F.sum(F.get("stats", F.lit(i))).alias(f"s{i}") for i in at]).collect()}
    stats["stat0"] = [sum(x[0] for x in of_shard.values()), words.start]
    share(folder)
    return Model(folder, order, words, stats)


def perplexity_columns(text: Column, shared) -> Column:
    """Struct ``n_tokens, n_known, base_score, score`` for a broadcast model."""
    @F.pandas_udf("n_tokens bigint, n_known bigint, base_score double, score double")
    def of(texts: pd.Series) -> pd.DataFrame:
        model, out, docs, size = shared.value, [], [], 0
        for t in texts:
            docs.append(token_hashes(t))
            size += len(docs[-1])
            if size >= SCORE_TOKENS:
                out += model.score(docs)
                docs, size = [], 0
        if docs:
            out += model.score(docs)
        return pd.DataFrame(out, columns=["n_tokens", "n_known", "base_score", "score"])

    return of(text_or_empty(text).cast("binary"))


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row per document row: ``doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score``; rows whose id's crc32 is a multiple of
    ten are held out of training."""
    held_out = crc32_of_id(F.col(f"`{id_col}`")) % 10 == 0
    model = train(docs.where(~held_out), text_col, order, shard_bytes)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), held_out.alias("held_out"), perplexity_columns(F.col(f"`{text_col}`"), shared).alias("s"))
    return rows.select("doc_id", "held_out", "s.n_tokens", "s.n_known", F.lit(model.tokens).cast("bigint").alias("train_tokens"), "s.base_score", "s.score")
