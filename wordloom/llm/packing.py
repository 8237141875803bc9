"""Packing documents into training sequences by vector bin packing.

A sequence is a bin with three capacities: tokens, segments (pieces) and
loss-bearing tokens.  Bins are filled by the dot-product heuristic: of the
waiting items that fit, the one whose size vector has the largest dot product
with the bin's free vector (both in shares of the capacities) goes in next.
When nothing whole fits, one item is cut so that its head fills the free space
and its rest waits on; a document longer than a sequence gives whole sequences
first.  A bin that closes at a length that is neither full nor a power of two
gives back what exceeds the largest power of two, so padding is only ever left
where the segment or loss capacity forces it.

Each Spark partition packs its own documents in one pass with a bounded pool
of waiting items: no shuffle, no text on the driver, memory bounded by the
pool.  Sequence numbers carry the partition in their upper bits, so they are
unique and a task that runs again gives the same ones.  Input should be a
table (its partitions and row order are then the same on a second run).

Defined results: a null or empty text is the end token alone; repeated rows
are packed each; an empty table gives no piece; null ids are kept.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.byte_symbols import symbol_to_byte
from .common import text_or_empty

SEQ_TOKENS = 2048
MAX_SEGMENTS = 128
POOL = 512  # waiting items a task chooses from
END_ID = 1
SLICE = 64  # documents encoded together

# fixed value: the pre-token rule of a tokenizer file's "ByteLevel" with "use_regex"
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class TextEncoder:
    """Token ids of whole texts as little-endian unsigned 32-bit numbers.

    A plain byte-level BPE whose ids follow its merge order is read from the
    tokenizer's file into tiktoken, which merges the same pairs several times
    faster; any other tokenizer, and every text that holds one of its special
    tokens, goes through the tokenizers library."""

    def __init__(self, tokenizer_json: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        said = json.loads(tokenizer_json)
        self.special = [t["content"] for t in said.get("added_tokens") or []]
        self.fast = byte_level_ranks(said)
        if self.fast is not None:
            import tiktoken

            self.fast = tiktoken.Encoding("file", pat_str=BYTE_LEVEL, mergeable_ranks=self.fast, special_tokens={})

    def ids(self, text: str) -> bytes:
        if self.fast is None or any(s in text for s in self.special):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        return list(map(self.ids, texts))


def byte_level_ranks(said: dict) -> dict[bytes, int] | None:
    """``token bytes -> id`` of a tokenizer file that is byte-level BPE and
    nothing else, with ids in merge order (None for any other file)."""
    model, pre = said["model"], said.get("pre_tokenizer") or {}
    plain = (
        model.get("type") == "BPE"
        and pre.get("type") == "ByteLevel"
        and pre.get("use_regex", True)
        and not pre.get("add_prefix_space")
        and not any(said.get(k) for k in ("normalizer", "truncation", "padding"))
        and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
    )
    if not plain:
        return None
    vocab, special = model["vocab"], {t["content"] for t in said.get("added_tokens") or []}
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    learned = [vocab[left + right] for left, right in merges]
    if learned != sorted(learned) or len({*learned}) != len(learned):
        return None
    byte_of = symbol_to_byte()
    ranks = {bytes(map(byte_of.__getitem__, t)): k for t, k in vocab.items() if t not in special}
    singles = [ranks.get(bytes([b])) for b in range(256)]
    if None in singles or len(ranks) != 256 + len(learned) or (learned and max(singles) > learned[0]):
        return None
    return ranks


@dataclass(slots=True)
class Item:
    """An uncut rest of one document: ids[start:], loss from ``loss_from`` on."""

    doc: object
    ids: bytes
    start: int
    total: int
    loss_from: int

    def tokens(self) -> int:
        return self.total - self.start

    def loss(self, length: int) -> int:
        return max(0, self.start + length - max(self.start, self.loss_from))

    def head(self, tokens: int, loss: int) -> int:
        """The longest head within both limits."""
        free_of_loss = max(0, self.loss_from - self.start)
        return min(self.tokens(), tokens, free_of_loss + loss)


class Packer:
    """Packs items into bins; ``pieces`` yields finished bins as lists of
    ``(item, start, length)``."""

    def __init__(self, tokens: int, segments: int, loss: int, pool: int):
        self.caps = np.array([tokens, segments, loss], dtype=np.float64)
        self.tokens, self.segments, self.loss, self.pool = tokens, segments, loss, pool
        self.items: list[Item] = []
        self.sizes = np.zeros((2 * pool, 3))

    def add(self, item: Item) -> Iterator[list]:
        """Take an item; yields the bins that can be closed before it waits."""
        while item.tokens() >= self.tokens:
            length = item.head(self.tokens, self.loss)
            if length < self.tokens:
                break  # its loss share is too dense for a sequence of its own
            yield [(item, item.start, length)]
            item.start += length
        if item.tokens():
            self._wait(item)
        while len(self.items) > self.pool:
            yield self._fill()

    def finish(self) -> Iterator[list]:
        while self.items:
            yield self._fill()

    def _wait(self, item: Item) -> None:
        if len(self.items) == len(self.sizes):
            self.sizes = np.vstack([self.sizes, np.zeros_like(self.sizes)])
        self.sizes[len(self.items)] = (item.tokens(), 1, item.loss(item.tokens()))
        self.items.append(item)

    def _take(self, k: int) -> Item:
        item, last = self.items[k], len(self.items) - 1
        self.items[k], self.sizes[k] = self.items[last], self.sizes[last]
        self.items.pop()
        return item

    def _fill(self) -> list:
        free, placed = self.caps.copy(), []
        while self.items and free[0] >= 1 and free[1] >= 1:
            sizes = self.sizes[: len(self.items)]
            score = (sizes / self.caps**2) @ free
            fits = (sizes <= free).all(axis=1)
            if fits.any():
                item = self._take(int(np.where(fits, score, -1.0).argmax()))
                length = item.tokens()
            else:
                k = int(score.argmax())
                length = self.items[k].head(int(free[0]), int(free[2]))
                if not length:
                    others = [self.items[j].head(int(free[0]), int(free[2])) for j in range(len(self.items))]
                    k = int(np.argmax(others))
                    if not (length := others[k]):
                        break
                item = self._take(k)
            placed.append((item, item.start, length))
            free -= (length, 1, item.loss(length))
            item.start += length
            if item.tokens():
                self._wait(item)
        return self._trimmed(placed)

    def _trimmed(self, placed: list) -> list:
        """Give back what exceeds a power of two, from the last piece on."""
        total = sum(p[2] for p in placed)
        over = 0 if total == self.tokens else total - (1 << (total.bit_length() - 1))
        while over:
            item, start, length = placed.pop()
            back = min(length, over)
            rest = Item(item.doc, item.ids, start + length - back, start + length, item.loss_from)
            same = next((x for x in self.items if x.doc is item.doc and x.start == start + length), None)
            if same is not None:
                k = self.items.index(same)
                rest.total = same.total
                self._take(k)
            if length > back:
                placed.append((item, start, length - back))
            self._wait(rest)
            over -= back
        return placed


def pack(docs: Iterable[tuple[object, bytes, int]], tokens: int, segments: int, loss: int, pool: int) -> Iterator[tuple]:
    """``(doc, start, length, ids, doc_tokens, sequence, offset)`` per piece for
    documents ``(key, little-endian ids, first loss-bearing position)``."""
    packer = Packer(tokens, segments, loss, pool)
    number = 0

    def out(bins):
        nonlocal number
        for placed in bins:
            offset = 0
            for item, start, length in placed:
                yield item.doc, start, length, item.ids[4 * start : 4 * (start + length)], len(item.ids) // 4, number, offset
                offset += length
            number += 1

    for key, ids, loss_from in docs:
        yield from out(packer.add(Item([key], ids, 0, len(ids) // 4, loss_from)))
    yield from out(packer.finish())


PIECES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids", pa.binary()),
        ("ids_crc32", pa.int64()),
        ("doc_tokens", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
    ]
)

_encoders: dict[int, TextEncoder] = {}


def encoder_of(json_text) -> TextEncoder:
    """One encoder per worker process and tokenizer."""
    key = zlib.crc32(json_text.value.encode())
    if key not in _encoders:
        _encoders[key] = TextEncoder(json_text.value)
    return _encoders[key]


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    seq_tokens: int = SEQ_TOKENS,
    max_segments: int = MAX_SEGMENTS,
    max_loss: int | None = None,
    prompt_chars_col: str | None = None,
    end_id: int = END_ID,
    with_ids: bool = True,
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids, ids_crc32, doc_tokens,
    sequence_id, offset``.

    ``prompt_chars_col`` (instruction data) names a column with the number of
    leading characters that bear no loss; without it every token does.  Ids are
    little-endian unsigned 32-bit numbers."""
    with open(tokenizer_path, encoding="utf-8") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())
    prompt = F.coalesce(F.col(f"`{prompt_chars_col}`").cast("bigint"), F.lit(0)) if prompt_chars_col else F.lit(0).cast("bigint")
    src = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), text_or_empty(F.col(f"`{text_col}`")).alias("text"), prompt.alias("prompt"))
    end = np.array([end_id], dtype="<u4").tobytes()
    loss_cap = max_loss if max_loss is not None else seq_tokens
    if min(seq_tokens, max_segments, loss_cap) < 1:
        raise ValueError("every capacity of a sequence must be at least 1")
    kept = PIECES if with_ids else pa.schema([f for f in PIECES if f.name != "ids"])

    def documents(batches, encoder):
        for batch in batches:
            rows = list(zip(*[c.to_pylist() for c in batch.columns], strict=True))
            for lo in range(0, len(rows), SLICE):
                some = rows[lo : lo + SLICE]
                heads = encoder.encode([text[:head] for _, text, head in some]) if any(h for _, _, h in some) else [b""] * len(some)
                for (doc, _, _), ids, lossless in zip(some, encoder.encode([t for _, t, _ in some]), heads, strict=True):
                    yield doc, ids + end, len(lossless) // 4

    def run(batches):
        from pyspark import TaskContext

        base = TaskContext.get().partitionId() << 33
        rows: list[tuple] = []
        for doc, start, length, ids, total, number, offset in pack(documents(batches, encoder_of(shared)), seq_tokens, max_segments, loss_cap, POOL):
            row = (doc[0], start, length, ids, zlib.crc32(ids), total, base + number, offset)
            rows.append(row)
            if len(rows) >= 4096:
                yield as_batch(rows, kept)
                rows = []
        yield as_batch(rows, kept)

    ddl = "doc_id bigint, start bigint, length bigint, " + ("ids binary, " if with_ids else "") + "ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
    return src.mapInArrow(run, ddl)


def as_batch(rows: list[tuple], kept: pa.Schema) -> pa.RecordBatch:
    columns = dict(zip(PIECES.names, zip(*rows, strict=True) if rows else [()] * len(PIECES.names), strict=True))
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in kept], schema=kept)
