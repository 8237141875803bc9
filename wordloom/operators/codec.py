"""Encoding and decoding whole corpora.

Both directions are row-local: no shuffle, no join, no skew.  The learned
vocabulary is bounded (``vocab_size`` entries, checked), so it travels with
the expression.  Encoding is one Arrow-batched UDF over the text column alone
(every other column stays in the JVM); decoding is a column expression with one
array look-up per id.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from array import array
from functools import cached_property

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import IM_START
from .tokenizer import MAX_VOCAB_SIZE, PRETOKEN_RULE, WHITE_SPACE, Tokenizer

WORD_CACHE = 200_000  # units per generation that a worker remembers; two are held
LONGEST_KEPT = 64  # longer units are encoded each time they come
UNITS_AT_ONCE = 200_000  # units of texts that are looked up together, or one text's
NO_RANK = np.int32(2**31 - 1)  # of a pair that no merge joins


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def special_split_pattern(tok: Tokenizer) -> str:
    alt = "|".join(_java_quote(s) for s in sorted(tok.specials, key=len, reverse=True))
    return f"(?=(?:{alt}))|(?<=(?:{alt}))"


def special_strip_pattern(tok: Tokenizer) -> str:
    return "|".join(_java_quote(s) for s in sorted(tok.specials, key=len, reverse=True))


def _java_quote(s: str) -> str:
    return "".join("\\" + ch if ch in r"\.[]{}()<>*+-=!?^$|" else ch for ch in s)


def split_specials(col, tok: Tokenizer) -> Column:
    """Ordered non-empty segments; each special marker is its own segment."""
    parts = F.split(F.coalesce(_c(col), F.lit("")), special_split_pattern(tok), -1)
    return F.filter(parts, lambda s: s != F.lit(""))


class WordMerger:
    """Merges the symbols of one pre-token, lowest rank first."""

    def __init__(self, tok: Tokenizer):
        self.symbol = {int(h, 16): i for h, i in tok.byte_hex_to_id().items()}
        self.rule = {(l, r): (rank, new) for rank, (l, r, new) in enumerate(tok.merges)}

    def ids(self, word: str) -> list[int]:
        """Bytes never seen in training are dropped.  Candidate merges wait in a
        heap by (rank, place) over a doubly linked list of symbols, so a word of
        n bytes takes O(n log n); an entry whose symbols have changed since it
        was pushed is skipped."""
        node = [self.symbol[b] for b in word.encode("utf-8") if b in self.symbol]
        n = len(node)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rule, waiting = self.rule, []

        def offer(i: int) -> None:
            j = after[i]
            if j < n and (found := rule.get((node[i], node[j]))):
                heapq.heappush(waiting, (found[0], i, node[i], node[j], found[1]))

        for i in range(n):
            offer(i)
        while waiting:
            _, i, left, right, new = heapq.heappop(waiting)
            j = after[i]
            if node[i] != left or j >= n or node[j] != right:
                continue
            node[i], node[j] = new, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        return [x for x in node if x >= 0]

    @cached_property
    def tables(self) -> tuple[np.ndarray, ...]:
        """Id of each byte (-1: none), the sorted pairs with their ranks, and by
        rank the new id and whether no pair that holds it has a lower rank."""
        symbol, size = np.full(256, -1, np.int32), 1 + max((r for r, _ in self.rule.values()), default=0)
        symbol[list(self.symbol)] = list(self.symbol.values())
        lowest: dict[int, int] = {}
        for pair, (rank, _) in self.rule.items():
            for x in pair:
                lowest[x] = min(rank, lowest.get(x, rank))
        made, settled = np.zeros(size, np.int32), np.ones(size, bool)
        for rank, new in self.rule.values():
            made[rank], settled[rank] = new, lowest.get(new, size) > rank
        pairs = sorted((l * MAX_VOCAB_SIZE + r, rank) for (l, r), (rank, _) in self.rule.items())
        codes, ranks = (np.array([p[k] for p in pairs], kind) for k, kind in ((0, np.int64), (1, np.int32)))
        return symbol, codes, ranks, made, settled

    def _ranks(self, ids: np.ndarray, of: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Ranks of the pairs that begin at the places ``at``."""
        _, codes, ranks, _, _ = self.tables
        after = np.minimum(at + 1, len(ids) - 1)
        code = ids[at].astype(np.int64) * MAX_VOCAB_SIZE + ids[after]
        i = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
        return np.where((codes[i] == code) & (of[at] == of[after]) & (after > at), ranks[i], NO_RANK)

    def many(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """What ``ids`` gives for each of many words: all ids one after the
        other, and where each word's end.

        The words are merged side by side: a round joins, in every word, the
        pairs of its lowest rank from left to right, or the first one alone where
        the new id may be part of a pair of a lower rank still.  Only pairs
        beside a new id are looked up again, and words without a pair leave."""
        symbol, codes, _, made, settled = self.tables
        data = [w.encode("utf-8") for w in words]
        ids = symbol[np.frombuffer(b"".join(data), np.uint8)]
        of = np.repeat(np.arange(len(words)), [len(w) for w in data])
        known = ids >= 0
        ids, of = ids[known], of[known]
        done = []
        if len(codes) and len(ids):
            rank = self._ranks(ids, of, np.arange(len(ids)))
        else:
            rank = np.full(len(ids), NO_RANK)
        while len(ids):
            starts = np.flatnonzero(np.diff(of, prepend=-1))
            low = np.repeat(np.minimum.reduceat(rank, starts), np.diff(starts, append=len(ids)))
            left = low != NO_RANK
            done.append((of[~left], ids[~left]))
            ids, of, rank, low = ids[left], of[left], rank[left], low[left]
            if not len(ids):
                break
            at = np.flatnonzero(rank == low)
            # of pairs that overlap (runs of one id) every second one is joined
            run = np.maximum.accumulate(np.where(np.diff(at, prepend=-2) > 1, at, 0))
            first = np.diff(of[at], prepend=-1) != 0
            at = at[((at - run) % 2 == 0) & (settled[rank[at]] | first)]
            ids[at] = made[rank[at]]
            stays = np.ones(len(ids), bool)
            stays[at + 1] = False
            at = at - np.arange(len(at))  # every pair before it took one place
            ids, of, rank = ids[stays], of[stays], rank[stays]
            at = np.concatenate([at, at[at > 0] - 1])
            rank[at] = self._ranks(ids, of, at)
        of, ids = (np.concatenate([x[k] for x in done]) if done else np.empty(0, np.int32) for k in (0, 1))
        order = np.argsort(of, kind="stable")
        return ids[order].astype(np.int32), np.cumsum(np.bincount(of, minlength=len(words)))


class UnitCodes(dict):
    """Ids (little-endian 32-bit) of the units of texts: what lies between two
    blanks, with the blank before it.  The key of a unit is its text without that
    blank; one that has none has a blank before its key instead."""

    def __init__(self, tok: Tokenizer, most: int = WORD_CACHE):
        super().__init__()
        self.merger, self.most, self.old = WordMerger(tok), most, {}
        self.words, self.blanks = regex.compile(PRETOKEN_RULE), re.compile(f" (?:[{WHITE_SPACE}]|\\Z)")

    def __missing__(self, key: str) -> bytes:
        ids = self.old.get(key)
        if ids is None:
            text = key[1:] if key[:1] == " " else " " + key
            ids = b"".join([array("i", self.merger.ids(w)).tobytes() for w in self.words.findall(text)])
        if len(key) <= LONGEST_KEPT:
            self[key] = ids
        return ids

    def units(self, text: str) -> list[str]:
        if self.blanks.search(text):  # a blank that need not begin a pre-token
            return [" " + w for w in self.words.findall(text)]
        units = text.split(" ")
        units[0] = " " + units[0]
        return units

    def turn(self) -> None:
        """Begin a new generation when this one is full."""
        if len(self) > self.most:
            self.old = dict(self)
            self.clear()

    def learn(self, units: set[str]) -> None:
        """Take in the units that are not known, merged side by side."""
        new = [key for key in units.difference(self) if len(key) <= LONGEST_KEPT]
        if self.old:
            for key in self.old.keys() & new:
                self[key] = self.old[key]
            new = [key for key in new if key not in self]
        if not new:
            return
        # units that follow a blank make one text: none begins with white space
        plain = [key for key in new if key[:1] != " "]
        text = " ".join(["", *plain])
        words = self.words.findall(text)
        begins = np.cumsum([0, *map(len, words)])
        counts = np.diff(np.searchsorted(begins, np.cumsum([0, *map(len, plain)]) + np.arange(len(plain) + 1))).tolist()
        for key in new:
            if key[:1] == " ":
                found = self.words.findall(key[1:])
                plain.append(key)
                words += found
                counts.append(len(found))
        ids, ends = self.merger.many(words)
        cuts = (4 * np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]).tolist()
        data = ids.tobytes()
        self.update(zip(plain, map(data.__getitem__, map(slice, cuts, cuts[1:]))))

    def encode(self, text: str) -> bytes:
        self.turn()
        return b"".join(map(self.__getitem__, self.units(text)))


_coders: dict[str, UnitCodes] = {}


def coder_of(kind: str, tok: Tokenizer) -> UnitCodes:
    """One coder per worker process, for one tokenizer at a time: it outlives tasks."""
    if kind not in _coders:
        _coders.clear()
        _coders[kind] = UnitCodes(tok)
    return _coders[kind]


def encode_ids(col, tok: Tokenizer) -> Column:
    """Text -> ``array<int>`` token ids.

    A marker becomes its single id wherever it occurs; what stands between
    markers is pre-tokenised and merged word by word.  A null text has no ids.
    A worker process keeps the ids of the units it met, a bounded number, for
    all batches and tasks, and merges new ones many at once; ids go from one buffer to Arrow, never as objects."""
    specials = {t: array("i", [i]).tobytes() for t, i in tok.specials.items()}
    marker = "|".join(re.escape(t) for t in sorted(specials, key=len, reverse=True))
    kind = hashlib.md5(repr((tok.tokens, tok.merges, tok.specials)).encode()).hexdigest()

    @F.arrow_udf("array<int>")
    def of(texts: pa.Array) -> pa.Array:
        coder, markers = coder_of(kind, tok), re.compile(f"({marker})")
        ids, ends, held, size = bytearray(), array("i", [0]), [], 0

        def encoded() -> None:
            coder.turn()
            coder.learn({u for parts in held for part in parts if type(part) is list for u in part})
            for parts in held:
                for part in parts:
                    ids.extend(part if type(part) is bytes else b"".join(map(coder.__getitem__, part)))
                ends.append(len(ids) // 4)
            held.clear()

        for text in texts:
            parts = enumerate(markers.split(text.as_py()))  # every second part is a marker
            held.append([specials[part] if k % 2 else coder.units(part) for k, part in parts if part])
            size += sum(map(len, held[-1]))
            if size >= UNITS_AT_ONCE:
                encoded()
                size = 0
        encoded()
        values = pa.Array.from_buffers(pa.int32(), len(ids) // 4, [None, pa.py_buffer(ids)])
        return pa.ListArray.from_arrays(pa.array(np.frombuffer(ends, np.int32)), values)

    return of(F.coalesce(_c(col), F.lit("")))


def encode(df: DataFrame, tok: Tokenizer, text_col: str = "sample", out_col: str = "ids") -> DataFrame:
    """``df`` with ``out_col``, the token ids of ``text_col``."""
    return df.withColumn(out_col, encode_ids(text_col, tok))


def decode_column(col, tok: Tokenizer) -> Column:
    """Ids -> text.  Special and unknown ids are skipped; bytes that do
    not form valid UTF-8 become U+FFFD."""
    of_id = tok.id_to_bytes_hex()
    # ids are dense: a constant array, indexed by id, in one literal
    table = F.split(F.lit(",".join(of_id.get(i, "") for i in range(tok.vocab_size))), ",")
    hexes = F.array_join(F.transform(_c(col), lambda i: F.get(table, i)), "")
    return F.make_valid_utf8(F.unhex(hexes).cast("string"))


def strip_specials(col, tok: Tokenizer) -> Column:
    return F.regexp_replace(F.coalesce(_c(col), F.lit("")), F.lit(special_strip_pattern(tok)), F.lit(""))


def roundtrip_audit(df: DataFrame, tok: Tokenizer, text_col: str = "sample") -> DataFrame:
    """decode(encode(t)) against t without markers; plus the first-id
    check (a sample must start with the start marker, id 1)."""
    enc = encode(df.select(text_col), tok, text_col)
    checked = enc.select(
        (decode_column("ids", tok) == strip_specials(text_col, tok)).alias("ok"),
        (F.get("ids", F.lit(0)) == F.lit(tok.specials[IM_START])).alias("first_is_start"),
        F.size("ids").alias("n_tokens"),
    )
    return checked.agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.sum(F.col("ok").cast("long")).alias("n_roundtrip_ok"),
        F.sum(F.coalesce(F.col("first_is_start"), F.lit(False)).cast("long")).alias("n_first_id_1"),
    )


def token_stats(encoded: DataFrame, text_col: str = "sample", ids_col: str = "ids", by: str = "split") -> DataFrame:
    """Token counts by split and characters per token."""
    return encoded.groupBy(by).agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.sum(F.size(ids_col)).alias("n_tokens"),
        F.round(F.avg(F.size(ids_col)), 6).alias("avg_tokens"),
        F.max(F.size(ids_col)).alias("max_tokens"),
        F.round(F.sum(F.length(text_col)) / F.sum(F.size(ids_col)), 6).alias("chars_per_token"),
    )
