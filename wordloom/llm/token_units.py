"""Token ids of texts through a cache of blank-delimited units, for tokenizers
that drop white space: the ids of a text are those of its units in order.

Units seen for the first time are encoded together, which spares most of a
call's cost: they are joined by a digit that none of them holds, and the ids
are cut where that digit's own id stands."""

from __future__ import annotations

import os
import re
import zlib

import numpy as np

CACHE_UNITS = 400_000  # per generation; two are held
CACHE_CHARS = 64  # longer units are encoded each time they come
JOIN_CHARS = 4096  # characters encoded in one string, unless one unit is longer
CLOSING = ".,;:!?"  # after a letter, these begin a token of their own
LATIN_END = "\u0100"  # letters below stay one letter when normalised or lower-cased

# white space to Python but not to the tokenizers' rule \s
INFORMATION_SEPARATOR = re.compile("[\x1c-\x1f]")


class BlankUnitCodes:
    """Ids of whole texts as little-endian unsigned 32-bit numbers."""

    def __init__(self, tokenizer_json: str, cache_units: int = CACHE_UNITS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        if self._ids("a  b\n") != self._ids("a b"):
            raise ValueError("the tokenizer does not drop white space, so units depend on what stands before them")
        if any(self._ids("ab" + c) != self._ids("ab") + self._ids(c) for c in [*CLOSING, CLOSING]):
            raise ValueError("the tokenizer joins a word and the punctuation after it")
        self.marks = [(d, ids[0]) for d in "0123456789" if len(ids := self._ids(d)) == 1]
        self.cache_units = cache_units
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _one_by_one(self, units: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(units, add_special_tokens=False)]

    def _joined(self, units: list[str], mark: str, mark_id: int) -> list[bytes]:
        text = f" {mark} ".join(units)
        ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
        ends = np.flatnonzero(ids == mark_id)
        if len(ends) != len(units) - 1:
            return self._one_by_one(units)
        raw, ends = ids.tobytes(), (4 * ends).tolist()
        return [raw[lo:hi] for lo, hi in zip([0, *(e + 4 for e in ends)], [*ends, len(raw)], strict=True)]

    def encode_units(self, units: list[str]) -> dict[str, bytes]:
        """The ids of each unit."""
        found: dict[str, bytes] = {}
        for mark, mark_id in self.marks:
            held: list[str] = []
            some: list[str] = []
            size = 0
            for u in units:
                if mark in u:
                    held.append(u)
                    continue
                some.append(u)
                size += len(u)
                if size > JOIN_CHARS:
                    found.update(zip(some, self._joined(some, mark, mark_id), strict=True))
                    some, size = [], 0
            if some:
                found.update(zip(some, self._joined(some, mark, mark_id), strict=True))
            units = held
        found.update(zip(units, self._one_by_one(units), strict=True))
        return found

    def _learn(self, missing: set[str]) -> dict[str, bytes]:
        """Put units into the young cache; the long ones are returned instead."""
        old, young = self.old, self.young
        new, closed = {}, []
        for u in missing:
            if (ids := old.get(u)) is not None:
                young[u] = ids
            elif (stem := u.rstrip(CLOSING)) != u and stem[-1:].isalpha() and stem[-1] < LATIN_END:
                closed.append((u, stem, u[len(stem) :]))
                for part in closed[-1][1:]:
                    if part not in young:
                        new[part] = None
            else:
                new[u] = None
        found = self.encode_units(list(new))
        long = {u: found.pop(u) for u in [u for u in found if len(u) > CACHE_CHARS]}
        young.update(found)
        for u, stem, tail in closed:
            both = b"".join([young[x] if x in young else long[x] for x in (stem, tail)])
            (young if len(u) <= CACHE_CHARS else long)[u] = both
        return long

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text."""
        if len(self.young) > self.cache_units:
            self.young, self.old = {}, self.young
        many = [t.split(" ") if INFORMATION_SEPARATOR.search(t) else t.split() for t in texts]
        missing: set[str] = set()
        for units in many:
            missing.update(units)
        long, young = self._learn(missing.difference(self.young)), self.young
        if not long:
            return [b"".join(map(young.__getitem__, units)) for units in many]
        return [b"".join([young[u] if u in young else long[u] for u in units]) for units in many]


_coders: dict[tuple, BlankUnitCodes] = {}


def coder_of(kind: type, json_text: str):
    """One coder per worker process, kind and tokenizer: its cache outlives tasks."""
    key = kind, zlib.crc32(json_text.encode())
    if key not in _coders:
        _coders[key] = kind(json_text)
    return _coders[key]
