"""Fill-in-middle documents from texts stored as seekable compressed frames.

``store`` cuts a text into runs of about ``FRAME_BYTES`` bytes at character
boundaries and writes each as an independent zstandard frame, with running
counts of lines, characters and bytes before it.  A cut after so many lines is
then found from the counts alone, and only the frame that holds it is
decompressed.  ``fill_in_middle`` puts the frames of prefix, middle and suffix
in the order that the form asks for: whole frames are taken as they lie, a cut
frame gives two new ones, and the marker strings are small frames of their own,
so the output is again a list of frames (joined, they are one valid zstandard
stream).  ``digests`` streams such lists frame by frame: of the output as it
is, and of the text that ``restore`` rebuilds from the output and its form
alone, by looking for the markers in the stream.

Lines are units: everything up to and with a line feed, and what is left after
the last one.  Every step is row-local; of a document's text only one frame is
decompressed at a time, and frames of a document stay in one row, so no text is
shuffled, joined or collected.

Defined results: a null text is the empty text; an empty text, or one holding a
marker, stays plain; a null id counts as empty in the seed's string; repeated
rows are each transformed (alike); an empty table gives no row; a line of any
length may span frames; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty

FRAME_BYTES = 1 << 16
LEVEL = 3
MARKERS = ("<P>", "<S>", "<M>")
SEED = 7
FIM_PERCENT = 100
SPM_PERCENT = 50
CONTINUATION = bytes(range(0x80, 0xC0))  # bytes that begin no character

FRAME = pa.struct([("lines_before", pa.int64()), ("chars_before", pa.int64()), ("data", pa.binary())])
STORE = pa.schema([("doc_id", pa.int64()), ("lines", pa.int64()), ("n", pa.int64()), ("chars", pa.int64()), ("marked", pa.bool_()), ("frames", pa.list_(FRAME))])
STORE_DDL = "doc_id bigint, lines bigint, n bigint, chars bigint, marked boolean, frames array<struct<lines_before: bigint, chars_before: bigint, data: binary>>"
OUT = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.list_(pa.binary()))])
OUT_DDL = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output array<binary>"


def chars_of(data: bytes) -> int:
    """Code points of UTF-8 bytes."""
    return len(data) if data.isascii() else len(data.translate(None, CONTINUATION))


def runs(text: bytes, size: int) -> Iterator[bytes]:
    """The text in runs of at most ``size`` bytes, or one character, cut where a character begins."""
    lo = 0
    while lo < len(text):
        hi = min(len(text), lo + size)
        while hi < len(text) and hi > lo and 0x80 <= text[hi] < 0xC0:
            hi -= 1
        if hi == lo:
            hi = lo + 1
            while hi < len(text) and 0x80 <= text[hi] < 0xC0:
                hi += 1
        yield text[lo:hi]
        lo = hi


@dataclass(frozen=True)
class Stored:
    """A document as frames: ``before[k]`` and ``chars[k]`` line feeds and
    characters lie before frame k; ``n`` units in all."""

    n: int
    lines: int
    total: int
    before: list[int]
    chars: list[int]
    frames: list[bytes]

    def cut(self, units: int, read) -> tuple[int, int]:
        """Where the first ``units`` units end: frame, and byte in it."""
        if units == 0 or not self.frames:
            return 0, 0
        if units > self.lines:  # the last unit has no line feed
            return len(self.frames), 0
        k = bisect_left(self.before, units) - 1
        data, at = read(self.frames[k]), 0
        for _ in range(units - self.before[k]):
            at = data.index(b"\n", at) + 1
        return (k + 1, 0) if at == len(data) else (k, at)

    def chars_to(self, frame: int, at: int, read) -> int:
        """Characters before a place."""
        start = self.chars[frame] if frame < len(self.frames) else self.total
        return start + (chars_of(read(self.frames[frame])[:at]) if at else 0)

    def part(self, lo: tuple[int, int], hi: tuple[int, int], read, write) -> list[bytes]:
        """Frames of what lies between two places."""
        (a, i), (b, j) = lo, hi
        if a == b:
            return [write(read(self.frames[a])[i:j])] if i < j else []
        head = [write(read(self.frames[a])[i:])] if i else [self.frames[a]]
        return head + self.frames[a + 1 : b] + ([write(read(self.frames[b])[:j])] if j else [])


class Codec:
    """One task's compressor and decompressor; keeps the last frame read, as
    both cuts of a short text lie in one frame."""

    def __init__(self, level: int = LEVEL):
        self._write = zstandard.ZstdCompressor(level=level)
        self._read = zstandard.ZstdDecompressor()
        self._last: tuple[bytes | None, bytes] = (None, b"")

    def write(self, data: bytes) -> bytes:
        return self._write.compress(data)

    def read(self, frame: bytes) -> bytes:
        if self._last[0] is not frame:
            self._last = frame, self._read.decompress(frame)
        return self._last[1]

    def stored(self, text: bytes, size: int = FRAME_BYTES) -> Stored:
        lines = chars = 0
        before, chars_before, frames = [], [], []
        for run in runs(text, size):
            before.append(lines)
            chars_before.append(chars)
            frames.append(self.write(run))
            lines += run.count(b"\n")
            chars += chars_of(run)
        n = lines + (bool(text) and not text.endswith(b"\n"))
        return Stored(n, lines, chars, before, chars_before, frames)


def store(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", markers: tuple[str, ...] = MARKERS, frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """One row per document: ``doc_id, lines`` (line feeds), ``n`` (units),
    ``chars, marked`` (holds a marker) and ``frames``."""
    if frame_bytes < 1 or not all(markers):
        raise ValueError("frames and markers must not be empty")
    src = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), text_or_empty(F.col(f"`{text_col}`")).cast("binary").alias("text"))
    signs = re.compile(b"|".join(re.escape(m.encode()) for m in markers))

    def run(batches):
        codec = Codec()
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                part, rows = batch.slice(lo, 64), []
                for doc, text in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                    data = text.as_py()
                    s = codec.stored(data, frame_bytes)
                    frames = [{"lines_before": b, "chars_before": c, "data": f} for b, c, f in zip(s.before, s.chars, s.frames, strict=True)]
                    rows.append({"doc_id": doc, "lines": s.lines, "n": s.n, "chars": s.total, "marked": bool(signs.search(data)), "frames": frames})
                yield pa.RecordBatch.from_pylist(rows, schema=STORE)

    return src.mapInArrow(run, STORE_DDL)


def draws(doc_id: int | None, seed: int) -> list[int]:
    """Four numbers below 2^32 that the seed and the id fix."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[k : k + 4], "big") for k in range(0, 16, 4)]


def arrange(s: Stored, marked: bool, h: list[int], markers: tuple[str, ...], fim_percent: int, spm_percent: int, codec: Codec) -> tuple[str, int | None, int | None, list[bytes]]:
    """Form, characters of prefix and middle, and the output's frames."""
    if not s.frames or marked or h[2] % 100 >= fim_percent:
        return "plain", None, None, s.frames
    first, second = sorted((h[0] % (s.n + 1), h[1] % (s.n + 1)))
    a, b = s.cut(first, codec.read), s.cut(second, codec.read)
    prefix_chars = s.chars_to(*a, codec.read)
    middle_chars = s.chars_to(*b, codec.read) - prefix_chars
    prefix, middle, suffix = (s.part(lo, hi, codec.read, codec.write) for lo, hi in (((0, 0), a), (a, b), (b, (len(s.frames), 0))))
    p, q, m = ([codec.write(x.encode())] for x in markers)
    if h[3] % 100 < spm_percent:
        return "spm", prefix_chars, middle_chars, q + suffix + p + prefix + m + middle
    return "psm", prefix_chars, middle_chars, p + prefix + q + suffix + m + middle


def fill_in_middle(stored: DataFrame, seed: int = SEED, markers: tuple[str, ...] = MARKERS, fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT) -> DataFrame:
    """One row per stored document: ``doc_id, n, form, prefix_chars,
    middle_chars, output`` (frames in order).  ``markers`` are those of prefix,
    suffix and middle that ``store`` looked for."""

    def run(batches):
        codec = Codec()
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                rows = []
                for r in batch.slice(lo, 64).to_pylist():
                    f = r["frames"]
                    s = Stored(r["n"], r["lines"], r["chars"], [x["lines_before"] for x in f], [x["chars_before"] for x in f], [x["data"] for x in f])
                    form, prefix, middle, output = arrange(s, r["marked"], draws(r["doc_id"], seed), markers, fim_percent, spm_percent, codec)
                    rows.append({"doc_id": r["doc_id"], "n": s.n, "form": form, "prefix_chars": prefix, "middle_chars": middle, "output": output})
                yield pa.RecordBatch.from_pylist(rows, schema=OUT)

    return stored.mapInArrow(run, OUT_DDL)


def text_of(output: Iterable[bytes]) -> bytes:
    """The whole output: its frames decompressed in order."""
    read = zstandard.ZstdDecompressor()
    return b"".join(read.decompress(f) for f in output)


def places_of(output: list[bytes], marker: bytes, codec: Codec) -> tuple[int, int]:
    """Bytes before the first occurrence of a marker in the stream, and after it."""
    done, tail = 0, b""
    for frame in output:
        data = tail + codec.read(frame)
        at = data.find(marker)
        if at >= 0:
            return done + at, done + at + len(marker)
        tail = data[max(0, len(data) - len(marker) + 1) :]
        done += len(data) - len(tail)
    raise ValueError(f"the output holds no {marker!r}")


def between(output: list[bytes], lo: int, hi: int | None, codec: Codec) -> Iterator[bytes]:
    """The bytes of the stream from ``lo`` to ``hi`` (None: the end)."""
    at = 0
    for frame in output:
        data = codec.read(frame)
        if at + len(data) > lo and (hi is None or at < hi):
            yield data[max(0, lo - at) : None if hi is None else hi - at]
        at += len(data)
        if hi is not None and at >= hi:
            return


def restore(output: list[bytes], form: str, markers: tuple[str, ...] = MARKERS, codec: Codec | None = None) -> Iterator[bytes]:
    """The text, piece by piece, from an output and its form alone."""
    codec = codec or Codec()
    if form == "plain":
        yield from between(output, 0, None, codec)
        return
    (p0, p1), (s0, s1), (m0, m1) = (places_of(output, m.encode(), codec) for m in markers)
    spans = {"psm": ((p1, s0), (m1, None), (s1, m0)), "spm": ((p1, m0), (m1, None), (s1, p0))}[form]
    for lo, hi in spans:
        yield from between(output, lo, hi, codec)


def digests(made: DataFrame, markers: tuple[str, ...] = MARKERS) -> DataFrame:
    """Rows of ``fill_in_middle`` with ``output_sha256`` and
    ``restored_sha256`` (lowercase hex) in place of the output."""

    @F.arrow_udf("struct<output_sha256: string, restored_sha256: string>")
    def sha(output: pa.Array, form: pa.Array) -> pa.Array:
        codec, rows = Codec(), []
        for frames, kind in zip(output, form.to_pylist(), strict=True):
            frames = frames.as_py()
            whole, again = hashlib.sha256(), hashlib.sha256()
            for data in between(frames, 0, None, codec):
                whole.update(data)
            for data in restore(frames, kind, markers, codec):
                again.update(data)
            rows.append({"output_sha256": whole.hexdigest(), "restored_sha256": again.hexdigest()})
        return pa.array(rows, pa.struct([("output_sha256", pa.string()), ("restored_sha256", pa.string())]))

    named = made.withColumn("sha", sha("output", "form"))
    return named.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "sha.output_sha256", "sha.restored_sha256")
