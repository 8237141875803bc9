"""Byte-level symbols: every UTF-8 byte is shown as one printable character.

The table is generated from its rule (printable Latin-1 bytes stand for
themselves, the other 68 bytes take code points 256, 257, ... in byte order),
so it is never written out by hand.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: bytes from FIRST_DIRECT on show as the character of their own
# code point, but for these two runs and one byte, which lie at SHIFTED and up
FIRST_DIRECT, SHIFTED = 0x21, 0x100
HIDDEN = (0x7F, 0xA0)
SOFT_HYPHEN = 0xAD


def symbol_code(byte: int) -> int:
    """Code point that shows a byte: the hidden bytes count up from SHIFTED."""
    if byte < FIRST_DIRECT:
        return SHIFTED + byte
    if HIDDEN[0] <= byte <= HIDDEN[1]:
        return SHIFTED + FIRST_DIRECT + byte - HIDDEN[0]
    if byte == SOFT_HYPHEN:
        return SHIFTED + FIRST_DIRECT + HIDDEN[1] - HIDDEN[0] + 1
    return byte


@lru_cache(maxsize=1)
def byte_to_symbol() -> dict[int, str]:
    return {b: chr(symbol_code(b)) for b in range(256)}


@lru_cache(maxsize=1)
def symbol_to_byte() -> dict[str, int]:
    return {s: b for b, s in byte_to_symbol().items()}


def byte_symbols(col) -> Column:
    """``array<string>`` of byte symbols of a word (space -> 'Ġ').

    The bytes are read as Latin-1, one character each, the hidden ones are
    replaced by their symbols, and the string is taken apart: a cost per byte
    that does not depend on the table's size."""
    c = F.col(col) if isinstance(col, str) else col
    shown = {chr(b): s for b, s in byte_to_symbol().items() if chr(b) != s}
    text = F.translate(F.decode(F.encode(c, "UTF-8"), "ISO-8859-1"), "".join(shown), "".join(shown.values()))
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, ""))


def symbols_to_bytes_hex(token: str) -> str:
    """Hex of the bytes a symbol string stands for (driver-side, per vocab
    entry); a character that shows no byte is an error."""
    try:
        return bytes(map(symbol_to_byte().__getitem__, token)).hex().upper()
    except KeyError as e:
        raise ValueError(f"{e.args[0]!r} in token {token!r} stands for no byte") from None


def word_to_symbols_py(word: str) -> list[str]:
    return [chr(symbol_code(b)) for b in word.encode("utf-8")]
