"""Scalar text functions (column expressions, all JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values that must equal the reference's behaviour ---------------
# Python's str.split()/str.strip() whitespace: the code points for which
# str.isspace() is true.  Java's \s and trim() differ on 23 of them.
WS_CLASS = (
    r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
WS_RUN = WS_CLASS + "+"
STRIP_RE = "^" + WS_RUN + "|" + WS_RUN + "$"

# the code points of WS_CLASS but the blank
OTHER_WS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"

PAD_TOKEN = "<pad>"
IM_START = "<|im_start|>"
IM_END = "<|im_end|>"
SPECIAL_TOKENS = [PAD_TOKEN, IM_START, IM_END]  # ids 0, 1, 2
PAD_ID, BOS_ID, EOS_ID = 0, 1, 2

SAMPLE_PREFIX = "<|im_start|>assistant\n"
TWO_ROLE_PREFIX = "<|im_start|>user\n"
TWO_ROLE_SUFFIX = "<|im_end|>\n<|im_start|>assistant\n"
EXIT_WORDS = ["quit", "exit", "q"]
DEFAULT_REPLY = "toki."
# ---------------------------------------------------------------------------


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def py_strip(col) -> Column:
    """Python ``str.strip()``: drop leading and trailing whitespace runs."""
    return F.regexp_replace(_c(col), F.lit(STRIP_RE), F.lit(""))


def clean_text(col) -> Column:
    """``" ".join((text or "").split())`` — null becomes ''."""
    blanks = F.translate(F.coalesce(_c(col), F.lit("")), OTHER_WS, " " * len(OTHER_WS))
    return F.trim(F.regexp_replace(blanks, F.lit("  +"), F.lit(" ")))  # a literal search, where single blanks are no match


def wrap_sample(col) -> Column:
    """Training sample: assistant turn around the cleaned text, no newline
    before the end marker."""
    return wrap_clean(clean_text(col))


def wrap_clean(col) -> Column:
    """``wrap_sample`` of a text that is clean already."""
    return F.concat(F.lit(SAMPLE_PREFIX), _c(col), F.lit(IM_END))


def truncate_reply(col) -> Column:
    """Cut at the first end marker, then at the first start marker, then
    strip."""
    cut = F.substring_index(F.substring_index(_c(col), IM_END, 1), IM_START, 1)
    return py_strip(cut)


def reply_or_default(col, default: str = DEFAULT_REPLY) -> Column:
    """Browser reply: the cleaned reply, or a default when it is empty."""
    return F.coalesce(F.nullif(truncate_reply(col), F.lit("")), F.lit(default))


def is_usable_prompt(col, skip_blank: bool = True) -> Column:
    """True for prompts that are not exit words (and, optionally, not blank)."""
    stripped = py_strip(F.coalesce(_c(col), F.lit("")))
    keep = ~F.lower(stripped).isin(*EXIT_WORDS)
    if skip_blank:
        keep = keep & (stripped != F.lit(""))
    return keep


def two_role_prompt(col) -> Column:
    """Browser prompt: user turn then an open assistant turn."""
    return F.concat(F.lit(TWO_ROLE_PREFIX), py_strip(F.coalesce(_c(col), F.lit(""))), F.lit(TWO_ROLE_SUFFIX))


def assistant_prompt(col) -> Column:
    """Command-line prompt: the message in an open assistant turn, not cleaned."""
    return F.concat(F.lit(SAMPLE_PREFIX), F.coalesce(_c(col), F.lit("")))
