"""Exact dedup by content-defined chunk recipes (DataFrame functions only).

A text is cut into chunks at places its own content decides, each distinct
chunk gets an identifier that has been verified against the chunk's content,
and two texts are equal exactly when their ordered identifier lists (their
recipes) are.  Chunk contents travel once, de-duplicated before the shuffle;
afterwards only recipes do, about one hundredth of the text.

Why this is exact: cutting is a function of the text and the chunks of a text
concatenate to it, so equal texts have equal chunk lists and unequal texts
unequal ones.  An identifier is (hash, rank): the rank tells apart different
contents that share a hash, so identifiers are equal exactly when the chunks
are.

Defined results: a null text is the empty text (empty recipe); null ids sort
after every id; rows that repeat both id and text are ordinary members of
their group, of which one row stays; an empty table gives an empty result;
columns beyond the id and the text are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keep_rows, materialise, row_sha, text_or_empty

MIN_CHUNK, MAX_CHUNK = 256, 4096
# a chunk ends behind a blank whose neighbourhood falls into these classes
# (about one place in two hundred of running text), or at MAX_CHUNK
BOUNDARY = r"(?<=[aeiou][a-m] [b-hp-t])"
MAX_COLLISIONS = 10_000


def normalise(text: Column) -> Column:
    """Every run of ASCII white space replaced by one blank.  The pattern
    skips single blanks, which are right already."""
    return F.regexp_replace(text_or_empty(text), r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]", " ")


def chunks(text: Column) -> Column:
    """The chunk list of a (normalised) text; [] for the empty text."""
    pattern = rf"(?s).{{{MIN_CHUNK},{MAX_CHUNK}}}?{BOUNDARY}|.{{1,{MAX_CHUNK}}}"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def chunk_collisions(texts: DataFrame, text_col: str, hash_fn: Callable[[Column], Column]) -> list:
    """Verify the hashes against the contents: the ``(h, chunk)`` rows of all
    distinct chunks that share a hash (with 64 bits almost always none).
    Chunks are made distinct inside each map task first, so one held by a
    third of all documents moves once per task."""
    distinct = (
        texts.select(F.explode(chunks(normalise(F.col(text_col)))).alias("chunk"))
        .select(hash_fn(F.col("chunk")).alias("h"), "chunk")
        .distinct()
    )
    shared = distinct.groupBy("h").count().where("count > 1").select("h")
    hashes = shared.limit(MAX_COLLISIONS + 1).collect()
    if not hashes:
        return []
    if len(hashes) > MAX_COLLISIONS:
        raise ValueError(f"more than {MAX_COLLISIONS} hashes stand for several chunks: use a wider hash_fn")
    wanted = F.col("h").isin([r[0] for r in hashes])
    found = distinct.where(wanted).limit(2 * MAX_COLLISIONS + 1).collect()
    if len(found) > 2 * MAX_COLLISIONS:
        raise ValueError(f"more than {2 * MAX_COLLISIONS} chunks share hashes: use a wider hash_fn")
    return [tuple(r) for r in found]


def ranks(collisions: list) -> dict[str, int]:
    by_hash: dict[int, list[str]] = {}
    for h, chunk in collisions:
        by_hash.setdefault(h, []).append(chunk)
    return {c: k for group in by_hash.values() for k, c in enumerate(sorted(group)) if k}


def recipe(text: Column, rank_of: dict[str, int], hash_fn: Callable[[Column], Column]) -> Column:
    """Ordered identifier list of a normalised text.  Without collisions the
    rank is 0 throughout and left out."""
    if not rank_of:
        return F.transform(chunks(text), lambda c: hash_fn(c))
    lookup = F.create_map(*[F.lit(x) for kv in rank_of.items() for x in kv])
    return F.flatten(
        F.transform(
            chunks(text),
            lambda c: F.array(hash_fn(c), F.coalesce(F.try_element_at(lookup, c), F.lit(0)).cast("long")),
        )
    )


def recipes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_fn: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """``(doc_id, row, row_sha, recipe, text_sha256)`` per row, written once."""
    src = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    bad = chunk_collisions(src, "text", hash_fn)
    norm = src.select("doc_id", row_sha(F.col("text")).alias("row_sha"), normalise(F.col("text")).alias("norm"))
    made = norm.select(
        "doc_id",
        "row_sha",
        F.monotonically_increasing_id().alias("row"),
        recipe(F.col("norm"), ranks(bad), hash_fn).alias("recipe"),
        F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256"),
    )
    return materialise(made, "recipes")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_fn: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """One row per document row: ``doc_id, keep_id, group_size, kept,
    text_sha256, row_sha``.  ``keep_id`` is the smallest id among rows of equal text;
    exactly one row of a group has ``kept``."""
    rec = recipes(docs, id_col, text_col, hash_fn)
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")
    groups = rec.groupBy("recipe").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("group_size"))
    # written first: joined straight from the aggregate, Spark could not split
    # the rows of a hot recipe over several tasks
    groups = materialise(groups, "recipe_groups")
    return rec.join(groups, "recipe").select(
        "doc_id",
        F.col("first.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("first.row")).alias("kept"),
        "text_sha256",
        "row_sha",
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The document rows that stay, with all their columns: one row of each
    group of equal texts."""
    decided = exact_dedup(docs, id_col, text_col).select("doc_id", "row_sha", "kept")
    return keep_rows(docs, decided, id_col, text_col)
