"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, shuffles_released  # noqa: F401  the operators take both from here

ASCII_SPACE = r"[\x20\x09-\x0D]"

# bytes -> bytes: A-Z lower-cased, the six ASCII white-space bytes to a blank
LOWER_BLANK = bytes(
    0x20 if 0x09 <= b <= 0x0D else b + 0x20 if 0x41 <= b <= 0x5A else b for b in range(256)
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(col: Column) -> Column:
    """A-Z lower-cased, every other character kept."""
    return F.translate(col, string.ascii_uppercase, string.ascii_lowercase)


def text_or_empty(col: Column) -> Column:
    return F.coalesce(col.cast("string"), F.lit(""))


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back, so
    that every later use reads the table (columns pruned) instead of running
    the work again, and lineage ends at files every executor can read."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def crc32_of_id(doc_id: Column) -> Column:
    """crc32 of the id's decimal text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def row_sha(text: Column) -> Column:
    """Digest of a row's text as stored (null: the empty text); with the id it
    names a row when decisions made on narrow tables are taken back to rows."""
    return F.sha2(text_or_empty(text).cast("binary"), 256)


def free_name(taken: list[str], name: str) -> str:
    """``name`` with underscores added until no column of ``taken`` has it."""
    used = {t.lower() for t in taken}
    while name in used:
        name += "_"
    return name


def keep_rows(docs: DataFrame, decided: DataFrame, id_col: str = "doc_id", text_col: str = "text", repeats: bool = False) -> DataFrame:
    """Rows of ``docs``, all columns kept, that ``decided`` (``doc_id, row_sha,
    kept``: one row per document row) keeps.  Texts are shuffled once, to meet
    the decisions.  Of rows alike in id and text the first by all columns stays,
    or with ``repeats`` all."""
    sha = row_sha(F.col(f"`{text_col}`"))
    id_name, sha_name = free_name(docs.columns, "kept_id"), free_name(docs.columns, "kept_sha")
    per_key = decided.groupBy("doc_id", "row_sha").agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n"))
    per_key = materialise(per_key.where("kept").select(F.col("doc_id").alias(id_name), F.col("row_sha").alias(sha_name), "n"), "keep")
    cond = F.col(f"`{id_col}`").eqNullSafe(F.col(id_name)) & (sha == F.col(sha_name))
    kept = docs.join(per_key.select(id_name, sha_name), cond, "left_semi")
    if repeats or per_key.where("n > 1").isEmpty():
        return kept
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    order = F.to_json(row) if "map<" in docs.schema.simpleString() else row  # maps have no order
    first = F.min_by(row, order).alias("row")
    return kept.groupBy(F.col(f"`{id_col}`").alias(id_name), sha.alias(sha_name)).agg(first).select("row.*")
