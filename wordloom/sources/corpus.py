"""Corpus sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read_corpus(
    spark: SparkSession, path: str, fmt: str = "parquet", text_col: str = "text", id_col: str = "doc_id", min_partitions: int | None = None
) -> DataFrame:
    """``(doc_id, text)`` from parquet / json / text files; nulls kept.

    A source without an id column is keyed on its text (``xxhash64``), so that
    orders and splits do not depend on how files are cut into tasks.  With
    ``min_partitions``, a scan of fewer splits (one small file) is spread
    round-robin, for text work that is bound by CPU.
    """
    if fmt == "text":
        df = spark.read.text(path).withColumnRenamed("value", text_col)
    else:
        df = spark.read.format(fmt).load(path)
    text = F.col(text_col).cast("string")
    df = df.select(F.col(id_col) if id_col in df.columns else F.xxhash64(text).alias(id_col), text.alias("text"))
    if min_partitions and df.rdd.getNumPartitions() < min_partitions:
        return df.repartition(min_partitions)
    return df


STRICT_ERROR = "line without a JSON object that has a text"


def read_jsonl_strict(spark: SparkSession, path: str) -> DataFrame:
    """Every line must be a JSON object with a ``text`` key.

    One pass: each line is parsed where it is read, and a blank line (of any
    white space), a malformed one or one without text raises when it is."""
    lines = spark.read.text(path)
    parsed = F.from_json("value", "text string", {"mode": "PERMISSIVE"})
    complaint = F.concat(F.lit(f"{STRICT_ERROR} in {path}: "), F.substring("value", 1, 80))
    text = F.coalesce(parsed["text"], F.raise_error(complaint).cast("string"))
    return lines.select(text.alias("text"))


def read_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """S3: blank and whitespace-only lines skipped; malformed lines raise."""
    return spark.read.schema("text string").option("mode", "FAILFAST").json(path)


def line_order(spark: SparkSession, path: str) -> DataFrame:
    """``(value, line_no)``: the lines of text files with their 0-based places
    in file order (files by path).

    A split of a file is read in order by one task; lines are numbered inside
    their split and shifted by the sizes of the splits before it, a table of one
    row per split.  Blank lines count."""
    at = F.col("_metadata.file_path"), F.col("_metadata.file_block_start")
    lines = spark.read.text(path).select("value", at[0].alias("_f"), at[1].alias("_b"), F.monotonically_increasing_id().alias("_m"))
    local = lines.withColumn("_n", F.row_number().over(Window.partitionBy("_f", "_b").orderBy("_m")))
    sizes = spark.read.text(path).select(at[0].alias("_f"), at[1].alias("_b")).groupBy("_f", "_b").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_f", "_b").rowsBetween(Window.unboundedPreceding, -1)  # one row per split
    offsets = sizes.select("_f", "_b", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_off"))
    return local.join(offsets, ["_f", "_b"]).select("value", (F.col("_off") + F.col("_n") - 1).alias("line_no"))


def read_jsonl_in_order(spark: SparkSession, path: str) -> DataFrame:
    """``(text, line_no)`` of the non-blank lines of JSONL files, in file order;
    malformed lines raise."""
    lines = line_order(spark, path).filter(F.trim("value") != "")
    parsed = F.from_json("value", "text string", {"mode": "FAILFAST"})
    return lines.select(parsed["text"].alias("text"), "line_no")


def write_jsonl(df: DataFrame, path: str, text_col: str = "text") -> None:
    """One ``{"text": ...}`` object per line, UTF-8 kept as is."""
    df.select(F.col(text_col).alias("text")).write.mode("overwrite").json(path)


def write_jsonl_ascii(df: DataFrame, path: str, text_col: str = "text") -> None:
    """Non-ASCII written as \\uXXXX escapes."""
    (
        df.select(F.col(text_col).alias("text"))
        .write.mode("overwrite")
        .option("writeNonAsciiCharacterAsCodePoint", "true")
        .json(path)
    )


def dataset_manifest(df: DataFrame, split_col: str = "split") -> DataFrame:
    """``(split, n_rows, columns)`` of a split dataset."""
    cols = ",".join(c for c in df.columns if c != split_col)
    return df.groupBy(split_col).agg(F.count(F.lit(1)).alias("n_rows")).withColumn("columns", F.lit(cols))


def publish_dataset(train: DataFrame, eval_: DataFrame, path: str) -> DataFrame:
    """Write ``train`` and ``eval`` as one parquet dataset partitioned by
    split and report the manifest read back from storage."""
    both = train.withColumn("split", F.lit("train")).unionByName(eval_.withColumn("split", F.lit("eval")))
    both.write.mode("overwrite").partitionBy("split").parquet(path)
    back = train.sparkSession.read.parquet(path)
    return dataset_manifest(back)
