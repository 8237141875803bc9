"""Save / load a learned vocabulary as two parquet tables, and import
a JSON tokenizer artefact (merges written either as "a b" or ["a", "b"];
added tokens overlay the vocabulary, later entries win)."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..operators.tokenizer import MAX_VOCAB_SIZE, Tokenizer


def save_tokenizer(tok: Tokenizer, spark: SparkSession, path: str) -> None:
    tok.vocab_df(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/vocab")
    tok.merges_df(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/merges")


def load_tokenizer(spark: SparkSession, path: str) -> Tokenizer:
    vocab = spark.read.parquet(f"{path}/vocab")
    if vocab.count() > MAX_VOCAB_SIZE:
        raise ValueError("vocabulary larger than supported bound")
    rows = vocab.orderBy("id").collect()
    tokens = [r["token"] for r in rows]
    specials = {r["token"]: r["id"] for r in rows if r["is_special"]}
    t2i = {t: i for i, t in enumerate(tokens)}
    t2i.update(specials)
    mrows = spark.read.parquet(f"{path}/merges").orderBy("rank").collect()
    merges = [(t2i[r["left"]], t2i[r["right"]], r["id"]) for r in mrows]
    return Tokenizer(tokens=tokens, merges=merges, specials=specials)


def export_tokenizer_json(tok: Tokenizer, spark: SparkSession, path: str, pairs: bool = True) -> None:
    """Write a JSON tokenizer file as ``import_tokenizer_json`` reads it; merges
    as ``["a", "b"]`` or, without ``pairs``, as ``"a b"``."""
    merges = [[tok.tokens[l], tok.tokens[r]] for l, r, _ in tok.merges]
    specials = {i: t for t, i in tok.specials.items()}
    said = {
        "added_tokens": [{"id": i, "content": t, "special": True} for i, t in sorted(specials.items())],
        "model": {"type": "BPE", "vocab": {t: i for i, t in enumerate(tok.tokens) if i not in specials}, "merges": merges if pairs else [" ".join(m) for m in merges]},
    }
    spark.createDataFrame([(json.dumps(said, ensure_ascii=False),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def import_tokenizer_json(spark: SparkSession, path: str) -> Tokenizer:
    """Read a JSON tokenizer file (``model.vocab``, ``model.merges``,
    ``added_tokens``) with Spark's JSON functions; the artefact is bounded by
    its vocabulary size.  The vocabulary is a map, so tokens that differ in case
    only are no clash of columns."""
    raw = spark.read.text(path, wholetext=True)
    said = "model struct<vocab: map<string, int>, merges: array<{}>>, added_tokens array<struct<content: string, id: int>>"
    pairs, strings = F.from_json("value", said.format("array<string>")), F.from_json("value", said.format("string"))
    art = raw.select(strings.alias("s"), pairs["model"]["merges"].alias("pairs"))
    vocab = art.select(F.explode(F.map_entries("s.model.vocab")).alias("e")).select(F.col("e.key").alias("token"), F.col("e.value").alias("id"))
    in_pairs = F.col("pairs").isNotNull() & F.exists(F.coalesce("pairs", F.array()), lambda p: p.isNotNull())
    listed = F.when(in_pairs, F.col("pairs")).otherwise(F.transform("s.model.merges", lambda m: F.split(m, " ", 2)))
    merges = art.select(F.posexplode(listed).alias("rank", "m")).select("rank", F.col("m")[0].alias("left"), F.col("m")[1].alias("right"))
    added = art.select(F.explode("s.added_tokens").alias("a")).select(F.col("a.content").alias("token"), F.col("a.id").alias("id"))
    vrows = vocab.collect()
    arows = added.collect()
    if len(vrows) + len(arows) > MAX_VOCAB_SIZE:
        raise ValueError("vocabulary larger than supported bound")
    by_id: dict[int, str] = {}
    t2i: dict[str, int] = {}
    for r in vrows:
        by_id[r["id"]] = r["token"]
        t2i[r["token"]] = r["id"]
    specials = {}
    for r in arows:  # added tokens overlay the vocabulary
        by_id[r["id"]] = r["token"]
        t2i[r["token"]] = r["id"]
        specials[r["token"]] = r["id"]
    tokens = [by_id.get(i, "") for i in range(max(by_id) + 1)]
    merges_l = [(t2i[r["left"]], t2i[r["right"]], t2i[r["left"] + r["right"]]) for r in merges.orderBy("rank").collect()]
    return Tokenizer(tokens=tokens, merges=merges_l, specials=specials)
