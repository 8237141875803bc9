"""Training-set shaping (D1–D7): truncate, filter, shift, batch, pad.

Batches are assigned from an exact global rank (md5 key per epoch), so no
step needs the whole split in one partition; padding needs the maximum
length per batch, a group of at most ``batch_size`` rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import EOS_ID, BOS_ID, PAD_ID
from ..session import written
from .ranking import DEFAULT_SEED, global_rank, shuffle_key
from .tokenizer import pretokenise_words

DEFAULT_MAX_LEN = 512  # dataset class default
TRAIN_MAX_LEN = 128  # what training passes (model context)
BATCH_SIZE = 32


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# ---- word ids as tokens (lets SQL engines check the shaping exactly) ------

def word_vocab(split_df: DataFrame, text_col: str = "text") -> DataFrame:
    """Distinct pre-tokens of the cleaned corpus with dense ids from 3 up,
    ordered by ``md5(word)``; 0, 1, 2 stay pad / start / end."""
    return _ranked_words(split_df.select(F.explode(pretokenise_words(text_col)).alias("word")))


def _ranked_words(words: DataFrame) -> DataFrame:
    # the ranking reads its input twice (bucket sizes, numbering): write the
    # distinct words once rather than pre-tokenising the corpus twice
    words = words.distinct().checkpoint(eager=True)
    ranked = global_rank(words, F.md5("word"), ["word"], rank_col="_r")
    # materialised, the vocabulary carries real size statistics, so the
    # planner picks the word -> id join up front: a size-checked broadcast
    # while it is small, a shuffle join (with AQE skew splitting) beyond
    return ranked.select("word", (F.col("_r") + F.lit(EOS_ID)).cast("int").alias("token")).checkpoint(eager=True)


CHUNK_WORDS = 1_000_000  # words of the documents that share one list of words


def _chunked(batches):
    """Task side: documents in chunks; a chunk is one row with its distinct
    words and one row per document with the words' places in that list."""
    chunk = TaskContext.get().partitionId() << 32
    for batch in batches:
        lists = batch.column(2)
        ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64))
        begin = 0
        while begin < len(ends):
            before = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, before + CHUNK_WORDS, side="right")))
            part = lists.slice(begin, end - begin)
            words = part.flatten().dictionary_encode()
            offsets = np.concatenate([[0], ends[begin:end] - before]).astype(np.int32)
            n = end - begin
            ids = pa.ListArray.from_arrays(pa.array(offsets), words.indices.cast(pa.int32()))
            known = pa.ListArray.from_arrays(pa.array([0, len(words.dictionary)], pa.int32()), words.dictionary.cast(pa.string()))
            key = pa.array(np.full(n, chunk, np.int64))
            columns = [key, batch.column(0).slice(begin, n), batch.column(1).slice(begin, n).cast(pa.string()), ids, pa.nulls(n, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, ["chunk", "id", "split", "at", "words"])
            columns = [key.slice(0, 1), pa.nulls(1, batch.column(0).type), pa.nulls(1, pa.string()), pa.nulls(1, pa.list_(pa.int32())), known]
            yield pa.RecordBatch.from_arrays(columns, ["chunk", "id", "split", "at", "words"])
            begin, chunk = end, chunk + 1


def _placed(docs: pa.Table, words: pa.Table) -> pa.Table:
    """A chunk's documents with the ids of its words, -1 for an unknown one."""
    at = docs.column("at").combine_chunks()
    place, token = (words.column(c).to_numpy() for c in ("place", "token"))
    flat = at.flatten().to_numpy(zero_copy_only=False)
    of = np.full(max(place.max(initial=-1), flat.max(initial=-1)) + 1, -1, np.int32)
    of[place] = token
    offsets = np.concatenate([[0], np.cumsum(pc.list_value_length(at).to_numpy(zero_copy_only=False))]).astype(np.int32)
    ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(of[flat]))
    return pa.table({"id": docs.column("id"), "split": docs.column("split"), "ids": ids})


def word_sequences(split_df: DataFrame, vocab: DataFrame | None = None, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``(id, split, ids)`` with ids = [start] + word ids in order + [end].

    Documents are dealt into chunks of bounded size that list their distinct
    words, and are written with the words' places in that list.  The word -> id
    join is a shuffle join on those lists, not on every word of the corpus; a
    chunk's documents then meet its ids, and rows of one id are put together,
    their words by place."""
    kind = split_df.schema[id_col].dataType
    schema = f"chunk bigint, id {kind.simpleString()}, split string, at array<int>, words array<string>"
    made = split_df.select(F.col(id_col).alias("id"), "split", pretokenise_words(text_col).alias("w"))
    chunks = written(made.mapInArrow(_chunked, schema), "word_places")
    words = chunks.filter(F.col("words").isNotNull()).select("chunk", F.posexplode("words").alias("place", "word"))
    vocab = vocab if vocab is not None else _ranked_words(words.select("word"))
    found = words.join(vocab, "word").select("chunk", "place", F.col("token").cast("int").alias("token"))
    again = chunks.toDF(*chunks.columns)  # a cogroup needs columns of its own on each side
    docs = again.filter(F.size("at") > 0).select("chunk", "id", "split", "at")
    placed = docs.groupBy("chunk").cogroup(found.groupBy("chunk")).applyInArrow(_placed, f"id {kind.simpleString()}, split string, ids array<int>")
    grouped = placed.groupBy("id", "split").agg(F.collect_list("ids").alias("_l"))
    # rows of one id: their words by place, then by word id
    at = lambda x: F.transform(x, lambda token, pos: F.struct(pos.alias("pos"), token.alias("token")))
    mixed = F.transform(F.sort_array(F.flatten(F.transform("_l", at))), lambda s: s["token"])
    body = F.filter(F.when(F.size("_l") == 1, F.get("_l", F.lit(0))).otherwise(mixed), lambda x: x >= 0)
    # cleaned non-empty text always yields at least one pre-token, so every
    # document of the split is present here
    known = grouped.select(F.col("id").alias(id_col), "split", body.alias("_b")).filter(F.size("_b") > 0)
    return known.select(id_col, "split", F.concat(F.array(F.lit(BOS_ID)), "_b", F.array(F.lit(EOS_ID))).alias("ids"))


# ---- D1–D3 -----------------------------------------------------------------

def truncate_ids(col, max_len: int = DEFAULT_MAX_LEN) -> Column:
    """Keep the first ``max_len`` ids."""
    return F.slice(_c(col), 1, max_len)


def drop_short(df: DataFrame, ids_col: str = "ids", min_len: int = 2) -> DataFrame:
    """A sequence needs at least two ids to give one (x, y) pair."""
    return df.filter(F.size(ids_col) >= min_len)


def truncate_filter(df: DataFrame, max_len: int = TRAIN_MAX_LEN, ids_col: str = "ids") -> DataFrame:
    return drop_short(df.withColumn(ids_col, truncate_ids(ids_col, max_len)), ids_col)


def windows(df: DataFrame, max_len: int = TRAIN_MAX_LEN, ids_col: str = "ids", id_col: str = "doc_id") -> DataFrame:
    """D1 + D2 without loss: consecutive windows of at most ``max_len`` ids that
    share one id, so every (context, next) pair is in exactly one window.
    Adds ``win`` (0-based) and ``seq_id`` (id and window)."""
    if max_len < 2:
        raise ValueError("a window needs at least two ids")
    step = max_len - 1
    last = F.floor((F.size(ids_col) - 2) / step).cast("int")
    each = drop_short(df, ids_col).withColumn("win", F.explode(F.sequence(F.lit(0), last)))
    cut = each.withColumn(ids_col, F.slice(F.col(ids_col), F.col("win") * step + 1, max_len))
    return cut.withColumn("seq_id", F.concat_ws(":", F.col(id_col).cast("string"), F.col("win").cast("string")))


def shift_pairs(df: DataFrame, ids_col: str = "ids") -> DataFrame:
    """D3: inputs ``x = ids[:-1]`` and targets ``y = ids[1:]``."""
    n = F.size(ids_col) - 1
    return df.withColumn("x", F.slice(ids_col, 1, n)).withColumn("y", F.slice(ids_col, 2, n))


# ---- D4–D7 -----------------------------------------------------------------

def assign_batches(
    df: DataFrame,
    batch_size: int = BATCH_SIZE,
    shuffle: bool = True,
    seed: int = DEFAULT_SEED,
    epoch: int = 0,
    id_col: str = "doc_id",
) -> DataFrame:
    """``batch_id`` and ``row_in_batch`` for one epoch.

    Shuffled sets are ordered by ``md5(seed:epoch:id)`` (a new order each
    epoch); unshuffled sets keep file order, which for a split written by
    ``train_eval_split`` is ``md5(seed:id)`` order.  The last short batch is
    kept.
    """
    key = F.md5(F.concat(F.lit(f"{seed}:{epoch}:"), F.col(id_col).cast("string"))) if shuffle else shuffle_key(seed, id_col)
    ranked = global_rank(df, key, [id_col], rank_col="_order")
    return ranked.select(
        "*",
        F.lit(epoch).alias("epoch"),
        F.floor((F.col("_order") - 1) / batch_size).cast("int").alias("batch_id"),
        ((F.col("_order") - 1) % batch_size).cast("int").alias("row_in_batch"),
    ).drop("_order")


def batches_in_order(df: DataFrame, position: str, batch_size: int = BATCH_SIZE) -> DataFrame:
    """D4, unshuffled: batches that follow a dense 0-based position (as
    ``line_no`` of ``read_jsonl_in_order``): plain arithmetic, no exchange."""
    p = F.col(position)
    return df.select("*", F.floor(p / batch_size).cast("int").alias("batch_id"), (p % batch_size).cast("int").alias("row_in_batch"))


def pad_batch(df: DataFrame, pad_id: int = PAD_ID, keys: tuple[str, ...] = ("split", "epoch", "batch_id")) -> DataFrame:
    """Right-pad ``x`` and ``y`` to the longest ``x`` of their batch.

    The batch maximum is a window over at most ``batch_size`` rows.
    """
    w = Window.partitionBy(*keys)
    L = F.max(F.size("x")).over(w)
    out = df.withColumn("padded_len", L)
    fill = lambda c: F.concat(F.col(c), F.array_repeat(F.lit(pad_id), F.col("padded_len") - F.size(c)))
    return out.withColumn("x_pad", fill("x")).withColumn("y_pad", fill("y"))


def padding_report(pairs: DataFrame, keys: tuple[str, ...] = ("split", "batch_id")) -> DataFrame:
    """Rows, real positions and padding of every batch.  The padding is
    what lacks to the longest row, so a grouping with partial sums suffices."""
    size = F.size("x").cast("bigint")
    sums = pairs.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), F.sum(size).alias("n_real"), F.max(size).alias("_longest"))
    return sums.select(*keys, "n_rows", "n_real", (F.col("n_rows") * F.col("_longest") - F.col("n_real")).alias("n_pad"))


def step_plan(train: DataFrame, max_steps: int, batch_size: int = BATCH_SIZE) -> DataFrame:
    """``(step, epoch, batch_id)`` — epochs repeat over the train batches
    until the step budget ends, possibly mid-epoch.  Only the number of
    sequences matters, so they are counted, not batched."""
    n_batches = -(-train.count() // batch_size)
    if n_batches == 0:
        raise ValueError("empty training set: the step loop would never end")
    step = F.col("id")
    return train.sparkSession.range(max_steps).select(
        step.alias("step"), F.floor(step / n_batches).alias("epoch"), (step % n_batches).alias("batch_id")
    )


def dataset_sizes(seqs: DataFrame) -> DataFrame:
    """Usable sequences per split (after truncate + drop-short)."""
    return seqs.groupBy("split").agg(F.count(F.lit(1)).alias("n_sequences"))


def ids_text(col) -> Column:
    """Space-joined ids, for stable reports and engine-neutral comparison."""
    return F.array_join(_c(col), " ")
