"""Ordering, sampling and splitting.

The order of rows is a pure function of the seed and the row: ``md5(seed:id)``,
then (for repeated ids) ``md5(text)``; rows alike in both are interchangeable.
A null id counts as the empty one, so no row is lost.  Thresholds are found on
the id key alone; texts are hashed only where a threshold cuts through a
repeated id.  The exact global rank is computed without a single-partition window: rows are
bucketed on the leading hex digits of the (uniform) md5 key, bucket sizes are
counted (partial aggregation, at most ``16**digits`` rows), turned into
running offsets on that tiny table, broadcast, and added to a ``row_number``
inside each bucket.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import WS_CLASS, clean_text, wrap_clean, wrap_sample

DEFAULT_SEED = 42
BUCKET_DIGITS = 4  # 65,536 buckets: the offset table stays ~1 MB


def shuffle_key(seed: int, id_col: str | Column) -> Column:
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(c.cast("string"), F.lit(""))))


def text_key(text_col: str | None) -> Column:
    """Orders rows of one id key; only needed where an id repeats."""
    return F.md5(F.coalesce(F.col(text_col).cast("string"), F.lit(""))) if text_col else F.lit("")


def check_fraction(ratio: float) -> None:
    if not (ratio >= 0 and ratio < 1):
        raise ValueError(f"the share of evaluation rows lies in [0, 1), not at {ratio}")


def check_rows(n: int | None, needed: bool = False) -> None:
    if (n is None and needed) or (n is not None and n < 1):
        raise ValueError(f"a sample has at least one row, not {n}")


def global_rank(
    df: DataFrame,
    key: Column,
    tiebreak: list[str] | None = None,
    rank_col: str = "rank",
    total_col: str | None = None,
    digits: int = BUCKET_DIGITS,
) -> DataFrame:
    """Exact 1-based rank of every row by ``(key, *tiebreak)``.

    ``key`` must be a uniformly distributed hex string (an md5), so the
    buckets taken from its first ``digits`` characters are balanced.  The
    offsets table has at most ``16**digits`` rows, a fixed bound, so it is
    broadcast.  If ``total_col`` is given the total row count is attached too.
    """
    tiebreak = tiebreak or []
    keyed = df.withColumn("_rk_key", key).withColumn("_rk_bucket", F.substring("_rk_key", 1, digits))
    # the input is read twice (bucket sizes, numbering): rank a table that is
    # cheap to read (a scan or a materialised intermediate), not a long plan
    sizes = keyed.groupBy("_rk_bucket").agg(F.count(F.lit(1)).alias("_rk_n"))
    # bounded table (<= 16**digits rows): a global window here is cheap
    w_all = Window.orderBy("_rk_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_rk_bucket",
        F.coalesce(F.sum("_rk_n").over(w_all), F.lit(0)).alias("_rk_off"),
        *([F.sum("_rk_n").over(Window.partitionBy()).alias(total_col)] if total_col else []),
    )
    w_bucket = Window.partitionBy("_rk_bucket").orderBy("_rk_key", *tiebreak)
    ranked = keyed.withColumn("_rk_rn", F.row_number().over(w_bucket)).join(
        F.broadcast(offsets), "_rk_bucket"
    )
    return ranked.withColumn(rank_col, (F.col("_rk_off") + F.col("_rk_rn")).cast("long")).drop(
        "_rk_key", "_rk_bucket", "_rk_rn", "_rk_off"
    )


def seeded_shuffle(
    df: DataFrame, seed: int = DEFAULT_SEED, id_col: str = "doc_id", total_col: str | None = None, text_col: str = "text"
) -> DataFrame:
    """Deterministic shuffle: adds ``rank`` = position in the shuffled order.

    Independent of partitioning; the multiset of rows is unchanged.
    """
    tied = df.withColumn("_rk_tie", text_key(text_col if text_col in df.columns else None))
    return global_rank(tied, shuffle_key(seed, id_col), ["_rk_tie", id_col], total_col=total_col).drop("_rk_tie")


def has_text(col: str) -> Column:
    """True when cleaning leaves something: the text holds a character that
    is not whitespace.  One short-circuiting search instead of two
    whole-text replacements, so it is cheap wherever the optimiser pushes it
    (it may run below a repartition, inside the scan)."""
    return F.coalesce(F.col(col).rlike("[^" + WS_CLASS[1:-1] + "]"), F.lit(False))


def clean_nonempty(df: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """P1 + P2: cleaned text, empty rows dropped."""
    return df.filter(has_text(text_col)).select(id_col, clean_text(text_col).alias(text_col))


FINAL_BUCKET_ROWS = 10_000  # at most this many keys are ever ordered at once
KEY_LENGTH = 32  # hex digits of a key


def bucket_counts(keyed: DataFrame, digits: int) -> list[tuple[str, int]]:
    """Rows per leading hex digits of ``_rk_key``: at most ``16**digits``."""
    sizes = keyed.groupBy(F.substring("_rk_key", 1, digits)).agg(F.count(F.lit(1)))
    return sorted((r[0], r[1]) for r in sizes.collect())


def kth_key(keyed: DataFrame, k: int, counts: list[tuple[str, int]], digits: int) -> tuple[str, int, int] | None:
    """The k-th smallest ``_rk_key`` (1-based), how many rows of that key are
    among the first k, and how many rows have it.

    ``counts`` are the first-level bucket sizes.  The bucket holding the k-th
    key is refined by further hex digits until it holds at most
    ``FINAL_BUCKET_ROWS`` rows or one key; what then reaches the driver is
    distinct keys with counts, at most that many."""
    level, prefix_len = counts, digits
    while True:
        chosen = None
        for bucket, n in level:
            if k <= n:
                chosen = (bucket, n)
                break
            k -= n
        if chosen is None:
            return None
        bucket, n = chosen
        inside = keyed.filter(F.substring("_rk_key", 1, prefix_len) == bucket)
        if n > FINAL_BUCKET_ROWS and prefix_len < KEY_LENGTH:
            prefix_len = min(KEY_LENGTH, prefix_len + digits)
            level = bucket_counts(inside, prefix_len)
            continue
        for row in inside.groupBy("_rk_key").agg(F.count(F.lit(1)).alias("n")).orderBy("_rk_key").collect():
            if k <= row["n"]:
                return row["_rk_key"], k, row["n"]
            k -= row["n"]
        return None


@dataclass(frozen=True)
class Bound:
    """Where the first k rows of the seeded order end: at an id key and, when
    that key's rows lie on both sides, at one of their text keys.  ``take`` of
    the ``same`` rows alike in both are among the first k."""

    key: str
    text: str | None
    take: int
    same: int

    def inside(self, tie: Column, alike: bool) -> Column:
        """Rows before the bound; with ``alike`` also those at it."""
        key = F.col("_rk_key")
        if self.text is None:
            return key <= self.key
        at = (tie <= self.text) if alike else (tie < self.text)
        return F.when(key == self.key, at).otherwise(key < self.key)  # texts of one id are hashed

    def at(self, tie: Column) -> Column:
        return F.when(F.col("_rk_key") == self.key, tie == self.text).otherwise(F.lit(False))


def bound_of(keyed: DataFrame, k: int, counts: list[tuple[str, int]], digits: int, text_col: str | None) -> Bound | None:
    """The bound after ``k`` rows.  The id keys decide; only where the k-th one
    repeats, and is cut through, are the texts of its rows looked at."""
    found = kth_key(keyed.select("_rk_key"), k, counts, digits)
    if found is None:
        return None
    key, take, same = found
    if take == same:
        return Bound(key, None, take, same)
    ties = keyed.filter(F.col("_rk_key") == key).select(text_key(text_col).alias("_rk_key"))
    text, take, same = kth_key(ties, take, bucket_counts(ties, digits), digits)
    return Bound(key, text, take, same)


def cut_rows(df: DataFrame, bound: Bound, tie: Column) -> tuple[DataFrame, DataFrame | None]:
    """The first rows of the order, and the one row, if any, that is repeated on
    both sides of the bound (rows alike in id and text are interchangeable)."""
    if bound.take == bound.same:
        return df.filter(bound.inside(tie, True)), None
    return df.filter(bound.inside(tie, False)), df.filter(bound.at(tie)).limit(1)


def times(one: DataFrame, n: int) -> DataFrame:
    """A row, repeated."""
    return one.withColumn("_rk_copy", F.explode(F.sequence(F.lit(1), F.lit(n)))).drop("_rk_copy")


def first_rows(df: DataFrame, bound: Bound | None, tie: Column) -> DataFrame:
    """The rows (with ``_rk_key``) up to a bound."""
    if bound is None:
        return df.limit(0)
    before, one = cut_rows(df, bound, tie)
    return before if one is None else before.unionByName(times(one, bound.take))


def sample_n(df: DataFrame, n: int, seed: int = DEFAULT_SEED, id_col: str = "doc_id", text_col: str = "text", digits: int = BUCKET_DIGITS) -> DataFrame:
    """Exactly ``min(n, count)`` rows: the first ``n`` of the seeded order, with
    ``rank``.  The n-th key is found on the narrow id key; only the rows up to
    it are ranked, so the rest of the table is filtered where it lies."""
    check_rows(n, needed=True)
    keyed = df.withColumn("_rk_key", shuffle_key(seed, id_col))
    keys = keyed.select("_rk_key")
    counts = bucket_counts(keys, digits)
    if n < sum(c for _, c in counts):
        keyed = keyed.filter(F.col("_rk_key") <= kth_key(keys, n, counts, digits)[0])
    return seeded_shuffle(keyed.drop("_rk_key"), seed, id_col, text_col=text_col).filter(F.col("rank") <= n)


def split_by_threshold(
    df: DataFrame,
    n_samples: int | None = None,
    eval_ratio: float = 0.05,
    seed: int = DEFAULT_SEED,
    text_col: str = "text",
    id_col: str = "doc_id",
    digits: int = BUCKET_DIGITS,
) -> DataFrame:
    """Same membership as ``train_eval_split`` without ranking every row.

    Eval is "the first floor(n * ratio) keys of the seeded order", i.e. every
    key up to the k-th smallest one.  That threshold comes from bucket counts
    of the id key (at most ``16**digits`` rows) and one top-j inside a single
    bucket, so the documents themselves are only filtered and labelled row by
    row: no shuffle of the text, and no text hashed unless the boundary id
    repeats.  Returns ``(id, text, split)``.
    """
    check_fraction(eval_ratio)
    check_rows(n_samples)
    items = df.filter(has_text(text_col)).select(
        id_col, clean_text(text_col).alias(text_col), shuffle_key(seed, id_col).alias("_rk_key"), F.col(text_col).alias("_rk_raw")
    )
    tie = text_key("_rk_raw")
    counts = bucket_counts(items.select("_rk_key"), digits)
    total = sum(n for _, n in counts)
    n = total if n_samples is None else min(total, n_samples)
    n_eval = int(n * float(eval_ratio))
    whole = items if n == total else first_rows(items, bound_of(items, n, counts, digits, "_rk_raw"), tie)
    bound = bound_of(items, n_eval, counts, digits, "_rk_raw") if n_eval else None
    if bound is None:
        return whole.withColumn("split", F.lit("train")).drop("_rk_key", "_rk_raw")
    if bound.take == bound.same:
        return whole.withColumn("split", F.when(bound.inside(tie, True), "eval").otherwise("train")).drop("_rk_key", "_rk_raw")
    # rows alike in id and text on both sides of the cut
    one = items.filter(bound.at(tie)).limit(1)
    alike = whole.filter(bound.at(tie)).count()
    cut = times(one, bound.take).withColumn("split", F.lit("eval"))
    if alike > bound.take:
        cut = cut.unionByName(times(one, alike - bound.take).withColumn("split", F.lit("train")))
    rest = whole.filter(~bound.at(tie))
    labelled = rest.withColumn("split", F.when(bound.inside(tie, False), "eval").otherwise("train"))
    return labelled.unionByName(cut).drop("_rk_key", "_rk_raw")


def train_eval_split(
    df: DataFrame,
    n_samples: int | None = None,
    eval_ratio: float = 0.05,
    seed: int = DEFAULT_SEED,
    text_col: str = "text",
    id_col: str = "doc_id",
) -> DataFrame:
    """Clean, drop empties, shuffle, optionally sample, then split.

    Eval takes the first ``floor(n * ratio)`` ranks (in double arithmetic),
    train the rest.  Duplicates survive, as in the reference.
    Returns ``(id, text, rank, split)``.
    """
    check_fraction(eval_ratio)
    check_rows(n_samples)
    # rows of one id are told apart by the text as it stands: cleaning every
    # text only to break ties would cost more than all the rest
    tie = text_key(text_col).alias("_rk_tie")
    items = df.filter(has_text(text_col)).select(id_col, clean_text(text_col).alias(text_col), tie)
    ranked = global_rank(items, shuffle_key(seed, id_col), ["_rk_tie", id_col], total_col="_total").drop("_rk_tie")
    n = F.col("_total")
    if n_samples is not None:
        ranked = ranked.filter(F.col("rank") <= n_samples)
        n = F.least(n, F.lit(n_samples).cast("long"))
    n_eval = F.floor(n.cast("double") * F.lit(float(eval_ratio)).cast("double"))
    return ranked.withColumn("split", F.when(F.col("rank") <= n_eval, "eval").otherwise("train")).drop("_total")


def split_summary(split_df: DataFrame) -> DataFrame:
    """Row count per split plus a ``total`` row."""
    return split_df.rollup("split").agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.coalesce("split", F.lit("total")).alias("split"), "n_rows"
    )


def split_overlap(split_df: DataFrame, text_col: str = "text") -> DataFrame:
    """Number of texts that occur in both splits and of rows that hold
    them (partial counts per text's digest; texts are not shuffled)."""
    per_text = split_df.groupBy(F.sha2(F.col(text_col), 256).alias("sha")).agg(
        F.count(F.lit(1)).alias("n"), F.min("split").alias("lo"), F.max("split").alias("hi")
    )
    both = per_text.filter(F.col("lo") != F.col("hi"))
    return both.agg(F.count(F.lit(1)).alias("n_texts"), F.sum("n").alias("n_rows"))


def tokenizer_corpus(split_df: DataFrame, train_only: bool = False, id_col: str = "doc_id", cleaned: bool = False) -> DataFrame:
    """Wrapped samples the vocabulary is learned on: train + eval (the
    reference learns on both), or train only.  ``cleaned``: the texts are, as
    those of a split are, and are not cleaned again."""
    src = split_df.filter(F.col("split") == "train") if train_only else split_df
    return src.select(id_col, "split", (wrap_clean if cleaned else wrap_sample)("text").alias("sample"))
