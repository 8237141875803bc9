"""Next-token model (M1–M10), re-aimed from the neural network as an
interpolated n-gram model (Jelinek–Mercer):

    P_k(w | h) = lam * c(h, w) / c(h) + (1 - lam) * P_{k-1}(w | h'),   P_0 = 1 / V
    and P_k(w | h) = P_{k-1}(w | h') when c(h) = 0.

"Logit" is ln P.  Counting is a partial aggregate over exploded positions;
probabilities are bottom-up equi-joins; sampling (temperature, top-k with
ties, softmax, inverse-CDF draw) is work per prompt that a hot prompt cannot pile up in
one task.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import EOS_ID, PAD_ID
from ..session import scratch_path, shuffles_released, working_tables, written
from . import follower_arrays

DEFAULT_ORDER = 3
DEFAULT_LAMBDA = 0.5
TOP_K = 50
TEMPERATURE = 0.7
MAX_NEW_TOKENS = 64
MAX_CONTEXT = 128


TOTAL = -1  # stands for all tokens: a context's total in the look-up table


def _written(df: DataFrame, name: str, *by: str, ends: int | None = 1) -> DataFrame:
    """``df`` written once under the shared folder and read back."""
    return written(df, name, *by, ends=ends)


def positions(seqs: DataFrame, order: int = DEFAULT_ORDER, ids_col: str = "ids", keys: tuple[str, ...] = ()) -> DataFrame:
    """``(*keys, p, token, hist)`` of every target: the token at place p + 1 and
    the up to ``order - 1`` ids before it, space-joined.

    Ids are read by place, so that a row carries its few ids and never the
    sequence; pad ids and place 0 are no targets."""
    ids = F.col(ids_col)

    def target(p: Column) -> Column:
        before = [F.get(ids, p - j).cast("string") for j in range(order - 2, -1, -1)]  # null before the start
        return F.struct(p.alias("p"), F.get(ids, p + 1).alias("token"), F.concat_ws(" ", *before).alias("hist"))

    targets = F.when(F.size(ids) >= 2, F.transform(F.sequence(F.lit(0), F.size(ids) - 2), target))
    return seqs.select(*keys, F.explode(targets).alias("t")).select(*keys, "t.*").filter(F.col("token") != PAD_ID)


GRAM_CHUNK = 4_000_000  # ids whose examples a task counts together


def _gram_counts(order: int):
    """Task side: ``(token, h1, h2, ..., n)`` of the examples of chunks of
    sequences, ``h1`` the id right before the token; null before the start."""
    names = ["token", *[f"h{j}" for j in range(1, order)]]

    def counted(lists: pa.ListArray) -> pa.RecordBatch:
        found = lists.flatten().dictionary_encode()
        code = pc.add(found.indices.cast(pa.int64()), 1).fill_null(0).to_numpy(zero_copy_only=False)  # 0: null
        base = len(found.dictionary) + 1
        sizes = pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        place = np.arange(len(code)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        pad = pc.index(found.dictionary, PAD_ID).as_py() + 1  # 0 without a pad id
        at = np.flatnonzero((place >= 1) & (code != 0) & (code != pad))
        columns = [code[at]] + [np.where(place[at] >= j, code[np.maximum(at - j, 0)], 0) for j in range(1, order)]
        if found.null_count:  # a null id is no part of a context: those before it move up
            for _ in names[2:]:
                for j in range(1, order - 1):
                    gap = columns[j] == 0
                    columns[j], columns[j + 1] = np.where(gap, columns[j + 1], columns[j]), np.where(gap, 0, columns[j + 1])
        if base**order <= max(len(code), 1 << 16):  # few ids: a cell for every gram there can be
            cells = np.zeros(len(at), np.int64)
            for x in columns:
                cells = cells * base + x
            n = np.bincount(cells, minlength=1)
            cells = np.flatnonzero(n)
            n, columns = n[cells], [cells // base ** (order - 1 - j) % base for j in range(order)]
        elif base**order < 1 << 63:  # a gram is one number; rows in order are also smaller when compressed
            cells = columns[0]
            for x in columns[1:]:
                cells = cells * base + x
            cells.sort()
            first = np.flatnonzero(np.diff(cells, prepend=-1))
            n, cells = np.diff(first, append=len(cells)), cells[first]
            columns = []
            for _ in range(order):
                cells, x = np.divmod(cells, base)
                columns.insert(0, x)
        else:
            table = pa.table(dict(zip(names, columns, strict=True))).group_by(names, use_threads=False).aggregate([([], "count_all")])
            n, columns = table.column("count_all").to_numpy(), [table.column(x).to_numpy() for x in names]
        ids = [found.dictionary.take(pa.array(x - 1, mask=x == 0)) for x in columns]
        return pa.RecordBatch.from_arrays([*ids, pa.array(n, pa.int64())], [*names, "n"])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            lists = batch.column(0)
            ends = np.cumsum(pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
            begin = 0
            while begin < len(ends):
                before = ends[begin - 1] if begin else 0
                end = max(begin + 1, int(np.searchsorted(ends, before + GRAM_CHUNK - size, side="right")))
                held.append(lists.slice(begin, end - begin))
                size += int(ends[end - 1] - before)
                begin = end
                if begin < len(ends) or size >= GRAM_CHUNK:
                    yield counted(pa.concat_arrays(held))
                    held, size = [], 0
        if held:
            yield counted(pa.concat_arrays(held))

    return run


def ngram_counts(seqs: DataFrame, order: int = DEFAULT_ORDER, ids_col: str = "ids") -> DataFrame:
    """M1: ``(order, ctx, token, n)`` over the (context -> next) examples of
    the shifted pairs; contexts are space-joined ids, '' for order 1.

    Examples are counted once, with their longest context and as numbers, first
    in the tasks, and written; a lower order adds up these counts.  Contexts become
    text at the end."""
    out = None
    for k, held, rows in _counts_by_order(seqs, order, ids_col):
        rows = rows.select(F.lit(k).alias("order"), _context_text(held), "token", "n")
        out = rows if out is None else out.unionByName(rows)
    return out


def _counts_by_order(seqs: DataFrame, order: int, ids_col: str) -> list[tuple[int, list[str], DataFrame]]:
    """For every order its context's columns (the nearest id first) and its
    counts ``(token, *context, n)``, all ids as numbers."""
    names = [f"h{j}" for j in range(1, order)]
    kind = seqs.schema[ids_col].dataType.elementType.simpleString()
    schema = ", ".join(f"{x} {kind}" for x in ["token", *names]) + ", n bigint"
    longest = seqs.select(ids_col).mapInArrow(_gram_counts(order), schema).groupBy("token", *names).agg(F.sum("n").alias("n"))
    longest = _written(longest, "ngram_longest")
    out = []
    for k in range(1, order + 1):
        held = names[: k - 1]
        rows = longest.filter(F.col(held[-1]).isNotNull()) if held else longest
        if k < order:
            rows = rows.groupBy("token", *held).agg(F.sum("n").alias("n"))
        out.append((k, held, rows))
    return out


def _context_text(held: list[str]) -> Column:
    text = F.concat_ws(" ", *[F.col(h).cast("string") for h in reversed(held)]) if held else F.lit("")
    return text.alias("ctx")


def fit(seqs: DataFrame, order: int = DEFAULT_ORDER, ids_col: str = "ids") -> DataFrame:
    """M1 as a model: the count table, written once, partitioned by order, so
    that whoever reads one order scans that order only."""
    with working_tables(seqs.sparkSession):  # the longest contexts' counts are not needed any more then
        return _written(ngram_counts(seqs, order, ids_col), "ngram_counts", "order", ends=2)


def context_totals(counts: DataFrame) -> DataFrame:
    return counts.groupBy("order", "ctx").agg(F.sum("n").alias("n_ctx"))


NO_ID = -1  # stands for a place before the start


def _with_near_ids(df: DataFrame, order: int, text_col: str) -> DataFrame:
    """``df`` with the ids of a space-joined context as numbers ``_h1``, ``_h2``,
    ..., the nearest first; NO_ID where there is none."""
    ids = F.when(F.col(text_col) != "", F.split(text_col, " ").cast("array<bigint>"))
    df = df.withColumn("_ids", ids)
    return df.withColumns({f"_h{j}": F.coalesce(F.get("_ids", F.size("_ids") - j), F.lit(NO_ID).cast("bigint")) for j in range(1, order)}).drop("_ids")


def ngram_probabilities(counts: DataFrame, vocab_size: int, order: int = DEFAULT_ORDER, lam: float = DEFAULT_LAMBDA) -> DataFrame:
    """M1: interpolated ``p`` for every observed ``(order, ctx, token)``.

    Bottom up, with contexts as numbers, which become text again at the end: an
    order's counts meet their contexts' totals in one join, written once, and then
    the order below, which is written once too, so no level is worked out again
    for the next one or for the union.  Order 1 has a single context, whose total
    is one value.  The result reads the tables written here, not ``counts``.
    """
    lam_c = F.lit(float(lam))
    first = counts.filter(F.col("order") == 1).select("token", "n")
    p1 = first.withColumn("n_ctx", first.agg(F.sum("n")).scalar())
    p1 = p1.withColumn("p", lam_c * F.col("n") / F.col("n_ctx") + (1 - lam_c) * F.lit(1.0 / vocab_size))
    out = [([], _written(p1, "ngram_p1", ends=None))]
    for k in range(2, order + 1):
        held = [f"_h{j}" for j in range(1, k)]
        own = _with_near_ids(counts.filter(F.col("order") == k), k, "ctx").select("token", *held, "n")
        with working_tables(counts.sparkSession):
            totals = own.groupBy(*held).agg(F.sum("n").alias("n_ctx"))
            own = _written(own.join(totals, held).select("token", *held, "n", "n_ctx"), "ngram_totals", ends=1 if k < order else None)
            pk = own.join(out[-1][1].select("token", *held[:-1], F.col("p").alias("_lp")), ["token", *held[:-1]])
            pk = pk.withColumn("p", lam_c * F.col("n") / F.col("n_ctx") + (1 - lam_c) * F.col("_lp")).drop("_lp")
            out.append((held, _written(pk, f"ngram_p{k}", ends=None) if k < order else pk))
    rows = [pk.select(F.lit(k).alias("order"), _context_text(held), "token", "n", "n_ctx", "p") for k, (held, pk) in enumerate(out, 1)]
    return reduce(DataFrame.unionByName, rows)


def score_grams(grams: DataFrame, counts: DataFrame, vocab_size: int, order: int = DEFAULT_ORDER, lam: float = DEFAULT_LAMBDA) -> DataFrame:
    """M2 for distinct ``grams (hist, token)``: ``(hist, token, nll)``, written once.

    A gram asks for its count and its context's total at every order; all
    questions meet the counts and totals, contexts being numbers on both sides, in
    one join on the whole key and come back in one grouping.  A context that a
    third of all grams share is one unique row of the totals, so AQE may split its
    questions."""
    near = [f"_h{j}" for j in range(1, order)]
    known = _with_near_ids(counts.filter(F.col("order") <= order), order, "ctx").select("order", *near, F.col("token").cast("bigint").alias("asked"), "n")
    total = F.lit(TOTAL).cast("bigint")
    # the total of a context is kept under the token TOTAL
    totals = known.groupBy("order", *near).agg(F.sum("n").alias("n")).select("order", *near, total.alias("asked"), "n")
    n1 = counts.filter(F.col("order") == 1).agg(F.sum("n")).scalar()
    token = F.col("token").cast("bigint")

    def question(slot: str, k: int, what: Column) -> Column:
        held = [F.col(h) if j < k else F.lit(NO_ID).cast("bigint") for j, h in enumerate(near, 1)]
        return F.struct(F.lit(slot).alias("slot"), F.lit(k).alias("order"), *[x.alias(h) for x, h in zip(held, near)], what.alias("asked"))

    asked = [question("c1", 1, token)]
    for k in range(2, order + 1):
        for slot, what in ((f"c{k}", token), (f"t{k}", total)):
            asked.append(F.when(F.col(f"_h{k - 1}") != NO_ID, question(slot, k, what)))
    asking = _with_near_ids(grams.select("hist", "token"), order, "hist")
    questions = asking.select("hist", "token", F.explode(F.filter(F.array(*asked), lambda s: s.isNotNull())).alias("q")).select("hist", "token", "q.*")
    answers = questions.join(known.unionByName(totals), ["order", *near, "asked"], "left").groupBy("hist", "token")
    slots = ["c1"] + [f"{s}{k}" for k in range(2, order + 1) for s in "ct"]
    found = answers.agg(*[F.max(F.when(F.col("slot") == s, F.col("n"))).alias(s) for s in slots])
    lam_c = F.lit(float(lam))
    prob = lam_c * F.coalesce("c1", F.lit(0)) / n1 + (1 - lam_c) * F.lit(1.0 / vocab_size)
    found = found.withColumn("prob", F.coalesce(prob, F.lit(1.0 / vocab_size)))  # an empty model knows the uniform only
    for k in range(2, order + 1):
        step = lam_c * F.coalesce(f"c{k}", F.lit(0)) / F.col(f"t{k}") + (1 - lam_c) * F.col("prob")
        found = found.withColumn("prob", F.when(F.col(f"t{k}") > 0, step).otherwise(F.col("prob")))
    return _written(found.select("hist", "token", (-F.log("prob")).alias("nll")), "ngram_nll")


def score_positions(
    seqs: DataFrame,
    counts: DataFrame,
    vocab_size: int,
    order: int = DEFAULT_ORDER,
    lam: float = DEFAULT_LAMBDA,
    ids_col: str = "ids",
    keys: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """M2: negative log-likelihood (nats) of every target position.

    Targets equal to the pad id are ignored; position 0 is never a target; a
    context never seen falls back to the order below.  Distinct grams are
    scored, and positions meet their gram's score in one join."""
    pos = positions(seqs, order, ids_col, keys)
    scores = score_grams(pos.select("hist", "token").distinct(), counts, vocab_size, order, lam)
    return pos.join(scores, ["hist", "token"]).select(*keys, "p", "token", "nll")


def score_batches(
    batched: DataFrame,
    counts: DataFrame,
    vocab_size: int,
    order: int = DEFAULT_ORDER,
    lam: float = DEFAULT_LAMBDA,
    ids_col: str = "ids",
    batch_key: str = "batch_id",
) -> DataFrame:
    """M3: ``(batch, n_targets, batch_loss)``, the mean token loss of every batch
    from counted grams: equal grams of a batch are joined and added up once."""
    grams = positions(batched, order, ids_col, (batch_key,)).groupBy(batch_key, "hist", "token").agg(F.count(F.lit(1)).alias("n"))
    grams = _written(grams, "ngram_eval")
    scores = score_grams(grams.select("hist", "token").distinct(), counts, vocab_size, order, lam)
    n, loss = F.sum("n"), F.sum(F.col("n") * F.col("nll"))
    return grams.join(scores, ["hist", "token"]).groupBy(batch_key).agg(n.alias("n_targets"), (loss / n).alias("batch_loss"))


MAX_EVAL_BATCHES = 50


def first_batches(batched: DataFrame, max_batches: int = MAX_EVAL_BATCHES) -> DataFrame:
    """The rows an evaluation looks at; apply it before scoring."""
    return batched.filter(F.col("batch_id") < max_batches)


def evaluate(nll: DataFrame, batch_keys: tuple[str, ...] = ("batch_id",), max_batches: int = MAX_EVAL_BATCHES) -> DataFrame:
    """M3: mean over the first ``max_batches`` batches of each batch's mean
    token loss (mean of batch means, 0.0 when there is no batch)."""
    return mean_of_batches(first_batches(nll, max_batches).groupBy(*batch_keys).agg(F.avg("nll").alias("batch_loss")))


def mean_of_batches(per_batch: DataFrame) -> DataFrame:
    """M3: mean of ``batch_loss``, 0.0 when there is no batch."""
    return per_batch.agg(F.coalesce(F.avg("batch_loss"), F.lit(0.0)).alias("eval_loss"))


# ---- sampling operators over a logit table (group, token, logit) ----------

def apply_temperature(logits: DataFrame, t: float = TEMPERATURE, col: str = "logit") -> DataFrame:
    """M4: divide logits by t (t must be > 0)."""
    if not t > 0:
        raise ValueError("temperature must be > 0")
    return logits.withColumn(col, F.col(col) / F.lit(float(t)))


def top_k(logits: DataFrame, k: int = TOP_K, group: str = "prompt_id", col: str = "logit") -> DataFrame:
    """M5: keep rows whose logit is at least the k-th largest of their group
    (ties kept, so ``rank``); k <= 0 keeps everything."""
    if k <= 0:
        return logits
    w = Window.partitionBy(group).orderBy(F.desc(col))
    return logits.withColumn("_rk", F.rank().over(w)).filter(F.col("_rk") <= k).drop("_rk")


def softmax(logits: DataFrame, group: str = "prompt_id", col: str = "logit", out: str = "prob") -> DataFrame:
    """M6: max-shifted softmax per group.  A group's maximum and sum come from
    groupings with partial results and meet its rows in a join, so the rows of a
    group need not meet in one task.  The logits are written once, as each step reads them."""
    logits = _written(logits, "logits")
    e = F.exp(F.col(col) - F.col("_top"))
    shifted = _with_group(logits, logits.groupBy(group).agg(F.max(col).alias("_top")), group).withColumn("_e", e).drop("_top")
    summed = _with_group(shifted, shifted.groupBy(group).agg(F.sum("_e").alias("_sum")), group)
    return summed.withColumn(out, F.col("_e") / F.col("_sum")).drop("_e", "_sum")


def _with_group(rows: DataFrame, facts: DataFrame, group: str) -> DataFrame:
    """Rows with the facts of their group, null being a group as any other."""
    facts = facts.withColumnRenamed(group, "_group")
    return rows.join(facts, F.col(group).eqNullSafe(F.col("_group"))).drop("_group")


def uniform(key: Column) -> Column:
    """Deterministic u in [0, 1) from the first 8 hex digits of md5(key)."""
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


DRAW_BLOCK = 4096  # token ids whose probabilities are added up together


def draw(probs: DataFrame, seed: int = 42, step: Column | int = 0, group: str = "prompt_id", prob: str = "prob", block: int = DRAW_BLOCK) -> DataFrame:
    """M7: inverse-CDF draw per group in token-id order; the first token with
    cumulative probability >= u, or the last candidate if rounding leaves
    none.  u depends only on (seed, group, step).

    Prefix sums are taken over the sums of blocks of ids, then inside the one
    block per group that u falls into: no window holds more than ``block`` rows,
    or a group's blocks.  The candidates are written once, as they are read twice."""
    step_c = step if isinstance(step, Column) else F.lit(step)
    u = uniform(F.concat_ws(":", F.lit(str(seed)), F.col(group).cast("string"), step_c.cast("string")))
    rows = _written(probs.select(F.col(group), F.col("token"), F.col(prob).alias("_p"), u.alias("_u"), F.floor(F.col("token") / block).alias("_block")), "draw")
    before = Window.partitionBy(group).orderBy("_block").rowsBetween(Window.unboundedPreceding, 0)
    sums = rows.groupBy(group, "_block").agg(F.sum("_p").alias("_s"), F.min("_u").alias("_at"))
    ends = sums.withColumn("_end", F.sum("_s").over(before))
    # blocks that reach u come first, then, if none does, the last one
    order = F.when(F.col("_end") >= F.col("_at"), F.struct(F.lit(0).alias("k"), F.col("_block").alias("b"))).otherwise(F.struct(F.lit(1).alias("k"), (-F.col("_block")).alias("b")))
    hit = ends.groupBy(group).agg(F.min_by(F.struct(F.col("_block").alias("b"), (F.col("_end") - F.col("_s")).alias("off")), order).alias("_hit"))
    hit = hit.select(F.col(group).alias("_group"), F.col("_hit.b").alias("_b"), F.col("_hit.off").alias("_off"))
    own = rows.join(hit, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_block") == F.col("_b")))
    inside = Window.partitionBy(group).orderBy("token").rowsBetween(Window.unboundedPreceding, 0)
    acc = own.withColumn("_acc", F.col("_off") + F.sum("_p").over(inside))
    return acc.groupBy(group).agg(
        F.coalesce(F.min(F.when(F.col("_acc") >= F.col("_u"), F.col("token"))), F.max("token")).alias("token")
    )


# ---- model housekeeping -------------------------------------------------------

KNOWN_IN_MEMORY = 4_000_000  # token ids of a target vocabulary that every executor may hold


def keep_known_tokens(model: DataFrame, vocab: DataFrame, token_col: str = "token") -> DataFrame:
    """M9: drop model rows whose token the target vocabulary does not know.

    The distinct tokens are written and counted: where they are numbers and not
    too many, they go to the model's rows, which then stay where they are."""
    known = _written(vocab.select(F.col(token_col)).distinct(), "known_tokens")
    if known.schema[token_col].dataType.simpleString() in ("int", "bigint") and known.count() <= KNOWN_IN_MEMORY:
        known = F.broadcast(known)
    return model.join(known, token_col, "left_semi")


def size_report(model: DataFrame) -> DataFrame:
    """Rows per order plus a total row (order 0)."""
    return model.rollup("order").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("n").alias("n_events")).select(
        F.coalesce(F.col("order"), F.lit(0)).alias("order"), "n_rows", "n_events"
    )


# ---- generation -----------------------------------------------------------------

@dataclass
class NgramModel:
    """``followers``, made of the written counts when it is read, holds one row
    per (order, context) with its next tokens and counts; a context's followers
    are bounded by the vocabulary.  ``arrays`` is the same table as sorted files
    that tasks look contexts up in."""

    followers: DataFrame  # order, ctx, n_ctx, toks array<int>, cnts array<long>
    arrays: follower_arrays.FollowerArrays
    unigram: dict[int, float]  # token -> P1 over the whole vocabulary (bounded)
    vocab_size: int
    order: int = DEFAULT_ORDER
    lam: float = DEFAULT_LAMBDA


def build_model(seqs: DataFrame, vocab_size: int, order: int = DEFAULT_ORDER, lam: float = DEFAULT_LAMBDA, max_vocab: int = 1 << 16) -> NgramModel:
    if vocab_size > max_vocab:
        raise ValueError("generation needs a bounded vocabulary")
    # a context stays numbers: the files are made of the counts, and text is made of it only where ``followers`` is read
    (_, _, single), *longer = _counts_by_order(seqs, order, "ids")
    spark = seqs.sparkSession
    longer = [(o, held, rows if o == order else written(rows, "ngram_lower", ends=None)) for o, held, rows in longer]
    followers = None
    for o, held, rows in longer:
        listed = F.sort_array(F.collect_list(F.struct("token", "n"))).alias("_f")
        rows = rows.groupBy(*held).agg(F.sum("n").alias("n_ctx"), listed)
        rows = rows.select(F.lit(o).alias("order"), _context_text(held), "n_ctx", F.col("_f.token").alias("toks"), F.col("_f.n").alias("cnts"))
        followers = rows if followers is None else followers.unionByName(rows)
    if followers is None:  # order 1 has one context, the unigram
        kind = single.schema["token"].dataType.simpleString()
        followers = spark.createDataFrame([], f"order int, ctx string, n_ctx bigint, toks array<{kind}>, cnts array<bigint>")
    with shuffles_released(spark):
        uni = {r["token"]: r["n"] for r in single.select("token", "n").collect()}
    total = sum(uni.values())
    p1 = {t: (lam * uni.get(t, 0) / total if total else 0.0) + (1 - lam if total else 1.0) / vocab_size for t in range(vocab_size)}
    arrays = follower_arrays.write([(held, rows) for _, held, rows in longer], vocab_size, order, scratch_path(spark, "follower_arrays"))
    return NgramModel(followers=followers, arrays=arrays, unigram=p1, vocab_size=vocab_size, order=order, lam=lam)


HELD_VALUES = 1 << 20  # numbers that a sampler keeps of the contexts it met; two generations are held


class _Kept(dict):
    """What a worker worked out for the contexts it met: a bounded number of
    values, in two generations."""

    def __init__(self):
        super().__init__()
        self.old, self.size = {}, 0

    def __missing__(self, key):
        made = self.old.get(key)
        if made is not None:
            self.put(key, *made)
        return made

    def put(self, key, *arrays) -> tuple:
        if self.size > HELD_VALUES:
            self.old, self.size = dict(self), 0
            self.clear()
        self[key] = arrays
        self.size += 32 + sum(map(len, arrays))  # an entry costs something besides its values
        return arrays


class Sampler:
    """Draws tokens for one prompt after the other on a worker.

    Same maths as ``top_k`` -> ``apply_temperature`` -> ``softmax`` -> ``draw``
    over all candidates.  A context's k most likely tokens (with ties) lie among
    its followers and those of the context one id shorter, since what does not
    follow it is ranked as there; so a step costs time in proportion to the
    followers of its contexts, and the vocabulary is gone through only if every
    token is kept.  What contexts come to is kept for the steps that meet them
    again."""

    def __init__(self, model: NgramModel, k: int, temperature: float, seed: int, max_context: int):
        self.arrays, self.order, self.lam, self.size = model.arrays, model.order, model.lam, model.vocab_size
        self.unigram = np.array([model.unigram[t] for t in range(model.vocab_size)])
        self.k, self.temperature, self.seed, self.max_context = k, temperature, seed, max_context
        # a token this much less likely than the k-th is below it whatever rounding does
        self.near = np.exp(-1e-9 - 2e-12 * temperature)
        self.whole = not (0 < k < self.size and 0 <= self.lam < 1)
        self.start = self._likeliest(np.arange(self.size), self.unigram)
        self.likely, self.choice = _Kept(), _Kept()

    def _likeliest(self, tokens: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if self.whole:
            return tokens, p
        kept = p >= np.partition(p, len(p) - self.k)[len(p) - self.k] * self.near
        return tokens[kept], p[kept]

    def _mixed(self, context: tuple[int, ...], found: tuple) -> tuple[np.ndarray, np.ndarray]:
        """The candidates for what follows a context and their probabilities."""
        total, toks, counts = found
        tokens = np.union1d(self._likely(context[1:])[0], toks)
        p = (1 - self.lam) * self._at(context[1:], tokens)
        p[tokens.searchsorted(toks)] += self.lam * counts / total
        return tokens, p

    def _likely(self, context: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
        """The tokens that can be among the k most likely after a context, and
        their probabilities."""
        if not context:
            return self.start
        kept = self.likely[context]
        if kept is None:
            found = self.arrays.find(context)
            kept = self.likely.put(context, *(self._likeliest(*self._mixed(context, found)) if found else self._likely(context[1:])))
        return kept

    def _at(self, context: tuple[int, ...], tokens: np.ndarray) -> np.ndarray:
        """Probabilities of some tokens after a context."""
        if not context:
            return self.unigram[tokens]
        p = self._at(context[1:], tokens)
        if found := self.arrays.find(context):
            total, toks, counts = found
            p = (1 - self.lam) * p
            at = np.minimum(toks.searchsorted(tokens), len(toks) - 1)
            follows = toks[at] == tokens
            p[follows] += self.lam * counts[at[follows]] / total
        return p

    def _choice(self, context: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
        """The tokens that may be drawn after a context, in order of their ids,
        and the running sums of their shares."""
        found = self.arrays.find(context) if context else None
        tokens, p = self._mixed(context, found) if found else self._likely(context[1:]) if context else self.start
        logit = np.log(p) / self.temperature
        # ties are kept: what differs from the k-th largest only by rounding is tied
        if 0 < self.k < self.size:
            kept = np.flatnonzero(logit >= np.partition(logit, len(logit) - self.k)[len(logit) - self.k] - 1e-12)
            tokens, logit = tokens[kept], logit[kept]
        e = np.exp(logit - logit.max())
        return tokens, np.cumsum(e / e.sum())

    def next_token(self, line: list[int], prompt_id: str, step: int) -> int:
        # a context longer than what the model may look back on is never met
        n = min(self.order - 1, self.max_context, len(line))
        context = tuple(line[len(line) - n :])
        tokens, shares = self.choice[context] or self.choice.put(context, *self._choice(context))
        u = int(hashlib.md5(f"{self.seed}:{prompt_id}:{step}".encode()).hexdigest()[:8], 16) / 4294967296.0
        reached = int(shares.searchsorted(u))
        return int(tokens[min(reached, len(tokens) - 1)])

    def reply(self, ids: list[int], prompt_id: str, max_new_tokens: int, eos_id: int) -> list[int]:
        line = list(ids)
        for step in range(max_new_tokens):
            line.append(self.next_token(line, prompt_id, step))
            if line[-1] == eos_id:
                break
        return line[len(ids) :]


def generate(
    prompts: DataFrame,
    model: NgramModel,
    max_new_tokens: int = MAX_NEW_TOKENS,
    temperature: float = TEMPERATURE,
    k: int = TOP_K,
    seed: int = 42,
    eos_id: int = EOS_ID,
    max_context: int = MAX_CONTEXT,
) -> DataFrame:
    """M8: sample up to ``max_new_tokens`` for every prompt ``(prompt_id, ids)``.

    One pass: a task draws all tokens of its prompts, looking their contexts up
    in the model's memory-mapped arrays, so there is no join and no round per
    token.  A prompt ends with the end id (included in the output) or at the
    limit.  Returns ``(prompt_id, ids, n_prompt, new_ids)``, lazily.
    """
    if not temperature > 0:
        raise ValueError("temperature must be > 0")
    spark = prompts.sparkSession
    shared = spark.sparkContext.broadcast(Sampler(model, k, temperature, seed, max_context))  # the vocabulary's size

    @F.pandas_udf("array<int>")
    def reply(prompt_id: pd.Series, ids: pd.Series) -> pd.Series:
        sampler = shared.value
        return pd.Series([sampler.reply(list(map(int, x)), p, max_new_tokens, eos_id) for p, x in zip(prompt_id, ids)], dtype=object)

    # a prompt is many steps of work for a few bytes: spread them
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spread = prompts.select("prompt_id", "ids").repartition(parts, "prompt_id")
    made = spread.withColumn("new_ids", reply(F.coalesce(F.col("prompt_id").cast("string"), F.lit("")), F.coalesce("ids", F.array().cast("array<int>"))))
    return made.select("prompt_id", F.concat("ids", "new_ids").alias("ids"), F.size("ids").alias("n_prompt"), "new_ids")
