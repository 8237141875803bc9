"""Byte-level BPE vocabulary learning.

Only one pass touches the corpus: pre-tokenising and counting words (T1, T3).
Every merge round after that works on the distinct-word table, a written table
of id arrays.  A round makes many merges on the distinct runs of frequent pairs,
which tell their counts exactly, so the result is that of a one-at-a-time
trainer (``learn_bpe``).
Each round's table lies in the shared checkpoint folder, which cuts lineage.
"""

from __future__ import annotations

import heapq
import logging
import time
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.byte_symbols import byte_symbols, byte_to_symbol, symbols_to_bytes_hex
from ..functions.text import SPECIAL_TOKENS
from ..session import ensure_checkpoint_dir, scratch_path

# --- fixed values: the byte-level pre-tokenizer split rule -----------------
# Java flavour with look-ahead; (?U) makes \s, \p{..} Unicode-aware.
PRETOKEN_PATTERN = r"(?U)'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Same rule without the look-ahead branch, for engines without look-around;
# equal to the full rule on cleaned text (single spaces only).
PRETOKEN_PATTERN_NO_LOOKAHEAD = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"
# The full rule for Python's regex module: white space is spelt as the Unicode
# White_Space set, which Java's (?U)\s matches.
WHITE_SPACE = r"\t\n\x0b\x0c\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PRETOKEN_RULE = (
    rf"'(?:[sdmt]|ll|ve|re)| ?\p{{L}}+| ?\p{{N}}+| ?[^{WHITE_SPACE}\p{{L}}\p{{N}}]+|[{WHITE_SPACE}]+(?![^{WHITE_SPACE}])|[{WHITE_SPACE}]+"
)
# ---------------------------------------------------------------------------

log = logging.getLogger(__name__)

DEFAULT_VOCAB_SIZE = 4096
MAX_VOCAB_SIZE = 1 << 16  # hard bound on anything kept on the driver / inlined


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def pretokenise_words(col) -> Column:
    """``array<string>`` of pre-tokens of a text column."""
    return F.regexp_extract_all(F.coalesce(_c(col), F.lit("")), F.lit(PRETOKEN_PATTERN), 0)


def pretokenise(df: DataFrame, text_col: str = "sample", id_col: str = "doc_id") -> DataFrame:
    """``(id, pos, word)``, ``pos`` 0-based."""
    return df.select(id_col, F.posexplode(pretokenise_words(text_col)).alias("pos", "word"))


def word_counts(df: DataFrame, text_col: str = "sample") -> DataFrame:
    """``(word, n)`` over the corpus (map-side partial count absorbs hot words)."""
    words = df.select(F.explode(pretokenise_words(text_col)).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def initial_vocab(wc: DataFrame) -> DataFrame:
    """T4: specials first (ids 0..2), then every byte symbol seen, by code
    point.  At most 256 symbols, so the final ordering is over a tiny table."""
    spark = wc.sparkSession
    symbols = wc.select(F.explode(byte_symbols("word")).alias("token")).distinct()
    alphabet = symbols.select(
        (F.row_number().over(_global_order("token")) + F.lit(len(SPECIAL_TOKENS) - 1)).cast("int").alias("id"),
        "token",
        F.lit(False).alias("is_special"),
    )
    specials = spark.createDataFrame(
        [(i, t, True) for i, t in enumerate(SPECIAL_TOKENS)],
        "id int, token string, is_special boolean",
    )
    return specials.unionByName(alphabet)


def _global_order(col: str):
    from pyspark.sql import Window

    return Window.orderBy(col)


def pair_counts(wc: DataFrame) -> DataFrame:
    """T5: ``(left, right, n)`` — adjacent symbol pairs weighted by word count."""
    sym = wc.select("n", byte_symbols("word").alias("s")).filter(F.size("s") >= 2)
    n = F.size("s")
    pairs = sym.select(
        "n", F.explode(F.arrays_zip(F.slice("s", 1, n - 1).alias("left"), F.slice("s", 2, n - 1).alias("right"))).alias("p")
    )
    return pairs.groupBy(F.col("p.left").alias("left"), F.col("p.right").alias("right")).agg(F.sum("n").alias("n"))


@dataclass
class Tokenizer:
    """A learned vocabulary: bounded (<= vocab_size entries) so it lives on
    the driver and is shipped to tasks as literals / broadcast."""

    tokens: list[str]  # id -> token string
    merges: list[tuple[int, int, int]] = field(default_factory=list)  # (left id, right id, new id) in rank order
    specials: dict[str, int] = field(default_factory=lambda: {t: i for i, t in enumerate(SPECIAL_TOKENS)})

    @property
    def vocab_size(self) -> int:
        return len(self.tokens)

    def token_to_id(self) -> dict[str, int]:
        out = {}
        for i, t in enumerate(self.tokens):
            out.setdefault(t, i)
        out.update(self.specials)
        return out

    def vocab_df(self, spark: SparkSession) -> DataFrame:
        special_ids = set(self.specials.values())
        rows = [(i, t, i in special_ids) for i, t in enumerate(self.tokens)]
        return spark.createDataFrame(rows, "id int, token string, is_special boolean")

    def merges_df(self, spark: SparkSession) -> DataFrame:
        rows = [
            (rank, self.tokens[l], self.tokens[r], self.tokens[n], n)
            for rank, (l, r, n) in enumerate(self.merges)
        ]
        return spark.createDataFrame(rows, "rank int, left string, right string, token string, id int")

    def byte_hex_to_id(self) -> dict[str, int]:
        """Byte (hex) -> id of its single-symbol token, only for seen bytes."""
        t2i = self.token_to_id()
        out = {}
        for b, s in byte_to_symbol().items():
            if s in t2i and s not in self.specials:
                out[f"{b:02X}"] = t2i[s]
        return out

    def id_to_bytes_hex(self) -> dict[int, str]:
        special_ids = set(self.specials.values())
        return {i: symbols_to_bytes_hex(t) for i, t in enumerate(self.tokens) if i not in special_ids}

    def has_reused_ids(self) -> bool:
        produced = [n for _, _, n in self.merges]
        return len(produced) != len(set(produced)) or any(n < len(self.tokens) - len(self.merges) for n in produced)


Pair = tuple[int, int]


class WordPairs:
    """Words as lists of ids, with an index from each pair to the words that
    hold it, so that a merge touches those words only."""

    def __init__(self, words: list[list[int]], counts: list[int]):
        self.words, self.counts = words, counts
        self.where: dict[Pair, list[int]] = {}
        for w, ids in enumerate(words):
            for p in zip(ids, ids[1:]):
                self.where.setdefault(p, []).append(w)

    def merge(self, left: int, right: int, new: int) -> tuple[dict[Pair, int], tuple]:
        """Replace the pair everywhere, leftmost first.  Returns how the counts
        of all pairs change, and what ``undo`` needs."""
        words, delta, log = self.words, {}, []
        held = self.where.pop((left, right), [])
        for w in held:
            old, n = words[w], self.counts[w]
            ids, i, last = [], 0, len(old) - 1
            while i <= last:
                if old[i] == left and i < last and old[i + 1] == right:
                    ids.append(new)
                    i += 2
                else:
                    ids.append(old[i])
                    i += 1
            if len(ids) == len(old):
                continue  # the word has changed since it was indexed
            log.append((w, old))
            words[w] = ids
            for p in zip(old, old[1:]):
                delta[p] = delta.get(p, 0) - n
            for p in zip(ids, ids[1:]):
                delta[p] = delta.get(p, 0) + n
                if new in p:
                    self.where.setdefault(p, []).append(w)
        return {p: d for p, d in delta.items() if d}, ((left, right), held, log)

    def undo(self, done: tuple) -> None:
        pair, held, log = done
        for w, old in log:
            self.words[w] = old
        self.where[pair] = held


class PairCounts:
    """Counts of all pairs with the next pick at hand: the highest count, ties
    to the smaller ids.  At most ``vocab_size`` squared entries."""

    def __init__(self, counts: dict[Pair, float]):
        self.counts = dict(counts)
        self.heap = [(-c, p) for p, c in counts.items()]
        heapq.heapify(self.heap)

    def add(self, delta: dict[Pair, float]) -> None:
        for p, d in delta.items():
            c = self.counts.get(p, 0) + d
            if c > 0:
                self.counts[p] = c
                heapq.heappush(self.heap, (-c, p))
            else:
                self.counts.pop(p, None)

    def best(self) -> tuple[Pair | None, float]:
        while self.heap:
            c, p = self.heap[0]
            if self.counts.get(p) == -c:
                return p, -c
            heapq.heappop(self.heap)  # outdated
        return None, 0


def _flat(batch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts, ids one after the other and where each word starts (and the last
    one ends) of a batch ``(n, ids)``."""
    lists = batch.column(1)
    starts = lists.offsets.to_numpy().astype(np.int64)
    ids = lists.values.to_numpy(zero_copy_only=False)[starts[0] : starts[-1]].astype("<i4")
    return batch.column(0).to_numpy(zero_copy_only=False), ids, starts - starts[0]


def _runs(ids: np.ndarray, starts: np.ndarray, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the runs start and end: stretches of a word in which every two
    neighbours are one of the sorted ``kept`` pairs."""
    if len(ids) < 2:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    pair = _pair_code(ids[:-1].astype(np.int64), ids[1:])
    linked = kept[np.minimum(np.searchsorted(kept, pair), len(kept) - 1)] == pair
    inner = starts[(starts > 0) & (starts < len(ids))]
    linked[inner - 1] = False
    edge = np.diff(linked.astype(np.int8), prepend=0, append=0)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) + 1


def _pair_code(left, right):
    return left * MAX_VOCAB_SIZE + right


RUNS_PER_TASK = 200_000  # distinct runs a task holds before it passes their counts on


def _run_counts(kept: np.ndarray):
    """Task side: the distinct runs of the words, with their counts."""

    def table(total: dict[bytes, int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(total), pa.binary()), pa.array(list(total.values()), pa.int64())], ["run", "n"])

    def run(batches):
        total: dict[bytes, int] = {}
        for batch in batches:
            n, ids, starts = _flat(batch)
            begin, end = _runs(ids, starts, kept)
            weights = n[np.searchsorted(starts, begin, side="right") - 1].tolist()
            data = ids.tobytes()
            for x, y, w in zip((begin * 4).tolist(), (end * 4).tolist(), weights):
                key = data[x:y]
                total[key] = total.get(key, 0) + w
            if len(total) >= RUNS_PER_TASK:
                yield table(total)
                total = {}
        yield table(total)

    return run


def _with_runs_merged(kept: np.ndarray, merged):
    """Task side: the words with their runs replaced by what the merges make of
    them (a broadcast look-up); words of one id are done."""

    def run(batches):
        of = merged.value
        for batch in batches:
            n, ids, starts = _flat(batch)
            begin, end = _runs(ids, starts, kept)
            data, stays = ids.tobytes(), np.ones(len(ids), bool)
            for x, y in zip(begin.tolist(), end.tolist()):
                if (made := of.get(data[4 * x : 4 * y])) is not None:
                    short = x + len(made) // 4
                    ids[x:short] = np.frombuffer(made, "<i4")
                    stays[short:y] = False
            length = np.diff(np.concatenate([[0], np.cumsum(stays)])[starts])
            alive = length > 1
            stays &= np.repeat(alive, np.diff(starts))
            offsets = np.concatenate([[0], np.cumsum(length[alive])]).astype(np.int32)
            words = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids[stays], pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(n[alive], pa.int64()), words], ["n", "ids"])

    return run


def _id_arrays(id_of: np.ndarray):
    """Task side: words as bytes to words as ids."""

    def run(batches):
        for batch in batches:
            words = batch.column(1).to_pylist()
            data = np.frombuffer(b"".join(words), np.uint8)
            offsets = np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(id_of[data], pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], ["n", "ids"])

    return run


GUESS_WORDS = 300_000  # distinct runs that the driver makes the next merges on
FIRST_PAIRS, MOST_PAIRS = 64, 16_384  # most frequent pairs that a round looks at


def learn_bpe(
    wc: DataFrame,
    vocab_size: int = DEFAULT_VOCAB_SIZE,
    min_frequency: int = 2,
    max_merges: int | None = None,
    guess_words: int = GUESS_WORDS,
) -> Tokenizer:
    """Learn merges from a word-count table ``(word, n)``.

    Stops when the vocabulary reaches ``vocab_size``, the best pair count is
    below ``min_frequency``, or ``max_merges`` merges were made.

    A round keeps the most frequent pairs, in the order of the picks, and cuts
    every word where two neighbours are no kept pair.  What lies across a cut
    never occurs more often, in any later token's pair either, than the first
    pair left out: a pair of later tokens holds, at its seam, a pair of the
    round's start.  So as long as the best pair comes before that one, the
    runs between the cuts tell all counts exactly, and the driver makes
    merges on the distinct runs with their counts alone.  Tasks then replace
    the runs in all words.  The pairs of a round are chosen so that at most
    ``guess_words`` distinct runs reach the driver; that decides how many merges
    a round makes, never which.  Words that have become one id leave the table."""
    if vocab_size > MAX_VOCAB_SIZE:
        raise ValueError(f"vocab_size above {MAX_VOCAB_SIZE} is not supported")
    spark = wc.sparkSession
    ensure_checkpoint_dir(spark)
    folder = scratch_path(spark, "bpe")

    def written(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    # one pass over the corpus: the words are written once and both the
    # alphabet and the initial state are read from that table
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    words = written(wc.select(F.col("n").cast("long").alias("n"), "word").where("word IS NOT NULL").repartition(n_parts), "words")
    alphabet = sorted(r["token"] for r in words.select(F.explode(byte_symbols("word")).alias("token")).distinct().collect())
    tokens = list(SPECIAL_TOKENS) + alphabet
    tok2id = {t: i for i, t in enumerate(tokens)}
    if not alphabet:
        return Tokenizer(tokens=tokens, merges=[])
    id_of = np.array([tok2id.get(s, 0) for _, s in sorted(byte_to_symbol().items())], dtype=np.int32)
    state = words.select("n", F.encode("word", "UTF-8").alias("w")).filter(F.length("w") >= 2)
    state = written(state.mapInArrow(_id_arrays(id_of), "n bigint, ids array<int>"), "0")
    merges: list[tuple[int, int, int]] = []
    wanted, rounds = FIRST_PAIRS, 0
    k = F.size("ids") - 1
    while True:
        t_round = time.time()
        room = vocab_size - len(tokens)
        if max_merges is not None:
            room = min(room, max_merges - len(merges))
        if room <= 0:
            break
        pairs = state.select("n", F.explode(F.arrays_zip(F.slice("ids", 1, k).alias("l"), F.slice("ids", 2, k).alias("r"))).alias("p"))
        counted = pairs.groupBy("p.l", "p.r").agg(F.sum("n").alias("c")).filter(F.col("c") >= min_frequency)
        top = [((r["l"], r["r"]), r["c"]) for r in counted.orderBy(F.desc("c"), "l", "r").limit(MOST_PAIRS + 1).collect()]
        if not top:
            break
        wanted = min(wanted, MOST_PAIRS)
        while True:
            held = dict(top[:wanted])
            left_out = (-top[wanted][1], top[wanted][0]) if wanted < len(top) else None
            kept = np.sort(np.array([_pair_code(*p) for p in held], dtype=np.int64))
            found = state.mapInArrow(_run_counts(kept), "run binary, n bigint").groupBy("run").agg(F.sum("n").alias("n"))
            if wanted == 1:  # runs of one pair differ in length only
                runs = found.toArrow()
                break
            runs = found.limit(guess_words + 1).toArrow()
            if runs.num_rows <= guess_words:
                break
            wanted = max(1, min(wanted, len(top)) // 3)
        keys = runs.column("run").to_pylist()
        sample = WordPairs([np.frombuffer(x, "<i4").tolist() for x in keys], runs.column("n").to_pylist())
        exact, made = PairCounts(held), 0
        while made < room:
            best, c = exact.best()
            # the first pick is the best pair of all; the others must come before what was left out
            if best is None or c < min_frequency or (made and left_out and (-c, best) >= left_out):
                break
            token = tokens[best[0]] + tokens[best[1]]
            known = token in tok2id
            if not known:
                tok2id[token] = len(tokens)
                tokens.append(token)
            new = tok2id[token]
            merges.append((*best, new))
            exact.add(sample.merge(*best, new)[0])
            exact.counts.pop(best, None)  # what overlaps in a run of one id is no pair any more
            made += 1
            if known:  # pairs of a token that is there already may lie across cuts: count anew
                break
        changed = {x: np.array(w, "<i4").tobytes() for x, w in zip(keys, sample.words, strict=True) if 4 * len(w) != len(x)}
        rounds += 1
        merged = spark.sparkContext.broadcast(changed)  # at most the distinct runs of a round
        state = written(state.mapInArrow(_with_runs_merged(kept, merged), "n bigint, ids array<int>"), str(rounds))
        merged.destroy()
        log.info("bpe round %d: %d pairs, %d runs, %d merges, %.2fs", rounds, len(held), len(keys), made, time.time() - t_round)
        if 3 * len(keys) <= guess_words:
            wanted *= 2
    return Tokenizer(tokens=tokens, merges=merges)


def learned_vocab_stats(vocab: DataFrame) -> DataFrame:
    """T7 over a vocab table: ``vocab_size = max(id) + 1`` and its parts."""
    return vocab.agg(
        F.sum(F.col("is_special").cast("int")).cast("long").alias("n_special"),
        F.sum((~F.col("is_special")).cast("int")).cast("long").alias("n_regular"),
        (F.max("id") + 1).cast("long").alias("vocab_size"),
    )

