"""Toxicity scores behind a noisy-channel deobfuscation.

1. A character trigram model (a-z, word boundary, any other letter) is counted
   over all documents in Spark; its table has at most 28^3 rows.
2. A token with leet signs, letters repeated three or more times, or single
   letters set apart by blanks or signs becomes a lattice: each observed sign
   lists what it may stand for with a channel probability (itself, a letter, a
   word boundary, nothing).  Viterbi finds the reading of highest channel times
   character-model probability.  A token without such signs is
   itself.  Where that is open, a token has further readings (signs at an edge
   as letters, doubled letters as one) and counts by the heaviest.  Runs of
   fragments of up to three letters are searched for whole weighted words.  A
   token of digits, or a price, is a number.
3. Restored words are scored.  On a bounded sample of labelled rows
   (``max_train``), words and word beginnings that are far more frequent in
   toxic documents get log-odds weights; a logistic regression on a document's
   weight sum, its excess over what clean text of that length shows, its density
   and its length gives the probability.

The sample of labels is broadcast (bounded by ``max_train``), so no text is
shuffled.  Scores read the text alone.

Defined results: null and empty texts score like a text without any weighted
word; label rows with null id or null label are ignored, repeated ones count
by the largest label; without rows of both classes every score is the share of
toxic rows (0 without labels).
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import crc32_of_id, text_or_empty

MAX_TRAIN = 40_000
THRESHOLD = 0.7
MIN_Z, MIN_DOCS, MIN_SHARE, MIN_LIFT = 5.0, 3, 0.002, 2.0
PREFIXES = range(3, 8)
CACHE_TOKENS = 150_000

# fixed values: what a sign may stand for
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l",
}
EDGE = ".,;:!?\"'()[]{}<>#*&%-_~`^/\\=…»«“”‘’"

OTHER, BOUND = 26, 27
SYMBOLS = 28


# ---- character model -------------------------------------------------------

# byte -> symbol; continuation bytes of UTF-8 are left out (255)
_CODE = np.full(256, BOUND, np.uint8)
_CODE[0x61:0x7B] = np.arange(26)
_CODE[0x41:0x5B] = np.arange(26)
_CODE[0xC0:] = OTHER
_CODE[0x80:0xC0] = 255


def trigram_counts(text: bytes) -> np.ndarray:
    """Counts of all 28^3 symbol trigrams; runs of boundaries are one."""
    codes = _CODE[np.frombuffer(b" " + text + b" ", np.uint8)]
    codes = codes[codes != 255]
    twice = np.flatnonzero((codes[1:] == BOUND) & (codes[:-1] == BOUND))
    codes = np.delete(codes, twice).astype(np.int32)
    if len(codes) < 3:
        return np.zeros(SYMBOLS**3, np.int64)
    return np.bincount((codes[:-2] * SYMBOLS + codes[1:-1]) * SYMBOLS + codes[2:], minlength=SYMBOLS**3)


def char_model(docs: DataFrame, text_col: str) -> np.ndarray:
    """log P(symbol | two symbols before) over all texts, [28, 28, 28]."""

    def count(batches):
        total = np.zeros(SYMBOLS**3, np.int64)
        for batch in batches:
            for text in batch.column(0):
                total += trigram_counts(text.as_py())
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64)), pa.array(total[at])], ["gram", "n"])

    texts = docs.select(text_or_empty(F.col(f"`{text_col}`")).cast("binary").alias("t")).where("octet_length(t) > 0")
    rows = texts.mapInArrow(count, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n")).collect()
    n = np.zeros(SYMBOLS**3)
    for r in rows:
        n[r["gram"]] = r["n"]
    tri = n.reshape(SYMBOLS, SYMBOLS, SYMBOLS)
    bi, uni = tri.sum(axis=0), tri.sum(axis=(0, 1))
    p1 = (uni + 1) / (uni.sum() + SYMBOLS)
    p2 = (bi + 10 * p1) / (bi.sum(axis=1, keepdims=True) + 10)
    p3 = (tri + 10 * p2[None]) / (tri.sum(axis=2, keepdims=True) + 10)
    return np.log(p3)


# ---- lattice and Viterbi ---------------------------------------------------


def symbol_of(c: str) -> int:
    return ord(c) - 97 if "a" <= c <= "z" else OTHER


FREE, EXACT = 1, 2  # bold readings: a doubled unit is one letter or two; it is as many as there are


def readings(token: str, bold: int = 0) -> list[list[tuple[str, float]]]:
    """The lattice: for each observed unit its readings and their channel log
    probabilities.  '' reads nothing, ' ' a word boundary.  When ``bold``, signs
    are letters, never boundaries."""
    out = []
    for m in re.finditer(r"(.)\1*", token, re.DOTALL):
        c, k = m.group(1), len(m.group(0))
        last = m.end() == len(token)
        if c in LEET and not (c == "!" and last):
            letters = LEET[c]
            options = [(x, np.log(0.7 / len(letters))) for x in letters] + [(" ", np.log(0.3))] * (not bold)
            if bold == EXACT:
                options = [(x * k, y) for x, y in options]
            elif k > 1:  # the letter doubled: a$$
                options += [(x + x, np.log(0.7 / len(letters))) for x in letters]
            out.append(options)
        elif c.isalpha():
            out.append([(c * k, 0.0)] if k < 3 - (bold == FREE and k == 2) else [(c, np.log(0.6)), (c + c, np.log(0.4))])
        elif c.isspace() or last or m.start() == 0:
            out.append([(" ", np.log(0.5)), ("", np.log(0.5))] if c.isspace() else [(" ", 0.0)])
        else:
            out.append([("", np.log(0.4)), (" ", np.log(0.6))])
    return out


def restore(token: str, model: list, bold: int = 0) -> list[str]:
    """The words of the best reading of a token."""
    states = {(BOUND, BOUND): (0.0, None)}  # last two symbols -> score, path
    for options in [*readings(token, bold), [(" ", 0.0)]]:
        after: dict = {}
        for (a, b), (score, path) in states.items():
            for text, channel in options:
                s, x, y = score + channel, a, b
                for c in text:
                    z = BOUND if c == " " else symbol_of(c)
                    if z == BOUND and y == BOUND:
                        continue
                    s += model[x][y][z]
                    x, y = y, z
                best = after.get((x, y))
                if best is None or s > best[0]:
                    after[(x, y)] = (s, (path, text))
        states = after
    path, texts = max(states.values(), key=lambda v: v[0])[1], []
    while path is not None:
        path, text = path
        texts.append(text)
    return "".join(reversed(texts)).split()


THRICE = re.compile(r"([^\W\d_])\1\1")
TWICE = re.compile("([^\\W\\d_]|[" + re.escape("".join(LEET)) + "])\\1+")
DOUBLES = 3  # up to so many doubled units, every way to read them is taken
PLAIN_EDGE = "".join(c for c in EDGE if c not in LEET)
NUMBER = re.compile(r"[+$€£]?\d[\d.,:/%-]*[+%$€£]?")


def token_words(token: str, model: list) -> list[str]:
    """Words of the first reading of a lower-cased token."""
    core = token.strip(EDGE)
    if core.isalpha():
        if not THRICE.search(core):
            return [core]
    elif not any(c.isalpha() for c in token):
        # signs alone are a word unless they are a number, a price or one sign
        wide = token.lstrip(PLAIN_EDGE).rstrip(PLAIN_EDGE + "!")
        if len(wide) < 2 or NUMBER.fullmatch(core) or NUMBER.fullmatch(wide) or not all(c in LEET for c in wide):
            return []
        return restore(wide, model, FREE) if not wide.isdigit() and len(set(wide)) > 1 else []
    return restore(token, model)


def undoubled(token: str) -> list[str]:
    """The token with each repeated letter or sign as two or as one."""
    out, at = [""], 0
    for m in TWICE.finditer(token):
        out = [x + token[at : m.start()] + y for x in out for y in (m.group(1) * 2, m.group(1))]
        at = m.end()
    return [x + token[at:] for x in out]


def token_readings(token: str, model: list) -> list[list[str]]:
    """Readings of a token, each a list of words: the first one, then those
    with signs at its edges as letters and with doubled letters as one."""
    first, core = token_words(token, model), token.strip(EDGE)
    wide = token.lstrip(PLAIN_EDGE).rstrip(PLAIN_EDGE + "!")
    if wide.isalpha():
        if not TWICE.search(wide):
            return [first]
    elif not first and not any(c.isalpha() for c in core):
        return [first]
    if len(TWICE.findall(wide)) > DOUBLES:
        out = [first, restore(wide, model, FREE)]
    else:
        out = [first, *([w] if w.isalpha() else restore(w, model, EXACT) for w in undoubled(wide))]
    return [x for k, x in enumerate(out) if x not in out[:k]]


SINGLES = 3  # so many single signs in a row are read as one spaced word
FRAGMENT = 3  # letters of a fragment of a spaced word


def bare(token: str) -> str:
    """A token without the punctuation around it, unless that is all of it."""
    return token if len(token) == 1 else token.strip(PLAIN_EDGE)


@lru_cache(maxsize=100_000)
def fragment(token: str) -> str:
    """A short token without its punctuation if it may be part of a spaced
    word, else nothing."""
    return b if 0 < len(b := bare(token)) <= FRAGMENT else ""


def fragments(tokens: list[str]) -> list[str]:
    return [fragment(t) if len(t) <= FRAGMENT + 2 else "" for t in tokens]


def runs_of(at: list[int], least: int) -> list[tuple[int, int]]:
    """Runs of at least so many neighbouring places: first and one past the last."""
    if not at:
        return []
    ends = [k + 1 for k, (i, j) in enumerate(zip(at, at[1:])) if j != i + 1]
    return [(at[lo], at[hi - 1] + 1) for lo, hi in zip([0, *ends], [*ends, len(at)]) if hi - lo >= least]


def spaced_runs(tokens: list[str], parts: list[str] | None = None) -> list[str]:
    """Runs of single-character tokens, punctuated or not, joined by blanks, for
    the lattice."""
    parts = fragments(tokens) if parts is None else parts
    at = [i for i, b in enumerate(parts) if len(b) == 1 and len(tokens[i]) < 5]
    return [" ".join(parts[lo:hi]) for lo, hi in runs_of(at, SINGLES)]


def fragment_runs(tokens: list[str], parts: list[str] | None = None) -> list[tuple[str, ...]]:
    """Runs of two or more short tokens without their punctuation."""
    parts = fragments(tokens) if parts is None else parts
    return [tuple(parts[lo:hi]) for lo, hi in runs_of([i for i, b in enumerate(parts) if b], 2)]


def spaced_or_token(unit: str, model: list) -> list[list[str]]:
    """Readings of a token, or the one of a spaced run."""
    return [restore(unit, model)] if " " in unit else token_readings(unit, model)


def features(word: str) -> list[str]:
    return [word, *[word[:k] + "-" for k in PREFIXES if k < len(word)]]


# ---- scoring ---------------------------------------------------------------


class _Shape(dict):
    """For ``str.translate``: letters as they are, leet signs as a letter they
    may stand for, any other character nothing.  ``i`` and ``l`` are one, as
    some signs stand for both."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        x = LEET[c][0] if c in LEET else c if c.isalpha() else ""
        self[code] = "i" if x == "l" else x
        return self[code]


_SHAPE = _Shape()
REPEATED = re.compile(r"(.)\1+", re.DOTALL)
SHAPE_LETTERS = 8  # letters of a feature's shape that are looked for


def shape(token: str) -> str:
    """Letters a token's signs may stand for, repeated ones once.  The shape of
    every word of every reading of a token is a part of the token's shape: signs
    without a letter are read as nothing or a boundary."""
    return REPEATED.sub(r"\1", token.translate(_SHAPE))


def shape_table(features: list[str]) -> list[tuple[int, set[str]]]:
    """Beginnings of the shapes of features, by length."""
    heads = {shape(f)[:SHAPE_LETTERS] for f in features}
    return [(k, own) for k in range(SHAPE_LETTERS + 1) if (own := {h for h in heads if len(h) == k})]


def holds_shape(z: str, table: list[tuple[int, set[str]]], places) -> bool:
    """Whether one of the table's shapes begins at one of the places of ``z``."""
    for k, own in table:
        for i in places:
            if z[i : i + k] in own:
                return True
    return False


def may_hold(token: str, table: list[tuple[int, set[str]]]) -> bool:
    """False only if no reading of a token holds one of the table's features.
    Words begin where the token does or behind a sign."""
    z, places, last, fresh = [], [], "", True
    for c in token:
        x = _SHAPE[ord(c)]
        if x and x != last:
            z.append(x)
            last = x
        if fresh and x:
            places.append(len(z) - 1)
            fresh = False
        fresh = fresh or not c.isalpha()
    return holds_shape("".join(z), table, places)


@dataclass
class ToxicityModel:
    """Everything a worker needs; bounded by the alphabet and the selection."""

    chars: list
    weights: dict[str, float] = field(default_factory=dict)
    clean_rate: tuple[float, float] = (0.0, 1.0)
    coef: list[float] = field(default_factory=list)
    prior: float = 0.0

    def __post_init__(self):
        self.cache: dict[str, float] = {}  # of tokens; two generations are held
        self.old: dict[str, float] = {}
        self.runs: dict[tuple[str, ...], float] = {}  # weights of runs of fragments
        self.shapes = shape_table([f.removesuffix("-") for f in self.weights])
        self.word_shapes = shape_table([f for f in self.weights if not f.endswith("-")])
        self.heads = {f.removesuffix("-")[: PREFIXES[0]] for f in self.weights}
        self.starts = {w[:k] for f in self.weights if not f.endswith("-") for w in [TWICE.sub(r"\1", f)] for k in range(1, len(w) + 1)}
        self.longest = max((len(w) for w in self.weights if not w.endswith("-")), default=0)

    def word_weight(self, word: str) -> float:
        """The heaviest feature of a word."""
        if word[: PREFIXES[0]] not in self.heads:
            return 0.0
        weights = self.weights
        best = weights.get(word, 0.0)
        for k in PREFIXES:
            if k >= len(word):
                break
            w = weights.get(word[:k] + "-", 0.0)
            if w > best:
                best = w
        return best

    def token_weight(self, token: str) -> float:
        core = token.strip(EDGE)
        if core.isalpha() and "(" not in token and "!" not in token:
            doubled = TWICE.findall(core)
            if not doubled:  # has one reading
                return self.word_weight(core)
            if not holds_shape(shape(core), self.shapes, (0,)):
                return 0.0
            if len(doubled) <= DOUBLES:  # every reading is among these, a word each
                return max(map(self.word_weight, undoubled(core)))
        elif not may_hold(token, self.shapes):
            return 0.0
        readings = spaced_or_token(token, self.chars)
        return max(sum(map(self.word_weight, reading)) for reading in readings)

    def fragments_weight(self, run: tuple[str, ...]) -> float:
        """Weights of whole words that lie broken in a run of fragments."""
        z = shape("".join(run))
        if not holds_shape(z, self.word_shapes, range(len(z))):
            return 0.0
        best = [0.0] * (len(run) + 1)  # of the fragments before a place
        for i in range(len(run)):
            best[i + 1] = max(best[i + 1], best[i])
            word = run[i]
            for j in range(i + 1, len(run)):
                word += run[j]
                if len(word) > 2 * self.longest or word.isalpha() and TWICE.sub(r"\1", word) not in self.starts:
                    break
                if len(word) <= FRAGMENT or len(word) == j + 1 - i:
                    continue  # single signs are spaced runs
                if word.isalpha() and not TWICE.search(word):
                    w = self.weights.get(word, 0.0)
                elif not may_hold(word, self.word_shapes):
                    w = 0.0
                else:
                    w = max(self.weights.get(r[0], 0.0) if len(r) == 1 else 0.0 for r in token_readings(word, self.chars))
                if w:
                    best[j + 1] = max(best[j + 1], best[i] + w)
        return best[-1]

    def document(self, text: str) -> tuple[float, float, int]:
        """Weight sum, number of weighted tokens, number of tokens."""
        tokens = text.lower().split()
        cache = self.cache
        parts = fragments(tokens)
        units = tokens + spaced_runs(tokens, parts)
        for t in set(units).difference(cache):
            known = self.old.get(t)
            cache[t] = self.token_weight(t) if known is None else known
        runs = fragment_runs(tokens, parts)
        for r in set(runs).difference(self.runs):
            self.runs[r] = self.fragments_weight(r)
        values = [*map(cache.__getitem__, units), *map(self.runs.__getitem__, runs)]
        if len(self.runs) > CACHE_TOKENS // 3:
            self.runs = {}
        if len(cache) > CACHE_TOKENS:
            self.cache, self.old = {}, cache
        return sum(values), len(values) - values.count(0.0), len(tokens)

    def inputs(self, sums: np.ndarray) -> np.ndarray:
        """Regression inputs from rows of (sum, hits, tokens)."""
        total, hits, n = sums.T
        mean, var = self.clean_rate
        return np.column_stack(
            [
                np.ones(len(n)),
                (total - mean * n) / np.sqrt(var * n + 4.0),
                np.log1p(total),
                np.log1p(hits),
                10 * hits / (n + 5.0),
                np.log1p(n) / 5,
            ]
        )

    def probability(self, sums: np.ndarray) -> np.ndarray:
        if not self.coef:
            return np.full(len(sums), self.prior)
        return 1 / (1 + np.exp(-np.clip(self.inputs(sums) @ np.array(self.coef), -30, 30)))


def document_features(texts: DataFrame, model) -> DataFrame:
    """``(feature, toxic, n)``: documents of each class that hold a feature,
    counted inside tasks first."""

    def count(batches):
        chars, known, old = model.value, {}, {}  # two generations of tokens
        counts: tuple[Counter, Counter] = (Counter(), Counter())

        def flush():
            for y in (0, 1):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(counts[y]), pa.string()), pa.array([y] * len(counts[y]), pa.int32()), pa.array(list(counts[y].values()), pa.int64())],
                    ["feature", "toxic", "n"],
                )
                counts[y].clear()

        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                tokens = text.lower().split()
                found: set[str] = set()
                for t in set(tokens + spaced_runs(tokens)):
                    held = known.get(t)
                    if held is None:
                        held = old.get(t)
                        known[t] = held = [f for r in spaced_or_token(t, chars) for w in r for f in features(w)] if held is None else held
                    found.update(held)
                counts[toxic].update(found)
                if len(known) > CACHE_TOKENS // 3:
                    known, old = {}, known
                if len(counts[0]) > CACHE_TOKENS:
                    yield from flush()
        yield from flush()

    return texts.mapInArrow(count, "feature string, toxic int, n bigint")


def select_weights(counted: DataFrame, n_toxic: int, n_clean: int) -> dict[str, float]:
    """Log-odds of the features that mark toxic documents.  A feature must be
    in ``MIN_SHARE`` of the toxic documents, which bounds how many there are."""
    per = counted.groupBy("feature").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).cast("double").alias("a"),
        F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).cast("double").alias("b"),
    )
    p1, p0 = F.col("a") / n_toxic, F.col("b") / n_clean
    p = (F.col("a") + F.col("b")) / (n_toxic + n_clean)
    z = (p1 - p0) / F.sqrt(F.greatest(p * (1 - p), F.lit(1e-12)) * (1 / n_toxic + 1 / n_clean))
    chosen = per.where((F.col("a") >= max(MIN_DOCS, MIN_SHARE * n_toxic)) & (p1 >= MIN_LIFT * p0) & (z >= MIN_Z))
    rows = chosen.select("feature", "a", "b").collect()
    return {r["feature"]: float(np.log((r["a"] + 0.5) / (n_toxic + 1)) - np.log((r["b"] + 0.5) / (n_clean + 1))) for r in rows}


def regress(x: np.ndarray, y: np.ndarray, penalty: float = 1e-2, rounds: int = 50) -> list[float]:
    """Logistic regression by Newton steps with a small ridge."""
    w = np.zeros(x.shape[1])
    ridge = penalty * np.eye(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ w)
        w += step * min(1.0, 4 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return w.tolist()


def weight_sums(text: Column, model) -> Column:
    @F.pandas_udf("array<double>")
    def of(texts: pd.Series) -> pd.Series:
        m = model.value
        return pd.Series([[float(v) for v in m.document(t)] for t in texts], dtype=object)

    return of(text_or_empty(text))


def fit(docs: DataFrame, labels: DataFrame, chars: np.ndarray, id_col: str, text_col: str, max_train: int) -> ToxicityModel:
    """Weights and regression from at most ``max_train`` labelled rows (those
    of smallest id hash) outside the held-out third."""
    sc = docs.sparkSession.sparkContext
    model = ToxicityModel(chars.tolist())
    rows = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(crc32_of_id(F.col("doc_id")) % 3 != 1)
    rows = rows.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    sample = [(r["doc_id"], r["toxic"]) for r in rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train).collect()]
    if not sample:
        return model
    wanted = docs.sparkSession.createDataFrame(sample, "__id bigint, toxic int")  # at most max_train rows
    train = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("__id"), text_or_empty(F.col(f"`{text_col}`")).alias("text"))
    train = train.join(F.broadcast(wanted), "__id").select("text", "toxic")
    sizes = {r["toxic"]: r["count"] for r in train.groupBy("toxic").count().collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    model.prior = n1 / max(1, n1 + n0)
    if not (n1 and n0):
        return model
    model = ToxicityModel(model.chars, select_weights(document_features(train, sc.broadcast(model.chars)), n1, n0), prior=model.prior)
    sums = train.select(weight_sums(F.col("text"), sc.broadcast(model)).alias("s"), "toxic").collect()
    x, y = np.array([r["s"] for r in sums]), np.array([r["toxic"] for r in sums], dtype=float)
    clean = x[y == 0]
    words = max(1.0, clean[:, 2].sum())
    mean = clean[:, 0].sum() / words
    model.clean_rate = (float(mean), float(max(1e-6, mean * max([1.0, *model.weights.values()]))))
    model.coef = regress(model.inputs(x), y)
    return model


def train_model(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_train: int = MAX_TRAIN) -> ToxicityModel:
    """Character model over all ``docs``, classifier on the labelled sample."""
    return fit(docs, labels, char_model(docs, text_col), id_col, text_col, max_train)


def toxicity_score(text: Column, shared) -> Column:
    """Probability of label 1 for a broadcast ``ToxicityModel``."""

    @F.pandas_udf("double")
    def of(texts: pd.Series) -> pd.Series:
        m = shared.value
        sums = np.array([m.document(t) for t in texts], dtype=float).reshape(-1, 3)
        return pd.Series(m.probability(sums))

    return of(text_or_empty(text))


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_train: int = MAX_TRAIN) -> DataFrame:
    """One row per document row: ``doc_id, held_out, score, predicted``."""
    shared = docs.sparkSession.sparkContext.broadcast(train_model(docs, labels, id_col, text_col, max_train))
    doc_id = F.col(f"`{id_col}`").alias("doc_id")
    scored = docs.select(doc_id, toxicity_score(F.col(f"`{text_col}`"), shared).alias("score"))
    return scored.select("doc_id", (crc32_of_id(F.col("doc_id")) % 3 == 1).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_train: int = MAX_TRAIN) -> DataFrame:
    """The rows of ``docs`` not rejected, all columns kept: a row-local filter."""
    shared = docs.sparkSession.sparkContext.broadcast(train_model(docs, labels, id_col, text_col, max_train))
    return docs.where(toxicity_score(F.col(f"`{text_col}`"), shared) < THRESHOLD)
