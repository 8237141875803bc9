"""Shared building blocks for the registered queries: table loading, the
prepared split, the learned tokenizer and model (computed once per session
and data folder), inline edge rows, and the SQL fragments their DuckDB
oracles share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import WS_CLASS
from ..operators import codec, ranking, sequences, tokenizer
from ..operators.tokenizer import PRETOKEN_PATTERN_NO_LOOKAHEAD
from ..session import shuffles_released, working_tables, written
from ..sources.corpus import read_corpus

BPE_MERGES = 32  # merges of the queries that SQL repeats step by step

_cache: dict = {}


def _app(spark: SparkSession) -> str:
    """Memo key part: unique per running application (a stopped and
    re-created session never sees another's cached tables)."""
    return spark.sparkContext.applicationId


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def documents(spark: SparkSession, d: str) -> DataFrame:
    return read_corpus(spark, f"{d}/documents.parquet", min_partitions=spark.sparkContext.defaultParallelism)


def split(spark: SparkSession, d: str) -> DataFrame:
    """``(doc_id, text, split)``; membership from the key threshold, so no
    shuffle of the documents (queries that report ranks rank explicitly).
    Written once per session and folder, as the prepared dataset is."""
    key = ("split", _app(spark), d)
    if key not in _cache:
        _cache[key] = written(ranking.split_by_threshold(documents(spark, d)), "split", ends=None)
    return _cache[key]


def corpus(spark: SparkSession, d: str) -> DataFrame:
    return ranking.tokenizer_corpus(split(spark, d), cleaned=True)


def learned_tokenizer(spark: SparkSession, d: str, merges: int | None = None) -> tokenizer.Tokenizer:
    """The tokenizer learned on the prepared corpus (driver-side, bounded):
    4,096 tokens, or the first ``merges`` merges.  Memoised per session and
    folder because learning is iterative."""
    key = ("tok", _app(spark), d, merges)
    if key not in _cache:
        wc = tokenizer.word_counts(corpus(spark, d))
        _cache[key] = tokenizer.learn_bpe(wc, max_merges=merges)
    return _cache[key]


def word_seq_table(spark: SparkSession, d: str) -> DataFrame:
    """Full word-id sequences ``(doc_id, split, ids)`` of both splits,
    written once per session and folder (the prepared-data table a pipeline
    would write), so the shaping and model queries read a table instead of
    re-running tokenisation and the word-id join in every branch of their
    plans."""
    key = ("wseq", _app(spark), d)
    if key not in _cache:
        cleaned = split(spark, d)
        with working_tables(spark), shuffles_released(spark):
            _cache[key] = written(sequences.word_sequences(cleaned), "word_seqs", ends=None)
    return _cache[key]


def bpe_seq_table(spark: SparkSession, d: str, merges: int | None = None) -> DataFrame:
    """``(doc_id, split, ids)`` of the learned vocabulary's ids, row-local from
    the corpus and written once per session and folder."""
    key = ("bseq", _app(spark), d, merges)
    if key not in _cache:
        made = codec.encode(corpus(spark, d), learned_tokenizer(spark, d, merges)).select("doc_id", "split", "ids")
        _cache[key] = written(made, "bpe_seqs", ends=None)
    return _cache[key]


def seq_table(spark: SparkSession, d: str, merges: int | None = None) -> DataFrame:
    """Sequences of word ids, or of token ids after ``merges`` merges."""
    return word_seq_table(spark, d) if merges is None else bpe_seq_table(spark, d, merges)


def seq_vocab_size(spark: SparkSession, d: str, merges: int | None = None) -> int:
    return word_vocab_size(spark, d) if merges is None else learned_tokenizer(spark, d, merges).vocab_size


def word_seqs(spark: SparkSession, d: str, max_len: int = sequences.TRAIN_MAX_LEN) -> DataFrame:
    """Word-id sequences after truncate + drop-short, both splits."""
    return sequences.truncate_filter(word_seq_table(spark, d), max_len)


def seq_windows(spark: SparkSession, d: str, merges: int | None = None, max_len: int = sequences.TRAIN_MAX_LEN) -> DataFrame:
    """``(doc_id, win, seq_id, split, ids)``: every document cut into windows
    of at most ``max_len`` ids, none dropped."""
    return sequences.windows(seq_table(spark, d, merges), max_len)


def word_vocab_size(spark: SparkSession, d: str) -> int:
    """One more than the largest word id of the prepared sequences."""
    key = ("wv", _app(spark), d)
    if key not in _cache:
        _cache[key] = int(word_seq_table(spark, d).agg(F.max(F.array_max("ids"))).first()[0]) + 1
    return _cache[key]


# ---- inline edge rows (same values in the query and in its oracle) ---------

EDGE_TEXTS = [
    (-1, None),
    (-2, ""),
    (-3, "   "),
    (-4, "\u3000"),
    (-5, "a\u0085b"),
    (-6, "a\u001cb"),
    (-7, "a\u2003b"),
    (-8, "a\u00a0b"),
    (-9, " x\t\n y  "),
]

MARKER_REPLIES = [
    (-1, 0, "x<|im_end|>y"),
    (-2, 0, "<|im_start|><|im_end|>"),
    (-3, 0, "  hi there <|im_start|>user"),
    (-4, 0, ""),
]

EXIT_PROMPTS = [(-1, 0, "quit"), (-2, 0, " EXIT "), (-3, 0, "q"), (-4, 0, ""), (-5, 0, "toki")]

NULL_LAST_TURN = [(-1, 1, "user", "a"), (-1, 2, "user", None)]

CONFIG_ROWS = [
    (-1, '{"hidden_size": 512, "d_model": 256, "n_layers": 4}'),
    (-2, "{}"),
    (-3, '{"model": {"d_model": 128, "max_seq_len": 64, "dropout": 0.2}, "train": {"batch_size": 8}}'),
    (-4, '{"max_position_embeddings": 256, "eos_token_id": 5, "vocab_size": 1000, "extra": 1}'),
]

NAN_RUN = [(-1, 0, 5.0), (-1, 1, 4.0), (-1, 2, 4.0), (-1, 3, 3.0), (-1, 4, float("nan")), (-1, 5, 2.0)]


def sql_str(s: str | None) -> str:
    """A SQL expression for ``s`` using chr() for anything not plain ASCII."""
    if s is None:
        return "CAST(NULL AS VARCHAR)"
    if s == "":
        return "''"
    parts, buf = [], ""
    for ch in s:
        if 32 <= ord(ch) < 127:
            buf += ch.replace("'", "''")
        else:
            if buf:
                parts.append(f"'{buf}'")
                buf = ""
            parts.append(f"chr({ord(ch)})")
    if buf:
        parts.append(f"'{buf}'")
    return " || ".join(parts)


def sql_values(rows, cols: list[str]) -> str:
    def lit(v):
        if v is None or isinstance(v, str):
            return sql_str(v)
        if isinstance(v, float):
            return "CAST('NaN' AS DOUBLE)" if v != v else f"CAST({v!r} AS DOUBLE)"
        return str(v)

    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"(SELECT * FROM (VALUES {body}) AS t({', '.join(cols)}))"


# ---- SQL fragments -----------------------------------------------------------

WS = WS_CLASS + "+"


def sql_clean(x: str) -> str:
    return f"regexp_replace(regexp_replace(coalesce({x}, ''), '{WS}', ' ', 'g'), '^ | $', '', 'g')"


def sql_strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}|{WS}$', '', 'g')"


NL = "chr(10)"
SQL_PAT = PRETOKEN_PATTERN_NO_LOOKAHEAD.replace("'", "''")


def sql_wrap(x: str) -> str:
    return f"'<|im_start|>assistant' || {NL} || {sql_clean(x)} || '<|im_end|>'"


SPLIT_CTE = f"""
items AS (SELECT doc_id, {sql_clean('text')} AS text FROM documents),
kept AS (SELECT doc_id, text FROM items WHERE text <> ''),
ranked AS (
  SELECT doc_id, text,
         row_number() OVER (ORDER BY md5('42:' || CAST(doc_id AS VARCHAR)), doc_id) AS rank,
         count(*) OVER () AS total
  FROM kept),
split AS (
  SELECT doc_id, text, rank,
         CASE WHEN rank <= floor(CAST(total AS DOUBLE) * CAST(0.05 AS DOUBLE)) THEN 'eval' ELSE 'train' END AS split
  FROM ranked),
corpus AS (SELECT doc_id, split, {sql_wrap('text')} AS sample FROM split)
"""

# training sequences and windows of seqs_full (doc_id, split, ids)
SHAPES_CTE = """seqs AS (SELECT doc_id, split, ids[1:128] AS ids FROM seqs_full WHERE len(ids[1:128]) >= 2),
wins AS (SELECT doc_id, CAST(w AS INTEGER) AS win, CAST(doc_id AS VARCHAR) || ':' || w AS seq_id, split, ids[w * 127 + 1:w * 127 + 128] AS ids
         FROM (SELECT *, unnest(generate_series(0, (len(ids) - 2) // 127)) AS w FROM seqs_full WHERE len(ids) >= 2))
"""

# word ids: distinct pre-tokens of the cleaned text ranked by md5(word), from 3
WORDS_CTE = f"""
wl AS (SELECT doc_id, split, regexp_extract_all(text, '{SQL_PAT}') AS w FROM split),
wpos AS (SELECT doc_id, split, unnest(w) AS word, unnest(generate_series(0, len(w) - 1)) AS pos FROM wl),
wvocab AS (SELECT word, CAST(row_number() OVER (ORDER BY md5(word), word) + 2 AS INTEGER) AS token
           FROM (SELECT DISTINCT word FROM wpos)),
seqs_full AS (
  SELECT doc_id, split, list_concat([1], list(token ORDER BY pos), [2]) AS ids
  FROM wpos JOIN wvocab USING (word) GROUP BY doc_id, split),
{SHAPES_CTE}"""


def bpe_cte(merges: int = BPE_MERGES) -> str:
    """CTEs that learn ``merges`` merges from ``syms (word, n, s)`` step by
    step: ``q{k}`` the k-th pair, ``tk`` all tokens, ``mg`` one row with all
    merges.  Ties go to the smaller ids."""
    parts = [
        "alpha AS (SELECT token, CAST(row_number() OVER (ORDER BY token) + 2 AS INTEGER) AS id FROM (SELECT DISTINCT unnest(s) AS token FROM syms))",
        "top AS (SELECT max(id) AS top FROM alpha)",
        "sp AS (SELECT word, n, unnest(s) AS sym, unnest(generate_series(1, len(s))) AS pos FROM syms)",
        "s0 AS MATERIALIZED (SELECT word, any_value(n) AS n, ' ' || string_agg(CAST(id AS VARCHAR), '  ' ORDER BY pos) || ' ' AS st "
        "FROM sp JOIN alpha ON token = sym GROUP BY word)",
    ]
    for k in range(1, merges + 1):
        parts.append(
            f"q{k} AS MATERIALIZED (SELECT l, r, top + {k} AS id FROM (SELECT p[i] AS l, p[i + 1] AS r, sum(n) AS c FROM "
            f"(SELECT n, CAST(string_split(trim(st), '  ') AS INTEGER[]) AS p FROM s{k - 1}) AS w, range(1, len(p)) AS t(i) GROUP BY ALL), top "
            "ORDER BY c DESC, l, r LIMIT 1)"
        )
        parts.append(f"s{k} AS MATERIALIZED (SELECT word, n, replace(st, ' ' || l || '  ' || r || ' ', ' ' || id || ' ') AS st FROM s{k - 1}, q{k})")
    parts.append("k0 AS (SELECT id, token FROM alpha)")
    for k in range(1, merges + 1):
        parts.append(
            f"k{k} AS MATERIALIZED (SELECT * FROM k{k - 1} UNION ALL SELECT q.id, a.token || b.token FROM q{k} AS q "
            f"JOIN k{k - 1} AS a ON a.id = q.l JOIN k{k - 1} AS b ON b.id = q.r)"
        )
    cols = ", ".join(f"q{k}.l AS l{k}, q{k}.r AS r{k}, q{k}.id AS n{k}" for k in range(1, merges + 1))
    parts.append(f"mg AS (SELECT {cols} FROM {', '.join(f'q{k}' for k in range(1, merges + 1))})")
    return ",\n".join(parts)


def _merge_steps(merges: int) -> str:
    state = "st"
    for k in range(1, merges + 1):
        state = f"replace({state}, ' ' || l{k} || '  ' || r{k} || ' ', ' ' || n{k} || ' ')"
    return state


_SYMBOL = "chr(CASE WHEN {b} < 33 THEN 256 + {b} WHEN {b} >= 127 AND {b} <= 160 THEN {b} + 162 WHEN {b} = 173 THEN 323 ELSE {b} END)".format(b="CAST('0x' || h AS INTEGER)")


def encode_body_cte(out: str, source: str, key: str, merges: int = BPE_MERGES) -> str:
    """CTEs ending in ``out (key, ids)``: merged ids of ``source (key, body)``,
    whose bodies hold no marker.  Bytes outside the alphabet are dropped."""
    return f"""
{out}_w AS (SELECT {key}, unnest(w) AS word, unnest(generate_series(1, len(w))) AS pos FROM (SELECT {key}, regexp_extract_all(body, '{SQL_PAT}') AS w FROM {source})),
{out}_d AS (SELECT word, list_transform(regexp_extract_all(hex(encode(word)), '..'), lambda h: {_SYMBOL}) AS s FROM (SELECT DISTINCT word FROM {out}_w)),
{out}_p AS (SELECT word, unnest(s) AS sym, unnest(generate_series(1, len(s))) AS pos FROM {out}_d),
{out}_0 AS (SELECT word, ' ' || string_agg(CAST(id AS VARCHAR), '  ' ORDER BY pos) || ' ' AS st FROM {out}_p JOIN alpha ON token = sym GROUP BY word),
{out}_e AS MATERIALIZED (SELECT word, CAST(string_split(trim({_merge_steps(merges)}), '  ') AS INTEGER[]) AS ids FROM {out}_0, mg),
{out} AS MATERIALIZED (SELECT {key}, flatten(list(e.ids ORDER BY pos)) AS ids FROM {out}_w JOIN {out}_e AS e USING (word) GROUP BY {key})"""


def bpe_encode_cte(merges: int = BPE_MERGES) -> str:
    """CTE ``enc (doc_id, split, sample, ids)``: token ids of the corpus, whose
    only markers are those of the wrapping."""
    return f"""
body AS (SELECT doc_id, split, sample, substr(sample, 13, length(sample) - 22) AS body FROM corpus),
{encode_body_cte("eb", "body", "doc_id", merges)},
enc AS (SELECT doc_id, split, sample, list_concat([1], eb.ids, [2]) AS ids FROM body JOIN eb USING (doc_id))"""


def generate_cte(prompts: str, max_new: int = 64, k: int = 50, temperature: float = 0.7, seed: int = 42) -> str:
    """CTE ``gen (prompt_id, step, ids, done)``: every step of sampling from the
    interpolated 3-gram model of the encoded train split, for ``prompts
    (prompt_id, ids)``."""
    return f"""
vsz AS (SELECT max(id) + 1 AS v FROM k{BPE_MERGES}),
tr AS (SELECT ids, unnest(generate_series(1, len(ids) - 1)) AS i FROM enc WHERE split = 'train'),
m1 AS (SELECT ids[i + 1] AS t, count(*) AS c FROM tr GROUP BY ALL),
m2 AS MATERIALIZED (SELECT ids[i] AS a, ids[i + 1] AS t, count(*) AS c FROM tr GROUP BY ALL),
m3 AS MATERIALIZED (SELECT ids[i - 1] AS a, ids[i] AS b, ids[i + 1] AS t, count(*) AS c FROM tr WHERE i >= 2 GROUP BY ALL),
c2 AS MATERIALIZED (SELECT a, sum(c) AS n FROM m2 GROUP BY ALL),
c3 AS MATERIALIZED (SELECT a, b, sum(c) AS n FROM m3 GROUP BY ALL),
voc AS MATERIALIZED (SELECT CAST(r.t AS INTEGER) AS t, 0.5::DOUBLE * coalesce(m1.c, 0) / (SELECT sum(c) FROM m1) + 0.5::DOUBLE / v AS p1
        FROM vsz, range(v) AS r(t) LEFT JOIN m1 ON m1.t = r.t),
gen AS (
  SELECT prompt_id, 0 AS step, ids, false AS done FROM {prompts}
  UNION ALL
  SELECT prompt_id, step + 1, list_append(any_value(ids), coalesce(min(CASE WHEN acc >= u THEN t END), max(t))),
         coalesce(min(CASE WHEN acc >= u THEN t END), max(t)) = 2
  FROM (SELECT prompt_id, step, ids, t, sum(e) OVER (PARTITION BY prompt_id ORDER BY t) / sum(e) OVER (PARTITION BY prompt_id) AS acc,
               CAST(CAST('0x' || substr(md5('{seed}:' || prompt_id || ':' || step), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296.0 AS u
        FROM (SELECT prompt_id, step, ids, t, exp(logit - max(logit) OVER (PARTITION BY prompt_id)) AS e
              FROM (SELECT *, max(CASE WHEN rn = {k} THEN logit END) OVER (PARTITION BY prompt_id) AS thr
                    FROM (SELECT *, row_number() OVER (PARTITION BY prompt_id ORDER BY logit DESC) AS rn
                          FROM (SELECT prompt_id, step, ids, t, ln(CASE WHEN n3 IS NULL THEN p2 ELSE 0.5::DOUBLE * coalesce(k3, 0) / n3 + 0.5::DOUBLE * p2 END) / {temperature}::DOUBLE AS logit
                                FROM (SELECT g.prompt_id, g.step, g.ids, voc.t, c3.n AS n3, m3.c AS k3,
                                             CASE WHEN c2.n IS NULL THEN p1 ELSE 0.5::DOUBLE * coalesce(m2.c, 0) / c2.n + 0.5::DOUBLE * p1 END AS p2
                                      FROM (SELECT *, ids[-1] AS z, ids[-2] AS y FROM gen WHERE NOT done AND step < {max_new}) AS g CROSS JOIN voc
                                      LEFT JOIN c2 ON c2.a = z LEFT JOIN m2 ON m2.a = z AND m2.t = voc.t
                                      LEFT JOIN c3 ON c3.a = y AND c3.b = z LEFT JOIN m3 ON m3.a = y AND m3.b = z AND m3.t = voc.t))))
              WHERE thr IS NULL OR logit >= thr - 1e-12))
  GROUP BY prompt_id, step)"""
