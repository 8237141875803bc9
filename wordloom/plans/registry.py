"""Registered queries: one per operator of the blueprint, each reading the
given tables, plus the DuckDB SQL that recomputes the same result.

Arrays are reported as space-joined text and doubles rounded, so both
engines hash the same values.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, update_wrapper

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as TX
from ..functions.byte_symbols import byte_symbols
from ..operators import chat, codec, ngram, ranking, runlog, sequences, tokenizer, vectors
from ..sources import config as cfg
from ..sources import corpus as src
from ..session import scratch_path, working_tables, written
from . import common as C
from .common import NL, SHAPES_CTE, SPLIT_CTE, SQL_PAT, WORDS_CTE, sql_clean, sql_strip, sql_values

Q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        Q[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return deco


def _edge_docs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(C.EDGE_TEXTS, "doc_id long, text string")


def _docs_with_edges(spark, d):
    return C.documents(spark, d).unionByName(_edge_docs(spark))


EDGE_SQL = f"(SELECT doc_id, text FROM documents UNION ALL SELECT * FROM {sql_values(C.EDGE_TEXTS, ['doc_id', 'text'])})"


# ---- S: sources and sinks -----------------------------------------------------

@register("corpus_scan", "SELECT doc_id, text FROM documents")
def corpus_scan(spark, d):
    return C.documents(spark, d)


@register(
    "dataset_manifest",
    f"WITH {SPLIT_CTE} SELECT split, count(*) AS n_rows, 'doc_id,text' AS columns FROM split GROUP BY split",
)
def dataset_manifest(spark, d):
    """Publish train and eval as one split-partitioned dataset in the
    shared folder; the manifest is read back from storage."""
    sp = C.split(spark, d)
    train = sp.filter(F.col("split") == "train").select("doc_id", "text")
    eval_ = sp.filter(F.col("split") == "eval").select("doc_id", "text")
    return src.publish_dataset(train, eval_, scratch_path(spark, "dataset"))


@register(
    "jsonl_roundtrip",
    f"WITH {SPLIT_CTE} SELECT sample AS text FROM corpus",
)
def jsonl_roundtrip(spark, d):
    path = scratch_path(spark, "jsonl")
    src.write_jsonl(C.corpus(spark, d), path, "sample")
    return src.read_jsonl_strict(spark, path)


@register(
    "jsonl_ascii_roundtrip",
    f"WITH {SPLIT_CTE} SELECT sample AS text FROM corpus",
)
def jsonl_ascii_roundtrip(spark, d):
    """S5 + S3: non-ASCII written as escapes, read back by the tolerant reader."""
    path = scratch_path(spark, "jsonl-ascii")
    src.write_jsonl_ascii(C.corpus(spark, d), path, "sample")
    return src.read_jsonl(spark, path)


_CFG_SRC = f"(SELECT event_id, props AS config FROM events UNION ALL SELECT * FROM {sql_values(C.CONFIG_ROWS, ['event_id', 'config'])})"


def _cfg_sql() -> str:
    body = "coalesce(json_extract(config, '$.model'), CAST(config AS JSON))"
    cols = []
    for name, public, own, default, typ in cfg.CONFIG_FIELDS:
        t = "INTEGER" if typ == "int" else "DOUBLE"
        cols.append(
            f"coalesce(TRY_CAST(json_extract_string(c, '$.{public}') AS {t}), "
            f"TRY_CAST(json_extract_string(c, '$.{own}') AS {t}), CAST({default} AS {t})) AS {name}"
        )
    return f"SELECT event_id, {', '.join(cols)} FROM (SELECT event_id, {body} AS c FROM {_CFG_SRC})"


@register("config_normalise", _cfg_sql())
def config_normalise(spark, d):
    ev = C.table(spark, d, "events").select("event_id", F.col("props").alias("config"))
    extra = spark.createDataFrame(C.CONFIG_ROWS, "event_id long, config string")
    return cfg.normalise_config(ev.unionByName(extra), "config", keep=("event_id",))


@register("corpus_scan_json", "SELECT doc_id, text FROM documents")
def corpus_scan_json(spark, d):
    """S1, JSON format: the documents written as JSON lines and read back."""
    path = scratch_path(spark, "corpus-json")
    C.table(spark, d, "documents").select("doc_id", "text").write.json(path)
    return src.read_corpus(spark, path, fmt="json")


@register(
    "corpus_scan_text",
    "SELECT line AS text, count(*) AS n FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY line",
)
def corpus_scan_text(spark, d):
    """S1, text format: lines written as plain text and read back; a line's id
    comes from its text, so equal lines share it."""
    path = scratch_path(spark, "corpus-text")
    C.table(spark, d, "documents").select(F.explode(F.split("text", "\n")).alias("value")).write.text(path)
    lines = src.read_corpus(spark, path, fmt="text")
    return lines.groupBy("doc_id", "text").agg(F.count(F.lit(1)).alias("n")).select("text", "n")


@register(
    "config_public_keys",
    "SELECT " + ", ".join(f"{own} AS {public}" for own, public, _, _, _ in cfg.CONFIG_FIELDS) + f" FROM ({_cfg_sql()}) AS c",
)
def config_public_keys(spark, d):
    """S8 inverted: normalised configs under the public key names."""
    ev = C.table(spark, d, "events").select("event_id", F.col("props").alias("config"))
    extra = spark.createDataFrame(C.CONFIG_ROWS, "event_id long, config string")
    return cfg.to_public_keys(cfg.normalise_config(ev.unionByName(extra), "config", keep=("event_id",)))


# ---- P: projections and scalar text functions -----------------------------------

@register("clean_text", f"SELECT doc_id, {sql_clean('text')} AS text FROM {EDGE_SQL}")
def clean_text(spark, d):
    return _docs_with_edges(spark, d).select("doc_id", TX.clean_text("text").alias("text"))


@register(
    "drop_empty",
    f"SELECT doc_id, text FROM (SELECT doc_id, {sql_clean('text')} AS text FROM {EDGE_SQL}) WHERE text <> ''",
)
def drop_empty(spark, d):
    return ranking.clean_nonempty(_docs_with_edges(spark, d))


@register("wrap_sample", f"SELECT doc_id, {C.sql_wrap('text')} AS sample FROM {EDGE_SQL}")
def wrap_sample(spark, d):
    return _docs_with_edges(spark, d).select("doc_id", TX.wrap_sample("text").alias("sample"))


_REPLY_SRC = (
    "(SELECT conv_id, turn, text FROM conversations WHERE role = 'assistant' UNION ALL SELECT * FROM "
    f"{sql_values(C.MARKER_REPLIES, ['conv_id', 'turn', 'text'])})"
)
_P4 = sql_strip("split_part(split_part(text, '<|im_end|>', 1), '<|im_start|>', 1)")


@register(
    "reply_cleanup",
    f"SELECT conv_id, turn, reply, coalesce(nullif(reply, ''), 'toki.') AS reply_or_default "
    f"FROM (SELECT conv_id, turn, {_P4} AS reply FROM {_REPLY_SRC})",
)
def reply_cleanup(spark, d):
    conv = C.table(spark, d, "conversations").filter(F.col("role") == "assistant").select("conv_id", "turn", "text")
    extra = spark.createDataFrame(C.MARKER_REPLIES, "conv_id long, turn long, text string")
    src_df = conv.unionByName(extra)
    return src_df.select(
        "conv_id", "turn", TX.truncate_reply("text").alias("reply"), TX.reply_or_default("text").alias("reply_or_default")
    )


_PROMPT_SRC = (
    "(SELECT conv_id, turn, text FROM conversations WHERE role = 'user' UNION ALL SELECT * FROM "
    f"{sql_values(C.EXIT_PROMPTS, ['conv_id', 'turn', 'text'])})"
)
_STRIPPED = sql_strip("coalesce(text, '')")


@register(
    "usable_prompts",
    f"SELECT conv_id, turn, {_STRIPPED} AS prompt FROM {_PROMPT_SRC} "
    f"WHERE lower({_STRIPPED}) NOT IN ('quit', 'exit', 'q') AND {_STRIPPED} <> ''",
)
def usable_prompts(spark, d):
    conv = C.table(spark, d, "conversations").filter(F.col("role") == "user").select("conv_id", "turn", "text")
    extra = spark.createDataFrame(C.EXIT_PROMPTS, "conv_id long, turn long, text string")
    return (
        conv.unionByName(extra)
        .filter(TX.is_usable_prompt("text", skip_blank=True))
        .select("conv_id", "turn", TX.py_strip(F.coalesce(F.col("text"), F.lit(""))).alias("prompt"))
    )


# ---- X: ordering, sampling, splitting ---------------------------------------

@register("seeded_shuffle", f"WITH {SPLIT_CTE} SELECT doc_id, rank FROM ranked")
def seeded_shuffle(spark, d):
    return ranking.seeded_shuffle(ranking.clean_nonempty(C.documents(spark, d))).select("doc_id", "rank")


@register("sample_n", f"WITH {SPLIT_CTE} SELECT doc_id, rank, text FROM ranked WHERE rank <= 500")
def sample_n(spark, d):
    return ranking.sample_n(ranking.clean_nonempty(C.documents(spark, d)), 500).select("doc_id", "rank", "text")


@register("train_eval_split", f"WITH {SPLIT_CTE} SELECT doc_id, rank, split FROM split")
def train_eval_split(spark, d):
    return ranking.train_eval_split(C.documents(spark, d)).select("doc_id", "rank", "split")


@register(
    "split_of_sample",
    f"WITH {SPLIT_CTE} SELECT doc_id, CASE WHEN rank <= floor(least(total, 300) * CAST(0.05 AS DOUBLE)) THEN 'eval' ELSE 'train' END AS split "
    "FROM ranked WHERE rank <= 300",
)
def split_of_sample(spark, d):
    """X3 with ``n_samples``: the first 300 of the seeded order, then split."""
    return ranking.split_by_threshold(C.documents(spark, d), n_samples=300).select("doc_id", "split")


@register(
    "split_overlap",
    f"WITH {SPLIT_CTE} SELECT count(*) AS n_texts, sum(n_rows) AS n_rows FROM "
    "(SELECT text, count(*) AS n_rows FROM split GROUP BY text HAVING count(DISTINCT split) > 1)",
)
def split_overlap(spark, d):
    """Texts that occur in both splits, and the rows that hold them."""
    return ranking.split_overlap(C.split(spark, d))


@register(
    "split_summary",
    f"WITH {SPLIT_CTE} SELECT split, count(*) AS n_rows FROM split GROUP BY split "
    "UNION ALL SELECT 'total' AS split, count(*) AS n_rows FROM split",
)
def split_summary(spark, d):
    return ranking.split_summary(C.split(spark, d))


@register("tokenizer_corpus", f"WITH {SPLIT_CTE} SELECT doc_id, split, sample FROM corpus")
def tokenizer_corpus(spark, d):
    return C.corpus(spark, d)


# ---- T: tokenizer -----------------------------------------------------------------

_WORDS_SQL = f"""
cw AS (SELECT doc_id, regexp_extract_all(sample, '{SQL_PAT}') AS w FROM corpus),
cpos AS (SELECT doc_id, unnest(w) AS word, unnest(generate_series(0, len(w) - 1)) AS pos FROM cw),
wc AS (SELECT word, count(*) AS n FROM cpos GROUP BY word)
"""

# byte -> symbol code point by the same rule as functions.byte_symbols
def _sym_sql() -> str:
    b = "CAST('0x' || h AS INTEGER)"
    sym = (
        f"chr(CASE WHEN {b} < 33 THEN 256 + {b} WHEN {b} >= 127 AND {b} <= 160 THEN {b} + 162 "
        f"WHEN {b} = 173 THEN 323 ELSE {b} END)"
    )
    return (
        "syms AS (SELECT word, n, list_transform(regexp_extract_all(hex(encode(word)), '..'), "
        f"lambda h: {sym}) AS s FROM wc)"
    )


@register(
    "pretokenise",
    f"WITH {SPLIT_CTE}, {_WORDS_SQL} SELECT doc_id, CAST(pos AS INTEGER) AS pos, word FROM cpos",
)
def pretokenise(spark, d):
    return tokenizer.pretokenise(C.corpus(spark, d), "sample")


@register("word_counts", f"WITH {SPLIT_CTE}, {_WORDS_SQL} SELECT word, n FROM wc")
def word_counts(spark, d):
    return tokenizer.word_counts(C.corpus(spark, d))


@register(
    "byte_symbols",
    f"WITH {SPLIT_CTE}, {_WORDS_SQL}, {_sym_sql()} SELECT word, array_to_string(s, '') AS symbols, len(s) AS n_symbols FROM syms",
)
def byte_symbols_q(spark, d):
    wc = tokenizer.word_counts(C.corpus(spark, d))
    s = byte_symbols("word")
    return wc.select("word", F.array_join(s, "").alias("symbols"), F.size(s).alias("n_symbols"))


@register(
    "initial_vocab",
    f"WITH {SPLIT_CTE}, {_WORDS_SQL}, {_sym_sql()}, "
    "alpha AS (SELECT DISTINCT unnest(s) AS token FROM syms) "
    "SELECT * FROM (VALUES (0, '<pad>', true), (1, '<|im_start|>', true), (2, '<|im_end|>', true)) AS t(id, token, is_special) "
    "UNION ALL SELECT CAST(row_number() OVER (ORDER BY token) + 2 AS INTEGER) AS id, token, false AS is_special FROM alpha",
)
def initial_vocab(spark, d):
    return tokenizer.initial_vocab(tokenizer.word_counts(C.corpus(spark, d)))


@register(
    "pair_counts",
    f"WITH {SPLIT_CTE}, {_WORDS_SQL}, {_sym_sql()} "
    "SELECT s[i] AS \"left\", s[i + 1] AS \"right\", sum(n) AS n FROM syms, range(1, len(s)) AS t(i) "
    "GROUP BY s[i], s[i + 1]",
)
def pair_counts(spark, d):
    return tokenizer.pair_counts(tokenizer.word_counts(C.corpus(spark, d)))


@register(
    "vocab_size",
    f"WITH {SPLIT_CTE}, {_WORDS_SQL}, {_sym_sql()}, alpha AS (SELECT DISTINCT unnest(s) AS token FROM syms) "
    "SELECT CAST(3 AS BIGINT) AS n_special, count(*) AS n_regular, count(*) + 3 AS vocab_size FROM alpha",
)
def vocab_size(spark, d):
    return tokenizer.learned_vocab_stats(tokenizer.initial_vocab(tokenizer.word_counts(C.corpus(spark, d))))


_BPE = f"WITH {SPLIT_CTE}, {_WORDS_SQL}, {_sym_sql()}, {C.bpe_cte()}"
_RANKED = " UNION ALL ".join(f"SELECT {k - 1} AS rank, l, r, id FROM q{k}" for k in range(1, C.BPE_MERGES + 1))


@register(
    "bpe_merges_32",
    f"{_BPE} SELECT CAST(rank AS INTEGER) AS rank, a.token AS \"left\", b.token AS \"right\", a.token || b.token AS token, CAST(m.id AS INTEGER) AS id "
    f"FROM ({_RANKED}) AS m JOIN k{C.BPE_MERGES} AS a ON a.id = m.l JOIN k{C.BPE_MERGES} AS b ON b.id = m.r",
)
def bpe_merges_32(spark, d):
    """The first 32 merges, which SQL repeats step by step."""
    return C.learned_tokenizer(spark, d, C.BPE_MERGES).merges_df(spark)


@register("bpe_merges")
def bpe_merges(spark, d):
    """T6 to the full stop rule: 4,096 tokens or no pair seen twice."""
    return C.learned_tokenizer(spark, d).merges_df(spark)


@register(
    "tokenizer_store_32",
    f"{_BPE} SELECT * FROM (VALUES (0, '<pad>', true), (1, '<|im_start|>', true), (2, '<|im_end|>', true)) AS t(id, token, is_special) "
    f"UNION ALL SELECT CAST(id AS INTEGER), token, false FROM k{C.BPE_MERGES}",
)
def tokenizer_store_32(spark, d):
    return _stored(spark, C.learned_tokenizer(spark, d, C.BPE_MERGES))


@register("tokenizer_store")
def tokenizer_store(spark, d):
    return _stored(spark, C.learned_tokenizer(spark, d))


def _stored(spark, tok):
    """The learned vocabulary and merges written as two tables and read
    back; the reloaded tokenizer must equal the learned one."""
    from ..sources.tokenizer_store import load_tokenizer, save_tokenizer

    path = scratch_path(spark, "tokenizer")
    save_tokenizer(tok, spark, path)
    back = load_tokenizer(spark, path)
    if back.tokens != tok.tokens or back.merges != tok.merges:
        raise AssertionError("tokenizer changed on its way through storage")
    return spark.read.parquet(f"{path}/vocab").select("id", "token", "is_special")


@register(
    "tokenizer_import",
    f"{_BPE} SELECT * FROM (VALUES (0, '<pad>', true), (1, '<|im_start|>', true), (2, '<|im_end|>', true)) AS t(id, token, is_special) "
    f"UNION ALL SELECT CAST(id AS INTEGER), token, false FROM k{C.BPE_MERGES}",
)
def tokenizer_import(spark, d):
    """The tokenizer written as a JSON artefact and imported again, with
    either spelling of the merges."""
    from ..sources.tokenizer_store import export_tokenizer_json, import_tokenizer_json

    tok = C.learned_tokenizer(spark, d, C.BPE_MERGES)
    found = []
    for pairs in (True, False):
        path = scratch_path(spark, "tokenizer-json")
        export_tokenizer_json(tok, spark, path, pairs)
        found.append(import_tokenizer_json(spark, path))
    if any(x.merges != tok.merges or x.tokens != tok.tokens for x in found):
        raise AssertionError("tokenizer changed on its way through JSON")
    return found[0].vocab_df(spark)


_SEP = "chr(57344) || chr(57345)"
_MARKED = f"replace(replace(sample, '<|im_start|>', {_SEP} || '<|im_start|>' || {_SEP}), '<|im_end|>', {_SEP} || '<|im_end|>' || {_SEP})"
_SEG_SRC = (
    "(SELECT doc_id, sample FROM corpus UNION ALL SELECT * FROM "
    f"{sql_values([(-1, 'x<|im_end|>y'), (-2, '<|im_start|><|im_end|>'), (-3, 'no markers')], ['doc_id', 'sample'])})"
)


@register(
    "split_specials",
    f"WITH {SPLIT_CTE}, segs AS (SELECT doc_id, list_filter(string_split({_MARKED}, {_SEP}), lambda x: x <> '') AS s FROM {_SEG_SRC}) "
    "SELECT doc_id, CAST(unnest(generate_series(0, len(s) - 1)) AS INTEGER) AS seg_pos, unnest(s) AS segment FROM segs",
)
def split_specials(spark, d):
    tok = tokenizer.Tokenizer(tokens=list(TX.SPECIAL_TOKENS))
    extra = spark.createDataFrame([(-1, "x<|im_end|>y"), (-2, "<|im_start|><|im_end|>"), (-3, "no markers")], "doc_id long, sample string")
    src_df = C.corpus(spark, d).select("doc_id", "sample").unionByName(extra)
    return src_df.select("doc_id", F.posexplode(codec.split_specials("sample", tok)).alias("seg_pos", "segment"))


_ENC = f"{_BPE}, {C.bpe_encode_cte()}"


@register("encode_tokens_32", f"{_ENC} SELECT doc_id, CAST(len(ids) AS INTEGER) AS n_tokens, array_to_string(ids, ' ') AS ids FROM enc")
def encode_tokens_32(spark, d):
    return _encoded(spark, d, C.BPE_MERGES)


@register("encode_tokens")
def encode_tokens(spark, d):
    """T9 with the full vocabulary."""
    return _encoded(spark, d, None)


def _encoded(spark, d, merges):
    enc = codec.encode(C.corpus(spark, d), C.learned_tokenizer(spark, d, merges))
    return enc.select("doc_id", F.size("ids").alias("n_tokens"), sequences.ids_text("ids").alias("ids"))


# every byte of the corpus is in the vocabulary learned on it, so decoding
# the encoding gives back the sample with its markers removed
@register(
    "decode_tokens",
    f"WITH {SPLIT_CTE} SELECT doc_id, replace(replace(sample, '<|im_start|>', ''), '<|im_end|>', '') AS text FROM corpus",
)
def decode_tokens(spark, d):
    tok = C.learned_tokenizer(spark, d)
    enc = codec.encode(C.corpus(spark, d), tok)
    return enc.select("doc_id", codec.decode_column("ids", tok).alias("text"))


@register(
    "roundtrip_audit",
    f"WITH {SPLIT_CTE} SELECT count(*) AS n_docs, count(*) AS n_roundtrip_ok, count(*) AS n_first_id_1 FROM corpus",
)
def roundtrip_audit(spark, d):
    return codec.roundtrip_audit(C.corpus(spark, d), C.learned_tokenizer(spark, d))


@register(
    "token_stats_32",
    f"{_ENC} SELECT split, count(*) AS n_docs, sum(len(ids)) AS n_tokens, round(avg(len(ids)), 6) AS avg_tokens, max(len(ids)) AS max_tokens, "
    "round(sum(length(sample)) / sum(len(ids)), 6) AS chars_per_token FROM enc GROUP BY split",
)
def token_stats_32(spark, d):
    tok = C.learned_tokenizer(spark, d, C.BPE_MERGES)
    return codec.token_stats(codec.encode(C.corpus(spark, d), tok))


@register("token_stats")
def token_stats(spark, d):
    """T12 with the full vocabulary."""
    tok = C.learned_tokenizer(spark, d)
    return codec.token_stats(codec.encode(C.corpus(spark, d), tok))


# ---- D: training-set shaping (word ids as tokens) -------------------------------

@register(
    "truncate_filter",
    f"WITH {SPLIT_CTE}, {WORDS_CTE} SELECT doc_id, split, len(ids) AS n_tokens, array_to_string(ids, ' ') AS ids FROM seqs",
)
def truncate_filter(spark, d):
    s = C.word_seqs(spark, d)
    return s.select("doc_id", "split", F.size("ids").alias("n_tokens"), sequences.ids_text("ids").alias("ids"))


@register(
    "shift_pairs",
    f"WITH {SPLIT_CTE}, {WORDS_CTE} SELECT doc_id, win, split, array_to_string(ids[1:len(ids) - 1], ' ') AS x, "
    "array_to_string(ids[2:len(ids)], ' ') AS y FROM wins",
)
def shift_pairs(spark, d, merges=None):
    s = sequences.shift_pairs(C.seq_windows(spark, d, merges))
    return s.select("doc_id", "win", "split", sequences.ids_text("x").alias("x"), sequences.ids_text("y").alias("y"))


_BATCH_SQL = """
batched AS (
  SELECT seq_id, split, ids, CAST(0 AS INTEGER) AS epoch,
         row_number() OVER (PARTITION BY split ORDER BY
            md5(CASE WHEN split = 'train' THEN '42:0:' ELSE '42:' END || seq_id), seq_id) AS o
  FROM wins),
b2 AS (SELECT seq_id, split, ids, epoch, CAST(floor((o - 1) / 32) AS INTEGER) AS batch_id,
              CAST((o - 1) % 32 AS INTEGER) AS row_in_batch FROM batched)
"""


def _batched(spark, d, merges=None):
    s = C.seq_windows(spark, d, merges)
    tr = sequences.assign_batches(s.filter(F.col("split") == "train"), shuffle=True, epoch=0, id_col="seq_id")
    ev = sequences.assign_batches(s.filter(F.col("split") == "eval"), shuffle=False, id_col="seq_id")
    return tr.unionByName(ev)


@register(
    "assign_batches",
    f"WITH {SPLIT_CTE}, {WORDS_CTE}, {_BATCH_SQL} SELECT seq_id, split, epoch, batch_id, row_in_batch FROM b2",
)
def assign_batches(spark, d, merges=None):
    return _batched(spark, d, merges).select("seq_id", "split", "epoch", "batch_id", "row_in_batch")


@register(
    "file_order_batches",
    f"WITH {SPLIT_CTE} SELECT md5(sample) AS sample_md5, CAST(floor((rank - 1) / 32) AS INTEGER) AS batch_id, CAST((rank - 1) % 32 AS INTEGER) AS row_in_batch "
    "FROM corpus JOIN split USING (doc_id) WHERE split.split = 'eval'",
)
def file_order_batches(spark, d):
    """D4 for the evaluation set: its JSONL file is written in split order, and
    batches follow the lines as they stand in the files."""
    ranked = ranking.train_eval_split(C.documents(spark, d)).filter(F.col("split") == "eval")
    ordered = ranked.select("rank", TX.wrap_sample("text").alias("sample")).repartitionByRange(4, "rank").sortWithinPartitions("rank")
    path = scratch_path(spark, "eval-jsonl")
    src.write_jsonl(ordered, path, "sample")
    lines = src.read_jsonl_in_order(spark, path)
    return sequences.batches_in_order(lines, "line_no").select(F.md5("text").alias("sample_md5"), "batch_id", "row_in_batch")


@register(
    "pad_batch",
    f"WITH {SPLIT_CTE}, {WORDS_CTE}, {_BATCH_SQL}, "
    "p AS (SELECT *, max(len(ids) - 1) OVER (PARTITION BY split, epoch, batch_id) AS padded_len FROM b2) "
    "SELECT seq_id, split, batch_id, CAST(padded_len AS INTEGER) AS padded_len, "
    "array_to_string(ids[1:len(ids) - 1], ' ') || repeat(' 0', CAST(padded_len - (len(ids) - 1) AS INTEGER)) AS x_pad, "
    "array_to_string(ids[2:len(ids)], ' ') || repeat(' 0', CAST(padded_len - (len(ids) - 1) AS INTEGER)) AS y_pad, "
    "CAST(len(ids) - 1 AS INTEGER) AS n_real, CAST(padded_len - (len(ids) - 1) AS INTEGER) AS n_pad FROM p",
)
def pad_batch(spark, d, merges=None):
    p = sequences.pad_batch(sequences.shift_pairs(_batched(spark, d, merges)))
    return p.select(
        "seq_id",
        "split",
        "batch_id",
        "padded_len",
        sequences.ids_text("x_pad").alias("x_pad"),
        sequences.ids_text("y_pad").alias("y_pad"),
        F.size("x").alias("n_real"),
        (F.col("padded_len") - F.size("x")).alias("n_pad"),
    )


@register(
    "padding_report",
    f"WITH {SPLIT_CTE}, {WORDS_CTE}, {_BATCH_SQL}, "
    "p AS (SELECT *, max(len(ids) - 1) OVER (PARTITION BY split, epoch, batch_id) AS padded_len FROM b2) "
    "SELECT split, batch_id, count(*) AS n_rows, sum(len(ids) - 1) AS n_real, sum(padded_len - (len(ids) - 1)) AS n_pad FROM p GROUP BY split, batch_id",
)
def padding_report(spark, d, merges=None):
    """Real and padded positions of every batch."""
    return sequences.padding_report(sequences.shift_pairs(_batched(spark, d, merges)))


@register(
    "step_plan",
    f"WITH {SPLIT_CTE}, {WORDS_CTE}, nb AS (SELECT CAST(ceil(count(*) / 32.0) AS BIGINT) AS n FROM wins WHERE split = 'train') "
    "SELECT step, CAST(step // n AS INTEGER) AS epoch, CAST(step % n AS INTEGER) AS batch_id FROM range(10000) AS t(step), nb",
)
def step_plan(spark, d, merges=None):
    tr = C.seq_windows(spark, d, merges).filter(F.col("split") == "train")
    return sequences.step_plan(tr, runlog.MAX_STEPS).select(
        "step", F.col("epoch").cast("int").alias("epoch"), F.col("batch_id").cast("int").alias("batch_id")
    )


@register(
    "dataset_sizes",
    f"WITH {SPLIT_CTE}, {WORDS_CTE} SELECT split, count(*) AS n_sequences FROM wins GROUP BY split",
)
def dataset_sizes(spark, d, merges=None):
    return sequences.dataset_sizes(C.seq_windows(spark, d, merges))


# ---- M: next-token model ---------------------------------------------------------

_NGRAM_SQL = """
tpos AS (SELECT doc_id, ids, unnest(generate_series(1, len(ids) - 1)) AS i FROM seqs_full WHERE split = '{split}'),
ex AS (
  SELECT 1 AS "order", '' AS ctx, ids[i + 1] AS token FROM tpos
  UNION ALL SELECT 2, array_to_string(ids[i:i], ' '), ids[i + 1] FROM tpos
  UNION ALL SELECT 3, array_to_string(ids[i - 1:i], ' '), ids[i + 1] FROM tpos WHERE i >= 2),
counts AS (SELECT "order", ctx, token, count(*) AS n FROM ex GROUP BY ALL),
totals AS (SELECT "order", ctx, sum(n) AS n_ctx FROM counts GROUP BY ALL)
"""
_NG_TRAIN = _NGRAM_SQL.format(split="train")


@register(
    "ngram_counts",
    f"WITH {SPLIT_CTE}, {WORDS_CTE}, {_NG_TRAIN} SELECT CAST(\"order\" AS INTEGER) AS \"order\", ctx, token, n FROM counts",
)
def ngram_counts(spark, d, merges=None):
    s = C.seq_table(spark, d, merges).filter(F.col("split") == "train")
    return ngram.ngram_counts(s)


def _vsize_sql() -> str:
    return "(SELECT max(token) + 1 FROM wvocab)"


_PROB_SQL = f"""
vs AS (SELECT CAST({_vsize_sql()} AS DOUBLE) AS v),
p1 AS (SELECT c.ctx, c.token, 0.5 * c.n / t.n_ctx + 0.5 * (1.0 / v) AS p FROM counts c JOIN totals t USING ("order", ctx), vs WHERE c."order" = 1),
p2 AS (SELECT c.ctx, c.token, 0.5 * c.n / t.n_ctx + 0.5 * p1.p AS p FROM counts c JOIN totals t USING ("order", ctx)
       JOIN p1 ON p1.token = c.token WHERE c."order" = 2),
p3 AS (SELECT c.ctx, c.token, 0.5 * c.n / t.n_ctx + 0.5 * p2.p AS p FROM counts c JOIN totals t USING ("order", ctx)
       JOIN p2 ON p2.ctx = split_part(c.ctx, ' ', 2) AND p2.token = c.token WHERE c."order" = 3)
"""


@register(
    "ngram_prob",
    f"WITH {SPLIT_CTE}, {WORDS_CTE}, {_NG_TRAIN}, {_PROB_SQL} "
    "SELECT 1 AS \"order\", ctx, token, round(p, 9) AS p FROM p1 UNION ALL SELECT 2, ctx, token, round(p, 9) FROM p2 "
    "UNION ALL SELECT 3, ctx, token, round(p, 9) FROM p3",
)
def ngram_prob(spark, d):
    s, size = C.word_seq_table(spark, d).filter(F.col("split") == "train"), C.word_vocab_size(spark, d)
    with working_tables(spark):
        pr = ngram.ngram_probabilities(ngram.fit(s), size)
    return pr.select("order", "ctx", "token", F.round("p", 9).alias("p"))


_NLL_SQL = f"""
vs AS (SELECT CAST({_vsize_sql()} AS DOUBLE) AS v),
n1 AS (SELECT n_ctx AS n1 FROM totals WHERE "order" = 1),
epos AS (SELECT doc_id, ids, unnest(generate_series(1, len(ids) - 1)) AS i FROM seqs_full WHERE split = 'eval'),
e AS (SELECT doc_id, i - 1 AS p, ids[i + 1] AS token, array_to_string(ids[i:i], ' ') AS h2,
             CASE WHEN i >= 2 THEN array_to_string(ids[i - 1:i], ' ') END AS h3 FROM epos),
s1 AS (SELECT e.*, 0.5 * coalesce(c1.n, 0) / n1.n1 + 0.5 * (1.0 / vs.v) AS prob
       FROM e LEFT JOIN counts c1 ON c1."order" = 1 AND c1.token = e.token, n1, vs),
s2 AS (SELECT s1.doc_id, s1.p, s1.token, s1.h3,
              CASE WHEN t2.n_ctx > 0 THEN 0.5 * coalesce(c2.n, 0) / t2.n_ctx + 0.5 * s1.prob ELSE s1.prob END AS prob
       FROM s1 LEFT JOIN counts c2 ON c2."order" = 2 AND c2.ctx = s1.h2 AND c2.token = s1.token
               LEFT JOIN totals t2 ON t2."order" = 2 AND t2.ctx = s1.h2),
s3 AS (SELECT s2.doc_id, s2.p, s2.token,
              CASE WHEN t3.n_ctx > 0 THEN 0.5 * coalesce(c3.n, 0) / t3.n_ctx + 0.5 * s2.prob ELSE s2.prob END AS prob
       FROM s2 LEFT JOIN counts c3 ON c3."order" = 3 AND c3.ctx = s2.h3 AND c3.token = s2.token
               LEFT JOIN totals t3 ON t3."order" = 3 AND t3.ctx = s2.h3)
"""


def _nll(spark, d, merges=None):
    s, size = C.seq_table(spark, d, merges), C.seq_vocab_size(spark, d, merges)
    with working_tables(spark):
        counts = ngram.fit(s.filter(F.col("split") == "train"))
        return written(ngram.score_positions(s.filter(F.col("split") == "eval"), counts, size), "token_nll", ends=2)


@register(
    "token_nll",
    f"WITH {SPLIT_CTE}, {WORDS_CTE}, {_NG_TRAIN}, {_NLL_SQL} "
    "SELECT doc_id, CAST(p AS INTEGER) AS p, token, round(-ln(prob), 9) AS nll FROM s3",
)
def token_nll(spark, d, merges=None):
    return _nll(spark, d, merges).select("doc_id", "p", "token", F.round("nll", 9).alias("nll"))


@register(
    "eval_loss",
    f"WITH {SPLIT_CTE}, {WORDS_CTE}, {_NG_TRAIN}, {_NLL_SQL}, "
    "eb AS (SELECT doc_id, CAST(floor((row_number() OVER (ORDER BY md5('42:' || CAST(doc_id AS VARCHAR)), doc_id) - 1) / 32) AS INTEGER) AS batch_id "
    "       FROM seqs_full WHERE split = 'eval'), "
    "pb AS (SELECT batch_id, avg(-ln(prob)) AS bl FROM s3 JOIN eb USING (doc_id) WHERE batch_id < 50 GROUP BY batch_id) "
    "SELECT round(coalesce(avg(bl), 0.0), 9) AS eval_loss FROM pb",
)
def eval_loss(spark, d, merges=None):
    s, size = C.seq_table(spark, d, merges), C.seq_vocab_size(spark, d, merges)
    with working_tables(spark):
        ev = sequences.assign_batches(s.filter(F.col("split") == "eval"), shuffle=False)
        ev = ngram.first_batches(ev).select("ids", "batch_id")  # only what is averaged is scored
        counts = ngram.fit(s.filter(F.col("split") == "train"))
        mean = ngram.mean_of_batches(ngram.score_batches(ev, counts, size))
        return written(mean.select(F.round("eval_loss", 9).alias("eval_loss")), "eval_loss", ends=2)


# the same operators on token ids, as training reads them; SQL learns the same merges
_BPE_SEQ = f"{_ENC}, wvocab AS (SELECT max(id) AS token FROM k{C.BPE_MERGES}), seqs_full AS (SELECT doc_id, split, ids FROM enc), {SHAPES_CTE}"
for _fn in (shift_pairs, pad_batch, ngram_counts):
    _name = _fn.__name__
    register(f"{_name}_bpe_32", SQL[_name].replace(f"WITH {SPLIT_CTE}, {WORDS_CTE}", _BPE_SEQ, 1))(update_wrapper(partial(_fn, merges=C.BPE_MERGES), _fn))


# logits of the bigram (order-2, maximum likelihood) next-token table per context
_LOGIT_SQL = """
lg AS (SELECT ctx, token, ln(CAST(c.n AS DOUBLE) / t.n_ctx) AS logit FROM counts c JOIN totals t USING ("order", ctx) WHERE c."order" = 2),
tk AS (SELECT * FROM (SELECT *, rank() OVER (PARTITION BY ctx ORDER BY logit DESC) AS rk FROM lg) WHERE rk <= 50),
sx AS (SELECT ctx, token, exp(logit / 0.7 - max(logit / 0.7) OVER (PARTITION BY ctx)) AS e FROM tk),
sm AS (SELECT ctx, token, e / sum(e) OVER (PARTITION BY ctx) AS prob FROM sx)
"""


def _bigram_logits(spark, d):
    s = C.word_seq_table(spark, d).filter(F.col("split") == "train")
    c2 = ngram.fit(s).filter(F.col("order") == 2)
    tot = ngram.context_totals(c2)
    return c2.join(tot, ["order", "ctx"]).select(
        F.col("ctx").alias("prompt_id"), "token", F.log(F.col("n") / F.col("n_ctx")).alias("logit")
    )


@register(
    "top_k_ties",
    f"WITH {SPLIT_CTE}, {WORDS_CTE}, {_NG_TRAIN}, {_LOGIT_SQL} SELECT ctx, token, round(logit, 9) AS logit FROM tk",
)
def top_k_ties(spark, d):
    t = ngram.top_k(_bigram_logits(spark, d), 50)
    return t.select(F.col("prompt_id").alias("ctx"), "token", F.round("logit", 9).alias("logit"))


def _softmaxed(spark, d):
    C.word_seq_table(spark, d)
    with working_tables(spark):
        return written(ngram.softmax(ngram.apply_temperature(ngram.top_k(_bigram_logits(spark, d), 50), 0.7)), "softmax", ends=2)


@register(
    "softmax",
    f"WITH {SPLIT_CTE}, {WORDS_CTE}, {_NG_TRAIN}, {_LOGIT_SQL} SELECT ctx, token, round(prob, 9) AS prob FROM sm",
)
def softmax_q(spark, d):
    return _softmaxed(spark, d).select(F.col("prompt_id").alias("ctx"), "token", F.round("prob", 9).alias("prob"))


@register(
    "draw_token",
    f"WITH {SPLIT_CTE}, {WORDS_CTE}, {_NG_TRAIN}, {_LOGIT_SQL}, "
    "acc AS (SELECT ctx, token, sum(prob) OVER (PARTITION BY ctx ORDER BY token ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS a, "
    "        (('0x' || substr(md5('42:' || ctx || ':0'), 1, 8))::BIGINT)::DOUBLE / 4294967296.0 AS u FROM sm) "
    "SELECT ctx, coalesce(min(CASE WHEN a >= u THEN token END), max(token)) AS token FROM acc GROUP BY ctx",
)
def draw_token(spark, d):
    C.word_seq_table(spark, d)
    with working_tables(spark):
        drawn = ngram.draw(_softmaxed(spark, d), seed=42, step=0)
        return written(drawn.select(F.col("prompt_id").alias("ctx"), "token"), "draw_token", ends=2)


@register(
    "known_tokens",
    f"WITH {SPLIT_CTE}, {WORDS_CTE}, {_NG_TRAIN}, "
    "ev AS (SELECT DISTINCT unnest(ids) AS token FROM seqs_full WHERE split = 'eval') "
    "SELECT CAST(\"order\" AS INTEGER) AS \"order\", ctx, token, n FROM counts WHERE token IN (SELECT token FROM ev)",
)
def known_tokens(spark, d):
    s = C.word_seq_table(spark, d)
    counts = ngram.ngram_counts(s.filter(F.col("split") == "train"))
    vocab = s.filter(F.col("split") == "eval").select(F.explode("ids").alias("token"))
    return ngram.keep_known_tokens(counts, vocab)


@register(
    "model_size",
    f"WITH {SPLIT_CTE}, {WORDS_CTE}, {_NG_TRAIN} "
    "SELECT CAST(\"order\" AS INTEGER) AS \"order\", count(*) AS n_rows, sum(n) AS n_events FROM counts GROUP BY \"order\" "
    "UNION ALL SELECT 0, count(*), sum(n) FROM counts",
)
def model_size(spark, d):
    s = C.word_seq_table(spark, d).filter(F.col("split") == "train")
    return ngram.size_report(ngram.ngram_counts(s))


def bpe_model(spark, d, merges: int | None = None) -> ngram.NgramModel:
    """n-gram model over the BPE ids of the train split (bounded vocabulary)."""
    key = ("bpe_model", C._app(spark), d, merges)
    if key not in C._cache:
        tok = C.learned_tokenizer(spark, d, merges)
        tr = C.corpus(spark, d).filter(F.col("split") == "train")
        C._cache[key] = ngram.build_model(codec.encode(tr, tok), tok.vocab_size)
    return C._cache[key]


_LAST = f"""
lastm AS (SELECT conv_id AS prompt_id, 'assistant' || {NL} || coalesce(arg_max_null(text, turn), '') AS body FROM conversations GROUP BY conv_id),
{C.encode_body_cte("pe", "lastm", "prompt_id")},
pids AS (SELECT prompt_id, list_prepend(1, ids) AS ids FROM pe)"""
_GEN = f"{_ENC}, {_LAST}, {C.generate_cte('pids')}".replace("WITH ", "WITH RECURSIVE ", 1)


@register(
    "generate_batch_32",
    f"{_GEN} SELECT prompt_id, CAST(len(pids.ids) AS INTEGER) AS n_prompt, CAST(step AS INTEGER) AS n_new, "
    "array_to_string(g.ids[len(pids.ids) + 1:], ' ') AS new_ids FROM "
    "(SELECT * FROM gen QUALIFY row_number() OVER (PARTITION BY prompt_id ORDER BY step DESC) = 1) AS g JOIN pids USING (prompt_id)",
)
def generate_batch_32(spark, d):
    return _generated(spark, d, C.BPE_MERGES)


@register("generate_batch")
def generate_batch(spark, d):
    """M8 with the full vocabulary."""
    return _generated(spark, d, None)


def _generated(spark, d, merges):
    tok = C.learned_tokenizer(spark, d, merges)
    prompts = chat.last_message_prompt(C.table(spark, d, "conversations"))
    enc = codec.encode(prompts, tok, "prompt", "ids")
    gen = ngram.generate(enc.select("prompt_id", "ids"), bpe_model(spark, d, merges))
    return gen.select("prompt_id", "n_prompt", F.size("new_ids").alias("n_new"), sequences.ids_text("new_ids").alias("new_ids"))


# ---- C: chat -------------------------------------------------------------------------

_CONV_SRC = (
    "(SELECT conv_id, turn, role, text FROM conversations UNION ALL SELECT * FROM "
    f"{sql_values(C.NULL_LAST_TURN, ['conv_id', 'turn', 'role', 'text'])})"
)


@register(
    "last_message_prompt",
    f"SELECT conv_id AS prompt_id, '<|im_start|>assistant' || {NL} || coalesce(text, '') AS prompt FROM "
    f"(SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS rn FROM {_CONV_SRC}) WHERE rn = 1",
)
def last_message_prompt(spark, d):
    conv = C.table(spark, d, "conversations")
    extra = spark.createDataFrame(C.NULL_LAST_TURN, "conv_id long, turn long, role string, text string")
    return chat.last_message_prompt(conv.unionByName(extra))


@register(
    "two_role_prompt",
    f"SELECT conv_id, turn, '<|im_start|>user' || {NL} || {sql_strip('coalesce(text, ' + chr(39) * 2 + ')')} || '<|im_end|>' || {NL} "
    f"|| '<|im_start|>assistant' || {NL} AS prompt FROM conversations WHERE role = 'user'",
)
def two_role_prompt(spark, d):
    user = C.table(spark, d, "conversations").filter(F.col("role") == "user")
    return chat.two_role_prompts(user).select("conv_id", "turn", "prompt")


@register(
    "choices_flatten",
    f"SELECT conv_id, turn, {sql_strip(_P4)} AS reply FROM conversations WHERE role = 'assistant'",
)
def choices_flatten(spark, d):
    a = C.table(spark, d, "conversations").filter(F.col("role") == "assistant")
    res = a.select("conv_id", "turn", TX.truncate_reply("text").alias("content")).select(
        "conv_id", "turn", chat.as_result("content").alias("result")
    )
    return chat.explode_choices(res).select("conv_id", "turn", "reply")


@register(
    "reply_quality",
    f"WITH {SPLIT_CTE}, known AS (SELECT DISTINCT unnest(regexp_extract_all(text, '{SQL_PAT}')) AS word FROM split WHERE split = 'train'), "
    f"r AS (SELECT {_P4} AS reply, contains(text, '<|im_end|>') AS ended FROM {_REPLY_SRC}), "
    f"rw AS (SELECT unnest(regexp_extract_all({sql_clean('reply')}, '{SQL_PAT}')) AS word FROM r), "
    "a AS (SELECT count(*) AS n_replies, count(*) FILTER (reply <> '') AS n_nonempty, count(*) FILTER (ended) AS n_ended FROM r), "
    "b AS (SELECT count(*) AS n_words, count(known.word) AS n_known FROM rw LEFT JOIN known USING (word)) "
    "SELECT *, round(n_known / n_words, 9) AS known_share, round(n_nonempty / n_replies, 9) AS nonempty_share, round(n_ended / n_replies, 9) AS ended_share FROM a, b",
)
def reply_quality(spark, d):
    """M11 on all assistant turns against the words of the train split."""
    conv = C.table(spark, d, "conversations").filter(F.col("role") == "assistant").select("conv_id", "turn", "text")
    extra = spark.createDataFrame(C.MARKER_REPLIES, "conv_id long, turn long, text string")
    made = chat.reply_quality(conv.unionByName(extra), C.split(spark, d).filter(F.col("split") == "train"))
    return made.select(*[F.round(c, 9).alias(c) if c.endswith("_share") else c for c in made.columns])


@register("chat_complete")
def chat_complete(spark, d):
    tok = C.learned_tokenizer(spark, d)
    prompts = chat.last_message_prompt(C.table(spark, d, "conversations"))
    res = chat.complete(prompts, tok, bpe_model(spark, d))
    return chat.explode_choices(res).select("prompt_id", "n_new", "reply")


def _user_prompts(spark, d):
    """Every usable user turn; the topic names its conversation."""
    user = C.table(spark, d, "conversations").filter((F.col("role") == "user") & TX.is_usable_prompt("text"))
    key = F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    return user.select(key.alias("prompt_id"), F.concat(F.lit("conversation "), F.col("conv_id").cast("string")).alias("topic"), TX.assistant_prompt("text").alias("prompt"))


@register("prompt_suite_report")
def prompt_suite_report(spark, d):
    tok = C.learned_tokenizer(spark, d)
    prompts = _user_prompts(spark, d)
    res = chat.complete(prompts, tok, bpe_model(spark, d))
    return chat.prompt_suite_report(prompts, res).select("prompt_id", "topic", "prompt", "reply")


@register("answer_stream")
def answer_stream_q(spark, d):
    """User turns arrive as a file stream and are answered per
    micro-batch; the sink is read back."""
    from ..streaming.answer_stream import answer_stream

    tok = C.learned_tokenizer(spark, d)
    out = scratch_path(spark, "answers")

    def prepare(stream):
        users = stream.filter(F.col("role") == "user")
        return users.select(F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("prompt_id"), "text")

    q = answer_stream(
        spark,
        f"{d}/conversation[s].parquet",
        "conv_id long, turn long, role string, text string",
        tok,
        bpe_model(spark, d),
        out,
        out + "-checkpoint",
        prepare=prepare,
    )
    q.awaitTermination()
    return spark.read.parquet(out).select("prompt_id", "n_new", "reply")


# ---- L: run-log analytics --------------------------------------------------------------

_LOG_SQL = """
lg AS (SELECT user_id AS run_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS step,
              CAST(value AS DOUBLE) AS loss, ts FROM events)
"""


def _log(spark, d, run_col: str = "user_id"):
    return runlog.run_log_from_events(C.table(spark, d, "events"), run_col)


# long runs: one run per event type (few, large runs; the blocked windows
# split them, and the interval / save steps are reached even at sf0.01)
_LONG_LOG_SQL = """
lg AS (SELECT event_type AS run_id, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS step,
              CAST(value AS DOUBLE) AS loss, ts FROM events)
"""


@register(
    "lr_schedule",
    f"WITH {_LOG_SQL} SELECT run_id, step, round(CASE WHEN step < 200 THEN 0.0003 * CAST(step AS DOUBLE) / 200.0 "
    "ELSE 3e-05 + (0.0003 - 3e-05) * (0.5 * (1.0 + cos(pi() * ((CAST(step AS DOUBLE) - 200.0) / 9800.0)))) END, 12) AS lr FROM lg",
)
def lr_schedule(spark, d):
    return _log(spark, d).select("run_id", "step", F.round(runlog.lr_schedule("step"), 12).alias("lr"))


@register(
    "rolling_loss",
    f"WITH {_LONG_LOG_SQL} SELECT run_id, step, round(r, 6) AS rolling_loss FROM "
    "(SELECT *, avg(loss) OVER (PARTITION BY run_id ORDER BY step ROWS BETWEEN 99 PRECEDING AND CURRENT ROW) AS r FROM lg) "
    "WHERE step % 100 = 0",
)
def rolling_loss(spark, d):
    r = runlog.rolling_train_loss(_log(spark, d, "event_type"))
    return r.select("run_id", "step", F.round("rolling_loss", 6).alias("rolling_loss"))


@register(
    "interval_loss",
    f"WITH {_LONG_LOG_SQL} SELECT run_id, step, round(r, 6) AS interval_loss FROM "
    "(SELECT *, avg(loss) OVER (PARTITION BY run_id ORDER BY step ROWS BETWEEN 199 PRECEDING AND CURRENT ROW) AS r FROM lg) "
    "WHERE step > 0 AND step % 200 = 0",
)
def interval_loss(spark, d):
    r = runlog.interval_train_loss(_log(spark, d, "event_type"))
    return r.select("run_id", "step", F.round("interval_loss", 6).alias("interval_loss"))


_BEST_SRC = f"(SELECT run_id, step, loss FROM lg UNION ALL SELECT * FROM {sql_values(C.NAN_RUN, ['run_id', 'step', 'loss'])})"


@register(
    "best_so_far",
    f"WITH {_LOG_SQL} SELECT run_id, step, CAST(CASE WHEN NOT isnan(loss) AND loss < coalesce(min(CASE WHEN NOT isnan(loss) THEN loss END) "
    "OVER (PARTITION BY run_id ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), CAST('inf' AS DOUBLE)) "
    f"THEN 1 ELSE 0 END AS INTEGER) AS is_best FROM {_BEST_SRC}",
)
def best_so_far(spark, d):
    lg = _log(spark, d).select("run_id", "step", "loss")
    extra = spark.createDataFrame(C.NAN_RUN, "run_id long, step long, loss double")
    return runlog.best_so_far(lg.unionByName(extra)).select("run_id", "step", "is_best")


@register(
    "checkpoint_rows",
    f"WITH {_LONG_LOG_SQL}, ev AS (SELECT * FROM lg WHERE step > 0 AND step % 200 = 0), "
    "evb AS (SELECT run_id, step, CASE WHEN NOT isnan(loss) AND loss < coalesce(min(CASE WHEN NOT isnan(loss) THEN loss END) "
    "OVER (PARTITION BY run_id ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), CAST('inf' AS DOUBLE)) THEN 1 ELSE 0 END AS b FROM ev) "
    "SELECT run_id, step, 'step_' || CAST(step AS VARCHAR) || '.pt' AS label FROM lg WHERE step > 0 AND step % 500 = 0 "
    "UNION ALL SELECT run_id, step, 'best_model.pt' FROM evb WHERE b = 1 "
    "UNION ALL SELECT run_id, count(*), 'final_model.pt' FROM lg GROUP BY run_id",
)
def checkpoint_rows(spark, d):
    return runlog.checkpoint_rows(_log(spark, d, "event_type"))


@register(
    "run_log_line",
    f"WITH {_LONG_LOG_SQL}, ev AS (SELECT run_id, step, loss FROM lg WHERE step > 0 AND step % 200 = 0), "
    "l AS (SELECT run_id, step, CASE WHEN step < 200 THEN 0.0003 * CAST(step AS DOUBLE) / 200.0 "
    "ELSE 3e-05 + (0.0003 - 3e-05) * (0.5 * (1.0 + cos(pi() * ((CAST(step AS DOUBLE) - 200.0) / 9800.0)))) END AS lr, "
    "avg(loss) OVER (PARTITION BY run_id ORDER BY step ROWS BETWEEN 99 PRECEDING AND CURRENT ROW) AS train_loss, "
    "epoch(ts) - min(epoch(ts)) OVER (PARTITION BY run_id) AS elapsed FROM lg) "
    "SELECT l.run_id, l.step, round(lr, 12) AS lr, round(train_loss, 6) AS train_loss, round(ev.loss, 6) AS eval_loss, round(elapsed, 6) AS elapsed_sec "
    "FROM (SELECT * FROM l WHERE step % 100 = 0) AS l ASOF LEFT JOIN ev ON l.run_id = ev.run_id AND l.step >= ev.step",
)
def run_log_line(spark, d):
    """One line per logged step of each event type's run."""
    r = runlog.run_log_lines(_log(spark, d, "event_type"))
    return r.select(
        "run_id", "step", F.round("lr", 12).alias("lr"), F.round("train_loss", 6).alias("train_loss"), F.round("eval_loss", 6).alias("eval_loss"), F.round("elapsed_sec", 6).alias("elapsed_sec")
    )


@register(
    "run_summary",
    f"WITH {_LOG_SQL}, s AS (SELECT run_id, count(*) AS n_steps, arg_max(loss, step) AS last_loss, "
    "round(epoch(max(ts)) - epoch(min(ts)), 6) AS elapsed_sec FROM lg GROUP BY run_id), "
    "b AS (SELECT run_id, min(CASE WHEN NOT isnan(loss) THEN loss END) AS best_eval FROM lg WHERE step > 0 AND step % 200 = 0 GROUP BY run_id) "
    "SELECT s.run_id, n_steps, last_loss, elapsed_sec, coalesce(best_eval, CAST('inf' AS DOUBLE)) AS best_eval FROM s LEFT JOIN b USING (run_id)",
)
def run_summary(spark, d):
    r = runlog.run_summary(_log(spark, d))
    return r.select("run_id", "n_steps", "last_loss", F.round("elapsed_sec", 6).alias("elapsed_sec"), "best_eval")


# ---- Q: vectors ----------------------------------------------------------------------

_QSQL = """
mm AS (SELECT least(min(CAST(x AS DOUBLE)), 0.0) AS lo, greatest(max(CAST(x AS DOUBLE)), 0.0) AS hi FROM (SELECT unnest(embedding) AS x FROM embeddings)),
prm AS (SELECT CASE WHEN hi > lo THEN (hi - lo) / 255.0 ELSE 1.0 END AS scale, lo FROM mm),
prm2 AS (SELECT scale, CAST(floor(-lo / scale + 0.5) AS INTEGER) AS zp FROM prm),
qv AS (SELECT vec_id, embedding, scale, zp,
       list_transform(embedding, lambda x: CAST(least(255, greatest(0, CAST(floor(CAST(x AS DOUBLE) / scale + 0.5) + zp AS INTEGER))) AS INTEGER)) AS q
       FROM embeddings, prm2)
"""


@register(
    "quantise_uint8",
    f"WITH {_QSQL} SELECT vec_id, array_to_string(q, ' ') AS q, round(scale, 12) AS scale, zp AS zero_point FROM qv",
)
def quantise_uint8(spark, d):
    q = vectors.quantise_uint8(C.table(spark, d, "embeddings"))
    return q.select("vec_id", sequences.ids_text("q").alias("q"), F.round("scale", 12).alias("scale"), "zero_point")


@register(
    "quantise_report",
    f"WITH {_QSQL}, e AS (SELECT scale, abs(CAST(x AS DOUBLE) - CAST(v - zp AS DOUBLE) * scale) AS err "
    "FROM (SELECT scale, zp, unnest(embedding) AS x, unnest(q) AS v FROM qv)) "
    "SELECT count(*) AS n_values, count(*) * 4 AS bytes_float32, count(*) AS bytes_uint8, round(max(err), 9) AS max_abs_err, "
    "round(avg(err), 9) AS mean_abs_err, round(max(scale / 2), 9) AS half_scale FROM e",
)
def quantise_report(spark, d):
    r = vectors.quantise_report(vectors.quantise_uint8(C.table(spark, d, "embeddings")))
    return r.select(
        "n_values",
        "bytes_float32",
        "bytes_uint8",
        F.round("max_abs_err", 9).alias("max_abs_err"),
        F.round("mean_abs_err", 9).alias("mean_abs_err"),
        F.round("half_scale", 9).alias("half_scale"),
    )
