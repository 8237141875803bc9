"""Registered queries of the training-data operators and their DuckDB SQL.

Every query applies its operator, with production parameters, to its whole
table and returns one row per document (page, piece)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import best_fit, chunk_recipes, decontaminate, frames, hilbert_blocks, html_blocks, kn_lm, license_scan, packing, shard_table, simhash_mih, toxicity, url_cascade
from .common import materialise, table


def op9_chunk_recipes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact dedup of all ``documents`` by content-defined chunk recipes."""
    return chunk_recipes.exact_dedup(table(spark, sf_dir, "documents")).drop("row_sha")


URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def op1_url_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts of the four rules for every ``pages`` url."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    made = url_cascade.judge(table(spark, sf_dir, "pages").select("page_id", "url"), rules)
    return made.select("page_id", "host", "path", "rule", "verdict")


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of all ``documents``, taken as files source/lang/doc_id."""
    docs = table(spark, sf_dir, "documents")
    path = license_scan.document_path(docs["source"], docs["lang"], docs["doc_id"])
    return license_scan.scan(docs, path)


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits of the 13-word windows of ``benchmark`` in all ``documents``."""
    made = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return made.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


def op4_html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all ``pages``."""
    return html_blocks.extract(spark, table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op5_simhash_mih(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash groups of all ``documents``: 4-word shingles, 4 bits."""
    docs = table(spark, sf_dir, "documents")
    made = simhash_mih.near_duplicates(docs, shingle=4, max_bits=4)
    return made.select("doc_id", simhash_mih.hex64(made["fingerprint"]).alias("fingerprint"), "component_id")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all ``documents`` as ``labels.toxic`` marks it."""
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


SHARDS = [f"shard-{k:03d}" for k in range(256)]


def op7_shard_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Placement of all ``documents`` on 256 shards by id."""
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return shard_table.place(docs, "doc_id", SHARDS).select("doc_id", "slot", "shard_no", "shard")


TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` packed into sequences of at most 2048 tokens."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path(), with_ids=False)


def op10_kn_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kneser-Ney log probabilities of all ``documents``."""
    return kn_lm.score_documents(table(spark, sf_dir, "documents"))


def op11_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` packed whole into sequences of at most 4096 tokens."""
    return best_fit.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), with_ids=False)


def op12_hilbert_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of the ``embeddings`` whose id is a multiple of 100; one
    row in seven has its label moved on first."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hilbert_blocks.mine(table(spark, sf_dir, "embeddings"), label=label)


def op13_fim_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fill-in-middle digests of all ``documents``, from their stored frames."""
    stored = materialise(frames.store(table(spark, sf_dir, "documents")), "frames")
    return frames.digests(frames.fill_in_middle(stored))


Q = {
    "op1_url_cascade": op1_url_cascade,
    "op2_license_scan": op2_license_scan,
    "op3_decontaminate": op3_decontaminate,
    "op4_html_blocks": op4_html_blocks,
    "op5_simhash_mih": op5_simhash_mih,
    "op6_toxicity": op6_toxicity,
    "op7_shard_table": op7_shard_table,
    "op8_packing": op8_packing,
    "op9_chunk_recipes": op9_chunk_recipes,
    "op10_kn_lm": op10_kn_lm,
    "op11_best_fit": op11_best_fit,
    "op12_hilbert_blocks": op12_hilbert_blocks,
    "op13_fim_frames": op13_fim_frames,
}

SQL_SPACE = r"[\x20\x09-\x0D]+"

SQL_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SQL_WORDS = rf"regexp_extract_all({SQL_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

SQL_RULES = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)

SQL_TEMPLATES = ", ".join("({}, '{}', '{}')".format(k, name, text.replace("'", "''")) for k, (name, text) in enumerate(license_scan.TEMPLATES))
SQL_TERMS = "regexp_extract_all(lower(text), '[a-z0-9]+')"

SQL_CUT = "array_to_string(u[{}:{}], '')"

SQL = {
    "op12_hilbert_blocks": """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
           FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
             CAST(list_dot_product(CAST(a.x AS DOUBLE[]), CAST(b.x AS DOUBLE[])) AS BIGINT) AS score
      FROM v AS a JOIN v AS b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 5""",
    "op13_fim_frames": rf"""
WITH h AS (SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x,
                  regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u FROM documents),
d AS (SELECT doc_id, text, u, len(u) AS n, [CAST('0x' || substr(x, k, 8) AS BIGINT) for k in [1, 9, 17, 25]] AS h FROM h),
c AS (SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
             CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= 100 THEN 'plain'
                  WHEN h[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM d),
p AS (SELECT doc_id, text, n, form, {SQL_CUT.format(1, 'a')} AS pre, {SQL_CUT.format('a + 1', 'b')} AS mid, {SQL_CUT.format('b + 1', 'n')} AS suf FROM c),
o AS (SELECT *, CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                          ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END AS output FROM p)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars, sha256(output) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN output
              WHEN 'psm' THEN regexp_extract(output, '(?s)^<P>(.*)<S>(.*)<M>(.*)$', 1) || regexp_extract(output, '(?s)^<P>(.*)<S>(.*)<M>(.*)$', 3) || regexp_extract(output, '(?s)^<P>(.*)<S>(.*)<M>(.*)$', 2)
              ELSE regexp_extract(output, '(?s)^<S>(.*)<P>(.*)<M>(.*)$', 2) || regexp_extract(output, '(?s)^<S>(.*)<P>(.*)<M>(.*)$', 3) || regexp_extract(output, '(?s)^<S>(.*)<P>(.*)<M>(.*)$', 1) END) AS restored_sha256
FROM o""",
    "op2_license_scan": f"""
WITH t(template, licence, text) AS (VALUES {SQL_TEMPLATES}),
tt AS (SELECT template, licence, term, count(*) AS tf
       FROM (SELECT template, licence, unnest({SQL_TERMS}) AS term FROM t) GROUP BY ALL),
d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(source, '-') || '/' || coalesce(lang, '-') AS dir,
             concat_ws('/', coalesce(source, '-'), coalesce(lang, '-'), coalesce(CAST(doc_id AS VARCHAR), '-')) AS path,
             coalesce(text, '') AS text FROM documents),
n AS (SELECT count(*) AS n FROM d),
df AS (SELECT term, count(DISTINCT row) AS df FROM (SELECT row, unnest({SQL_TERMS}) AS term FROM d) GROUP BY term),
idf AS (SELECT term, ln((n + 1) / (coalesce(df, 0) + 1)) + 1 AS idf
        FROM (SELECT DISTINCT term FROM tt) LEFT JOIN df USING (term), n),
tw AS (SELECT template, licence, term, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY template)) AS tw
       FROM tt JOIN idf USING (term)),
u AS (SELECT row, -1 AS line, text FROM d UNION ALL
      SELECT row, unnest(generate_series(0, len(l) - 1)) AS line, unnest(l) AS text
      FROM (SELECT row, string_split(text, chr(10)) AS l FROM d)),
utf AS (SELECT row, line, term, count(*) AS tf FROM (SELECT row, line, unnest({SQL_TERMS}) AS term FROM u) GROUP BY ALL),
uw AS (SELECT row, line, term, tf * coalesce(idf, ln(n + 1) + 1) AS w FROM utf LEFT JOIN idf USING (term), n),
norm AS (SELECT row, line, sqrt(sum(w * w)) AS norm FROM uw GROUP BY ALL),
dot AS (SELECT row, line, template, licence, sum(w * tw) AS dot FROM uw JOIN tw USING (term) GROUP BY ALL),
best AS (SELECT row, line, licence, round(dot / norm, 6) AS cosine FROM dot JOIN norm USING (row, line)
         QUALIFY row_number() OVER (PARTITION BY row, line ORDER BY cosine DESC, licence) = 1),
own AS (SELECT row, licence AS own, cosine AS own_cosine, CASE WHEN line < 0 THEN 'file' ELSE 'header' END AS own_via FROM best
        WHERE (line < 0 AND cosine >= {license_scan.FILE_COSINE}) OR (line >= 0 AND cosine >= {license_scan.HEADER_COSINE})
        QUALIFY row_number() OVER (PARTITION BY row ORDER BY line >= 0, cosine DESC, licence) = 1),
o AS (SELECT * FROM d LEFT JOIN own USING (row)),
licensed AS (SELECT dir AS from_dir, own AS dl, own_cosine AS dc FROM o WHERE own_via = 'file'
             QUALIFY row_number() OVER (PARTITION BY dir ORDER BY own_cosine DESC, doc_id) = 1),
near AS (SELECT dir, from_dir, dl, dc FROM (SELECT DISTINCT dir FROM d) JOIN licensed ON dir = from_dir OR starts_with(dir, from_dir || '/')
         QUALIFY row_number() OVER (PARTITION BY dir ORDER BY length(from_dir) DESC) = 1)
SELECT doc_id, path, coalesce(own, dl) AS licence, coalesce(own_cosine, dc) AS cosine,
       coalesce(own_via, CASE WHEN dl IS NOT NULL THEN 'inherited' END) AS via,
       CASE WHEN own IS NULL THEN from_dir END AS from_dir
FROM o LEFT JOIN near USING (dir)""",
    "op1_url_cascade": f"""
WITH u AS (SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
r(h, p, v) AS (VALUES {SQL_RULES}),
j AS (SELECT u.*, h || p AS rule, v FROM u LEFT JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM j
QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC NULLS LAST) = 1""",
    "op3_decontaminate": f"""
WITH d AS (SELECT doc_id, {SQL_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {SQL_WORDS} AS w FROM benchmark),
bw AS (SELECT item, least(13, len(w)) AS l, w, unnest(generate_series(1, len(w) - least(13, len(w)) + 1)) AS i
       FROM b WHERE len(w) > 0),
pat AS (SELECT DISTINCT item, l, array_to_string(w[i:i + l - 1], ' ') AS s FROM bw),
lens AS (SELECT DISTINCT l FROM pat),
dw AS (SELECT doc_id, l, unnest(generate_series(1, len(w) - l + 1)) AS i, w FROM d, lens WHERE len(w) >= l),
occ AS (SELECT dw.doc_id, dw.i, dw.l, pat.item FROM dw JOIN pat ON pat.l = dw.l AND pat.s = array_to_string(dw.w[dw.i:dw.i + dw.l - 1], ' ')),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + l - 1)) AS p FROM occ) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM occ) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)""",
    "op9_chunk_recipes": f"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '{SQL_SPACE}', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, sha256(norm) AS text_sha256
FROM n WINDOW g AS (PARTITION BY norm)""",
}
