"""Exact ranks, deterministic shuffle, exact sample and split."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF001
from wordloom.operators import ranking as R
from wordloom.sources.corpus import read_corpus


@pytest.fixture(scope="module")
def docs(spark):
    return read_corpus(spark, f"{SF001}/documents.parquet")


def test_global_rank_equals_row_number(spark, docs):
    key = R.shuffle_key(42, "doc_id")
    ours = {r.doc_id: r["rank"] for r in R.global_rank(docs.select("doc_id"), key, ["doc_id"]).collect()}
    plain = docs.select("doc_id", F.row_number().over(Window.orderBy(key, "doc_id")).alias("rn"))
    assert ours == {r.doc_id: r.rn for r in plain.collect()}


def test_shuffle_independent_of_partitioning(spark, docs):
    a = {r.doc_id: r["rank"] for r in R.seeded_shuffle(docs.coalesce(1)).collect()}
    b = {r.doc_id: r["rank"] for r in R.seeded_shuffle(docs.repartition(7)).collect()}
    assert a == b and sorted(a.values()) == list(range(1, len(a) + 1))


def test_sample_n_exact(spark, docs):
    assert R.sample_n(R.clean_nonempty(docs), 37).count() == 37
    assert R.sample_n(R.clean_nonempty(docs), 10_000).count() == R.clean_nonempty(docs).count()


@pytest.mark.parametrize("n_samples,ratio", [(None, 0.05), (64, 0.05), (100, 0.0), (150, 0.5)])
def test_split_sizes_and_threshold_path(spark, docs, n_samples, ratio):
    ranked = R.train_eval_split(docs, n_samples=n_samples, eval_ratio=ratio)
    total = R.clean_nonempty(docs).count()
    n = total if n_samples is None else min(total, n_samples)
    counts = {r.split: r["count"] for r in ranked.groupBy("split").count().collect()}
    assert counts.get("eval", 0) == int(n * ratio)
    assert counts.get("train", 0) == n - int(n * ratio)
    fast = R.split_by_threshold(docs, n_samples=n_samples, eval_ratio=ratio)
    assert {(r.doc_id, r.split) for r in ranked.collect()} == {(r.doc_id, r.split) for r in fast.collect()}


def test_smoke_corpus_64(spark, docs):
    sp = R.train_eval_split(docs, n_samples=64)
    assert {r.split: r["count"] for r in sp.groupBy("split").count().collect()} == {"train": 61, "eval": 3}


@pytest.mark.parametrize("kw", [{"eval_ratio": -0.1}, {"eval_ratio": 1.0}, {"n_samples": 0}])
def test_split_argument_checks(spark, docs, kw):
    with pytest.raises(ValueError):
        R.train_eval_split(docs, **kw)
    with pytest.raises(ValueError):
        R.split_by_threshold(docs, **kw)


def test_summary_and_tokenizer_corpus(spark, docs):
    sp = R.split_by_threshold(docs)
    summ = {r.split: r.n_rows for r in R.split_summary(sp).collect()}
    assert summ["total"] == summ["train"] + summ["eval"]
    corp = R.tokenizer_corpus(sp)
    assert corp.count() == summ["total"]
    assert R.tokenizer_corpus(sp, train_only=True).count() == summ["train"]
    assert corp.filter(~F.col("sample").startswith("<|im_start|>assistant\n")).count() == 0


def test_kth_key_refines_buckets(spark, monkeypatch):
    monkeypatch.setattr(R, "FINAL_BUCKET_ROWS", 3)
    keys = spark.range(0, 3000).withColumnRenamed("id", "doc_id").withColumn("_rk_key", R.shuffle_key(42, "doc_id"))
    counts = R.bucket_counts(keys, 1)
    allk = sorted(r._rk_key for r in keys.collect())
    for k in (1, 7, 1500, 3000):
        assert R.kth_key(keys, k, counts, 1) == (allk[k - 1], 1, 1)
    assert R.kth_key(keys, 3001, counts, 1) is None


def rows_with_repeats(spark):
    rows = [(i % 10, f"text {i % 10}") for i in range(200)]  # each row twenty times
    rows += [(None, f"no id {k}") for k in range(10)]
    return spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)


@pytest.mark.parametrize("n_samples", [None, 33, 200, 500])
@pytest.mark.parametrize("final", [10_000, 2])
def test_null_and_repeated_ids_lose_no_row_and_both_splits_agree(spark, monkeypatch, n_samples, final):
    monkeypatch.setattr(R, "FINAL_BUCKET_ROWS", final)
    df = rows_with_repeats(spark)
    n = min(210, n_samples or 210)
    ranked = R.train_eval_split(df, n_samples=n_samples, eval_ratio=0.05)
    fast = R.split_by_threshold(df, n_samples=n_samples, eval_ratio=0.05)
    key = lambda r: (str(r.doc_id), r.text, r.split)
    assert sorted(map(key, ranked.collect())) == sorted(map(key, fast.collect()))
    assert ranked.count() == n and fast.filter("split = 'eval'").count() == int(n * 0.05)


def test_sample_and_shuffle_with_null_and_repeated_ids(spark):
    df = rows_with_repeats(spark)
    assert sorted(r["rank"] for r in R.seeded_shuffle(df).collect()) == list(range(1, 211))
    assert sorted(r["rank"] for r in R.sample_n(df, 45).collect()) == list(range(1, 46))


def test_split_of_a_corpus_without_ids_does_not_depend_on_file_splits(spark, tmp_path):
    (tmp_path / "raw.txt").write_text("\n".join(f"line {k} with some words to fill it" for k in range(4000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    got = []
    for size in ("128m", "20k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        sp = R.split_by_threshold(read_corpus(spark, str(tmp_path / "raw.txt"), fmt="text"))
        got.append({r.text for r in sp.filter("split = 'eval'").collect()})
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got[0] == got[1] and len(got[0]) == 200


def test_a_clean_split_is_not_cleaned_again(spark):
    """Samples are made of a split's clean texts as
    they are; they equal those that are cleaned once more."""
    from wordloom.plans import common

    corpus = common.corpus(spark, SF001)
    plan = corpus._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_replace" not in plan and "translate" not in plan
    assert corpus.exceptAll(R.tokenizer_corpus(common.split(spark, SF001))).count() == 0
