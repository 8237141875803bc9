"""Plan guards: the scale properties the operators are built around."""

import re

from pyspark.sql import functions as F

from conftest import SF001
from wordloom.operators import codec, ranking, runlog
from wordloom.operators import tokenizer as T
from wordloom.plans import common


def plan(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_split_does_not_shuffle_text(spark):
    sp = ranking.split_by_threshold(common.documents(spark, SF001))
    p = plan(sp)
    exchanges = re.findall(r"Exchange (\w+)", p)
    assert all(e == "RoundRobinPartitioning" for e in exchanges), exchanges


def test_no_text_is_hashed_before_the_boundary_key_is_known(spark, monkeypatch):
    seen = []
    real = ranking.bucket_counts
    monkeypatch.setattr(ranking, "bucket_counts", lambda keyed, digits: (seen.append(keyed), real(keyed, digits))[1])
    sp = ranking.split_by_threshold(common.documents(spark, SF001))
    assert len(seen) == 1
    shown = seen[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "md5" in shown and not re.search(r"md5\(cast\([^()]*text", shown) and "regexp_replace" not in shown
    assert "md5(cast(text" not in sp._jdf.queryExecution().optimizedPlan().toString()


def test_encode_is_row_local(spark):
    corp = common.corpus(spark, SF001).checkpoint(eager=True)
    tok = T.learn_bpe(T.word_counts(corp), max_merges=4)
    p = plan(codec.encode(corp, tok))
    assert "Exchange" not in p
    # the text alone goes to Python
    assert re.search(r"ArrowEvalPython \[of\((?:coalesce\()?sample", p), p


def test_word_counts_aggregate_map_side(spark):
    p = plan(T.word_counts(common.corpus(spark, SF001)))
    assert "partial_count" in p


def test_run_log_windows_never_partition_by_run_alone(spark):
    ev = common.table(spark, SF001, "events")
    log = runlog.run_log_from_events(ev)
    rolling = plan(runlog.rolling_train_loss(log.select("run_id", "step", "loss").checkpoint(eager=True)))
    assert "Window" not in rolling and "partial_avg" in rolling
    for df in (runlog.best_so_far(log),):
        p = plan(df)
        for funcs, spec in re.findall(r"Window \[(.*?)\], \[([^\]]*)\]", p):
            keys = [k.split("#")[0].strip() for k in spec.split(",") if k.strip()]
            if keys == ["run_id"]:
                # allowed only over the small per-run tables: piece sizes
                # (pieces per run) and block minimums (blocks per run)
                assert re.search(r"\(_n#|\(_bm#", funcs), funcs


def test_sample_shuffles_only_the_sample(spark):
    p = plan(ranking.sample_n(common.documents(spark, SF001), 20))
    # rows beyond the n-th key are filtered where they lie, below every exchange of text
    for scan in re.split(r"Exchange hashpartitioning\(_rk_bucket", p)[1:]:
        assert re.search(r"<= [0-9a-f]{32}\b", scan), scan


def test_scoring_and_quantising_have_no_nested_loop(spark):
    from wordloom.operators import ngram, vectors

    seqs = spark.createDataFrame([(0, [1, 3, 4, 5, 2]), (1, [1, 3, 3, 2])], "doc_id long, ids array<int>")
    p = plan(ngram.score_positions(seqs, ngram.fit(seqs), 6))
    assert "NestedLoop" not in p and "Cartesian" not in p
    assert p.count("Exchange hash") <= 2 and p.count("FileScan") <= 2
    p = plan(ngram.ngram_probabilities(ngram.fit(seqs), 6))
    assert "NestedLoop" not in p and p.count("Exchange hash") <= 2
    p = plan(vectors.quantise_uint8(common.table(spark, SF001, "embeddings")))
    assert "NestedLoop" not in p
