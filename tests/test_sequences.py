"""Truncate, drop short, shift, batch, pad, step plan."""

from pyspark.sql import functions as F

from wordloom.operators import sequences as S


def seq_df(spark, seqs):
    return spark.createDataFrame([(i, "train", s) for i, s in enumerate(seqs)], "doc_id long, split string, ids array<int>")


def test_truncate_and_drop_short(spark):
    lens = [0, 1, 2, 128, 129]
    df = seq_df(spark, [list(range(3, 3 + n)) for n in lens])
    out = {r.doc_id: len(r.ids) for r in S.truncate_filter(df, 128).collect()}
    assert out == {2: 2, 3: 128, 4: 128}


def test_shift_pairs(spark):
    r = S.shift_pairs(seq_df(spark, [[1, 5, 6, 2]])).first()
    assert r.x == [1, 5, 6] and r.y == [5, 6, 2]


def test_batch_remainder_kept(spark):
    df = seq_df(spark, [[1, 2]] * 33)
    b = S.assign_batches(df, batch_size=32)
    sizes = sorted(r["count"] for r in b.groupBy("batch_id").count().collect())
    assert sizes == [1, 32]
    rows = b.select("batch_id", "row_in_batch").collect()
    assert len({(r.batch_id, r.row_in_batch) for r in rows}) == 33


def test_epochs_reshuffle_and_eval_keeps_order(spark):
    df = seq_df(spark, [[1, 2]] * 40)
    e0 = {r.doc_id: (r.batch_id, r.row_in_batch) for r in S.assign_batches(df, 8, shuffle=True, epoch=0).collect()}
    e1 = {r.doc_id: (r.batch_id, r.row_in_batch) for r in S.assign_batches(df, 8, shuffle=True, epoch=1).collect()}
    assert e0 != e1
    a = {r.doc_id: (r.batch_id, r.row_in_batch) for r in S.assign_batches(df, 8, shuffle=False).collect()}
    b = {r.doc_id: (r.batch_id, r.row_in_batch) for r in S.assign_batches(df.repartition(3), 8, shuffle=False).collect()}
    assert a == b


def test_pad_to_batch_max(spark):
    df = seq_df(spark, [[1, 5, 2], [1, 5, 6, 7, 2], [1, 2]]).withColumn("epoch", F.lit(0)).withColumn("batch_id", F.lit(0))
    out = S.pad_batch(S.shift_pairs(df)).orderBy("doc_id").collect()
    assert [r.padded_len for r in out] == [4, 4, 4]
    assert out[0].x_pad == [1, 5, 0, 0] and out[0].y_pad == [5, 2, 0, 0]
    assert out[2].x_pad == [1, 0, 0, 0]


def test_step_plan(spark):
    df = seq_df(spark, [[1, 2]] * 3)
    plan = [(r.step, r.epoch, r.batch_id) for r in S.step_plan(df, 7, batch_size=1).orderBy("step").collect()]
    assert plan == [(s, s // 3, s % 3) for s in range(7)]


def test_windows_keep_every_pair(spark):
    seqs = [list(range(100, 100 + n)) for n in (0, 1, 2, 4, 5, 7, 8, 300)]
    out = S.windows(seq_df(spark, seqs), 4).collect()
    assert all(2 <= len(r.ids) <= 4 and r.seq_id == f"{r.doc_id}:{r.win}" for r in out)
    pairs = sorted((r.doc_id, p) for r in out for p in zip(r.ids, r.ids[1:]))
    assert pairs == sorted((i, p) for i, s in enumerate(seqs) for p in zip(s, s[1:]))


def test_step_plan_empty_raises(spark):
    import pytest

    df = seq_df(spark, [[1, 2]]).filter(F.lit(False))
    with pytest.raises(ValueError):
        S.step_plan(df, 10)


def test_word_ids_meet_lists_of_distinct_words(spark):
    """the join is on the distinct words of a chunk, not on every
    word; rows of one id are put together, unknown words are left out."""
    rows = [(1, "b a b", "train"), (2, "a c", "eval"), (1, "d a", "train"), (None, "c c", "train"), (3, "zz", "train")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, split string")
    words = {"a": 9, " a": 5, "b": 7, " b": 3, "c": 4, " c": 6, "d": 8}
    vocab = spark.createDataFrame(list(words.items()), "word string, token int")
    made = S.word_sequences(df, vocab)
    got = {(r.doc_id, r.split): list(r.ids) for r in made.collect()}
    assert got == {(1, "train"): [1, 7, 8, 5, 5, 3, 2], (2, "eval"): [1, 9, 6, 2], (None, "train"): [1, 4, 6, 2]}
    p = made._jdf.queryExecution().toString()
    assert "FlatMapCoGroups" in p and "regexp_extract_all" not in p
    own = S.word_sequences(df)
    assert own.count() == 4 and S.word_sequences(df.limit(0)).count() == 0
    vocab = {r.word: r.token for r in S.word_vocab(df).collect()}
    assert [list(r.ids) for r in own.filter("doc_id = 2").collect()] == [[1, vocab["a"], vocab[" c"], 2]]
