"""N-gram fit, interpolated scoring, sampling, generation —
checked against brute force over the full vocabulary."""

import hashlib
import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from wordloom.operators import ngram as N

SEQS = [[1, 3, 4, 5, 2], [1, 3, 4, 3, 4, 6, 2], [1, 5, 5, 5, 2], [1, 4, 3, 2]]
V = 8
LAM = 0.5


def seq_df(spark, seqs, split="train"):
    return spark.createDataFrame([(i, split, s) for i, s in enumerate(seqs)], "doc_id long, split string, ids array<int>")


def brute_counts(seqs, order=3):
    c = Counter()
    for s in seqs:
        for i in range(1, len(s)):
            for k in range(1, order + 1):
                if i - (k - 1) >= 0:
                    ctx = " ".join(map(str, s[i - k + 1 : i])) if k > 1 else ""
                    c[(k, ctx, s[i])] += 1
    return c


def brute_p(c, hist, w, order=3):
    p = 1.0 / V
    for k in range(1, order + 1):
        if k > 1 and len(hist) < k - 1:
            break
        ctx = " ".join(map(str, hist[len(hist) - (k - 1) :])) if k > 1 else ""
        tot = sum(n for (o, h, _), n in c.items() if o == k and h == ctx)
        if tot > 0:
            p = LAM * c.get((k, ctx, w), 0) / tot + (1 - LAM) * p
    return p


def test_counts(spark):
    got = {(r.order, r.ctx, r.token): r.n for r in N.ngram_counts(seq_df(spark, SEQS)).collect()}
    assert got == dict(brute_counts(SEQS))


def test_probabilities_sum_to_one_and_match(spark):
    counts = N.ngram_counts(seq_df(spark, SEQS))
    probs = {(r.order, r.ctx, r.token): r.p for r in N.ngram_probabilities(counts, V).collect()}
    c = brute_counts(SEQS)
    for (k, ctx, w), p in probs.items():
        hist = [int(x) for x in ctx.split()] if ctx else []
        assert p == pytest.approx(brute_p(c, hist, w, order=k))
    for ctx in ["3 4", "5 5"]:
        hist = [int(x) for x in ctx.split()]
        assert sum(brute_p(c, hist, w) for w in range(V)) == pytest.approx(1.0)


def test_score_and_eval_loss(spark):
    ev = [[1, 3, 4, 7, 2], [1, 6, 6, 2]]
    counts = N.ngram_counts(seq_df(spark, SEQS))
    nll = N.score_positions(seq_df(spark, ev, "eval"), counts, V).collect()
    c = brute_counts(SEQS)
    for r in nll:
        s = ev[r.doc_id]
        assert r.nll == pytest.approx(-math.log(brute_p(c, s[: r.p + 1], s[r.p + 1])))
    empty = spark.createDataFrame([], "doc_id long, p int, token int, nll double, batch_id int")
    assert N.evaluate(empty).first().eval_loss == 0.0


@pytest.mark.parametrize("order", [1, 2, 4])
def test_other_orders_equal_brute_force(spark, order):
    ev = [[1, 3, 4, 7, 2], [1, 6, 6, 2], [5], [], [1, 3, 4, 3, 4, 6, 2], [1, 3, 4, 7, 2, 0, 0]]
    train = seq_df(spark, [*SEQS, [], [4]])
    c = brute_counts(SEQS, order)
    assert {(r.order, r.ctx, r.token): r.n for r in N.ngram_counts(train, order).collect()} == dict(c)
    want = {(i, p): -math.log(brute_p(c, s[: p + 1], s[p + 1], order)) for i, s in enumerate(ev) for p in range(len(s) - 1) if s[p + 1]}
    rows = N.score_positions(seq_df(spark, ev), N.fit(train, order), V, order).collect()
    assert {(r.doc_id, r.p): r.nll for r in rows} == pytest.approx(want)
    batched = seq_df(spark, ev).withColumn("batch_id", (F.col("doc_id") % 2).cast("int"))
    got = {r.batch_id: (r.n_targets, r.batch_loss) for r in N.score_batches(batched, N.fit(train, order), V, order).collect()}
    for b in (0, 1):
        losses = [v for (i, _), v in want.items() if i % 2 == b]
        assert got[b] == (len(losses), pytest.approx(sum(losses) / len(losses)))


def test_an_empty_model_scores_uniformly(spark):
    none = N.ngram_counts(seq_df(spark, SEQS).limit(0))
    assert [r.nll for r in N.score_positions(seq_df(spark, [[1, 3, 2]]), none, V).collect()] == pytest.approx([math.log(V)] * 2)
    empty = N.score_batches(seq_df(spark, SEQS).limit(0).withColumn("batch_id", F.lit(0)), N.ngram_counts(seq_df(spark, SEQS)), V)
    assert N.mean_of_batches(empty).first().eval_loss == 0.0


def test_a_long_sequence_is_read_by_place(spark):
    """Rows carry their few ids; copying the sequence per target would take hours."""
    long = spark.range(1).select(F.lit(0).cast("long").alias("doc_id"), F.transform(F.sequence(F.lit(0), F.lit(199_999)), lambda i: (i % 7 + 1).cast("int")).alias("ids"))
    counts = N.fit(long)
    assert counts.agg(F.sum("n")).first()[0] == 199_999 + 199_999 + 199_998
    assert N.score_positions(long, counts, 8).count() == 199_999


def test_top_k_keeps_ties(spark):
    df = spark.createDataFrame([("a", t, float(v)) for t, v in enumerate([5, 4, 4, 4, 1])], "prompt_id string, token int, logit double")
    assert N.top_k(df, 2).count() == 4
    assert N.top_k(df, 0).count() == 5


def test_softmax_and_draw_of_a_group_of_many_blocks(spark):
    rng = np.random.default_rng(3)
    rows = [(g, int(t), float(x)) for g, n in (("hot", 3000), ("b", 40), ("one", 1), (None, 30)) for t, x in zip(rng.permutation(n), rng.normal(size=n))]
    df = spark.createDataFrame(rows, "prompt_id string, token int, logit double")
    sm = N.softmax(df)
    got = {(r.prompt_id, r.token): r.prob for r in sm.collect()}
    assert len(got) == len(rows)
    for g in ("hot", "b", "one", None):
        own = sorted((t, x) for h, t, x in rows if h == g)
        e = np.exp([x - max(x for _, x in own) for _, x in own])
        p = e / e.sum()
        assert np.allclose([got[(g, t)] for t, _ in own], p, atol=1e-12)
    for step in range(4):
        drawn = {r.prompt_id: r.token for r in N.draw(sm, seed=5, step=step, block=16).collect()}
        assert set(drawn) == {"hot", "b", "one", None}
        for g, token in drawn.items():
            u = int(hashlib.md5(":".join(["5", *([g] if g else []), str(step)]).encode()).hexdigest()[:8], 16) / 2**32
            acc = np.cumsum([got[(g, t)] for t in range(len([1 for h, *_ in rows if h == g]))])
            assert token == min(int(np.searchsorted(acc, u)), len(acc) - 1)
    short = spark.createDataFrame([("a", t, 1e-9) for t in range(50)], "prompt_id string, token int, prob double")
    assert N.draw(short, block=16).collect() == [("a", 49)]
    assert N.draw(short.limit(0)).count() == 0


def test_softmax_and_draw_windows_hold_blocks_only(spark):
    df = spark.createDataFrame([("a", 1, 0.5)], "prompt_id string, token int, logit double")
    assert "Window" not in N.softmax(df)._jdf.queryExecution().executedPlan().toString()


def test_softmax_and_draw(spark):
    df = spark.createDataFrame([("a", t, float(v)) for t, v in enumerate([2.0, 1.0, 0.5])], "prompt_id string, token int, logit double")
    sm = N.softmax(N.apply_temperature(df, 0.7))
    assert sum(r.prob for r in sm.collect()) == pytest.approx(1.0)
    t1 = N.draw(sm, seed=1, step=3).first().token
    t2 = N.draw(sm, seed=1, step=3).first().token
    assert t1 == t2 and t1 in (0, 1, 2)
    with pytest.raises(ValueError):
        N.apply_temperature(df, 0.0)


def unigram_topk(p1: dict[int, float], k: int) -> list[int]:
    if k <= 0 or k >= len(p1):
        return sorted(p1)
    vals = sorted(p1.values(), reverse=True)
    thr = vals[k - 1]
    return sorted(t for t, v in p1.items() if v >= thr)


def next_token_logits(active, model, k) :
    """Candidate logits for the next token of every active row
    ``(prompt_id, ids)``.

    For an interpolated model the top-k of P_N(.|h) lies inside
    followers(h_N) ∪ ... ∪ followers(h_2) ∪ top-k(P_1) (ties included), since a
    token that does not follow a context is ranked by the order below only.
    So only those candidates are scored — never prompts × vocabulary.
    """
    order, lam = model.order, model.lam
    a = active.select("prompt_id", "ids")
    for k_ in range(2, order + 1):
        last = F.slice("ids", -(k_ - 1), k_ - 1)
        a = a.withColumn(f"h{k_}", F.when(F.size("ids") >= k_ - 1, F.array_join(last, " ")))
    for k_ in range(2, order + 1):
        f = model.followers.filter(F.col("order") == k_).select(
            F.col("ctx").alias(f"h{k_}"), F.col("n_ctx").alias(f"t{k_}"), F.col("toks").alias(f"toks{k_}"), F.col("cnts").alias(f"cnts{k_}")
        )
        a = a.join(f, f"h{k_}", "left")
    uni_top = unigram_topk(model.unigram, k)
    p1 = F.split(F.lit(",".join(repr(float(model.unigram[t])) for t in range(model.vocab_size))), ",")
    cand = F.array(*[F.lit(t) for t in uni_top])
    for k_ in range(2, order + 1):
        cand = F.array_union(cand, F.coalesce(F.col(f"toks{k_}"), F.array().cast("array<int>")))
    ex = a.select("*", F.explode(cand).alias("token"))
    lam_c = F.lit(float(lam))
    prob = F.get(p1, F.col("token")).cast("double")
    for k_ in range(2, order + 1):
        fm = F.map_from_arrays(F.col(f"toks{k_}"), F.col(f"cnts{k_}"))
        c = F.coalesce(F.try_element_at(fm, F.col("token")), F.lit(0))
        seen = F.col(f"t{k_}").isNotNull()
        prob = F.when(seen, lam_c * c / F.col(f"t{k_}") + (1 - lam_c) * prob).otherwise(prob)
    return ex.select("prompt_id", "ids", "token", F.log(prob).alias("logit"))


def test_candidate_topk_equals_full_vocabulary(spark):
    model = N.build_model(seq_df(spark, SEQS), V)
    prompts = spark.createDataFrame([(0, [1, 3, 4]), (1, [7, 7]), (2, [5])], "prompt_id long, ids array<int>")
    got = N.top_k(next_token_logits(prompts, model, 3), 3).collect()
    c = brute_counts(SEQS)
    for pid, ids in [(0, [1, 3, 4]), (1, [7, 7]), (2, [5])]:
        full = sorted(((math.log(brute_p(c, ids, w)), w) for w in range(V)), reverse=True)
        thr = full[2][0]
        want = {w for v, w in full if v >= thr - 1e-12}
        have = {r.token for r in got if r.prompt_id == pid}
        assert have == want


def test_generate_stops_and_is_deterministic(spark):
    model = N.build_model(seq_df(spark, SEQS), V)
    prompts = spark.createDataFrame([(0, [1, 3]), (1, [1, 5])], "prompt_id long, ids array<int>")
    a = {r.prompt_id: r.new_ids for r in N.generate(prompts, model, max_new_tokens=6).collect()}
    b = {r.prompt_id: r.new_ids for r in N.generate(prompts, model, max_new_tokens=6).collect()}
    assert a == b
    for ids in a.values():
        assert len(ids) <= 6 and (len(ids) == 6 or ids[-1] == 2)
        assert 2 not in ids[:-1]


def test_known_tokens_and_size(spark):
    counts = N.ngram_counts(seq_df(spark, SEQS))
    vocab = spark.createDataFrame([(3,), (4,)], "token int")
    kept = N.keep_known_tokens(counts, vocab)
    assert {r.token for r in kept.collect()} == {3, 4}
    size = {r.order: r.n_rows for r in N.size_report(counts).collect()}
    assert size[0] == size[1] + size[2] + size[3]


def test_row_local_sampler_equals_window_operators(spark):
    model = N.build_model(seq_df(spark, SEQS), V)
    prompts = spark.createDataFrame([(i, ids) for i, ids in enumerate([[1, 3], [1, 5], [4], [1, 3, 4], [6, 6]])], "prompt_id long, ids array<int>")
    for step in range(4):
        logits = next_token_logits(prompts, model, 3)
        want = {r.prompt_id: r.token for r in N.draw(N.softmax(N.apply_temperature(N.top_k(logits, 3), 0.7)), seed=9, step=step).collect()}
        sampler = N.Sampler(model, 3, 0.7, 9, N.MAX_CONTEXT)
        got = {r.prompt_id: sampler.next_token(list(r.ids), str(r.prompt_id), step) for r in prompts.collect()}
        assert got == want


def test_evaluation_stops_at_max_batches(spark):
    rows = [(i, 0, 3, float(i), i) for i in range(6)]
    nll = spark.createDataFrame(rows, "doc_id long, p int, token int, nll double, batch_id int")
    assert N.evaluate(nll, max_batches=3).first().eval_loss == pytest.approx(1.0)
    assert N.first_batches(nll, 2).count() == 2


def test_generation_uses_the_contexts_of_short_prompts(spark):
    import hashlib

    model = N.build_model(seq_df(spark, SEQS), V)
    prompts = {0: [1, 3], 1: [1, 5], 2: [4], 3: [1, 3, 4]}
    df = spark.createDataFrame(list(prompts.items()), "prompt_id long, ids array<int>")
    got = {r.prompt_id: list(r.new_ids) for r in N.generate(df, model, max_new_tokens=5, k=4).collect()}
    c = brute_counts(SEQS)
    for pid, ids in prompts.items():
        line, out = list(ids), []
        for step in range(5):
            logit = {w: math.log(brute_p(c, line, w)) / 0.7 for w in range(V)}
            low = sorted(logit.values())[-4]
            kept = [w for w in range(V) if logit[w] >= low - 1e-12]
            e = [math.exp(logit[w] - max(logit.values())) for w in kept]
            u, acc, pick = int(hashlib.md5(f"42:{pid}:{step}".encode()).hexdigest()[:8], 16) / 2**32, 0.0, kept[-1]
            for w, x in zip(kept, e):
                acc += x / sum(e)
                if acc >= u:
                    pick = w
                    break
            line.append(pick)
            out.append(pick)
            if pick == 2:
                break
        assert got[pid] == out, pid


def test_follower_files_hold_every_context(spark, monkeypatch, tmp_path):
    from wordloom.operators import follower_arrays as A

    monkeypatch.setattr(A, "FILE_CONTEXTS", 3)
    model = N.build_model(seq_df(spark, SEQS), V)
    assert len(model.arrays.parts) > 2
    rows = model.followers.collect()
    for r in rows:
        total, toks, counts = model.arrays.find([int(x) for x in r.ctx.split(" ")])
        assert (total, toks.tolist(), counts.tolist()) == (r.n_ctx, r.toks, r.cnts)
    known = {r.ctx for r in rows}
    for a in range(V):
        assert (model.arrays.find([a]) is not None) == (str(a) in known)
        for b in range(V):
            assert (model.arrays.find([a, b]) is not None) == (f"{a} {b}" in known)
    assert model.arrays.find([V]) is None and model.arrays.find([-1, 2]) is None
    gone = A.FollowerArrays(str(tmp_path), V, 3, model.arrays.parts)
    with pytest.raises(FileNotFoundError):
        gone.find([1])


def test_generation_is_one_pass_without_a_join(spark):
    model = N.build_model(seq_df(spark, SEQS), V)
    prompts = spark.createDataFrame([(0, [1, 3]), (1, []), (2, [V + 5])], "prompt_id long, ids array<int>")
    made = N.generate(prompts, model, max_new_tokens=4)
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("ArrowEvalPython") == 1
    assert all(1 <= len(r.new_ids) <= 4 and r.ids[r.n_prompt :] == r.new_ids for r in made.collect())


def test_examples_are_counted_once_and_as_numbers(spark):
    """orders add up the written counts of the longest contexts; a null id
    is no part of a context."""
    made = N.ngram_counts(spark.createDataFrame([(0, [1, 5, None, 6, 7]), (1, [8]), (2, None)], "doc_id long, ids array<int>"))
    assert "Generate" not in made._jdf.queryExecution().toString()
    got = {(r.order, r.ctx, r.token): r.n for r in made.collect()}
    want = [(1, "", 5), (1, "", 6), (1, "", 7), (2, "1", 5), (2, "5", 6), (2, "6", 7)]
    assert got == {x: 1 for x in want}


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_tasks_count_equal_examples_once(order):
    """a task passes on a row for each gram it met, not for each place;
    null ids, pads and sequences over a chunk's end are as in the rule."""
    import random
    from collections import Counter

    import pyarrow as pa

    rng = random.Random(order)
    for ids, chunk in (([None, 0, 3, 4], 4_000_000), ([5, 6], 30), (list(range(2000)), 500)):
        seqs = [None, [], [2], *[[rng.choice(ids) for _ in range(rng.randint(0, 9))] for _ in range(400)]]
        want = Counter()
        for s in seqs:
            for p in range(1, len(s or ())):
                if s[p] not in (None, 0):
                    near = [x for x in reversed(s[max(0, p - order + 1) : p]) if x is not None]
                    want[(s[p], *near, *[None] * (order - 1 - len(near)))] += 1
        got, rows, most = Counter(), 0, N.GRAM_CHUNK
        N.GRAM_CHUNK = chunk
        try:
            batches = [pa.RecordBatch.from_arrays([pa.array(seqs[i : i + 100], pa.list_(pa.int32()))], ["ids"]) for i in range(0, len(seqs), 100)]
            for out in N._gram_counts(order)(batches):
                rows += out.num_rows
                for *key, n in zip(*[c.to_pylist() for c in out.columns]):
                    got[tuple(key)] += n
        finally:
            N.GRAM_CHUNK = most
        assert got == want
        if chunk == most:
            assert rows == len(want)


def test_a_model_groups_contexts_as_numbers(spark, monkeypatch):
    """no table of all grams with contexts as text is written for a model."""
    written = []
    monkeypatch.setattr(N, "_written", lambda df, name, *by, of=N._written: written.append(df.columns) or of(df, name, *by))
    model = N.build_model(seq_df(spark, SEQS), V)
    assert written == [["token", "h1", "h2", "n"]]
    counts = N.ngram_counts(seq_df(spark, SEQS)).collect()
    want = {}
    for r in counts:
        if r.order > 1:
            want.setdefault((r.order, r.ctx), {})[r.token] = r.n
    got = {(r.order, r.ctx): (r.n_ctx, dict(zip(r.toks, r.cnts))) for r in model.followers.collect()}
    assert got == {k: (sum(v.values()), v) for k, v in want.items()}
    single = N.build_model(seq_df(spark, SEQS), V, order=1)
    assert single.followers.count() == 0 and single.unigram == model.unigram


@pytest.mark.parametrize("k, temperature", [(5, 0.7), (50, 0.7), (5, 3000.0), (0, 0.7)])
def test_a_step_goes_through_followers_and_not_the_vocabulary(spark, k, temperature):
    """the tokens drawn are those of the whole vocabulary's
    probabilities, worked out for a context's followers and the k first only."""
    import random

    rng, size = random.Random(7), 3000
    seqs = [[1, *[int(rng.paretovariate(0.6)) % (size - 3) + 3 for _ in range(40)], 2] for _ in range(60)]
    model = N.build_model(seq_df(spark, seqs), size)
    sampler = N.Sampler(model, k, temperature, 42, N.MAX_CONTEXT)
    contexts = [[], [1], [size - 1], [1, 3], [2, 2], *[s[i : i + 2] for s in seqs[:20] for i in range(0, 40, 5)]]
    for step, line in enumerate(contexts * 2):
        p = np.array([model.unigram[t] for t in range(size)])
        for n in (1, 2):
            found = model.arrays.find(line[-n:]) if len(line) >= n else None
            if found:
                p = (1 - model.lam) * p
                p[found[1]] += model.lam * found[2] / found[0]
        logit = np.log(p) / temperature
        kept = np.flatnonzero(logit >= np.sort(logit)[-k] - 1e-12) if k else np.arange(size)
        e = np.exp(logit[kept] - logit[kept].max())
        shares = np.cumsum(e / e.sum())
        u = int(hashlib.md5(f"42:p:{step}".encode()).hexdigest()[:8], 16) / 2**32
        assert sampler.next_token(line, "p", step) == kept[min(np.searchsorted(shares, u), len(kept) - 1)]
        tokens, mine = sampler.choice[tuple(line)]
        assert tokens.tolist() == kept.tolist() and mine.tolist() == shares.tolist()
    if 0 < k and temperature < 1:
        assert max(len(sampler._mixed(tuple(c), f)[0]) for c in contexts if c and (f := model.arrays.find(c))) < size / 2


def test_what_a_sampler_keeps_is_bounded(monkeypatch):
    monkeypatch.setattr(N, "HELD_VALUES", 200)
    kept = N._Kept()
    for i in range(1000):
        assert kept[(i,)] is None
        kept.put((i,), np.arange(8))
        assert kept[(i,)][0].tolist() == list(range(8)) and len(kept) + len(kept.old) < 20
    assert kept[(998,)] is not None and kept[(0,)] is None


def test_grams_that_fit_no_number_are_counted_too():
    import pyarrow as pa

    ids = list(range(3000))
    got = [out for out in N._gram_counts(8)([pa.RecordBatch.from_arrays([pa.array([ids, ids[:9]], pa.list_(pa.int32()))], ["ids"])])]
    rows = [dict(zip(out.schema.names, r)) for out in got for r in zip(*[c.to_pylist() for c in out.columns])]
    assert len(rows) == 2999 and {r["n"] for r in rows if r["token"] < 9} == {2} and {r["n"] for r in rows if r["token"] > 8} == {1}
    assert {(r["token"], r["h1"], r["h7"]) for r in rows} == {(t, t - 1, t - 7 if t >= 7 else None) for t in range(1, 3000)}


def folders(spark):
    import os

    return {x.rpartition("-")[0] for x in os.listdir(spark.sparkContext.getCheckpointDir().removeprefix("file:"))}


def test_a_model_writes_no_table_of_followers(spark, monkeypatch, tmp_path):
    """contexts stay numbers up to the array files."""
    monkeypatch.setattr(spark.sparkContext, "getCheckpointDir", lambda: str(tmp_path))
    N.build_model(seq_df(spark, SEQS), V)
    assert folders(spark) == {"ngram_longest", "ngram_lower", "follower_arrays"}


@pytest.mark.parametrize("name, left", [("ngram_prob", {"ngram_p1", "ngram_p2", "ngram_totals"}), *[(x, {x}) for x in ("token_nll", "eval_loss", "softmax", "draw_token")], ("known_tokens", {"ngram_longest", "known_tokens"})])
def test_model_queries_leave_what_their_result_reads(spark, monkeypatch, tmp_path, name, left):
    """Tables on the way to a result do not stay beside it."""
    from conftest import SF001
    from wordloom.plans import common, registry

    common.word_seq_table(spark, SF001)
    monkeypatch.setattr(spark.sparkContext, "getCheckpointDir", lambda: str(tmp_path))
    assert registry.Q[name](spark, SF001).count()
    assert folders(spark) == left


def test_prepared_sequences_leave_no_places(spark, monkeypatch, tmp_path):
    from conftest import SF001
    from wordloom.plans import common

    common.split(spark, SF001)
    monkeypatch.setattr(common, "_cache", {k: v for k, v in common._cache.items() if k[0] == "split"})
    with monkeypatch.context() as m:
        m.setattr(spark.sparkContext, "getCheckpointDir", lambda: str(tmp_path))
        seqs = common.word_seq_table(spark, SF001)
        assert folders(spark) == {"word_seqs"} and seqs.count()


def test_known_tokens_go_to_the_rows(spark, monkeypatch):
    """rows of a model are not shuffled to meet the tokens, unless these are too many."""
    model = spark.createDataFrame([(1, "", t, 1) for t in (1, 2, None)], "order int, ctx string, token int, n long")
    vocab = spark.createDataFrame([(2,), (2,), (None,), (3,)], "token int")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for most, join in ((N.KNOWN_IN_MEMORY, "BroadcastHashJoin"), (2, "SortMergeJoin")):
            monkeypatch.setattr(N, "KNOWN_IN_MEMORY", most)
            kept = N.keep_known_tokens(model, vocab)
            assert [r.token for r in kept.collect()] == [2]
            assert join in kept._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
