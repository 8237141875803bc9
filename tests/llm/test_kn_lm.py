"""Kneser-Ney model against a dictionary version of the same formulas."""

import math
from collections import Counter, defaultdict

import pytest

from wordloom.llm import kn_lm

TEXTS = [
    (1, "the cat sat on the mat"), (2, "the cat sat on the hat"), (3, "a dog sat on a mat"), (4, None), (5, ""),
    (6, "The  CAT\tsat"), (7, "the the the the"), (8, "dog ate the cat and the hat"), (9, "über den mat the cat"),
    (10, "unseen words only here"), (11, "the cat sat on the mat"), (None, "the dog"), (13, "a b c d e f g a b c a b"),
    (14, "cat sat on a b c"), (15, "x"), (16, "the mat"), (17, "y " * 500),
]


def held_out(i):
    import zlib

    return zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0


def tokens(t):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in (t or ""))
    return [w for w in __import__("re").split(r"[\x20\x09-\x0d]+", low) if w] + ["</s>"]


def brute(rows, order):
    train = [tokens(t) for i, t in rows if not held_out(i)]
    uni = Counter(w for t in train for w in t)
    n_all, v = sum(uni.values()), len(uni)
    grams = {order: Counter()}
    for t in train:
        line = ["<s>"] * (order - 1) + t
        for i in range(order - 1, len(line)):
            grams[order][tuple(line[i - order + 1 : i + 1])] += 1
    for k in range(order - 1, 0, -1):
        grams[k] = Counter(g[1:] for g in grams[k + 1])
    disc, by_ctx = {}, {}
    for k, c in grams.items():
        disc[k] = kn_lm.discounts([sum(n == m for n in c.values()) for m in (1, 2, 3, 4)])
        by_ctx[k] = defaultdict(list)
        for g, n in c.items():
            by_ctx[k][g[:-1]].append(n)

    def p(k, ctx, w):
        if k == 0:
            return 1 / (v + 1)
        low = p(k - 1, ctx[1:], w)
        ns = by_ctx[k].get(ctx)
        if not ns:
            return low
        a, d = grams[k].get((*ctx, w), 0), disc[k]
        gamma = sum(d[min(n, 3)] for n in ns) / sum(ns)
        return max(a - d[min(a, 3)], 0) / sum(ns) + gamma * low

    out = {}
    for i, t in rows:
        line = ["<s>"] * (order - 1) + tokens(t)
        s = sum(math.log10(p(order, tuple(line[j - order + 1 : j]), line[j])) for j in range(order - 1, len(line)))
        base = sum(math.log10((uni[w] + 0.1) / (n_all + 0.1 * (v + 1))) for w in tokens(t))
        out[i] = (held_out(i), len(tokens(t)), sum(uni[w] > 0 for w in tokens(t)), n_all, base, s)
    return out


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_equal_brute_force(spark, order, monkeypatch):
    monkeypatch.setattr(kn_lm, "BLOCK_TOKENS", 7)
    docs = spark.createDataFrame([(i, t, "x", 1.0) for i, t in TEXTS], "doc_id bigint, text string, score string, shard double").repartition(3)
    got = {r["doc_id"]: tuple(r)[1:] for r in kn_lm.score_documents(docs, order=order, shard_bytes=40).collect()}
    want = brute(TEXTS, order)
    assert set(got) == set(want)
    for i, w in want.items():
        assert got[i][:4] == w[:4], i
        assert got[i][4:] == pytest.approx(w[4:], rel=1e-9), i


def test_probabilities_sum_to_one(spark):
    docs = spark.createDataFrame(TEXTS, "doc_id bigint, text string")
    model = kn_lm.train(docs, order=2, shard_bytes=64)
    import numpy as np

    words = sorted({w for _, t in TEXTS for w in tokens(t)[:-1]})
    h = [kn_lm.token_hashes(w.encode())[0] for w in words] + [np.uint64(kn_lm.END), kn_lm.token_hashes(b"never-seen-zz")[0]]
    first = kn_lm.token_hashes(b"the")[0]
    total = 0.0
    for x in h:
        both = model.score([np.array([first, x], np.uint64)])[0][3]
        total += 10 ** (both - model.score([np.array([first], np.uint64)])[0][3])
    assert total == pytest.approx(1.0, rel=1e-9)


def test_empty_table_and_empty_training(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert kn_lm.score_documents(empty).collect() == []
    only = next(i for i in range(100) if held_out(i))
    r = kn_lm.score_documents(spark.createDataFrame([(only, "a b")], "doc_id bigint, text string")).first()
    assert r["train_tokens"] == 0 and r["n_known"] == 0 and r["score"] == pytest.approx(0.0)


def test_registered_model_reads_two_words_of_context(spark):
    docs = [(1, "a b c a b c d b e d b e")] * 5 + [(2, "a b c"), (3, "d b c")]
    got = {r["doc_id"]: r["score"] for r in kn_lm.score_documents(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    want = brute(docs, 3)
    assert all(got[i] == pytest.approx(want[i][5], rel=1e-9) for i in got)
    assert got[2] != pytest.approx(brute(docs, 2)[2][5], rel=1e-3)


def test_counts_beyond_a_byte(spark):
    docs = [(1, "u v w " * 254), (2, "u v w " * 255), (3, "p q " * 700 + "u v"), (4, "u q w")]
    got = {r["doc_id"]: r["score"] for r in kn_lm.score_documents(spark.createDataFrame(docs, "doc_id bigint, text string"), shard_bytes=1000).collect()}
    want = brute(docs, 3)
    assert all(got[i] == pytest.approx(want[i][5], rel=1e-9) for i in got)


def test_order_four_equals_brute_force(spark):
    docs = spark.createDataFrame(TEXTS, "doc_id bigint, text string")
    got = {r["doc_id"]: r["score"] for r in kn_lm.score_documents(docs, order=4, shard_bytes=100).collect()}
    want = brute(TEXTS, 4)
    assert all(got[i] == pytest.approx(want[i][5], rel=1e-9) for i in got)


def test_a_missing_folder_or_file_is_an_error(tmp_path):
    import numpy as np

    folder = f"file://{tmp_path}"
    with pytest.raises(FileNotFoundError):
        kn_lm.Arrays(folder).array("k1", np.uint64)
    kn_lm.put(folder, kn_lm.LISTED, np.frombuffer(b"k1\nk2", np.uint8))
    kn_lm.put(folder, "k1", np.arange(3, dtype=np.uint64))
    arrays = kn_lm.Arrays(folder)
    assert arrays.array("k1", np.uint64).tolist() == [0, 1, 2]
    assert not len(arrays.array("k3", np.uint64))
    with pytest.raises(FileNotFoundError):
        arrays.array("k2", np.uint64)
