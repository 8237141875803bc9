"""Byte-level BPE learning, encoding and decoding.

The public ``tokenizers`` package (the library the reference trains with) is
used as a black-box oracle when it is installed."""

import json

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from wordloom.functions.byte_symbols import byte_to_symbol, word_to_symbols_py
from wordloom.operators import codec, ranking
from wordloom.operators import tokenizer as T
from wordloom.plans import common
from wordloom.sources.tokenizer_store import import_tokenizer_json, load_tokenizer, save_tokenizer

hf = pytest.importorskip("tokenizers")


def texts_df(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, sample string")


def learn(spark, texts, **kw):
    return T.learn_bpe(T.word_counts(texts_df(spark, texts)), **kw)


def hf_train(texts, vocab_size):
    from tokenizers import Tokenizer, decoders, models, pre_tokenizers, trainers

    tok = Tokenizer(models.BPE())
    tok.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False)
    tok.decoder = decoders.ByteLevel()
    tr = trainers.BpeTrainer(vocab_size=vocab_size, special_tokens=["<pad>", "<|im_start|>", "<|im_end|>"], show_progress=False, min_frequency=2)
    tok.train_from_iterator(texts, tr)
    return tok


def hf_merges(tok):
    j = json.loads(tok.to_str())
    return [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in j["model"]["merges"]]


def test_byte_map_is_bijective():
    m = byte_to_symbol()
    assert len(set(m.values())) == 256
    assert m[32] == "Ġ" and m[10] == "Ċ" and m[65] == "A"


def test_pretokenise_matches_library(spark):
    from tokenizers import pre_tokenizers

    pt = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
    texts = ["<|im_start|>assistant\nHello, world!  It's 2024...\tok", "a  b\n\n c", "x<|im_end|>y ÉÀ 中文"]
    got = [r.words for r in texts_df(spark, texts).select(T.pretokenise_words("sample").alias("words")).orderBy("doc_id").collect()]
    want = [[p for p, _ in pt.pre_tokenize_str(t)] for t in texts]
    assert [["".join(word_to_symbols_py(w)) for w in g] for g in got] == want


def test_merges_and_vocab_match_library_on_corpus(spark):
    corp = ranking.tokenizer_corpus(ranking.split_by_threshold(common.documents(spark, SF001)))
    texts = [r.sample for r in corp.orderBy("doc_id").collect()]
    ours = T.learn_bpe(T.word_counts(corp), max_merges=64)
    lib = hf_train(texts, len(ours.tokens))
    assert hf_merges(lib) == [(ours.tokens[l], ours.tokens[r]) for l, r, _ in ours.merges]
    assert lib.get_vocab() == {t: i for i, t in enumerate(ours.tokens)}
    enc = codec.encode(corp, ours).orderBy("doc_id").collect()
    assert all(lib.encode(t).ids == list(r.ids) for r, t in zip(enc, texts))


def test_full_depth_equals_the_library(spark):
    """The full stop rule: 4,096 tokens, and every text encoded alike."""
    corp = ranking.tokenizer_corpus(ranking.split_by_threshold(common.documents(spark, SF001))).checkpoint()
    texts = [r.sample for r in corp.orderBy("doc_id").collect()]
    ours = T.learn_bpe(T.word_counts(corp))
    assert ours.vocab_size == T.DEFAULT_VOCAB_SIZE and len(ours.merges) > 3_000
    lib = hf_train(texts, T.DEFAULT_VOCAB_SIZE)
    assert hf_merges(lib) == [(ours.tokens[l], ours.tokens[r]) for l, r, _ in ours.merges]
    assert lib.get_vocab() == {t: i for i, t in enumerate(ours.tokens)}
    enc = codec.encode(corp, ours).orderBy("doc_id").collect()
    assert all(lib.encode(t).ids == list(r.ids) for r, t in zip(enc, texts))


def test_wrong_guesses_change_no_merge(spark):
    corp = ranking.tokenizer_corpus(ranking.split_by_threshold(common.documents(spark, SF001))).limit(60).checkpoint()
    wc = T.word_counts(corp).checkpoint()
    want = T.learn_bpe(wc, max_merges=60)
    for words in (1, 40):
        assert T.learn_bpe(wc, max_merges=60, guess_words=words).merges == want.merges


def test_pair_index_follows_every_merge():
    import random

    rng = random.Random(2)
    words = [[rng.randrange(3) for _ in range(rng.randint(1, 9))] for _ in range(300)]
    counts = [rng.randint(1, 5) for _ in words]

    def counted(ws):
        out = {}
        for ids, n in zip(ws, counts):
            for p in zip(ids, ids[1:]):
                out[p] = out.get(p, 0) + n
        return out

    pairs = T.WordPairs([list(w) for w in words], counts)
    now, logs = T.PairCounts(counted(words)), []
    for new in range(3, 12):
        p, c = now.best()
        assert c == max(counted(pairs.words).values())
        delta, done = pairs.merge(*p, new)
        logs.append(done)
        now.add(delta)
        assert {k: v for k, v in now.counts.items()} == counted(pairs.words)
    for done in reversed(logs):
        pairs.undo(done)
    assert pairs.words == words
    assert pairs.merge(*T.PairCounts(counted(words)).best()[0], 3)[0] != {}


def test_tie_order(spark):
    ours = learn(spark, ["zy zy ab ab ba ba"])
    got = [ours.tokens[l] + " " + ours.tokens[r] for l, r, _ in ours.merges]
    assert got == ["a b", "b a", "z y", "Ġ ab", "Ġ ba"]
    lib = hf_train(["zy zy ab ab ba ba"], 4096)
    assert [" ".join(m) for m in hf_merges(lib)] == got


def test_repeated_symbol(spark):
    ours = learn(spark, ["aaaa aaaa"], max_merges=1)
    enc = codec.encode(texts_df(spark, ["aaaa"]), ours).first().ids
    assert [ours.tokens[i] for i in enc] == ["aa", "aa"]


def test_min_frequency_stops(spark):
    ours = learn(spark, ["abc"])
    assert ours.merges == []


def test_unseen_byte_dropped_and_broken_utf8(spark):
    ours = learn(spark, ["aa ab"])
    assert codec.encode(texts_df(spark, ["é"]), ours).first().ids == []
    a_id = ours.token_to_id()["a"]
    df = spark.createDataFrame([([a_id],)], "ids array<int>")
    # byte C3 alone: add a token for it to decode an invalid sequence
    ours2 = T.Tokenizer(tokens=ours.tokens + [byte_to_symbol()[0xC3]], merges=ours.merges)
    df2 = spark.createDataFrame([([a_id, len(ours.tokens)],)], "ids array<int>")
    assert df2.select(codec.decode_column("ids", ours2)).first()[0] == "a�"
    assert df.select(codec.decode_column("ids", ours)).first()[0] == "a"


def test_markers_single_ids_and_skipped_on_decode(spark):
    ours = learn(spark, ["<|im_start|>assistant\nalpha beta<|im_end|>"] * 3)
    df = texts_df(spark, ["<|im_start|>assistant\nalpha beta<|im_end|>", "s<|im_end|>a"])
    rows = codec.encode(df, ours).orderBy("doc_id").collect()
    assert rows[0].ids[0] == 1 and rows[0].ids[-1] == 2
    assert 2 in rows[1].ids
    dec = codec.encode(df, ours).select("doc_id", codec.decode_column("ids", ours).alias("t")).orderBy("doc_id").collect()
    assert [r.t for r in dec] == ["assistant\nalpha beta", "sa"]
    audit = codec.roundtrip_audit(df, ours).first()
    assert audit.n_docs == 2 and audit.n_roundtrip_ok == 2 and audit.n_first_id_1 == 1


def test_split_specials(spark):
    tok = T.Tokenizer(tokens=["<pad>", "<|im_start|>", "<|im_end|>"])
    df = texts_df(spark, ["x<|im_end|>y", "<|im_start|><|im_end|>", "plain"])
    got = [r.s for r in df.select(codec.split_specials("sample", tok).alias("s")).orderBy("doc_id").collect()]
    assert got == [["x", "<|im_end|>", "y"], ["<|im_start|>", "<|im_end|>"], ["plain"]]


def test_save_load_and_json_import(spark, tmp_path):
    texts = ["alpha beta gamma beta", "delta of the river", "gamma beta alpha"] * 4
    ours = learn(spark, texts)
    save_tokenizer(ours, spark, str(tmp_path / "tok"))
    back = load_tokenizer(spark, str(tmp_path / "tok"))
    assert back.tokens == ours.tokens and back.merges == ours.merges
    lib = hf_train(texts, len(ours.tokens))
    lib.save(str(tmp_path / "tokenizer.json"))
    imported = import_tokenizer_json(spark, str(tmp_path / "tokenizer.json"))
    assert imported.tokens == ours.tokens and imported.merges == ours.merges


def test_initial_vocab_and_pairs(spark):
    wc = T.word_counts(texts_df(spark, ["ab ab", "ba"]))
    vocab = [(r.id, r.token) for r in T.initial_vocab(wc).orderBy("id").collect()]
    assert vocab[:3] == [(0, "<pad>"), (1, "<|im_start|>"), (2, "<|im_end|>")]
    assert [t for _, t in vocab[3:]] == sorted(t for _, t in vocab[3:])
    pairs = {(r.left, r.right): r.n for r in T.pair_counts(wc).collect()}
    assert pairs == {("a", "b"): 2, ("Ġ", "a"): 1, ("b", "a"): 1}


def test_encoder_on_raw_whitespace(spark):
    train = ["a\x1cb  c　d e\n\nf", "x\x85y z", "it's 12 ok!!"] * 3
    ours = learn(spark, train)
    texts = ["a\x1cb  c　d e\n\nf", "x\x85y z  ", "\x1f\x1d it's"]
    df = texts_df(spark, texts)
    got = [list(r.ids) for r in codec.encode(df, ours).orderBy("doc_id").collect()]
    lib = hf_train(train, len(ours.tokens))
    assert [lib.encode(t).ids for t in texts] == got


def test_encoding_keeps_other_columns_exact(spark):
    ours = learn(spark, ["aa ab aa"])
    rows = [((1 << 60) + 1, "aa"), (None, None)]
    got = codec.encode(spark.createDataFrame(rows, "doc_id bigint, sample string").coalesce(1), ours).collect()
    assert [r.doc_id for r in got] == [(1 << 60) + 1, None] and got[1].ids == []


def test_audit_counts_a_document_without_known_bytes(spark):
    ours = learn(spark, ["aa ab"])
    r = codec.roundtrip_audit(texts_df(spark, ["é", "<|im_start|>aa"]), ours).first()
    assert (r.n_docs, r.n_roundtrip_ok, r.n_first_id_1) == (2, 1, 1)


def test_long_pretoken_merges_fast():
    import random
    import time

    from wordloom.operators.codec import WordMerger

    letters = [T.SPECIAL_TOKENS[0], *T.SPECIAL_TOKENS[1:], "a", "b", "aa", "ab", "abab", "aaaa"]
    tok = T.Tokenizer(tokens=letters, merges=[(3, 3, 5), (3, 4, 6), (6, 6, 7), (5, 5, 8)])
    word = "".join(random.Random(1).choice("ab") for _ in range(16_000))
    t0 = time.time()
    ids = WordMerger(tok).ids(word)
    assert time.time() - t0 < 1 and "".join(letters[i] for i in ids) == word


def test_decode_cost_does_not_grow_with_the_vocabulary(spark):
    import time

    df = spark.range(200).select(F.expr("transform(sequence(1, 1000), x -> cast((x * 7 + id) % 97 as int) + 3)").alias("ids")).cache()
    df.count()

    def seconds(size):
        tok = T.Tokenizer(tokens=[*T.SPECIAL_TOKENS, *["ab"] * (size - 3)])
        best = 9.0
        for _ in range(3):
            t0 = time.time()
            df.select(F.sum(F.length(codec.decode_column("ids", tok)))).collect()
            best = min(best, time.time() - t0)
        return best

    assert seconds(32_768) < 2 * seconds(140) + 1
    df.unpersist()


def test_symbol_outside_the_byte_table_is_an_error():
    from wordloom.functions.byte_symbols import symbols_to_bytes_hex

    assert symbols_to_bytes_hex("Ġa") == "2061"
    with pytest.raises(ValueError, match="stands for no byte"):
        symbols_to_bytes_hex("中")


def test_json_import_with_string_merges(spark, tmp_path):
    texts = ["alpha beta gamma beta", "delta of the river"] * 4
    ours = learn(spark, texts)
    lib = hf_train(texts, len(ours.tokens))
    j = json.loads(lib.to_str())
    j["model"]["merges"] = [" ".join(m) if isinstance(m, list) else m for m in j["model"]["merges"]]
    p = tmp_path / "string_merges.json"
    p.write_text(json.dumps(j), encoding="utf-8")
    imported = import_tokenizer_json(spark, str(p))
    assert imported.tokens == ours.tokens and imported.merges == ours.merges


def one_at_a_time(words, merges, specials=T.SPECIAL_TOKENS):
    """The trainer by definition: count all pairs, merge the best, start again."""
    from wordloom.functions.byte_symbols import word_to_symbols_py

    tokens = list(specials) + sorted({s for w in words for s in word_to_symbols_py(w)})
    ids = {t: i for i, t in enumerate(tokens)}
    state, made = [([ids[s] for s in word_to_symbols_py(w)], n) for w, n in words.items()], []
    while len(made) < merges:
        count = {}
        for w, n in state:
            for p in zip(w, w[1:]):
                count[p] = count.get(p, 0) + n
        best = min(count, key=lambda p: (-count[p], p), default=None)
        if best is None or count[best] < 2:
            break
        token = tokens[best[0]] + tokens[best[1]]
        if token not in ids:
            ids[token] = len(tokens)
            tokens.append(token)
        made.append((*best, ids[token]))
        for i, (w, n) in enumerate(state):
            out, j = [], 0
            while j < len(w):
                hit = j + 1 < len(w) and (w[j], w[j + 1]) == best
                out.append(ids[token] if hit else w[j])
                j += 2 if hit else 1
            state[i] = (out, n)
    return tokens, made


@pytest.mark.parametrize("seed, letters, count", [(1, "ab", 3), (2, "abc", 60), (3, "abcdé", 1)])
def test_merges_on_runs_equal_the_trainer_by_definition(spark, seed, letters, count):
    """Few letters, many ties and tokens that two pairs make; runs of frequent
    pairs reach the driver, from one run to all words."""
    import random

    rng = random.Random(seed)
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(1, 12))): rng.randint(1, count) for _ in range(150)}
    wc = spark.createDataFrame(list(words.items()), "word string, n bigint").checkpoint()
    tokens, made = one_at_a_time(words, 40)
    for held in (40, 10_000):
        ours = T.learn_bpe(wc, max_merges=40, guess_words=held)
        assert ours.merges == made and ours.tokens == tokens


def test_rounds_stay_few_when_most_words_are_not_on_the_driver(spark, caplog):
    """A round's merges do not depend on a sample that knows the order."""
    import logging
    import random

    rng = random.Random(7)
    parts = [a + b + c for a in "bdfglmn" for b in "aeiou" for c in ("", "r", "s", "nt")]
    words = {"".join(rng.choice(parts[: 3 + int(rng.expovariate(0.02))]) for _ in range(rng.randint(2, 5))): rng.randint(1, 9) for _ in range(6000)}
    wc = spark.createDataFrame(list(words.items()), "word string, n bigint").checkpoint()
    with caplog.at_level(logging.INFO, logger="wordloom.operators.tokenizer"):
        assert len(T.learn_bpe(wc, max_merges=300, guess_words=600).merges) == 300
    assert sum("bpe round" in r.getMessage() for r in caplog.records) <= 25


def test_units_give_the_ids_of_the_rule(spark):
    """Units are kept over texts, a bounded number of
    them, and white space of any kind gives the ids of the rule run on whole texts."""
    import random

    import regex

    ours = learn(spark, ["a ll b's  it's\n\na12 !!", "aab bba ab ab"] * 3)
    coder = codec.UnitCodes(ours, most=50)
    merger, rng = codec.WordMerger(ours), random.Random(3)
    parts = ["a", "b", "'", "s", "ll", " ", " ", "  ", "\n", "\t", "\x1c", "\x85", "　", "1", "!", "é"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        want = [i for w in regex.findall(T.PRETOKEN_RULE, text) for i in merger.ids(w)]
        assert list(memoryview(coder.encode(text)).cast("i")) == want
    assert len(coder) + len(coder.old) < 2 * (50 + 13)
    met = []
    coder.merger.ids = lambda w, of=coder.merger.ids: met.append(w) or of(w)
    for _ in range(3):
        coder.encode("new words only once")
    assert met == ["new", " words", " only", " once"]


@pytest.mark.parametrize("seed, letters", [(1, "ab"), (2, "abcé"), (3, "a")])
def test_words_merged_side_by_side_equal_words_merged_alone(seed, letters):
    """Any merges, also pairs given twice and tokens that several pairs make."""
    import random

    import numpy as np

    rng = random.Random(seed)
    for _ in range(40):
        tokens = [*T.SPECIAL_TOKENS, *sorted({s for x in letters for s in word_to_symbols_py(x)})]
        merges = []
        for _ in range(rng.randint(0, 25)):
            l, r = rng.randrange(3, len(tokens)), rng.randrange(3, len(tokens))
            if tokens[l] + tokens[r] not in tokens:
                tokens.append(tokens[l] + tokens[r])
            merges.append((l, r, tokens.index(tokens[l] + tokens[r])))
        merger = codec.WordMerger(T.Tokenizer(tokens=tokens, merges=merges))
        words = ["".join(rng.choice(letters + "ü") for _ in range(rng.randint(0, 14))) for _ in range(60)]
        ids, ends = merger.many(words)
        assert [list(x) for x in np.split(ids, ends)[:-1]] == [merger.ids(w) for w in words]
        assert [len(x) for x in merger.many([])] == [0, 0]


def test_new_units_are_merged_together_and_kept_long_ones_alone(spark):
    """One by one, a task's new words took most of the encoding's time."""
    import random

    import regex

    ours = learn(spark, ["a ll b's  it's\n\na12 !!", "aab bba ab ab"] * 3)
    coder, merger = codec.UnitCodes(ours), codec.WordMerger(ours)
    long, met = "ab" * 40, []
    texts = ["aab bba it's a12!! é", f"a\n\nb {long} abab"]
    want = [merger.ids(w) for t in texts for w in regex.findall(T.PRETOKEN_RULE, t)]
    coder.merger.ids = lambda w, of=coder.merger.ids: met.append(w) or of(w)
    coder.learn({u for t in texts for u in coder.units(t)})
    got = b"".join(coder.encode(t) for t in texts)
    assert list(memoryview(got).cast("i")) == [i for ids in want for i in ids]
    assert met == [" " + long] and long not in coder
    rng, parts = random.Random(4), ["a", "b", "'", "s", "ll", " ", " ", "  ", "\n", "\t", "\x1c", "\x85", "　", "1", "!", "é"]
    coder = codec.UnitCodes(ours, most=40)
    coder.learn(set())
    for _ in range(200):
        texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(9)]
        coder.turn()
        coder.learn({u for t in texts for u in coder.units(t)})
        for t in texts:
            want = [i for w in regex.findall(T.PRETOKEN_RULE, t) for i in merger.ids(w)]
            assert list(memoryview(b"".join(map(coder.__getitem__, coder.units(t)))).cast("i")) == want
