"""Toxicity, HTML extraction and packing."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from wordloom.llm import html_blocks, packing, toxicity

from .conftest import EDGE

BAD = ["rotten", "wretch", "swine"]


def toxic_case(n=600, seed=3):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("aeiourstlnmd") for _ in range(rng.randint(2, 9))) for _ in range(400)]
    docs, labels = [], []
    for k in range(n):
        words = [rng.choice(vocab) for _ in range(rng.randint(5, 120))]
        toxic = rng.random() < 0.3
        if toxic:
            for _ in range(rng.randint(2, 4)):
                words.insert(rng.randint(0, len(words)), rng.choice(BAD))
        docs.append((k, " ".join(words)))
        labels.append((k, 1, int(toxic)))
    return docs, labels


@pytest.fixture(scope="module")
def fitted(spark):
    docs, labels = toxic_case()
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    lab = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    return d, lab, toxicity.train_model(d, lab)


def test_held_out_rows_are_told_apart(fitted):
    d, lab, _ = fitted
    rows = toxicity.score_documents(d, lab).join(lab, "doc_id").where("held_out").collect()
    assert len(rows) > 100
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    assert np.mean([r["predicted"] == r["toxic"] for r in rows]) > 0.97
    kept = toxicity.drop_toxic(d, lab)
    assert kept.columns == d.columns and 0.6 < kept.count() / d.count() < 0.8


def test_obfuscated_words_are_restored_and_scored(fitted):
    _, _, model = fitted
    for shown, word in [("r0tten", "rotten"), ("$w1ne", "swine"), ("wr3tch", "wretch"), ("wreeeetch!!!", "wretch"), ("sw|ne,", "swine"), ("r.o.t.t.e.n", "rotten")]:
        assert toxicity.token_words(shown, model.chars) == [word], shown
    assert toxicity.spaced_runs("he is s w 1 n e to me".split()) == ["s w 1 n e"]
    assert toxicity.restore("s w 1 n e", model.chars) == ["swine"]
    plain = "soul nurse " * 20
    scores = model.probability(np.array([model.document(t) for t in (plain, plain + "r0tten $wine wr3tch", plain + "s w 1 n e and rooootten", "")], dtype=float))
    assert scores[0] < 0.5 < min(scores[1], scores[2]) and scores[3] < 0.7


def test_signs_doubled_letters_and_fragments_are_decoded(fitted):
    chars = fitted[2].chars
    m = toxicity.ToxicityModel(chars, {"rotten": 5.0, "swine": 4.0, "idiot": 3.0, "clown": 2.0, "ass": 1.0})
    for shown, weight in [("@$$", 1), ("4$$", 1), ("@$$!", 1), ("!diot", 3), ("(lown", 2), ("!d1ot!!", 3), ("iidiot", 3), ("swiine", 4), ("rrotten", 5), ("rroten", 0)]:
        assert m.token_weight(shown) == weight, shown
    for shown, weight in [("sw in e", 4), ("i, d, i, o, t", 3), ("to id io t, me", 3), ("rot ten", 5), ("5w in e", 4), ("he is to me", 0)]:
        assert m.document(shown)[0] == weight, shown
    for number in ["$100", "1,000", "50%", "(1994)", "12:30", "+", "$$", "3.5+"]:
        assert toxicity.token_readings(number, chars) == [[]], number


def test_plain_tokens_are_read_as_they_are(fitted):
    _, _, model = fitted
    assert toxicity.token_words("(Hello,".lower(), model.chars) == ["hello"]
    assert toxicity.token_words("1234", model.chars) == [] and toxicity.token_words("--", model.chars) == []
    assert toxicity.token_words("naïve", model.chars) == ["naïve"]


def brute_viterbi(token, model):
    import itertools

    best = None
    for path in itertools.product(*toxicity.readings(token), [(" ", 0.0)]):
        s, x, y = sum(c for _, c in path), toxicity.BOUND, toxicity.BOUND
        for c in "".join(t for t, _ in path):
            z = toxicity.BOUND if c == " " else toxicity.symbol_of(c)
            if z == y == toxicity.BOUND:
                continue
            s += model[x][y][z]
            x, y = y, z
        if best is None or s > best[0] + 1e-12:
            best = (s, "".join(t for t, _ in path).split())
    return best[1]


def test_viterbi_equals_all_paths(fitted):
    _, _, model = fitted
    for token in ["r0t7en", "$$wine", "a1b2", "s w 1 n e", "wr3e3tch", "l00l", "x--y"]:
        assert toxicity.restore(token, model.chars) == brute_viterbi(token, model.chars)


def test_toxicity_edge_rows(spark, edge_docs, no_docs, fitted):
    _, lab, _ = fitted
    rows = toxicity.score_documents(edge_docs, lab).collect()
    assert len(rows) == len(EDGE) and all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.score_documents(no_docs, lab).count() == 0
    none = spark.createDataFrame([(None, 1, 1), (1, 1, None)], "doc_id bigint, quality int, toxic int")
    assert {r["score"] for r in toxicity.score_documents(edge_docs, none).collect()} == {0.0}
    one = spark.createDataFrame([(k, 1, 1) for k in range(30)], "doc_id bigint, quality int, toxic int")
    assert {r["score"] for r in toxicity.score_documents(edge_docs, one).collect()} == {1.0}


def test_trigram_counts():
    n = toxicity.trigram_counts("ab, é".encode()).reshape(28, 28, 28)
    b, o = toxicity.BOUND, toxicity.OTHER
    assert {tuple(map(int, x)): int(n[tuple(x)]) for x in np.argwhere(n)} == {(b, 0, 1): 1, (0, 1, b): 1, (1, b, o): 1, (b, o, b): 1}


# ---- html ------------------------------------------------------------------


def test_leaf_blocks_of_broken_markup():
    html = (
        "<!doctype html><title>t</title><script>var x='</p>'</script><nav><li><a href='/x>y'>One</a><li>Two</nav><!-- <p>no</p> -->"
        "<article class='mainPost'><p><b>Bold<br>line &amp; more<p>a<i>b</i>c &lt;tag&gt;<p></article>tail<!-- open <p>x"
    )
    got = html_blocks.leaf_blocks(html)
    assert [b[0] for b in got] == ["One", "Two", "Bold line & more", "abc <tag>", "tail"]
    assert got[0][2] == 1.0 and got[1][2] == 0.0
    assert html_blocks.leaf_blocks("") == [] and html_blocks.leaf_blocks("<p> \n </p>") == []
    assert [b[0] for b in html_blocks.leaf_blocks("1 < 2 <p title=\"a>b\">x")] == ["1 < 2", "x"]


def test_skipped_elements_end_where_they_end():
    def texts(html):
        return [b[0] for b in html_blocks.leaf_blocks(html)]

    for name in ("svg-icon", "template-x", "title-bar", "select-box", "object-view", "script-note", "iframe-x"):
        assert texts(f"<p>a</p><{name} name='x'></{name}><p>the rest</p>") == ["a", "the rest"], name
    for tag in ('<svg width="1"/>', "<svg/>", "<SVG a='>' />", "<noscript>", "<template>", "<object data='x'>", "<select>", "<svg>"):
        assert texts(f"<p>a</p>{tag}<p>the rest</p>") == ["a", "the rest"], tag
    for name in html_blocks.SKIPPED:
        assert texts(f"<p>a</p><{name} x='1'><b>no</b></{name.upper()} ><p>the rest</p><{name}><p>too") == ["a", "the rest", "too"], name
    assert texts("<p>a<script>no</script ><p>b<style>no") == ["a", "b"]
    assert texts("<select>" * 50_000 + "x") == ["x"]


HOSTILE = {
    "names without an end": "<script" * 150_000,
    "one long name": "<" + "a" * 1_000_000,
    "nested blocks": "<div>x" * 40_000,
    "nested inline, then blocks": "<b>" * 20_000 + "<div></div>" * 20_000,
    "quotes around every end": "<a '>'" * 150_000,
    "end tags without an end": "<script></script " + "</script " * 100_000,
    "end tags of nothing": "<div>" * 20_000 + "</p>" * 20_000,
}


@pytest.mark.parametrize("case", HOSTILE)
def test_reading_time_is_linear(case):
    from time import process_time

    t = process_time()
    html_blocks.leaf_blocks(HOSTILE[case])
    assert process_time() - t < 5  # under a second on an idle core; hours when quadratic or worse


def test_a_comment_or_script_without_an_end_swallows_the_rest():
    for tail in ("<!-- b", "<!-->b", "<script>b</script", "<!-- b > c"):
        assert [t for t, _, _ in html_blocks.leaf_blocks("<p>a</p>" + tail)] == ["a"]
    assert [t for t, _, _ in html_blocks.leaf_blocks("<p>a</p>b < c <d")] == ["a", "b < c <d"]


def test_long_paths_as_counts_give_the_same_vectors(monkeypatch):
    html = "".join(f"<div class='c{k % 7}x d'>t{k}" for k in range(120))
    labeller = html_blocks.Labeller()
    plain = labeller.scores([html_blocks.with_words(html_blocks.leaf_blocks(html))])[0]
    monkeypatch.setattr(html_blocks, "LONG_PATH", 20)
    monkeypatch.setattr(html_blocks, "ENTRIES", 50)
    counted = html_blocks.with_words(html_blocks.leaf_blocks(html))
    assert any(isinstance(b[1], html_blocks.LongPath) for b in counted)
    assert np.allclose(labeller.scores([counted])[0], plain, atol=1e-4)


def test_scores_equal_a_forward_pass_cell_by_cell():
    """One page without padding, gates and sums written out one by one."""
    from math import exp, log1p, tanh

    html = "<div class=menu><a href=x>Go on</a></div><article><h1>Title</h1><p>Some text of it. More &amp; more.</p></article><p>End"
    lab = html_blocks.Labeller(seed=3)
    page = html_blocks.with_words(html_blocks.leaf_blocks(html))
    other = html_blocks.with_words(html_blocks.leaf_blocks("<p>a<p>b<p>c<p>d<p>e<p>f"))
    p = {k: v.astype(float) for k, v in lab.p.items()}

    def sig(v):
        return 1 / (1 + exp(-v))

    xs = []
    for text, path, share, words in page:
        x = []
        for name, slots, dim in (("path", path, html_blocks.PATH_DIM), ("word", words, html_blocks.WORD_DIM)):
            f = min(len(slots) ** -0.5, 4 / len(slots)) if slots else 0
            x += [f * sum(p[name][s][j] for s in slots) for j in range(dim)]
        x += [log1p(len(text)) / 4, share, min(len(text), 120) / 120, float(text[-1] in ".!?…。")]
        xs.append(x)
    h_dim = html_blocks.HIDDEN
    states = {}
    for side in "fb":
        h, c = [0.0] * h_dim, [0.0] * h_dim
        w, u, b = p["w" + side], p["u" + side], p["b" + side]
        for k in range(len(xs)) if side == "f" else reversed(range(len(xs))):
            z = [b[j] + sum(xs[k][i] * w[i][j] for i in range(len(xs[k]))) + sum(h[i] * u[i][j] for i in range(h_dim)) for j in range(4 * h_dim)]
            c = [sig(z[h_dim + j]) * c[j] + sig(z[j]) * tanh(z[3 * h_dim + j]) for j in range(h_dim)]
            h = [sig(z[2 * h_dim + j]) * tanh(c[j]) for j in range(h_dim)]
            states[side, k] = h
    want = [sum(a * o for a, o in zip(states["f", k] + states["b", k], p["out"], strict=True)) + p["bias"][0] for k in range(len(xs))]
    assert np.allclose(lab.scores([page, other])[0], want, atol=1e-4)


def test_gradients_equal_finite_differences():
    net = html_blocks.Labeller()
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    texts = ["some words here.", "other text of a page", "x"]
    pages, labels = html_blocks.training_set(texts, 3, seed=2)
    _, grads = net.gradients(pages, labels)
    rng = np.random.default_rng(0)
    for name in net.p:
        spots = np.argwhere(np.abs(grads[name]) > 1e-4)
        for at in spots[rng.permutation(len(spots))[:3]]:
            at = tuple(at)
            old, eps = net.p[name][at], 1e-4
            net.p[name][at] = old + eps
            up = net.gradients(pages, labels)[0]
            net.p[name][at] = old - eps
            down = net.gradients(pages, labels)[0]
            net.p[name][at] = old
            assert (up - down) / (2 * eps) == pytest.approx(grads[name][at], rel=0.05, abs=2e-5), name


@pytest.fixture(scope="module")
def labeller(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    return html_blocks.train(pages)


def test_held_out_layouts(labeller):
    pages, labels = html_blocks.training_set(["Fresh words of other pages, never seen. " * 5, "Short text."], 200, seed=77)
    found = np.concatenate([s > 0 for s in labeller.scores(pages)])
    assert (found == np.concatenate(labels).astype(bool)).mean() > 0.98


def test_articles_of_the_table(spark, labeller):
    rows = [r["html"] for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("html").collect()]
    got = html_blocks.main_texts(rows, labeller)
    want = [" ".join(t for t, _, _ in html_blocks.leaf_blocks(h[h.index("<article>") : h.index("</article>")])) for h in rows]
    assert sum(a == b for a, b in zip(got, want)) >= 0.98 * len(rows)


def test_comments_and_forms_are_left_out(labeller):
    text = "A sentence of the story that goes on for a while and ends here."
    html = (
        f"<div id='cookie-notice'><p>{text}</p></div><header><h2>Site</h2></header><div class='content'><h1>Title of it</h1>"
        + f"<p>{text}</p>" * 4
        + f"<aside class='sidebar'>{text}</aside></div><form><label>Name</label></form><div class='comments'><p>{text}</p></div><footer>{text}</footer>"
    )
    assert html_blocks.main_texts([html], labeller) == ["Title of it " + " ".join([text] * 4)]


def test_extract_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, "<p"), (4, "plain text only"), (4, "plain text only"), (5, "<article>" + "<p>words and more words.</p>" * 3000 + "</article>"), (None, "<div>" * 500)]
    pages = spark.createDataFrame([(i, "u", h, "old") for i, h in rows], "page_id bigint, url string, html string, text string")
    got = html_blocks.extract(spark, pages).collect()
    by = {r["page_id"]: r for r in got}
    assert len(got) == len(rows) and by[1]["text"] == "" and by[2]["n_chars"] == 0
    assert by[5]["n_chars"] == 3000 * 21 + 2999
    assert html_blocks.extract(spark, pages.limit(0)).count() == 0


def test_extract_with_clashing_names_and_any_file_layout(spark):
    rows = [(k, f"<nav><a>Menu {k}</a></nav><article><p>Words of page {k} that are its text, quite a few of them.</p></article>", "old", 9) for k in range(40)]
    pages = spark.createDataFrame(rows, "page_id bigint, text string, `n.b` string, n_chars int")
    a = html_blocks.extract(spark, pages.repartition(1), html_col="text")
    assert a.columns == ["page_id", "n.b", "text", "n_chars"]
    b = html_blocks.extract(spark, pages.repartition(5), html_col="text")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_the_shortcuts_change_no_weight(monkeypatch):
    rng = random.Random(6)
    model = toxicity.ToxicityModel(np.log(np.full((28, 28, 28), 1 / 28)).tolist(), {"idiot": 2.0, "idi-": 1.0, "stupid": 3.0, "ärger": 1.5, "x9": 1.0})
    signs = "idotsupähx0159!|$@. "
    tokens = ["".join(rng.choice(signs) for _ in range(rng.randint(1, 8))).strip() or "a" for _ in range(3000)]
    fast = [model.token_weight(t) for t in tokens]
    skipped = sum(not toxicity.may_hold(t, model.shapes) for t in tokens)
    heaviest = lambda words: sum(max(model.weights.get(f, 0.0) for f in toxicity.features(w)) for w in words)
    assert fast == [max(map(heaviest, toxicity.spaced_or_token(t, model.chars))) for t in tokens] and 100 < skipped < 3000
    runs = [tuple("".join(rng.choice(signs[:-1]) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(2, 5))) for _ in range(2000)]
    for word in ["idiot", "stupid", "1di0t", "$tupi|d", "iddiiot", "stu.pid"] * 50:
        cuts = sorted(rng.sample(range(1, len(word)), 2))
        runs.append((rng.choice(signs[:-1]), word[: cuts[0]], word[cuts[0] : cuts[1]], word[cuts[1] :]))
    fast = [model.fragments_weight(r) for r in runs]
    monkeypatch.setattr(toxicity, "may_hold", lambda token, table: True)
    monkeypatch.setattr(toxicity, "holds_shape", lambda z, table, places: True)
    assert fast == [model.fragments_weight(r) for r in runs] and any(fast)


# ---- packing ---------------------------------------------------------------


def tokenizer_path():
    return pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")


def test_text_encoder_equals_the_tokenizer():
    from tokenizers import Tokenizer

    with open(tokenizer_path(), encoding="utf-8") as f:
        text = f.read()
    whole, fast = Tokenizer.from_str(text), packing.TextEncoder(text)
    assert fast.fast is not None
    rng = random.Random(1)
    signs = list("ab 's.,!\n\t  é1²_'") + ["don't", " we'll", "\x85", "　", "\u2028", "\x1c", "😀", "ǅ", "́", "\r\n", "<|endoftext|>", "...", "the", " rotation", "x" * 40]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 14))) for _ in range(3000)]
    texts += [f"a{chr(c)}b {chr(c)}1{chr(c)} '{chr(c)}  {chr(c)}\n" for c in range(1, 0x30000, 13) if not 0xD800 <= c < 0xE000]
    for t, want in zip(texts, whole.encode_batch(texts, add_special_tokens=False), strict=True):
        assert np.frombuffer(fast.ids(t), "<u4").tolist() == want.ids, repr(t)


def test_other_tokenizers_are_read_by_their_library():
    import json

    with open(tokenizer_path(), encoding="utf-8") as f:
        said = json.load(f)
    assert packing.byte_level_ranks(said) is not None
    assert packing.byte_level_ranks({**said, "normalizer": {"type": "Lowercase"}}) is None
    merges = said["model"]["merges"]
    assert packing.byte_level_ranks({**said, "model": {**said["model"], "merges": [merges[1], merges[0], *merges[2:]]}}) is None
    other = pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")
    with open(other, encoding="utf-8") as f:
        coder = packing.TextEncoder(f.read())
    assert coder.fast is None
    assert np.frombuffer(coder.ids("Some words, here"), "<u4").tolist() == coder.tokenizer.encode("Some words, here", add_special_tokens=False).ids


def check_bins(docs, rows, tokens, segments, loss):
    by_doc, by_seq = {}, {}
    for doc, start, length, ids, total, seq, offset in rows:
        by_doc.setdefault(doc[0], []).append((start, length, ids, total))
        by_seq.setdefault(seq, []).append((offset, length, doc[0], start))
    for key, ids, _ in docs:
        pieces = sorted(by_doc[key])
        assert b"".join(p[2] for p in pieces) == ids and all(p[3] == len(ids) // 4 for p in pieces)
        assert [p[0] for p in pieces] == np.cumsum([0, *[p[1] for p in pieces]])[:-1].tolist()
    first_loss = {key: lf for key, _, lf in docs}
    padding = 0
    for pieces in by_seq.values():
        pieces.sort()
        assert [p[0] for p in pieces] == np.cumsum([0, *[p[1] for p in pieces]])[:-1].tolist()
        n = sum(p[1] for p in pieces)
        assert n <= tokens and len(pieces) <= segments
        assert sum(max(0, s + k - max(s, first_loss[d])) for _, k, d, s in pieces) <= loss
        padding += 0 if n & (n - 1) == 0 else tokens - n
    return padding


@pytest.mark.parametrize(("tokens", "segments", "loss", "pool"), [(64, 8, 64, 16), (64, 2, 64, 4), (64, 8, 10, 16), (16, 1, 16, 1), (7, 3, 2, 5)])
def test_bins_keep_every_limit(tokens, segments, loss, pool):
    rng = random.Random(tokens + loss)
    docs = []
    for k in range(300):
        n = rng.choice([1, 1, 2, 3, 5, 17, 40, 63, 64, 65, 300])
        docs.append((k, np.arange(n, dtype="<u4").tobytes(), rng.choice([0, 0, n // 2, n])))
    rows = list(packing.pack(docs, tokens, segments, loss, pool))
    padding = check_bins(docs, rows, tokens, segments, loss)
    if loss == tokens and tokens & (tokens - 1) == 0:
        assert padding == 0


def test_pack_edge_rows(edge_docs, no_docs):
    rows = packing.pack_documents(edge_docs, tokenizer_path(), seq_tokens=256, max_segments=4).collect()
    assert all(zlib.crc32(bytes(r["ids"])) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"] for r in rows)
    assert sum(r["start"] == 0 for r in rows) == len(EDGE)
    per_seq = {}
    for r in rows:
        per_seq.setdefault(r["sequence_id"], []).append(r["length"])
    assert max(map(sum, per_seq.values())) <= 256 and max(map(len, per_seq.values())) <= 4
    assert [r["doc_tokens"] for r in rows if r["doc_id"] == 1] == [1]
    assert packing.pack_documents(no_docs, tokenizer_path()).count() == 0
    with pytest.raises(ValueError):
        packing.pack_documents(edge_docs, tokenizer_path(), max_segments=0)


def test_prompt_tokens_bear_no_loss(spark):
    docs = spark.createDataFrame([(k, "ask me " * 20 + "answer " * 10, 140) for k in range(20)], "doc_id bigint, text string, prompt int")
    rows = packing.pack_documents(docs, tokenizer_path(), seq_tokens=256, max_loss=24, prompt_chars_col="prompt").collect()
    assert sum(r["length"] for r in rows) == sum({r["doc_id"]: r["doc_tokens"] for r in rows}.values())
    assert docs.select(F.max("prompt")).first()[0] == 140
