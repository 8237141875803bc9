"""Best-fit packing against piece-by-piece packing and the tokenizer itself."""

import random
import zlib
from bisect import bisect_left, insort
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from wordloom.llm import best_fit
from wordloom.llm.token_units import BlankUnitCodes

from .conftest import EDGE


def tokenizer_path():
    return pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")


def bins_one_by_one(lengths, capacity):
    """Bins when the pieces are placed singly: pairs of large ones, then best fit."""
    large = sorted(x for x in lengths if 3 * x > capacity)
    gaps = []
    n = 0
    while large:
        x = large.pop()
        k = bisect_left(large, capacity - x + 1) - 1
        gap = capacity - x - (large.pop(k) if k >= 0 else 0)
        insort(gaps, gap)
        n += 1
    for x in sorted((x for x in lengths if 3 * x <= capacity), reverse=True):
        k = bisect_left(gaps, x)
        if k == len(gaps):
            insort(gaps, capacity - x)
            n += 1
        else:
            insort(gaps, gaps.pop(k) - x)
    return n


def placed(counts, capacity):
    """Every piece's (bin, offset, length) by the segments."""
    segments, bins = best_fit.plan(counts, capacity)
    places = best_fit.Places(segments)
    rows = []
    for length, n in counts.items():
        b, o = places.of(np.full(n, length), np.arange(n))
        rows += zip(b.tolist(), o.tolist(), [length] * n)
    return rows, bins


@pytest.mark.parametrize("seed", range(40))
def test_segments_equal_packing_one_by_one(seed):
    rng = random.Random(seed)
    capacity = rng.choice([1, 2, 3, 7, 12, 30, 100, 4096])
    lengths = [min(capacity, max(1, int(rng.choice([rng.expovariate(4 / capacity), rng.uniform(1, capacity), rng.choice([capacity, capacity // 2, capacity // 3 + 1, 1])])))) for _ in range(rng.choice([0, 1, 5, 400]))]
    rows, bins = placed(dict(Counter(lengths)), capacity)
    assert bins == bins_one_by_one(lengths, capacity) == len({b for b, _, _ in rows})
    by_bin = {}
    for b, o, n in rows:
        by_bin.setdefault(b, []).append((o, n))
    for pieces in by_bin.values():
        pieces.sort()
        assert [o for o, _ in pieces] == np.cumsum([0, *[n for _, n in pieces]])[:-1].tolist()
        assert sum(n for _, n in pieces) <= capacity
        assert sum(3 * n > capacity for _, n in pieces) <= 2


def test_segments_do_not_grow_with_the_table():
    rng = random.Random(5)
    counts = {n: rng.randint(1, 50) for n in range(1, 4097)}
    few, _ = best_fit.plan(counts, 4096)
    many, bins = best_fit.plan({n: 10**9 * c for n, c in counts.items()}, 4096)
    assert len(many) < 1.1 * len(few) < 100_000
    assert bins >= sum(10**9 * n * c for n, c in counts.items()) / 4096


def test_unit_codes_equal_the_tokenizer():
    with open(tokenizer_path(), encoding="utf-8") as f:
        units = BlankUnitCodes(f.read(), cache_units=50)
    rng = random.Random(1)
    signs = list("ab 's.,!\n\t  é1²_'0 9") + ["Don't", " WE'LL", "\x85", "　", "İ", "Σ", "\x1c", "😀", "ǅ", "́", "\r\n", "<|endoftext|>", "<|STARTOFTEXT|>", "...", "0123456789", "x" * 70]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 14))) for _ in range(3000)]
    for lo in range(0, 3000, 100):
        got = units.encode(texts[lo : lo + 100])
        for t, ids in zip(texts[lo:], got):
            assert np.frombuffer(ids, "<u4").tolist() == units.tokenizer.encode(t, add_special_tokens=False).ids, repr(t)


def check_pieces(rows, texts, capacity):
    """Every id once, in order; only long documents cut; bins gapless."""
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokenizer_path())
    want = Counter((i, tuple(whole.encode(t or "", add_special_tokens=False).ids) + (1,)) for i, t in texts)
    starts = [r for r in rows if r["piece"] == 0]
    assert Counter(r["doc_id"] for r in starts) == Counter(i for i, _ in texts)
    for (doc, ids), n in want.items():
        cuts = [ids[k : k + capacity] for k in range(0, len(ids), capacity)]
        for k, cut in enumerate(cuts):
            raw = np.array(cut, "<u4").tobytes()
            found = [r for r in rows if (r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) == (doc, k, k * capacity, len(cut), zlib.crc32(raw))]
            assert len(found) >= n
            assert all("ids" not in r or bytes(r["ids"]) == raw for r in found)
    by_bin = {}
    for r in rows:
        by_bin.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in by_bin.values():
        pieces.sort()
        assert [o for o, _ in pieces] == np.cumsum([0, *[n for _, n in pieces]])[:-1].tolist()
    assert len(by_bin) == bins_one_by_one([r["length"] for r in rows], capacity)


def test_edge_rows(edge_docs, no_docs):
    rows = [r.asDict() for r in best_fit.pack_documents(edge_docs, tokenizer_path(), seq_tokens=256).collect()]
    check_pieces(rows, EDGE, 256)
    assert best_fit.pack_documents(no_docs, tokenizer_path()).count() == 0
    with pytest.raises(ValueError):
        best_fit.pack_documents(edge_docs, tokenizer_path(), seq_tokens=0)


def test_one_length_holds_a_third_of_the_rows(spark):
    texts = [(k, "the same five words here" if k % 3 else "word " * (k % 90)) for k in range(900)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(7)
    made = best_fit.pack_documents(docs, tokenizer_path(), seq_tokens=128, with_ids=False)
    assert "ids" not in made.columns
    check_pieces([r.asDict() for r in made.collect()], texts, 128)
    plan = made.select(F.max("offset"))._jdf.queryExecution().optimizedPlan().toString()
    assert "Cartesian" not in plan
