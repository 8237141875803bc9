"""Exact dedup, SimHash groups and connected components against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from wordloom.llm import chunk_recipes, simhash_mih
from wordloom.llm.components import connected_components

from .conftest import EDGE


def norm(t):
    return re.sub(r"[\x20\x09-\x0d]+", " ", t or "")


def groups_of(rows):
    by = {}
    for i, t in rows:
        by.setdefault(norm(t), []).append(i)
    return by


def test_exact_dedup_edge_rows(edge_docs):
    got = chunk_recipes.exact_dedup(edge_docs).collect()
    by = groups_of(EDGE)
    assert len(got) == len(EDGE)
    for r in got:
        group = next(g for g in by.values() if r["doc_id"] in g)
        assert r["group_size"] == len(group)
        assert r["keep_id"] == min(i for i in group if i is not None)
    assert sum(r["kept"] for r in got) == len(by)


def test_exact_dedup_stage_keeps_one_row_and_all_columns(edge_docs, no_docs):
    left = chunk_recipes.drop_copies(edge_docs)
    assert left.columns == edge_docs.columns and left.schema == edge_docs.schema
    assert sorted(norm(r["text"]) for r in left.collect()) == sorted(groups_of(EDGE))
    assert chunk_recipes.drop_copies(no_docs).count() == 0


def test_hash_collisions_do_not_merge_texts(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["aa", "bb", "en an", "cc dd"]) for _ in range(400)) for _ in range(20)] * 2
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    weak = chunk_recipes.exact_dedup(docs, hash_fn=lambda c: (F.length(c) % 2).cast("long"))
    assert {r["doc_id"]: r["keep_id"] for r in weak.collect()} == {i: i % 20 for i in range(40)}


def test_chunks_concatenate_to_the_text(spark):
    rng = random.Random(5)
    texts = ["", "a", "é" * 9000, *("".join(rng.choice("aeinrst  bcdg😀") for _ in range(6000)) for _ in range(5))]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", chunk_recipes.chunks(F.col("t")).alias("c")).collect():
        assert "".join(r["c"]) == r["t"]
        assert all(len(c) <= chunk_recipes.MAX_CHUNK + 1 for c in r["c"])


def test_an_edit_changes_few_chunks(spark):
    rng = random.Random(9)
    words = ["".join(rng.choice("aeinrstbcd") for _ in range(rng.randint(2, 8))) for _ in range(4000)]
    a, b = " ".join(words), " ".join(["new"] + words)
    df = spark.createDataFrame([(0, a), (1, b)], "i int, t string")
    one, two = (set(r["c"]) for r in df.orderBy("i").select(chunk_recipes.chunks(F.col("t")).alias("c")).collect())
    assert len(one - two) <= 0.3 * len(one)


def fingerprint(t, k=4):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in (t or ""))
    w = [x for x in re.split(r"[\x20\x09-\x0d]+", low) if x]
    if not w:
        return 0
    sh = [" ".join(w[i : i + k]) for i in range(len(w) - k + 1)] or [" ".join(w)]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def components(ids, fps, bits):
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= bits:
                root[find(i)] = find(j)
    out = {}
    for i in range(len(ids)):
        out.setdefault(find(i), []).append(i)
    return {i: min((ids[j] for j in g if ids[j] is not None), default=None) for g in out.values() for i in g}


def test_simhash_edge_rows(edge_docs, no_docs):
    fps = [fingerprint(t) for _, t in EDGE]
    want = components([i for i, _ in EDGE], fps, 4)
    got = simhash_mih.near_duplicates(edge_docs).select("doc_id", simhash_mih.hex64(F.col("fingerprint")).alias("f"), "component_id").collect()
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(str((i, f"{f:016x}", want[k])) for k, ((i, _), f) in enumerate(zip(EDGE, fps)))
    left = simhash_mih.drop_near_copies(edge_docs)
    assert left.columns == edge_docs.columns and left.count() == len({want[k] for k in want})
    assert simhash_mih.drop_near_copies(no_docs).count() == 0


@pytest.mark.parametrize(("bits", "segments"), [(4, 3), (4, 4), (3, 2), (2, 5), (0, 1)])
def test_links_equal_brute_force(spark, bits, segments):
    rng = random.Random(bits)
    base = [rng.getrandbits(64) for _ in range(30)]
    fps = {b ^ sum(1 << k for k in rng.sample(range(64), rng.randint(0, 5))) for b in base for _ in range(12)}
    signed = sorted(f - (1 << 64) if f >> 63 else f for f in fps)
    got = simhash_mih.links_within(spark.createDataFrame([(f,) for f in signed], "fp bigint"), bits, segments)
    want = {(a, b) for a in signed for b in signed if a < b and int(np.bitwise_count(np.uint64((a ^ b) & (2**64 - 1)))) <= bits}
    assert {tuple(r) for r in got.collect()} == want


def test_block_boundaries_do_not_change_fingerprints(monkeypatch):
    text = ("some words of a text " * 40).encode()
    whole = simhash_mih.fingerprint_bytes(text, 4)
    monkeypatch.setattr(simhash_mih, "BLOCK", 7)
    assert simhash_mih.fingerprint_bytes(text, 4) == whole


def test_components_of_chains_and_hubs(spark):
    chain = [(i, i + 1) for i in range(60)]
    hub = [(1000, 1000 + i) for i in range(1, 200)]
    got = connected_components(spark.createDataFrame(chain + hub + [(5000, 5000)], "a bigint, b bigint")).collect()
    roots = {}
    for r in got:
        roots.setdefault(r["root"], set()).add(r["node"])
    assert sorted(map(len, roots.values())) == [1, 61, 200]
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_kept_rows_with_clashing_names_and_a_defined_survivor(spark):
    schema = "doc_id bigint, text string, kept_id int, `kept_sha` string, __id string, __sha string, row int, m map<string,int>"
    rows = [(1, "a b", 5, "z", "p", "q", 3, {"k": 1}), (1, "a b", 4, "y", "p", "q", 3, {"k": 2}), (2, "a  b", 1, "x", "p", "q", 3, None), (3, "c", None, None, None, None, None, None)]
    docs = spark.createDataFrame(rows, schema)
    for cols in (docs.columns, docs.columns[:-1]):
        some = docs.select(cols)
        for n in (1, 4):
            got = chunk_recipes.drop_copies(some.repartition(n))
            assert got.columns == cols
            assert sorted((r.doc_id, r.kept_id) for r in got.collect()) == [(1, 4), (3, None)]
            near = simhash_mih.drop_near_copies(some.repartition(n), shingle=4, max_bits=4)
            assert sorted(r.doc_id for r in near.collect()) == [1, 3] and near.columns == cols


def test_id_columns_with_dots(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "a b"), (3, "c")], "`a.b` bigint, text string")
    assert sorted(r[0] for r in chunk_recipes.drop_copies(docs, id_col="a.b").collect()) == [1, 3]
