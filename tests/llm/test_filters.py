"""URL cascade, licence scan, decontamination and shard table."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from wordloom.llm import decontaminate, license_scan, shard_table, url_cascade

from .conftest import EDGE

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"), ("a.b.c", "", "block")]
URLS = [
    None, "", "no scheme", "http://x.NET/a", "http://net/", "http://net", "https://m.example.net/en/1?x=/de/", "http://example.net/en", "http://notexample.com/de/x",
    "http://w.example.com/de/x#f", "http://EXAMPLE.com/DE/x", "ftp://q.org/fr/", "http://org.fr/", "http://a.b.c", "http://z.a.b.c?q", "http://u@h.net:80/x",
    "a://b://c.net/", "http://..net/", "http:///net/", "x" * 5000 + "://k.net/" + "y" * 5000,
]


def judge(url):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in m.group(1)) if m else ""
    path = m.group(2) if m else ""
    fit = [(len(h + p), len(h), h + p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=(0, 0, None, "allow"))
    return host, path, best[2], best[3]


def rules_df(spark, rules=RULES):
    return spark.createDataFrame(rules, "host string, path string, verdict string")


def test_url_verdicts_equal_brute_force(spark):
    pages = spark.createDataFrame([(k, u, "old") for k, u in enumerate(URLS)], "page_id int, url string, verdict string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_cascade.judge(pages, rules_df(spark)).collect()}
    assert got == {k: judge(u) for k, u in enumerate(URLS)}


def test_url_cascade_is_exact_over_a_large_universe(spark):
    rng = random.Random(1)
    keys = [f"h{k}.net/" for k in range(4000)]
    listed = set(rng.sample(keys, 300))
    uni = url_cascade.hashed(spark.createDataFrame([(k,) for k in keys], "key string"))
    cascade = url_cascade.build_cascade(url_cascade.hashed(spark.createDataFrame([(k,) for k in listed], "key string")), uni)
    rows = uni.collect()
    answer = cascade.listed(np.array([r["h1"] for r in rows]), np.array([r["h2"] for r in rows]))
    assert {r["key"] for r, a in zip(rows, answer) if a} == listed
    assert len(cascade.levels) >= 2  # mistakes of level 1 were there to correct
    assert sum(level.bits for level in cascade.levels) < 64 * 4000


def test_url_no_rules_no_rows_and_contradiction(spark):
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id int, url string")
    assert url_cascade.judge(pages, rules_df(spark).limit(0)).first()["verdict"] == "allow"
    assert url_cascade.judge(pages.limit(0), rules_df(spark)).count() == 0
    with pytest.raises(ValueError, match="both verdicts"):
        url_cascade.judge(pages, rules_df(spark, [("net", "/", "block"), ("net", "/", "allow")]))


LICENCE_DOCS = [
    (1, "a/b/1", "Licensed under the Apache License, Version 2.0."),
    (2, "a/b/2", "some text\nReleased under the MIT License.\nmore text of the kind " + "w " * 50),
    (3, "a/b/c/3", "plain text without any notice"),
    (4, "a/4", "plain text"),
    (5, "a/b/c/d/5", None),
    (6, "a/b/c/d/6", "Released under the MIT License."),
    (7, "z/7", ""),
    (7, "z/7", ""),
    (8, "abc/b/8", "licensed driver wanted for the version two of the work"),
]


def test_licences_and_nearest_ancestor(spark):
    docs = spark.createDataFrame([(*r, "old") for r in LICENCE_DOCS], "doc_id int, p string, text string, licence string")
    got = {r["doc_id"]: (r["licence"], r["via"], r["from_dir"]) for r in license_scan.scan(docs, F.col("p")).collect()}
    assert got == {
        1: ("Apache-2.0", "file", None),
        2: ("MIT", "header", None),
        3: ("Apache-2.0", "inherited", "a/b"),
        4: (None, None, None),
        5: ("MIT", "inherited", "a/b/c/d"),
        6: ("MIT", "file", None),
        7: (None, None, None),
        8: (None, None, None),
    }
    assert license_scan.scan(docs.limit(0), F.col("p")).count() == 0


def test_anchors_beside_underscores_are_found(spark):
    rows = [(1, "a/1", "Released_under_the_MIT_License"), (2, "b/2", "first line\n__Licensed_under_CC_BY_NC_4_0__\n" + "w " * 50), (3, "c/3", "submitted relicensed")]
    got = {r["doc_id"]: r for r in license_scan.scan(spark.createDataFrame(rows, "doc_id int, p string, text string"), F.col("p")).collect()}
    assert (got[1]["licence"], got[1]["cosine"]) == ("MIT", 1.0)
    assert (got[2]["licence"], got[2]["via"], got[2]["cosine"]) == ("CC-BY-NC-4.0", "header", 1.0)
    assert got[3]["licence"] is None


def test_licence_edge_rows(edge_docs):
    got = license_scan.scan(edge_docs, F.col("path"))
    assert got.count() == len(EDGE) and got.where("licence IS NOT NULL").count() == 0


def test_anchors_lose_no_match():
    rng = random.Random(2)
    terms = [f"t{k}" for k in range(12)]
    weights = [(k, t, rng.random()) for k in range(4) for t in rng.sample(terms, 6)]
    found = set(license_scan.anchors(weights, 0.7))
    for k in range(4):
        own = {t: w for j, t, w in weights if j == k}
        rest = {t: w for t, w in own.items() if t not in found}
        whole = sum(w * w for w in own.values()) ** 0.5
        assert sum(w * w for w in rest.values()) ** 0.5 < 0.7 * whole  # the best cosine without an anchor


def hits(text, items):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in (text or ""))
    pat = r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+"
    words, hit, found = re.findall(pat, low), set(), set()
    for item, t in items:
        w = re.findall(pat, "".join(c.lower() if "A" <= c <= "Z" else c for c in (t or "")))
        n = min(13, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            for j in range(len(words) - n + 1):
                if words[j : j + n] == w[i : i + n]:
                    hit.update(range(j, j + n))
                    found.add("" if item is None else str(item))
    return len(words), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(words)


def contamination_case():
    rng = random.Random(4)
    vocab = ["alpha", "beta", "Gamma", "délta", "x1", "42"]
    items = [(k, " ".join(rng.choice(vocab) for _ in range(rng.choice([1, 2, 5, 13, 14, 30])))) for k in range(12)]
    items += [(12, None), (13, ""), (14, "?!"), (5, items[6][1]), (None, "unique phrase here")]
    docs = []
    for k in range(60):
        words = [rng.choice(vocab + ["noise", "other"]) for _ in range(rng.randint(0, 60))]
        if k % 3 == 0:
            at = rng.randint(0, len(words))
            words[at:at] = (items[rng.randrange(12)][1]).upper().split()
        docs.append((k, "-".join(words) if k % 2 else "\n".join(words)))
    return [*docs, (60, None), (61, ""), (62, "Unique PHRASE, here!"), (62, "Unique PHRASE, here!")], items


@pytest.mark.parametrize("block_bytes", [1 << 20, 200])
def test_decontamination_equals_brute_force(spark, block_bytes):
    rows, items = contamination_case()
    docs = spark.createDataFrame([(*r, "c") for r in rows], "doc_id bigint, text string, items string").repartition(3)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = decontaminate.contamination(docs, bench, block_bytes=block_bytes).collect()
    want = sorted((i, *hits(t, items)) for i, t in rows)
    assert sorted((r["doc_id"], r["n_words"], r["n_hit"], list(r["items"]), r["contaminated"]) for r in got) == want
    for r in got:
        assert sum(s["last"] - s["first"] + 1 for s in r["spans"]) == r["n_hit"]
    left = decontaminate.drop_contaminated(docs, bench, block_bytes=block_bytes)
    assert left.columns == docs.columns
    assert sorted(r["doc_id"] for r in left.collect()) == [i for i, *_, bad in want if not bad]


def test_decontamination_empty_tables(edge_docs, no_docs, spark):
    bench = spark.createDataFrame([(1, "one"), (2, "the same words here")], "item_id bigint, text string")
    assert decontaminate.contamination(no_docs, bench).count() == 0
    assert decontaminate.drop_contaminated(edge_docs, bench.limit(0)).count() == len(EDGE)
    assert decontaminate.contamination(edge_docs, bench).where("contaminated").count() == 5


def brute_table(shards, size):
    import xxhash

    perms = []
    for s in shards:
        a, b = xxhash.xxh64_intdigest(s.encode(), 1) % size, xxhash.xxh64_intdigest(s.encode(), 2) % (size - 1) + 1
        perms.append([(a + j * b) % size for j in range(size)])
    table = [None] * size
    while None in table:
        for k, p in enumerate(perms):
            if None in table:
                table[next(x for x in p if table[x] is None)] = k
    return table


def test_shard_table_equals_brute_force_and_moves_little():
    names = [f"s{k}" for k in range(7)]
    assert shard_table.fill_table(names, 251).tolist() == brute_table(names, 251)
    full = shard_table.fill_table(names, 65_537)
    counts = np.bincount(full)
    assert counts.max() - counts.min() <= 1
    fewer = shard_table.fill_table(names[:-1], 65_537)
    kept = full != 6
    assert (full[kept] == fewer[kept]).mean() > 0.85
    assert np.bincount(shard_table.fill_table(["a", "b"], 101, [1, 3])).tolist() == [26, 75]
    for bad in ([], ["a", "a"]):
        with pytest.raises(ValueError):
            shard_table.fill_table(bad, 101)
    with pytest.raises(ValueError):
        shard_table.fill_table(["a"], 100)


def test_placement_edge_rows(edge_docs, no_docs, tmp_path):
    names = ["a", "b", "c"]
    got = shard_table.place(edge_docs, "doc_id", names, 101)
    owner = shard_table.fill_table(names, 101)
    rows = got.collect()
    assert len(rows) == len(EDGE) and set(edge_docs.columns) <= set(got.columns)
    assert all(r["shard_no"] == owner[r["slot"]] and names[r["shard_no"]] == r["shard"] for r in rows)
    assert shard_table.place(no_docs, "doc_id", names, 101).count() == 0
    shard_table.write_shards(got, str(tmp_path / "out"))
    back = edge_docs.sparkSession.read.parquet(str(tmp_path / "out"))
    assert back.count() == len(EDGE)
