"""The pipeline: planted cases go, clean documents stay, stages keep columns."""

import random

import pytest

import corpus_pipeline as cp
from wordloom.llm import queries


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    rng = random.Random(8)
    vocab = ["".join(rng.choice("aeiourstlnmdp") for _ in range(rng.randint(2, 9))) for _ in range(900)]

    def words(n):
        return [rng.choice(vocab) for _ in range(n)]

    bench = [(k, " ".join(words(30))) for k in range(5)]
    docs, labels, bad = [], [], {}
    for k in range(400):
        w = words(rng.randint(60, 200))
        toxic = k % 4 == 0
        if toxic:
            for _ in range(4):
                w.insert(rng.randrange(len(w)), rng.choice(["vilest", "grotty"]))
            bad[k] = "toxic"
        docs.append((k, " ".join(w)))
        labels.append((k, 1, int(toxic)))
    for k in range(5):
        docs.append((1000 + k, docs[4 * k + 1][1].replace(" ", "\n")))
        bad[1000 + k] = "exact copy"
        near = docs[4 * k + 2][1].split()
        docs.append((1010 + k, " ".join([*near[:-1], "changedword"])))
        docs.append((1020 + k, " ".join(words(60)) + " " + bench[k][1].upper() + " " + " ".join(words(60))))
        bad[1020 + k] = "contaminated"
    docs += [(1030, None), (1031, ""), (1031, "")]
    folder = tmp_path_factory.mktemp("tables")
    rows = [(i, t, "en", "s", 0 if t is None else len(t), "x") for i, t in docs]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(bench, "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), dict(docs), bad


def test_stages_remove_what_is_planted(spark, planted):
    folder, texts, bad = planted
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    schema = docs.schema
    for name, stage in cp.STAGES[:-1]:
        docs = cp.materialise(stage(spark, docs, folder), name)
        assert docs.schema == schema, name
    left = [r["doc_id"] for r in docs.select("doc_id").collect()]
    assert len(left) == len(set(left))
    assert not [k for k in bad if k in left and bad[k] != "toxic"]
    assert sum(k in left for k in bad if bad[k] == "toxic") <= 2
    clean = [k for k in range(400) if k % 4 and k not in left]
    assert len(clean) <= 2, clean
    assert (1030 in left) + (1031 in left) == 1  # null and empty text are equal
    pieces = cp.run(spark, folder)
    assert pieces.select("doc_id").distinct().count() == len(left)


def test_run_on_empty_documents(spark, planted, tmp_path):
    folder, _, _ = planted
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert cp.run(spark, str(tmp_path)).count() == 0


def test_every_operator_is_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert {n.split("_")[0] for n in queries.Q} == {f"op{k}" for k in range(1, 14)}
    assert set(queries.Q) | {"pipeline"} <= set(names)
    assert set(queries.SQL) <= set(queries.Q)
    assert [n for n, _ in cp.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "decontamination", "packing"]
