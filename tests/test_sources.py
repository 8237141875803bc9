"""Readers, writers, manifest, config normalisation."""

import json

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from wordloom.sources import config as cfg
from wordloom.sources import corpus as src


def test_read_corpus_parquet_and_text(spark, tmp_path):
    df = src.read_corpus(spark, f"{SF001}/documents.parquet")
    assert df.columns == ["doc_id", "text"] and df.count() == 200
    p = tmp_path / "raw.txt"
    p.write_text("one\ntwo\n")
    t = src.read_corpus(spark, str(p), fmt="text")
    assert sorted(r.text for r in t.collect()) == ["one", "two"]


def test_jsonl_write_read_roundtrip(spark, tmp_path):
    rows = [("é <|im_end|>\nx",), ("plain",)]
    df = spark.createDataFrame(rows, "text string")
    path = str(tmp_path / "j")
    src.write_jsonl(df, path)
    back = sorted(r.text for r in src.read_jsonl_strict(spark, path).collect())
    assert back == sorted(r[0] for r in rows)
    raw = "".join(p.read_text(encoding="utf-8") for p in (tmp_path / "j").glob("*.json"))
    assert "é" in raw and "\\n" in raw


def test_jsonl_ascii(spark, tmp_path):
    df = spark.createDataFrame([("é",)], "text string")
    path = str(tmp_path / "a")
    src.write_jsonl_ascii(df, path)
    raw = "".join(p.read_text() for p in (tmp_path / "a").glob("*.json"))
    assert "\\u00E9" in raw or "\\u00e9" in raw
    assert src.read_jsonl(spark, path).first().text == "é"


@pytest.mark.parametrize("bad", ["", "   ", "\t", '{"other": 1}', "{broken", '{"text": null}', "[1]"])
def test_strict_reader_rejects(spark, tmp_path, bad):
    lines = tmp_path / "bad.jsonl"
    lines.write_text('{"text": "a"}\n' + bad + '\n{"text": "b"}\n')
    with pytest.raises(Exception, match=src.STRICT_ERROR):
        src.read_jsonl_strict(spark, str(lines)).collect()
    if not bad.strip():
        assert src.read_jsonl(spark, str(lines)).count() == 2


def test_read_corpus_json_and_null_text(spark, tmp_path):
    (tmp_path / "c.json").write_text('{"doc_id": 7, "text": "a"}\n{"doc_id": 8, "text": null}\n')
    rows = {(r.doc_id, r.text) for r in src.read_corpus(spark, str(tmp_path / "c.json"), fmt="json").collect()}
    assert rows == {(7, "a"), (8, None)}


def test_publish_dataset(spark, tmp_path):
    tr = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    ev = spark.createDataFrame([(3, "c")], "doc_id long, text string")
    man = {r.split: (r.n_rows, r.columns) for r in src.publish_dataset(tr, ev, str(tmp_path / "ds")).collect()}
    assert man == {"train": (2, "doc_id,text"), "eval": (1, "doc_id,text")}


def test_config_normalise(spark):
    rows = [
        (1, json.dumps({"hidden_size": 512, "d_model": 256, "n_layers": 4})),
        (2, "{}"),
        (3, json.dumps({"model": {"d_model": 128, "dropout": 0.2}, "train": {"batch_size": 8}})),
    ]
    df = spark.createDataFrame(rows, "id long, config string")
    out = {r.id: r for r in cfg.normalise_config(df, "config", keep=("id",)).collect()}
    assert out[1].d_model == 512 and out[1].n_layers == 4 and out[1].vocab_size == 4096
    assert out[2].d_model == 384 and out[2].dropout == pytest.approx(0.1)
    assert out[3].d_model == 128 and out[3].dropout == pytest.approx(0.2)
    bad = spark.createDataFrame([(4, '{"d_model": "abc", "n_layers": "5", "dropout": "x"}'), (5, "no json"), (6, None)], "id long, config string")
    wrong = {r.id: (r.d_model, r.n_layers, r.dropout) for r in cfg.normalise_config(bad, "config", keep=("id",)).collect()}
    assert wrong == {4: (384, 5, 0.1), 5: (384, 6, 0.1), 6: (384, 6, 0.1)}
    pub = cfg.to_public_keys(cfg.normalise_config(df, "config", keep=("id",)))
    assert "hidden_size" in pub.columns and "max_position_embeddings" in pub.columns


def test_lines_keep_their_file_order(spark, tmp_path):
    from wordloom.sources.corpus import read_jsonl_in_order

    for k in range(3):
        body = "".join(f'{{"text": "f{k} line {i} {"x" * (i % 40)}"}}\n' for i in range(500))
        (tmp_path / f"part-{k}.json").write_text(body)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for size in ("128m", "4k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        rows = sorted((r.line_no, r.text) for r in read_jsonl_in_order(spark, str(tmp_path)).collect())
        assert [t.rsplit(" ", 1)[0] for _, t in rows] == [f"f{k} line {i}" for k in range(3) for i in range(500)]
        assert [n for n, _ in rows] == list(range(1500))
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)
