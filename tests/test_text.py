"""Scalar text functions against Python's own string semantics."""

from pyspark.sql import functions as F

from wordloom.functions import text as TX


def py_clean(s):
    """The expected text, from the character class alone."""
    words, word = [], ""
    for c in s or "":
        if c.isspace():
            words, word = ([*words, word] if word else words), ""
        else:
            word += c
    return " ".join([*words, word] if word else words)


def test_clean_text_matches_python_whitespace(spark):
    rows = [(c, "a" + chr(c) + "b") for c in list(range(1, 0x2100)) + list(range(0x2100, 0x3100, 7)) if not 0xD800 <= c <= 0xDFFF]
    df = spark.createDataFrame(rows, "c int, s string")
    got = {r.c: r.t for r in df.select("c", TX.clean_text("s").alias("t")).collect()}
    bad = [c for c, s in rows if got[c] != py_clean(s)]
    assert bad == []


def test_clean_text_edges(spark):
    rows = [(None,), ("",), ("   ",), ("　",), (" x\t\n y  ",), ("a\u0085b",)]
    df = spark.createDataFrame(rows, "s string")
    got = [r.t for r in df.select(TX.clean_text("s").alias("t")).collect()]
    assert got == ["", "", "", "", "x y", "a b"]


def test_wrap_sample_has_no_newline_before_end(spark):
    df = spark.createDataFrame([("  two  words ",)], "s string")
    assert df.select(TX.wrap_sample("s")).first()[0] == "<|im_start|>assistant\ntwo words<|im_end|>"


def test_truncate_reply_and_default(spark):
    rows = [("x<|im_end|>y",), ("<|im_start|><|im_end|>",), ("  hi <|im_start|>user",), ("plain　",)]
    df = spark.createDataFrame(rows, "s string")
    got = df.select(TX.truncate_reply("s").alias("r"), TX.reply_or_default("s").alias("d")).collect()
    assert [r.r for r in got] == ["x", "", "hi", "plain"]
    assert [r.d for r in got] == ["x", "toki.", "hi", "plain"]


def test_usable_prompt(spark):
    rows = [("quit",), (" EXIT ",), ("q",), ("",), ("toki",), ("Quitting",)]
    df = spark.createDataFrame(rows, "s string")
    keep = [r.s for r in df.filter(TX.is_usable_prompt("s")).collect()]
    assert keep == ["toki", "Quitting"]
    keep_blank = [r.s for r in df.filter(TX.is_usable_prompt("s", skip_blank=False)).collect()]
    assert keep_blank == ["", "toki", "Quitting"]


def test_two_role_prompt(spark):
    df = spark.createDataFrame([(" toki ",)], "s string")
    assert df.select(TX.two_role_prompt("s")).first()[0] == "<|im_start|>user\ntoki<|im_end|>\n<|im_start|>assistant\n"
