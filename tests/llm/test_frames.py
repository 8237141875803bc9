"""Fill-in-middle from frames against slicing the text."""

import hashlib
import random
import re

import pytest
import zstandard

from wordloom.llm import frames

from .conftest import EDGE

SIGNS = ["\n", "\r\n", "a", "line one\n", "é", "😀", "zwölf ", "\n\n", "日本", "<P", ">", " "]


def by_slicing(doc, text, fim=100, spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    x = hashlib.sha256(f"7:{'' if doc is None else doc}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(x[k : k + 8], 16) for k in range(0, 32, 8))
    if not text or any(m in text for m in frames.MARKERS) or h3 % 100 >= fim:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < spm:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


@pytest.mark.parametrize("size", [1, 2, 3, 7, 64, 1 << 16])
def test_frames_equal_slicing(size):
    rng = random.Random(size)
    codec = frames.Codec()
    for doc in range(300):
        text = "".join(rng.choice(SIGNS) for _ in range(rng.choice([0, 1, 2, 9, 80])))
        s = codec.stored(text.encode(), size)
        marked = any(m in text for m in frames.MARKERS)
        form, prefix, middle, output = frames.arrange(s, marked, frames.draws(doc, 7), frames.MARKERS, 100, 50, codec)
        got = frames.text_of(output).decode()
        assert (s.n, form, prefix, middle, got) == by_slicing(doc, text)
        assert b"".join(frames.restore(output, form)).decode() == text
        assert zstandard.ZstdDecompressor().stream_reader(b"".join(output), read_across_frames=True).read().decode() == got


def test_only_cut_frames_are_decompressed():
    text = "".join(f"line {k}\n" for k in range(20_000)).encode()
    codec = frames.Codec()
    s = codec.stored(text, 4096)
    seen = set()
    read = codec.read

    def counted(frame):
        seen.add(id(frame))
        return read(frame)

    codec.read = counted
    frames.arrange(s, False, [5_000, 15_000, 0, 0], frames.MARKERS, 100, 50, codec)
    assert len(s.frames) > 40 and len(seen) == 2


def test_a_marker_across_frames_is_found():
    codec = frames.Codec()
    out = [codec.write(x.encode()) for x in ["<", "P>ab\n<", "S>", "cd<", "M", ">e\n"]]
    assert b"".join(frames.restore(out, "psm")) == b"ab\ne\ncd"
    with pytest.raises(ValueError):
        list(frames.restore(out[:3], "psm"))


def test_edge_rows(edge_docs, no_docs, spark):
    rows = frames.digests(frames.fill_in_middle(frames.store(edge_docs, frame_bytes=1000))).collect()
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = []
    for doc, text in EDGE:
        n, form, prefix, middle, output = by_slicing(doc, text)
        want.append((doc, n, form, prefix, middle, sha(output), sha(text or "")))
    key = lambda r: (str(r[0]), r[5])
    assert sorted([tuple(r) for r in rows], key=key) == sorted(want, key=key)
    assert frames.digests(frames.fill_in_middle(frames.store(no_docs))).count() == 0
    marked = spark.createDataFrame([(1, "a\nb<S>c\n"), (2, "<M>")], "doc_id bigint, text string")
    assert {r["form"] for r in frames.fill_in_middle(frames.store(marked)).collect()} == {"plain"}
    with pytest.raises(ValueError):
        frames.store(marked, frame_bytes=0)


def test_rates_choose_the_forms(spark):
    docs = spark.createDataFrame([(k, f"a{k}\nb\nc\nd") for k in range(2000)], "doc_id bigint, text string")
    rows = frames.fill_in_middle(frames.store(docs), fim_percent=60, spm_percent=25).collect()
    for r in rows:
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], frames.text_of(r["output"]).decode()) == by_slicing(r["doc_id"], f"a{r['doc_id']}\nb\nc\nd", 60, 25)
    shares = {f: sum(r["form"] == f for r in rows) / 2000 for f in ("plain", "psm", "spm")}
    assert abs(shares["plain"] - 0.4) < 0.05 and abs(shares["spm"] - 0.15) < 0.05
