"""Main text of web pages by a recurrent block labeller.

A page is read into its leaf sequence: runs of text between block-level tags,
each with its tag path (open tags and the tokens of their class, id and role),
its words and how much of it is link text.  Paths and words are hashed into
small embedding tables; a bidirectional LSTM (numpy, trained here) reads the
whole sequence, so each block's label depends on the whole page, and blocks
labelled main text are joined in page order.

Training.  There are no labels in the table, so training pages are made: texts
of a bounded sample of pages (``TRAIN_PAGES``, smallest id hash) are re-dressed at
random in common page layouts (semantic or class-named containers, menus,
sidebars, notices, adverts, forms, comments, inside and outside the article),
where the layout gives every block's label.  Path tokens are dropped at random
so that context counts.  Sample size and epochs are constants, so training
costs the same at any corpus size; the weights are broadcast (about 50 kB).

Defined results: null and empty html give an empty text; a page without text
blocks or without a block labelled main gives an empty text; unclosed and
misnested tags and quotes are read on to the end, never dropped (text after an
unclosed comment, script, style, title, textarea or iframe belongs to that);
repeated rows are extracted each; very long pages are labelled whole.  Reading
is linear in the page's length, however its tags are nested or broken: paths of
more than ``LONG_PATH`` tokens are kept as counts per slot (same sum).
"""

from __future__ import annotations

import random
import re
import zlib
from functools import lru_cache
from html import unescape

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import text_or_empty

TRAIN_PAGES = 300
EPOCHS = 16
PATH_SLOTS, WORD_SLOTS = 512, 512
PATH_DIM, WORD_DIM, EXTRA, HIDDEN = 16, 8, 4, 16
DECAY = 0.01  # weight decay, tenfold for words
CELLS = 100_000  # blocks (padding included) labelled in one go
ENTRIES = 1_000_000  # path or word slots summed in one go

# ---- leaf sequence ---------------------------------------------------------

# fixed values of HTML: elements without a closing tag, elements inside a line
# of text, elements whose content is not text of the page
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var".split()
)
# a tag ends at the first ">" outside quotes, or, where its quotes do not
# match, at the first ">"; no part gives back what it has read
TAG = re.compile(
    r"<!--.*?(?:(-->)|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>"
    r"|<[!?][^>]*+>",
    re.DOTALL,
)
# elements whose content is no markup; without an end tag they go on to the end
RAW = {"script", "style", "title", "textarea", "iframe"}
# elements that are left out with their content when they are closed
SKIPPED = {"noscript", "template", "svg", "object", "select"}
END = {t: re.compile(rf"</{t}(?=[\s/>])", re.IGNORECASE) for t in RAW | SKIPPED}
LONG_PATH = 256  # from so many tokens on, a path is kept as counts
NAMED = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)


def slot(token: str, slots: int) -> int:
    return zlib.crc32(token.encode()) % slots


@lru_cache(maxsize=50_000)
def path_tokens(tag: str, attributes: str) -> tuple[int, ...]:
    """Slots of a tag and of the parts of its class, id and role."""
    found = ["<" + tag]
    for m in NAMED.finditer(attributes):
        value = next(v for v in m.groups() if v is not None)
        value = re.sub(r"([a-z])([A-Z])", r"\1 \2", value)
        found += [w.rstrip("s") or w for w in re.findall(r"[a-z]+", value.lower())]
    return tuple(slot(t, PATH_SLOTS) for t in dict.fromkeys(found))


class LongPath:
    """A long path as distinct slots and their counts."""

    def __init__(self, counts: dict[int, int]):
        self.slots = np.fromiter(counts.keys(), np.int32, len(counts))
        self.counts = np.fromiter(counts.values(), np.int32, len(counts))

    def __len__(self) -> int:
        return int(self.counts.sum())


class OpenTags:
    """Open elements of a page.  Every step costs what it adds or takes away,
    however deep the page is nested."""

    def __init__(self):
        self.items: list[tuple[str, bool, tuple[int, ...]]] = []  # tag, inline, slots
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []  # places of elements that are not inline
        self.counts: dict[int, int] = {}
        self.tokens = 0

    def push(self, tag: str, inline: bool, slots: tuple[int, ...]) -> None:
        self.places.setdefault(tag, []).append(len(self.items))
        if not inline:
            self.blocks.append(len(self.items))
        self.items.append((tag, inline, slots))
        self.tokens += len(slots)
        for s in slots:
            self.counts[s] = self.counts.get(s, 0) + 1

    def cut(self, k: int) -> None:
        """Close the elements from place ``k`` on."""
        while len(self.items) > k:
            tag, inline, slots = self.items.pop()
            self.places[tag].pop()
            if not inline:
                self.blocks.pop()
            self.tokens -= len(slots)
            for s in slots:
                self.counts[s] -= 1
                if not self.counts[s]:
                    del self.counts[s]

    def close(self, tag: str, inline: bool) -> None:
        """Close the last such element; an inline one not across a block."""
        at = self.places.get(tag)
        if at and not (inline and self.blocks and self.blocks[-1] > at[-1]):
            self.cut(at[-1])

    def path(self) -> list[int] | LongPath:
        if self.tokens <= LONG_PATH:
            return [s for _, _, slots in self.items for s in slots]
        return LongPath(self.counts)


def leaf_blocks(html: str) -> list[tuple[str, list[int] | LongPath, float]]:
    """``(text, path slots, share of link text)`` of each leaf block."""
    out: list[tuple[str, list[int] | LongPath, float]] = []
    tags = OpenTags()
    parts: list[str] = []
    linked = 0

    def flush():
        nonlocal linked
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            if text:
                out.append((text, tags.path(), min(1.0, linked / len(text))))
            parts.clear()
            linked = 0

    def text(piece: str):
        nonlocal linked
        parts.append(piece)
        if tags.places.get("a"):
            linked += len(piece)

    def after_end(tag: str, at: int) -> int:
        """Place after the end tag of ``tag``, or -1."""
        end = END[tag].search(html, at)
        return html.find(">", end.end()) + 1 or -1 if end else -1

    at = 0
    last = html.rfind(">") + 1  # no tag ends beyond, so none is looked for there
    unclosed: set[str] = set()
    while m := TAG.search(html, at, last):
        if m.start() > at:
            text(html[at : m.start()])
        at = m.end()
        tag = m.group(3) or m.group(6)
        if tag is None:
            if m.group().startswith("<!--") and not m.group(1):
                at = len(html)
            continue
        tag = tag.lower()
        closing, attributes = m.group(2) or m.group(5), m.group(4) or m.group(7) or ""
        if tag in RAW and not closing:
            end = after_end(tag, at)
            at = end if end > 0 else len(html)
            continue
        if tag in SKIPPED and not closing:
            if tag in unclosed or tag == "svg" and attributes.endswith("/"):
                continue
            end = after_end(tag, at)
            if end > 0:
                at = end
            else:  # nor has a later one an end
                unclosed.add(tag)
            continue
        inline = tag in INLINE
        if closing:
            if not inline:
                flush()
            tags.close(tag, inline)
        elif tag == "br":
            parts.append("\n")
        elif tag in VOID:
            if tag == "hr":
                flush()
        else:
            if not inline:
                flush()
                if tags.blocks:
                    above = tags.items[tags.blocks[-1]][0]
                    if above == "p" or above == tag in ("li", "dt", "dd", "td", "th", "tr", "option"):
                        tags.cut(tags.blocks[-1])  # its end tag may be left out
            tags.push(tag, inline, path_tokens(tag, attributes))
    comment = html.find("<!--", max(at, last))
    rest = html[at:comment] if comment >= 0 else html[at:]
    if rest:
        text(rest)
    flush()
    return out


# ---- network ---------------------------------------------------------------


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def scale(sizes: np.ndarray) -> np.ndarray:
    """Factor of a sum of ``sizes`` embeddings: long blocks weigh no more than
    blocks of 16 words."""
    return np.minimum(sizes**-0.5, 4.0 / sizes).astype(np.float32)[:, None]


class Labeller:
    """Embeddings, bidirectional LSTM and a logistic output, with training."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        d, h = PATH_DIM + WORD_DIM + EXTRA, HIDDEN

        def normal(*shape, scale):
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        self.p = {
            "path": normal(PATH_SLOTS, PATH_DIM, scale=0.3),
            "word": normal(WORD_SLOTS, WORD_DIM, scale=0.1),
            "out": normal(2 * h, scale=0.3),
            "bias": np.zeros(1, np.float32),
        }
        for side in "fb":
            self.p["w" + side] = normal(d, 4 * h, scale=d**-0.5)
            self.p["u" + side] = normal(h, 4 * h, scale=h**-0.5)
            b = np.zeros(4 * h, np.float32)
            b[h : 2 * h] = 1  # forget gates start open
            self.p["b" + side] = b

    def embed(self, page_blocks: list) -> np.ndarray:
        """Input vectors of a flat list of blocks."""
        n = len(page_blocks)
        x = np.zeros((n, PATH_DIM + WORD_DIM + EXTRA), np.float32)
        for name, slots, lo, dim in (("path", [b[1] for b in page_blocks], 0, PATH_DIM), ("word", [b[3] for b in page_blocks], PATH_DIM, WORD_DIM)):
            sizes = np.array([len(s) for s in slots])
            entries = np.array([len(s.slots) if isinstance(s, LongPath) else len(s) for s in slots])
            some = np.flatnonzero(sizes)
            ends = np.cumsum(entries[some])
            while len(some):  # so many entries at a time that memory stays bounded
                k = max(1, int(np.searchsorted(ends, ends[0] - entries[some[0]] + ENTRIES, "right")))
                part = some[:k]
                many = [slots[i] for i in part]
                vectors = self.p[name][np.concatenate([s.slots if isinstance(s, LongPath) else np.asarray(s, np.int32) for s in many])]
                if any(isinstance(s, LongPath) for s in many):
                    counts = np.concatenate([s.counts if isinstance(s, LongPath) else np.ones(len(s), np.int32) for s in many])
                    vectors = vectors * counts[:, None].astype(np.float32)
                starts = np.cumsum(entries[part]) - entries[part]
                x[part, lo : lo + dim] = np.add.reduceat(vectors, starts, axis=0) * scale(sizes[part])
                some, ends = some[k:], ends[k:]
        chars = np.array([min(len(b[0]), 2000) for b in page_blocks])
        x[:, -4] = np.log1p(chars) / 4
        x[:, -3] = [b[2] for b in page_blocks]
        x[:, -2] = np.minimum(chars, 120) / 120
        x[:, -1] = [b[0][-1] in ".!?…。" for b in page_blocks]
        return x

    def lstm(self, x: np.ndarray, mask: np.ndarray, side: str, keep: list | None = None) -> np.ndarray:
        """States [pages, blocks, HIDDEN] of one direction."""
        n, t, _ = x.shape
        h = c = np.zeros((n, HIDDEN), np.float32)
        out = np.zeros((n, t, HIDDEN), np.float32)
        xw = x @ self.p["w" + side] + self.p["b" + side]
        u = self.p["u" + side]
        for k in range(t) if side == "f" else range(t - 1, -1, -1):
            z = xw[:, k] + h @ u
            gates = sigmoid(z[:, : 3 * HIDDEN])
            i, f, o = np.split(gates, 3, axis=1)
            g = np.tanh(z[:, 3 * HIDDEN :])
            c_new = (f * c + i * g) * mask[:, k : k + 1]
            tc = np.tanh(c_new)
            h_new = o * tc * mask[:, k : k + 1]
            if keep is not None:
                keep.append((k, i, f, o, g, c, tc, h))
            h, c = h_new, c_new
            out[:, k] = h
        return out

    def back(self, x, mask, side, keep, dout, grads) -> np.ndarray:
        """Gradients through one direction; returns the input's."""
        u, w = self.p["u" + side], self.p["w" + side]
        dx = np.zeros_like(x)
        dh = dc = np.zeros((x.shape[0], HIDDEN), np.float32)
        for k, i, f, o, g, c_before, tc, h_before in reversed(keep):
            m = mask[:, k : k + 1]
            dh = (dh + dout[:, k]) * m
            dc = (dc + dh * o * (1 - tc**2)) * m
            dz = np.concatenate([dc * g * i * (1 - i), dc * c_before * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g**2)], axis=1)
            grads["w" + side] += x[:, k].T @ dz
            grads["u" + side] += h_before.T @ dz
            grads["b" + side] += dz.sum(axis=0)
            dx[:, k] = dz @ w.T
            dh, dc = dz @ u.T, dc * f
        return dx

    def padded(self, pages: list[list]) -> tuple[np.ndarray, np.ndarray]:
        t = max(len(p) for p in pages)
        x = np.zeros((len(pages), t, PATH_DIM + WORD_DIM + EXTRA), np.float32)
        mask = np.zeros((len(pages), t), np.float32)
        for k, p in enumerate(pages):
            mask[k, : len(p)] = 1
        x[mask > 0] = self.embed([b for p in pages for b in p])
        return x, mask

    def scores(self, pages: list[list]) -> list[np.ndarray]:
        """Logit of every block of non-empty pages."""
        x, mask = self.padded(pages)
        states = np.concatenate([self.lstm(x, mask, "f"), self.lstm(x, mask, "b")], axis=2)
        logits = states @ self.p["out"] + self.p["bias"]
        return [logits[k, : len(p)] for k, p in enumerate(pages)]

    def gradients(self, pages: list[list], labels: list[np.ndarray]) -> tuple[float, dict]:
        x, mask = self.padded(pages)
        keep: dict[str, list] = {"f": [], "b": []}
        states = np.concatenate([self.lstm(x, mask, s, keep[s]) for s in "fb"], axis=2)
        y = np.zeros_like(mask)
        y[mask > 0] = np.concatenate(labels)
        p = sigmoid(states @ self.p["out"] + self.p["bias"])
        n = mask.sum()
        loss = float(-(mask * (y * np.log(p + 1e-7) + (1 - y) * np.log(1 - p + 1e-7))).sum() / n)
        grads = {k: np.zeros_like(v) for k, v in self.p.items()}
        dz = (mask * (p - y) / n).astype(np.float32)
        grads["out"] = np.einsum("nt,nth->h", dz, states)
        grads["bias"] = dz.sum(keepdims=True).reshape(1)
        dstates = dz[:, :, None] * self.p["out"]
        dx = self.back(x, mask, "f", keep["f"], dstates[:, :, :HIDDEN], grads)
        dx += self.back(x, mask, "b", keep["b"], dstates[:, :, HIDDEN:], grads)
        flat, blocks = dx[mask > 0], [b for page in pages for b in page]
        for name, slots, lo, dim in (("path", [b[1] for b in blocks], 0, PATH_DIM), ("word", [b[3] for b in blocks], PATH_DIM, WORD_DIM)):
            sizes = np.array([len(s) for s in slots])
            rows = np.repeat(flat[:, lo : lo + dim] * scale(np.maximum(sizes, 1)), sizes, axis=0)
            if len(rows):
                np.add.at(grads[name], np.concatenate([np.asarray(s, np.int32) for s in slots if len(s)]), rows)
        return loss, grads

    def train(self, pages: list[list], labels: list[np.ndarray], epochs: int, rate: float = 0.01, batch: int = 16, seed: int = 11) -> float:
        """Adam; returns the last epoch's mean loss."""
        rng = random.Random(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        step, mean = 0, 0.0
        order = list(range(len(pages)))
        for _ in range(epochs):
            rng.shuffle(order)
            losses = []
            for lo in range(0, len(order), batch):
                some = order[lo : lo + batch]
                # path tokens are dropped now and then, words of half the blocks, so
                # that neither is learned by heart
                dropped = [[(b[0], [s for s in b[1] if rng.random() > 0.05], b[2], b[3] if rng.random() > 0.5 else []) for b in pages[k]] for k in some]
                loss, grads = self.gradients(dropped, [labels[k] for k in some])
                losses.append(loss)
                step += 1
                for k, g in grads.items():
                    g = np.clip(g, -1, 1)
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.99 * v[k] + 0.01 * g * g
                    self.p[k] *= 1 - rate * DECAY * (10 if k == "word" else 1)
                    self.p[k] -= (rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
            mean = float(np.mean(losses))
        return mean


def with_words(blocks: list) -> list:
    return [(t, p, q, [zlib.crc32(w.encode()) % WORD_SLOTS for w in t.lower().split()]) for t, p, q in blocks]


# ---- training pages --------------------------------------------------------

# fixed values: usual names of containers on web pages
MAIN = ["article", "main", "div class=content", "div class=post-body", "div id=content", "section class=story", "div class=entry-content",
        "div class=article-text", "main role=main", "div role=main", "td class=content"]
MENU = ["nav", "ul class=menu", "nav class=navbar", "div class=navigation", "div id=nav", "ul class=breadcrumb", "div class=toc", "div role=navigation"]
ASIDE = ["aside", "div class=sidebar", "div id=sidebar", "div class=widget", "section class=related", "div class=related-posts", "div class=recommended",
         "div class=popular", "aside class=promo"]
ADVERT = ["div class=ad", "div class=ads", "div class=advert", "div class=advertisement", "section class=sponsored", "div class=banner", "div class=promo"]
NOTICE = ["div class=cookie", "div id=cookie-notice", "div class=notice", "div class=consent", "div class=alert", "div class=popup", "div class=paywall",
          "div role=alert", "div class=gdpr-banner"]
COMMENT = ["div class=comments", "section id=comments", "ol class=comment-list", "div class=comment", "div class=replies", "section class=discussion",
           "div id=disqus_thread", "div class=user-comments", "section class=reviews"]
FORM = ["form", "form class=search", "form id=newsletter", "div class=subscribe", "form class=login", "div class=signup", "form class=comment-form"]
TOP = ["header", "div class=header", "div id=masthead", "header class=site-header", "div class=topbar", "div role=banner"]
BOTTOM = ["footer", "div class=footer", "div id=footer", "footer class=site-footer", "div class=copyright", "div role=contentinfo"]
SHARE = ["div class=share", "ul class=social", "div class=tags", "div class=author-bio", "div class=byline", "div class=meta"]


def tag(kind: str, inner: str) -> str:
    name, _, attribute = kind.partition(" ")
    key, _, value = attribute.partition("=")
    return f'<{name} {key}="{value}">{inner}</{name}>' if attribute else f"<{name}>{inner}</{name}>"


class Layouts:
    """Random pages from given sentences, main text marked by a sentinel."""

    MARK = "\ue000"  # a private-use character

    def __init__(self, texts: list[str], rng: random.Random):
        self.texts, self.rng = [t for t in texts if t] or ["text of a page"], rng

    def some(self, lo: int, hi: int) -> str:
        words = self.rng.choice(self.texts).split()
        k = self.rng.randint(lo, hi)
        at = self.rng.randrange(max(1, len(words) - k + 1))
        return " ".join(words[at : at + k]) or "text"

    def links(self, wrapped: bool) -> str:
        items = [f'<a href="/x">{self.some(1, 3)}</a>' for _ in range(self.rng.randint(2, 8))]
        return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>" if wrapped else " ".join(items)

    def boiler(self, kinds: list[str]) -> str:
        r = self.rng.random()
        if kinds is MENU:
            inner = self.links(r < 0.8)
        elif kinds is COMMENT:
            inner = "".join(self.rng.choice(["<p>{}</p>", "<div>{}</div>", "<li>{}</li>"]).format(self.some(3, 60)) for _ in range(self.rng.randint(1, 5)))
        elif kinds is FORM:
            inner = f"<label>{self.some(1, 4)}</label><input><button>{self.some(1, 2)}</button>" + (f"<p>{self.some(3, 15)}</p>" if r < 0.4 else "")
        else:
            body = self.some(2, 30)
            inner = body if r < 0.4 else f"<p>{body}</p>" if r < 0.8 else f"<h3>{self.some(1, 4)}</h3>" + self.links(True)
        return tag(self.rng.choice(kinds), inner)

    def main_block(self, short: float) -> str:
        m, r = self.MARK, self.rng.random()
        body = m + (self.some(1, self.rng.choice([1, 3, 8])) if self.rng.random() < short else self.some(8, 120))
        if r < 0.75:
            return self.rng.choice(["<p>{}</p>", "<p>{}</p>", "<p>{}", "<p><b>{}<br>", "<p><i>{}</i></p>"]).format(body)
        if r < 0.82:
            return f"<h2>{m}{self.some(1, 8)}</h2>"
        if r < 0.88:
            return "<ul>" + "".join(f"<li>{m}{self.some(2, 25)}</li>" for _ in range(3)) + "</ul>"
        return self.rng.choice(["<blockquote>{}</blockquote>", "<blockquote><p>{}</p></blockquote>", "<pre>{}</pre>", "<div>{}</div>", "{}<hr>", "<table><tr><td>{}</td></tr></table>"]).format(body)

    def page(self) -> str:
        rng = self.rng
        before = [self.boiler(k) for k in (NOTICE, TOP, MENU, ADVERT, FORM, ASIDE) if rng.random() < 0.5]
        after = [self.boiler(k) for k in (SHARE, COMMENT, FORM, ASIDE, ADVERT, MENU, NOTICE) if rng.random() < 0.4]
        after += [self.boiler(BOTTOM)] * (rng.random() < 0.8)
        blocks = [self.main_block(0.35) for _ in range(rng.choice([0, 1, 2, 4, 8, 14]))]
        if rng.random() < 0.8:
            blocks.insert(0, f"<h1>{self.MARK}{self.some(2, 14)}</h1>")
        for kinds in (ADVERT, SHARE, ASIDE, FORM, COMMENT, MENU, NOTICE, BOTTOM):
            if rng.random() < 0.12:
                blocks.insert(rng.randint(0, len(blocks)), self.boiler(kinds))
        body = tag(rng.choice(MAIN), "".join(blocks))
        if rng.random() < 0.4:
            body = tag(rng.choice(["div class=container", "div id=page", "div class=wrapper", "div", "section"]), body)
        html = "".join(before) + body + "".join(after)
        return f"<html><head><title>x</title></head><body>{html}</body></html>"


def training_set(texts: list[str], pages: int, seed: int = 5) -> tuple[list[list], list[np.ndarray]]:
    made = Layouts(texts, random.Random(seed))
    blocks, labels = [], []
    for _ in range(pages):
        found = leaf_blocks(made.page())
        if found:
            labels.append(np.array([Layouts.MARK in t for t, _, _ in found], np.float32))
            blocks.append(with_words([(t.replace(Layouts.MARK, "").strip() or "x", p, q) for t, p, q in found]))
    return blocks, labels


def train(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", train_pages: int = TRAIN_PAGES, epochs: int = EPOCHS) -> Labeller:
    """A labeller trained on layouts filled with texts of a page sample."""
    key = F.xxhash64(F.col(f"`{id_col}`"))
    sample = pages.select(key.alias("k"), F.col(f"`{id_col}`").cast("string").alias("id")).orderBy("k", "id").limit(train_pages)
    ids = [r["id"] for r in sample.collect()]
    rows = pages.select(key.alias("k"), F.col(f"`{id_col}`").cast("string").alias("id"), text_or_empty(F.col(f"`{html_col}`")).alias("h"))
    # in a fixed order, so that weights do not depend on the files' layout
    rows = rows.where(F.col("id").isin(ids)).orderBy("k", "id", "h").limit(2 * train_pages)
    texts = [t for r in rows.collect() for t, _, _ in leaf_blocks(r["h"])]
    labeller = Labeller()
    blocks, labels = training_set(texts, 3 * train_pages)
    labeller.train(blocks, labels, epochs)
    return labeller


# ---- extraction ------------------------------------------------------------


def main_texts(htmls: list[str], labeller: Labeller) -> list[str]:
    """Main text of each page; pages are labelled in groups of like length."""
    pages = [with_words(leaf_blocks(h)) for h in htmls]
    out = [""] * len(pages)
    waiting = sorted((k for k, p in enumerate(pages) if p), key=lambda k: len(pages[k]))
    while waiting:
        n = 1
        while n < len(waiting) and (n + 1) * len(pages[waiting[n]]) <= CELLS and len(pages[waiting[n]]) <= 1.3 * len(pages[waiting[0]]) + 4:
            n += 1
        group, waiting = waiting[:n], waiting[n:]
        for k, logits in zip(group, labeller.scores([pages[k] for k in group]), strict=True):
            out[k] = " ".join(b[0] for b, z in zip(pages[k], logits, strict=True) if z > 0)
    return out


def main_text(html: Column, shared) -> Column:
    """Main text for a broadcast ``Labeller``."""

    @F.pandas_udf("string")
    def of(htmls: pd.Series) -> pd.Series:
        done = []
        for lo in range(0, len(htmls), 256):
            done += main_texts(htmls.iloc[lo : lo + 256].tolist(), shared.value)
        return pd.Series(done, dtype=object)

    return of(text_or_empty(html))


def extract(spark: SparkSession, pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """All rows of ``pages`` with the columns ``text`` (main text) and
    ``n_chars`` instead of the html; columns of these names are replaced."""
    shared = spark.sparkContext.broadcast(train(pages, id_col, html_col))
    others = [F.col(f"`{c}`") for c in pages.columns if c.lower() not in (html_col.lower(), "text", "n_chars")]
    made = pages.select(*others, main_text(F.col(f"`{html_col}`"), shared).alias("text"))
    return made.withColumn("n_chars", F.char_length("text").cast("bigint"))
