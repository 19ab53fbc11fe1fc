"""Main text of web pages by a recurrent block labeller.

A page is parsed into leaf blocks in page order (texts between block-level tags,
without scripts, styles and form fields). Each block is a vector: hashed names of
the tags, classes and ids on its path, all its words hashed, and a few measures. A
bidirectional LSTM in numpy reads the whole sequence and labels every block with
document-wide context; the kept blocks are the main text.

The labeller is trained by the driver when the operator is built, on SYNTHETIC
generated pages and on at most SAMPLE pages of the table (chosen by a hash of the
id) that mark their article themselves; both bounds are parameters, and the seed is
fixed. In those, articles inside the article (reader comments) and what its names
call an aside aren't main text.

Nulls: a null or empty page, or one without main text, has empty text and n_chars
0. Null ids and urls pass through. Ties: pages with one id may all be learned from.
Repeated rows each give a row. A page of any length is read whole, and short ones in
batches; memory is in proportion to the longest page. Other columns, whatever their
names, are passed by. An empty table gives no rows.
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

SAMPLE, SYNTHETIC, HIDDEN, EPOCHS, SEED = 150, 350, 16, 24, 5
PATH_DIMS, WORD_DIMS = 96, 32
#: A quote opens a value only after an equals sign, and only if it is closed; elsewhere it is a character like others.
MARKUP = re.compile(r"""<!--(?:-?>|.*?(?:--!?>|\Z))|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*"[^"]*"|=\s*'[^']*'|[^>])*+)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""(?<![\w-])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
#: HTML's element kinds.
RAW = {"script", "style", "textarea", "title", "xmp", "noframes", "noembed"}
SILENT = {"script", "style", "textarea", "title", "noscript", "template", "svg", "math", "iframe", "object", "select", "option", "button", "canvas", "audio", "video", "head", "noframes", "noembed", "datalist"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "input", "nobr"}
CLOSES_P = {"address", "article", "aside", "blockquote", "div", "dl", "fieldset", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "nav", "ol", "p", "pre", "section", "table", "ul"}
OWN_KIND = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table", "tbody", "thead", "tfoot"}, "td": {"tr"}, "th": {"tr"}}


#: What isn't main text inside a page's own article, for learning: tags, and words of class, id and role.
ASIDE = {"nav", "aside", "footer", "form"}
ASIDE |= {"." + w for w in ("ad", "ads", "advert", "sponsored", "promo", "comment", "comments", "reply", "replies", "responses", "discussion", "sidebar", "related", "recommended", "widget", "share", "menu", "nav", "breadcrumb", "cookie", "consent", "notice", "newsletter")}


class _Open:
    """An open element: its names, and what its path adds up to, so that blocks below share it."""

    __slots__ = ("bits", "depth", "own", "parent", "tag")

    def __init__(self, tag: str, own: list[str], parent: _Open | None):
        self.tag, self.own, self.parent = tag, own, parent
        self.depth, self.bits = len(own) + (parent.depth if parent else 0), parent.bits if parent else 0
        for x in own:
            self.bits |= 1 << _hash(x) % PATH_DIMS


class Block:
    __slots__ = ("inside", "link", "text")

    def __init__(self, text: str, inside: _Open | None, link: int):
        self.text, self.inside, self.link = text, inside, link

    @property
    def path(self) -> tuple[str, ...]:
        out, at = [], self.inside
        while at:
            out.append(at.own)
            at = at.parent
        return tuple(x for own in reversed(out) for x in own)


def blocks(page: str) -> list[Block]:
    """Leaf blocks in page order; path items are tags and, after a dot, words of class, id and role. Time is in proportion to the page: where each tag is open, and which elements aren't inline, is kept beside the stack."""
    out: list[Block] = []
    stack: list[_Open] = []
    open_at: dict[str, list[int]] = {}  # places in the stack, by tag
    hard: list[int] = []  # places of elements that aren't inline
    held: list[str] = []
    link = silent = anchors = at = 0

    def last(tags) -> int:
        return max((open_at[t][-1] for t in tags if open_at.get(t)), default=-1)

    def flush() -> None:
        nonlocal link
        text = " ".join("".join(held).split())
        if text:
            out.append(Block(text, stack[-1] if stack else None, link))
        held.clear()
        link = 0

    def pop(k: int) -> None:
        nonlocal silent, anchors
        while len(stack) > k:
            tag = stack.pop().tag
            open_at[tag].pop()
            if tag not in INLINE:
                hard.pop()
            silent -= tag in SILENT
            anchors -= tag == "a"

    def said(raw: str) -> None:
        nonlocal link
        if raw and not silent:
            text = html.unescape(raw)
            held.append(text)
            if anchors:
                link += len(text.strip())

    n = len(page)
    while at < n:
        m = MARKUP.search(page, at)
        if not m:
            said(page[at:])
            break
        said(page[at : m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if tag == "br":
            if not silent:
                held.append(" ")
            continue
        if tag not in INLINE:
            flush()
        if m[1]:
            k = last((tag,))
            if k >= 0 and (tag not in INLINE or not hard or hard[-1] < k):
                pop(k)
            continue
        if tag in VOID:
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else n
            continue
        if tag in CLOSES_P:
            if hard and stack[hard[-1]].tag == "p":
                pop(hard[-1])
        elif tag in OWN_KIND:
            k = last(next((x for x in (("dt", "dd"), ("td", "th")) if tag in x), (tag,)))
            if k > last(OWN_KIND[tag]):
                pop(k)
        elif tag == "a" and anchors:
            pop(last(("a",)))
        own = [tag]
        if m[3] and not m[3].isspace():
            for a in ATTRIBUTE.finditer(m[3]):
                own += ["." + w for w in re.split(r"[^a-z]+", (a[2] or a[3] or a[4] or "").lower()) if w]
        if m[3].rstrip().endswith("/") and tag not in INLINE and tag in ("svg", "math", "iframe"):
            continue
        open_at.setdefault(tag, []).append(len(stack))
        if tag not in INLINE:
            hard.append(len(stack))
        stack.append(_Open(tag, own, stack[-1] if stack else None))
        silent += tag in SILENT
        anchors += tag == "a"
    flush()
    return out


# ---- vectors

_hashes: dict[str, int] = {}


def _hash(x: str) -> int:
    if (got := _hashes.get(x)) is None:
        if len(_hashes) > 200_000:
            _hashes.clear()
        got = _hashes[x] = zlib.crc32(x.encode("utf-8", "surrogatepass"))
    return got


_buckets: dict[str, int] = {}


def _bucket(word: str) -> int:
    if (got := _buckets.get(word)) is None:
        if len(_buckets) > 200_000:
            _buckets.clear()
        got = _buckets[word] = PATH_DIMS + _hash(word.lower().strip(".,:;!?|")) % WORD_DIMS
    return got


DIMS = PATH_DIMS + WORD_DIMS + 8


def vectors(found: list[Block]) -> np.ndarray:
    out = np.zeros((len(found), DIMS), np.float32)
    total = max(1, sum(len(b.text) for b in found))
    before = 0
    for k, b in enumerate(found):
        row = out[k]
        if b.inside:
            row[:PATH_DIMS] = np.unpackbits(np.frombuffer(b.inside.bits.to_bytes(PATH_DIMS // 8, "little"), np.uint8), bitorder="little")
        words = b.text.split()
        for w in words:
            row[_bucket(w)] += 1
        said = row[PATH_DIMS:-8]
        np.multiply(np.log1p(said), 0.3 / np.log(2), out=said)  # by a log, so that a long block stays bounded
        n = len(b.text)
        row[-8:] = (min(np.log1p(n) / 6, 2), min(np.log1p(len(words)) / 4, 2), b.link / n, sum(b.text.count(c) for c in ".,;!?|") / len(words) / 2, k / len(found), before / total, 1 if b.text[-1] in ".!?" else 0, (b.inside.depth if b.inside else 0) / 10)
        before += n
    return out


# ---- the labeller


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _start(rng: np.random.Generator) -> dict[str, np.ndarray]:
    p = {}
    for side in "fb":
        p[f"x{side}"] = rng.normal(0, DIMS**-0.5, (DIMS, 4 * HIDDEN))
        p[f"h{side}"] = rng.normal(0, HIDDEN**-0.5, (HIDDEN, 4 * HIDDEN))
        p[f"c{side}"] = np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)])
    p["o"], p["d"] = rng.normal(0, 0.3, 2 * HIDDEN), np.zeros(1)
    return {k: v.astype(np.float32) for k, v in p.items()}


def _pass(p: dict, side: str, x: np.ndarray, mask: np.ndarray, keep: list | None = None) -> np.ndarray:
    """One direction over padded sequences (batch, time, dims); a masked step carries its state on."""
    n, t = mask.shape
    pre = (x.reshape(n * t, -1) @ p[f"x{side}"] + p[f"c{side}"]).reshape(n, t, -1)
    h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
    out = np.zeros((n, t, HIDDEN), np.float32)
    for k in range(t) if side == "f" else range(t - 1, -1, -1):
        a = pre[:, k] + h @ p[f"h{side}"]
        gates = _sigmoid(a[:, : 3 * HIDDEN])
        i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
        g = np.tanh(a[:, 3 * HIDDEN :])
        m = mask[:, k, None]
        now = f * c + i * g
        tanh = np.tanh(now)
        if keep is not None:
            keep.append((k, h, c, i, f, o, g, tanh, m))
        c = m * now + (1 - m) * c
        h = m * (o * tanh) + (1 - m) * h
        out[:, k] = h
    return out


def _back(p: dict, side: str, x: np.ndarray, kept: list, dout: np.ndarray, grads: dict) -> None:
    n = x.shape[0]
    dh, dc = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
    for k, h, c, i, f, o, g, tanh, m in reversed(kept):
        dh = dh + dout[:, k]
        on = m * dh
        dnow = m * dc + on * o * (1 - tanh**2)
        da = np.hstack([dnow * g * i * (1 - i), dnow * c * f * (1 - f), on * tanh * o * (1 - o), dnow * i * (1 - g**2)])
        grads[f"x{side}"] += x[:, k].T @ da
        grads[f"h{side}"] += h.T @ da
        grads[f"c{side}"] += da.sum(axis=0)
        dh = (1 - m) * dh + da @ p[f"h{side}"].T
        dc = (1 - m) * dc + dnow * f


def gradients(p: dict, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    """Of the mean cross entropy over the steps that mask has."""
    kf, kb = [], []
    both = np.concatenate([_pass(p, "f", x, mask, kf), _pass(p, "b", x, mask, kb)], axis=2)
    e = (_sigmoid(both @ p["o"] + p["d"]) - y) * mask / mask.sum()
    grads = {k: np.zeros_like(v) for k, v in p.items()}
    grads["o"] += np.einsum("nt,nth->h", e, both)
    grads["d"] += e.sum()
    dout = e[..., None] * p["o"]
    _back(p, "f", x, kf, dout[..., :HIDDEN], grads)
    _back(p, "b", x, kb, dout[..., HIDDEN:], grads)
    return grads


def _padded(seqs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    t = max(len(s) for s in seqs)
    x, mask = np.zeros((len(seqs), t, DIMS), np.float32), np.zeros((len(seqs), t), np.float32)
    for k, s in enumerate(seqs):
        x[k, : len(s)], mask[k, : len(s)] = s, 1
    return x, mask


def train(seqs: list[np.ndarray], labels: list[np.ndarray], seed: int = SEED) -> dict[str, np.ndarray]:
    """Back-propagation through time with Adam, in batches of pages of like length."""
    rng = np.random.default_rng(seed)
    p = _start(rng)
    first, second = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    order = sorted(range(len(seqs)), key=lambda k: len(seqs[k]))
    batches = [order[i : i + 16] for i in range(0, len(order), 16)]
    step = 0
    for epoch in range(EPOCHS):
        for b in rng.permutation(len(batches)):
            own = batches[b]
            x, mask = _padded([seqs[k] for k in own])
            x = x * (rng.random(x.shape[2]) > 0.1)  # some dimensions go unseen, so that no name decides alone
            y = np.zeros_like(mask)
            for r, k in enumerate(own):
                y[r, : len(labels[k])] = labels[k]
            grads = gradients(p, x, mask, y)
            step += 1
            rate = 0.02 * (1 - epoch / EPOCHS) + 0.001
            for k in p:
                g = np.clip(grads[k] + 1e-5 * p[k], -1, 1)
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                p[k] = (p[k] - rate * first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return p


def label(p: dict, seqs: list[np.ndarray]) -> list[np.ndarray]:
    """The chance of each block of being main text."""
    out: list = [np.zeros(0)] * len(seqs)
    order = sorted((k for k in range(len(seqs)) if len(seqs[k])), key=lambda k: len(seqs[k]))
    while order:
        n = max(1, min(256, 8192 // len(seqs[order[0]])))
        own, order = order[:n], order[n:]
        while len(own) > 1 and len(seqs[own[-1]]) > 1.3 * len(seqs[own[0]]) + 2:
            order.insert(0, own.pop())
        x, mask = _padded([seqs[k] for k in own])
        both = np.concatenate([_pass(p, "f", x, mask), _pass(p, "b", x, mask)], axis=2)
        chance = _sigmoid(both @ p["o"] + p["d"])
        for r, k in enumerate(own):
            out[k] = chance[r, : len(seqs[k])]
    return out


# ---- generated pages to learn from


class Generator:
    """Pages of invented words with known main text."""

    def __init__(self, seed: int):
        self.rng = np.random.default_rng(seed)
        r = self.rng
        letters = "bcdfghklmnprstvw", "aeiouéäó"
        syllable = lambda: r.choice([*letters[0]]) + r.choice([*letters[1]]) + (r.choice([*letters[0]]) if r.random() < 0.3 else "")
        self.words = ["".join(syllable() for _ in range(r.integers(1, 4))) for _ in range(3000)]

    def pick(self, *options):
        return options[self.rng.integers(len(options))]

    def say(self, low: int, high: int, stop: bool = True) -> str:
        n = int(self.rng.integers(low, high + 1))
        w = [self.words[i] for i in self.rng.integers(0, len(self.words), n)]
        for i in range(n):
            if self.rng.random() < 0.1:
                w[i] += self.pick(".", ",", " |", "!")
        return " ".join(w).capitalize() + ("." if stop else "")

    def some(self, low: int, high: int) -> range:
        return range(int(self.rng.integers(low, high + 1)))

    def wrap(self, tag: str, inner: str, *names: str) -> str:
        own = f' {self.pick("class", "class", "id")}="{self.pick(*names)}"' if names and self.rng.random() < 0.85 else ""
        return f"<{tag}{own}>{inner}</{tag}>"

    def links(self, low: int, high: int) -> str:
        items = [f'<a href="/{i}">{self.say(1, 2, False)}</a>' for i in self.some(low, high)]
        return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>" if self.rng.random() < 0.7 else self.pick(" | ", " ").join(items)

    def menu(self) -> str:
        return self.wrap(self.pick("nav", "nav", "div"), self.links(3, 9), "menu", "navbar", "nav", "navigation", "breadcrumb")

    def header(self) -> str:
        return self.wrap(self.pick("header", "div"), self.wrap(self.pick("div", "span", "h1"), self.say(1, 4, False), "logo", "site-title", "brand") + (self.links(2, 5) if self.rng.random() < 0.5 else ""), "header", "site-header", "masthead", "topbar")

    def footer(self) -> str:
        return self.wrap(self.pick("footer", "footer", "div"), self.pick("&copy; ", "Copyright 2024 ", "All rights reserved. ", "") + self.say(3, 25) + (self.links(1, 5) if self.rng.random() < 0.4 else ""), "footer", "site-footer", "copyright", "colophon")

    def advert(self) -> str:
        return self.wrap(self.pick("div", "aside", "section"), self.pick("", "<b>Ad</b> ", "Sponsored: ") + self.say(3, 25), "ad", "ads", "advert", "sponsored", "promo", "banner", "ad-box")

    def sidebar(self) -> str:
        inner = self.wrap(self.pick("h3", "h4"), self.say(1, 3, False)) + (self.links(2, 6) if self.rng.random() < 0.7 else f"<p>{self.say(5, 30)}</p>")
        return self.wrap(self.pick("aside", "aside", "div"), inner, "sidebar", "related", "widget", "recommended", "side", "popular", "share")

    def notice(self) -> str:
        return self.wrap(self.pick("div", "section", "p"), self.pick("", "We use cookies. ", "Please accept our privacy policy. ") + self.say(3, 20) + self.pick("", "<button>OK</button>"), "cookie", "cookie-notice", "consent", "notice", "gdpr-banner", "alert", "newsletter", "popup")

    def form(self) -> str:
        return self.wrap("form", f"<label>{self.say(1, 3, False)}</label><input name=q>" + self.pick("", f"<p>{self.say(3, 15)}</p>") + f"<button>{self.say(1, 1, False)}</button>", "search", "subscribe", "login", "newsletter", "signup")

    def comments(self) -> str:
        one = lambda: self.wrap(self.pick("div", "li", "article"), self.wrap(self.pick("span", "b", "h4"), self.say(1, 2, False), "author", "user") + f"<p>{self.say(4, 40)}</p>", "comment", "reply", "comment-body", "response")
        return self.wrap(self.pick("section", "div", "ol"), self.pick("", "<h3>Comments</h3>") + "".join(one() for _ in self.some(1, 4)), "comments", "discussion", "responses", "comment-list", "disqus")

    def article(self, main: list[str]) -> str:
        def told(tag: str, low: int, high: int) -> str:
            text = self.say(low, high)
            main.append(text)
            if self.rng.random() < 0.15:
                k = text.find(" ") + 1
                text = f"{text[:k]}<{self.pick('b', 'em', 'a href=/x')}>{text[k:]}" + self.pick("</b>", "</em>", "</a>", "")
            return f"<{tag}>{text}</{tag}>" if self.rng.random() < 0.9 or tag != "p" else f"<{tag}>{text}"

        parts = [told("h1", 2, 12)] if self.rng.random() < 0.8 else []
        for _ in self.some(1, 9):
            parts.append(told("p", *self.pick((1, 4), (5, 30), (20, 90), (40, 160))))
            if self.rng.random() < 0.12:
                parts.append(told(self.pick("h2", "h3"), 2, 8))
            if self.rng.random() < 0.08:
                parts.append("<ul>" + "".join(told("li", 2, 12) for _ in self.some(2, 5)) + "</ul>")
            if self.rng.random() < 0.06:
                parts.append(f"<blockquote>{told('p', 5, 30)}</blockquote>")
            if self.rng.random() < 0.06:
                parts.append(self.pick(self.advert, self.sidebar, self.form)())
        if self.rng.random() < 0.12:
            parts.append(self.comments())
        inner = "".join(parts)
        if (r := self.rng.random()) < 0.5:
            return self.wrap("article", inner) if self.rng.random() < 0.7 else self.wrap("article", inner, "post", "article", "entry")
        if r < 0.65:
            return self.wrap("main", inner)
        return self.wrap(self.pick("div", "div", "section"), inner, "content", "article-body", "post", "entry-content", "main", "story", "text", "post-content")

    def page(self) -> tuple[str, set[str]]:
        """Its HTML, and the texts of its main blocks."""
        main: list[str] = []
        maybe = lambda share, f: f() if self.rng.random() < share else ""
        top = maybe(0.25, self.notice) + maybe(0.35, self.header) + maybe(0.8, self.menu) + maybe(0.4, self.advert) + maybe(0.15, self.sidebar) + maybe(0.1, self.form)
        body = self.article(main) if self.rng.random() < 0.97 else ""
        end = maybe(0.15, self.form) + maybe(0.2, self.comments) + maybe(0.25, self.sidebar) + maybe(0.15, self.advert) + maybe(0.85, self.footer) + maybe(0.15, self.notice)
        if self.rng.random() < 0.3:
            body = f"<div id=wrapper><div class=row>{body}</div></div>"
        whole = f"<!DOCTYPE html><html><head><title>{self.say(2, 8)}</title><script>var a='<p>';</script></head><body>{top}{body}{end}</body></html>"
        return whole, set(main)


def learn(pages: DataFrame) -> dict[str, np.ndarray]:
    common.prepare(pages.sparkSession)
    generator = Generator(SEED)
    seqs, labels = [], []
    for _ in range(SYNTHETIC):
        page, main = generator.page()
        found = blocks(page)
        if found:
            seqs.append(vectors(found))
            labels.append(np.array([b.text in main for b in found], np.float32))
    marked = pages.select(F.col("page_id").cast("long").alias("page_id"), "html").where("html is not null and html like '%<article%' and length(html) < 50000")
    ids = common.sampled(marked.select("page_id"), "page_id", "pages", SAMPLE)
    own = pages.sparkSession.createDataFrame(ids, "page_id long")
    chosen = marked.join(F.broadcast(own), "page_id", "left_semi").limit(2 * SAMPLE).collect()
    for r in sorted(chosen, key=lambda r: (r["page_id"], r["html"])):
        found = blocks(r["html"])
        inside = np.array([b.path.count("article") == 1 and ASIDE.isdisjoint(b.path) for b in found], np.float32)
        if len(found):
            seqs.append(vectors(found))
            labels.append(inside)
    return train(seqs, labels)


def main_text(page: str | None, p: dict) -> str:
    found = blocks(page or "")
    return " ".join(b.text for b, c in zip(found, label(p, [vectors(found)])[0], strict=True) if c >= 0.5) if found else ""


def _texts(batches: Iterator[pa.RecordBatch], sent) -> Iterator[pa.RecordBatch]:
    p = sent.value
    for whole in batches:
        for piece in common.small_batches(iter([whole]), "html"):
            for b in (piece.slice(i, 512) for i in range(0, piece.num_rows, 512)):
                found = [blocks(h) for h in common.strings(b.column(2))]
                chances = label(p, [vectors(f) if f else np.zeros((0, DIMS), np.float32) for f in found])
                texts = [" ".join(x.text for x, c in zip(f, cs, strict=True) if c >= 0.5) for f, cs in zip(found, chances, strict=True)]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame, model: dict[str, np.ndarray]) -> DataFrame:
    """page_id, url, text and n_chars of every row."""
    common.prepare(pages.sparkSession)
    sent = pages.sparkSession.sparkContext.broadcast(model)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").alias("html"))
    return rows.mapInArrow(lambda it: _texts(it, sent), "page_id long, url string, text string, n_chars long")


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = common.table(spark, sf_dir, "pages")
    return extract(pages, learn(pages))
