"""Main text of web pages by a recurrent block labeller.

A page becomes the sequence of its leaf blocks. Each block is a vector of its hashed tag path (tags, class and id words of its
ancestors), its hashed words and a few shares. A bidirectional LSTM in numpy reads the whole sequence and labels every block.
It is trained here, on a bounded sample of pages labelled by their semantic containers and on layouts composed from the
sample's own words.
"""

from __future__ import annotations

import html
import math
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

SLICE = 1 << 20
SAMPLE = 160
COMPOSED = 420
PATH, WORDS, SHARES = 128, 32, 6
DIM = PATH + WORDS + SHARES
HIDDEN = 20

# fixed values: element classes of HTML
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea".split())
UNSHOWN = frozenset("noscript template iframe title".split())
IN_HEAD = RAW | UNSHOWN | frozenset("base link meta".split())
BLOCK = frozenset("address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html label legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead tr ul".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
# fixed values: containers and words of class names that tell content from the rest
CONTENT = frozenset("article main".split())
OTHER = frozenset("nav header footer aside form button menu dialog select".split())
NAMING = frozenset("class id role".split())
OTHER_WORDS = frozenset("ad ads advert banner breadcrumb breadcrumbs comment comments consent cookie cookies footer header menu nav navbar navigation newsletter notice popup promo related reply share sharing sidebar social sponsor sponsored subscribe tags toolbar widget".split())

# a quote opens a value only right after "="; one that never closes is part of a value without quotes
_value = r"(?:\"[^\"]*\"|'[^']*'|[^\s>]*)"
_tag = re.compile(rf"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*{_value}|[^>=])*+)>|<[!?][^>]*>", re.S)
_attr = re.compile(rf"([^\s=/>\"']+)(?:\s*=\s*({_value}))?")
_part = re.compile(r"[a-z]+")


class Block:
    __slots__ = ("linked", "path", "text")

    def __init__(self, text: str, path: tuple[str, ...], linked: int):
        self.text, self.path, self.linked = text, path, linked


def blocks(page: str) -> list[Block]:
    """Leaf blocks in page order: decoded text, white space as single spaces, with the path of enclosing elements."""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    text: list[str] = []
    anchors = linked = at = 0
    in_head = False

    def flush() -> None:
        nonlocal linked
        body = " ".join(html.unescape("".join(text)).split())
        if body:
            out.append(Block(body, tuple(x for t, names in stack if t in BLOCK or names for x in (t, *names)), linked))
        text.clear()
        linked = 0

    def pop(tags: set[str] | frozenset[str], stop: frozenset[str] = frozenset()) -> None:
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in tags:
                del stack[i:]
                return
            if stack[i][0] in stop:
                return

    while m := _tag.search(page, at):
        if m.start() > at:
            in_head = in_head and page[at : m.start()].isspace()
            text.append(page[at : m.start()])
            linked += anchors * (m.start() - at)
        at = m.end()
        if m[2] is None:
            continue
        name, closing = m[2].lower(), bool(m[1])
        if name == "head":
            flush()
            in_head = not closing
            continue
        if name in RAW or name in UNSHOWN:
            if not closing and not m[3].endswith("/"):
                end = re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I).search(page, at)
                if name in BLOCK:
                    flush()
                # without an end tag, script and style run to the end of the page; other elements are passed over
                at = end.end() if end else len(page) if name in RAW else at
            continue
        in_head = in_head and (closing or name in IN_HEAD)
        if name not in ("option", "optgroup", "hr") and name in BLOCK and not closing:
            pop({"select"}, BLOCK - {"option", "select"})
        if name == "a":
            anchors = 0 if closing else 1
        if name in VOID or name not in BLOCK:
            if name == "br":
                text.append(" ")
            continue
        flush()
        if closing:
            pop({name})
            continue
        if name not in ("button", "label", "summary"):
            pop({"p"}, BLOCK - {"p"})
        if name in CLOSES:
            pop(CLOSES[name], frozenset({"ul", "ol", "dl", "table", "menu"}))
        names = [w for key, value in _attr.findall(m[3]) if key.lower() in NAMING for w in _part.findall(value.lower())]
        if not m[3].endswith("/"):
            stack.append((name, tuple("." + w for w in names)))
    if at < len(page):
        text.append(page[at:])
    flush()
    return out


@lru_cache(1 << 16)
def _slot(word: str, size: int) -> int:
    return zlib.crc32(word.encode("utf-8", "replace")) % size


@lru_cache(1 << 12)
def _slots(path: tuple[str, ...]) -> list[int]:
    return sorted({_slot(p, PATH) for p in path})


def vectors(found: list[Block]) -> np.ndarray:
    """One row of DIM numbers for each block."""
    x = np.zeros((len(found), DIM), dtype=np.float32)
    for i, b in enumerate(found):
        row = x[i]
        row[_slots(b.path)] = 1
        words = b.text.split(" ")
        row[PATH : PATH + WORDS] = np.bincount([_slot(w, WORDS) for w in words], minlength=WORDS) / len(words)
        n = len(b.text)
        row[PATH + WORDS :] = (min(math.log1p(n) / 8, 2), min(b.linked / n, 1), (b.text.count(".") + b.text.count(",")) / (n / 20 + 1), (i + 1) / len(found), n < 60, b.path[-1:] in (("h1",), ("h2",), ("h3",)))
    return x


class Labeller:
    """Bidirectional LSTM with one logistic output for each step."""

    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        h = HIDDEN
        self.w = {f"{k}{d}": (r.standard_normal(s) / np.sqrt(s[0])).astype(np.float32) for d in "fb" for k, s in (("x", (DIM, 4 * h)), ("h", (h, 4 * h)))}
        self.w |= {f"b{d}": np.concatenate([np.zeros(h), np.ones(h), np.zeros(2 * h)]).astype(np.float32) for d in "fb"}
        self.w |= {"o": (r.standard_normal(2 * h) / np.sqrt(2 * h)).astype(np.float32), "c": np.zeros(1, np.float32)}

    @staticmethod
    def _sig(x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x, -30, 30)))

    def _run(self, x: np.ndarray, mask: np.ndarray, d: str, keep: bool) -> tuple[np.ndarray, list]:
        """x: (steps, pages, DIM). Steps beyond a page's end leave its state as it is."""
        steps, n, h = len(x), x.shape[1], HIDDEN
        pre = x @ self.w["x" + d] + self.w["b" + d]
        out, kept = np.zeros((steps, n, h), np.float32), []
        hid, cell = np.zeros((n, h), np.float32), np.zeros((n, h), np.float32)
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            g = pre[t] + hid @ self.w["h" + d]
            s = self._sig(g[:, : 3 * h])
            i, f, o, z = s[:, :h], s[:, h : 2 * h], s[:, 2 * h :], np.tanh(g[:, 3 * h :])
            m = mask[t][:, None]
            new = f * cell + i * z
            if keep:
                kept.append((t, hid, cell, i, f, o, z, new))
            cell = np.where(m, new, cell)
            hid = np.where(m, o * np.tanh(new), hid)
            out[t] = hid
        return out, kept

    def forward(self, x: np.ndarray, mask: np.ndarray, keep: bool = False) -> tuple[np.ndarray, tuple]:
        a, ka = self._run(x, mask, "f", keep)
        b, kb = self._run(x, mask, "b", keep)
        both = np.concatenate([a, b], axis=2)
        return self._sig(both @ self.w["o"] + self.w["c"]), (both, ka, kb)

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        p, (both, ka, kb) = self.forward(x, mask, True)
        d = ((p - y) * mask / mask.sum()).astype(np.float32)
        g = {"o": (both * d[..., None]).sum(axis=(0, 1)), "c": np.array([d.sum()], np.float32)}
        for kept, way, part in ((ka, "f", slice(0, HIDDEN)), (kb, "b", slice(HIDDEN, None))):
            wh = self.w["h" + way]
            gx, gh = np.zeros_like(self.w["x" + way]), np.zeros_like(wh)
            gb = np.zeros_like(self.w["b" + way])
            dh, dc = np.zeros_like(kept[0][1]), np.zeros_like(kept[0][1])
            for t, hid, cell, i, f, o, z, new in reversed(kept):
                m = mask[t][:, None]
                dh = dh + d[t][:, None] * self.w["o"][part]
                th = np.tanh(new)
                dn = np.where(m, dc + dh * o * (1 - th * th), 0)
                do = np.where(m, dh * th, 0)
                dg = np.concatenate([dn * z * i * (1 - i), dn * cell * f * (1 - f), do * o * (1 - o), dn * i * (1 - z * z)], axis=1)
                gx += x[t].T @ dg
                gh += hid.T @ dg
                gb += dg.sum(axis=0)
                dc = np.where(m, dn * f, dc)
                dh = np.where(m, dg @ wh.T, dh)
            g |= {"x" + way: gx, "h" + way: gh, "b" + way: gb}
        return g


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(map(len, pages))
    x, mask = np.zeros((steps, len(pages), pages[0].shape[1]), np.float32), np.zeros((steps, len(pages)), bool)
    for i, p in enumerate(pages):
        x[: len(p), i], mask[: len(p), i] = p, True
    return x, mask


def teacher(b: Block) -> int:
    """The weak label: inside an article or main element, and in nothing that is named as something else."""
    names = {x[1:] for x in b.path if x[0] == "."}
    return int(bool(CONTENT & set(b.path)) and not OTHER & set(b.path) and not OTHER_WORDS & names)


def compose(texts: list[str], r: np.random.Generator) -> list[tuple[Block, int]]:
    """A page of a made-up layout around real texts, with the label of each block."""

    def some(n: int) -> str:
        t = texts[r.integers(len(texts))].split(" ")
        at = r.integers(max(1, len(t) - n))
        return " ".join(t[at : at + n]) or "x"

    def pick(*x: str) -> str:
        return str(r.choice(x))

    junk = sorted(OTHER_WORDS)
    out: list[tuple[Block, int]] = []

    def other(tag: str, names: tuple[str, ...], count: int, inner: tuple[str, ...], linked: bool, around: tuple[str, ...] = ()) -> None:
        for _ in range(count):
            t = some(int(r.integers(1, 14)) if r.random() < 0.8 else int(r.integers(15, 60)))
            out.append((Block(t, ("html", "body", *around, tag, *("." + x for x in names), *inner), len(t) if linked else 0), 0))

    def frame(where: str) -> None:
        for _ in range(int(r.integers(0, 4))):
            kind = pick("nav", "header", "footer", "aside", "form", "div", "section") if where != "after" else pick("footer", "aside", "form", "div", "section", "nav")
            names = () if kind in OTHER and r.random() < 0.6 else tuple(r.choice(junk, int(r.integers(1, 3))))
            inner = [(), ("p",), ("ul", "li"), ("div",), ("div", "p"), ("h3",)][int(r.integers(6))]
            other(kind, names, int(r.integers(1, 7)), inner, r.random() < 0.5)

    frame("before")
    holder = [("article",), ("main",), ("main", "article"), ("div", ".content"), ("div", ".post"), ("div", ".entry", ".content"), ("div", ".article", ".body"), ("section", ".story"), ("div", ".main", "article"), ("div", ".page", "div", ".text")][int(r.integers(10))]
    for i in range(int(r.integers(1, 14))):
        tag = "h1" if i == 0 and r.random() < 0.8 else pick("p", "p", "p", "p", "h2", "li", "blockquote", "div", "pre", "td")
        t = some(int(r.integers(1, 12)) if tag[0] == "h" or r.random() < 0.3 else int(r.integers(8, 120)))
        path = (*holder, *({"li": ("ul", "li"), "td": ("table", "tr", "td")}.get(tag, (tag,))))
        out.append((Block(t, ("html", "body", *path), len(t) // 4 * int(r.random() < 0.15)), 1))
        if r.random() < 0.06:
            other(pick("div", "aside"), tuple(r.choice(junk, 1)), 1, (), r.random() < 0.5, holder)
    frame("after")
    if r.random() < 0.4:
        other(pick("div", "section"), (pick("comments", "comment", "reply"),), int(r.integers(1, 6)), [("p",), ("ul", "li"), ("div", "p")][int(r.integers(3))], False, holder if r.random() < 0.2 else ())
    return out


def train(pages: list[str], composed: int = COMPOSED, rounds: int = 14, seed: int = 11) -> Labeller:
    """Fit to the sample and to composed pages by Adam; the same sample gives the same labeller."""
    r = np.random.default_rng(seed)
    seen = [b for b in map(blocks, pages) if b]
    data = [(vectors(b), np.array([teacher(x) for x in b], np.float32)) for b in seen]
    texts = [b.text for p in seen for b in p if len(b.text) > 20] or ["some words of a text"]
    for _ in range(composed):
        if made := compose(texts, r):
            data.append((vectors([b for b, _ in made]), np.array([y for _, y in made], np.float32)))
    model, m, v, step = Labeller(), {}, {}, 0
    for _ in range(rounds):
        order = sorted(range(len(data)), key=lambda i: len(data[i][0]) + 4 * r.random())
        batches = [order[i : i + 24] for i in range(0, len(order), 24)]
        for k in r.permutation(len(batches)):
            x, mask = padded([data[i][0] for i in batches[k]])
            y, _ = padded([data[i][1][:, None] for i in batches[k]])
            step += 1
            for name, g in model.gradients(x, mask, y[:, :, 0]).items():
                m[name] = 0.9 * m.get(name, 0) + 0.1 * g
                v[name] = 0.99 * v.get(name, 0) + 0.01 * g * g
                model.w[name] -= (0.02 * (m[name] / (1 - 0.9**step)) / (np.sqrt(v[name] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return model


def label(model: Labeller, pages: list[list[Block]]) -> list[np.ndarray]:
    """Which blocks of each page are main text. Pages of like length are read together."""
    out = [np.zeros(0, bool)] * len(pages)
    order = sorted((i for i, p in enumerate(pages) if p), key=lambda i: len(pages[i]))
    at = 0
    while at < len(order):
        end = at + 1
        while end < len(order) and end - at < 128 and len(pages[order[end]]) * (end - at + 1) < 4000:
            end += 1
        part = order[at:end]
        x, mask = padded([vectors(pages[i]) for i in part])
        p, _ = model.forward(x, mask)
        for j, i in enumerate(part):
            out[i] = p[: len(pages[i]), j] >= 0.5
        at = end
    return out


def extract_pages(pages: DataFrame, sample: int = SAMPLE, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: page_id, url, text, n_chars.

    text joins the main blocks in page order by line feeds; it is empty where there are none, and for null or empty
    html. Blocks end where block elements begin or end; a line break is white space. References are decoded, white space of
    any kind becomes one space. Pages are read whole; those that repeat are labelled alike. The labeller is trained on the
    `sample` pages whose ids hash least; an empty table gives no rows. Other columns are ignored.
    """
    p = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"))
    order = F.xxhash64("page_id")
    last = p.select(order.alias("h")).orderBy("h").limit(sample).agg(F.max("h")).first()[0]
    got = [r.html for r in p.filter(order <= last).orderBy(order, "page_id", "html").limit(sample).select("html").collect()] if last is not None else []
    weights = train(got).w

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Labeller()
        model.w = weights
        for batch in slices(batches, "html", SLICE):
            found = [blocks(h) for h in batch.column("html").to_pylist()]
            text = ["\n".join(b.text for b, k in zip(f, keep, strict=True) if k) for f, keep in zip(found, label(model, found), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return p.mapInArrow(run, "page_id long, url string, text string, n_chars long")
