"""HTML main text by a recurrent block labeller.

A page is cut into leaf blocks: the text between two block-level tags, with
the path of open elements above it. A numpy bidirectional LSTM reads the
blocks of a page in order, each as a vector of its hashed path (tag names,
classes, ids, roles), its hashed words and a few counts, and labels each block
as main text or not from the context of the whole page.

The pages have no labels. The labeller is trained at run time on a bounded
sample of them in two ways. Pages whose elements say what they are (article,
main, nav, footer and so on) label their own blocks. And their blocks are laid
out anew in random page layouts, in which menus, notices, sidebars, forms and
comments stand in plain elements with the class names that sites use, so that
the model learns to read names, words and position together.
"""

from __future__ import annotations

import functools
import html
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlab.llm.common import arrow_map

# Elements of the HTML standard.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike "
             "strong sub sup time tt u var wbr br img".split())
RAW = set("script style noscript template textarea title svg math iframe object select option button".split())
CLOSES_P = set("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre "
               "section table ul li dd dt".split())
# What elements and class names say about their content.
MAIN_TAGS = {"article", "main"}
OTHER_TAGS = {"nav", "footer", "aside", "form", "header", "menu", "dialog", "button", "select"}
OTHER_NAMES = ("ad ads advert advertisement banner sponsor promo nav navbar menu breadcrumb footer header masthead sidebar "
               "widget related share social cookie consent notice alert popup modal newsletter subscribe comment comments reply "
               "respond pagination pager login search form disclaimer copyright legal").split()
MAIN_NAMES = "article content post entry story body text main prose article-body post-content entry-content".split()

PATH_DIM, WORD_DIM, HIDDEN = 512, 1024, 24
N_COUNTS = 8
_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*>?|<\?[^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.S)
_ATTR = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_NAME = re.compile(r"[a-z]+")


@dataclass
class Block:
    text: str
    path: tuple[str, ...]
    names: tuple[str, ...]
    link_chars: int


def blocks(page: str | None) -> list[Block]:
    """Leaf blocks in page order. Character references decoded, white space
    inside a block to one space, trimmed; blocks without text left out, and the
    content of scripts, styles and other elements that don't show as text."""
    page = page or ""
    out: list[Block] = []
    path: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    links = open_link = 0
    at, end = 0, len(page)

    def flush():
        nonlocal parts, links
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                out.append(Block(text, tuple(t for t, _ in path), tuple(n for _, ns in path for n in ns), links))
            parts, links = [], 0

    while at < end:
        m = _TAG.search(page, at)
        if m is None or m.end() == m.start():
            parts.append(page[at:])
            break
        if m.start() > at:
            parts.append(page[at:m.start()])
            if open_link:
                links += m.start() - at
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if tag in INLINE:
            if tag == "a":
                open_link = 0 if m[1] else 1
            elif tag == "br":
                parts.append("\n")
            continue
        flush()
        if m[1]:
            for k in range(len(path) - 1, -1, -1):
                if path[k][0] == tag:
                    del path[k:]
                    break
            continue
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}\b[^>]*>?", re.I).search(page, at)
            at = close.end() if close else end
            continue
        if tag in CLOSES_P and path and path[-1][0] == "p" or tag == "li" and path and path[-1][0] == "li":
            path.pop()
        if tag in VOID or m[3].rstrip().endswith("/") and tag not in CLOSES_P:
            continue
        open_link = 0
        path.append((tag, _names(m[3])))
    flush()
    return out


@functools.lru_cache(maxsize=20_000)
def _names(attributes: str) -> tuple[str, ...]:
    got = []
    for key, a, b, c in _ATTR.findall(attributes):
        got += _NAME.findall((a or b or c or key).lower())
    return tuple(got)


@functools.lru_cache(maxsize=200_000)
def _bucket(word: str, dim: int) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) % dim


@functools.lru_cache(maxsize=20_000)
def _path_buckets(path: tuple[str, ...], names: tuple[str, ...]) -> np.ndarray:
    """The elements above a block, its nearest ones and its place under them, and the names they carry."""
    words = [f"t:{t}" for t in path] + [f"n:{n}" for n in names] + [f"l:{t}" for t in path[-1:]] + [f"b:{'/'.join(path[-2:])}"]
    return np.unique([_bucket(w, PATH_DIM) for w in words])


def vectors(page: list[Block]) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """Per block: buckets of the path, buckets of all words, counts."""
    counts = np.zeros((len(page), N_COUNTS))
    paths, words = [], []
    for k, b in enumerate(page):
        ws = b.text.lower().split()
        n = len(b.text)
        paths.append(_path_buckets(b.path, b.names))
        words.append(np.fromiter((_bucket(w, WORD_DIM) for w in ws), np.int64, len(ws)))
        counts[k] = (np.log1p(n) / 5, np.log1p(len(ws)) / 4, min(1.0, b.link_chars / n), b.text[-1] in ".!?:;\"", len(b.path) / 10,
                     k / max(1, len(page) - 1), n < 25, b.text[0].isupper())
    return paths, words, counts


# ------------------------------------------------------------- the network (numpy)

class Labeller:
    """Embeddings for paths and words, one LSTM layer each way, a logistic output."""

    def __init__(self, seed: int = 3):
        rng = np.random.default_rng(seed)
        d = 16 + 8 + N_COUNTS
        self.p = {"path": rng.normal(0, 0.3, (PATH_DIM, 16)), "word": rng.normal(0, 0.1, (WORD_DIM, 8)), "out": rng.normal(0, 0.2, 2 * HIDDEN),
                  "skip": np.zeros(d), "bias": np.zeros(1)}
        for way in "fb":
            self.p |= {f"w{way}": rng.normal(0, 1 / np.sqrt(d), (d, 4 * HIDDEN)),
                       f"u{way}": rng.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, 4 * HIDDEN)), f"c{way}": np.zeros(4 * HIDDEN)}
            self.p[f"c{way}"][HIDDEN:2 * HIDDEN] = 1.0

    def inputs(self, pages) -> tuple[np.ndarray, np.ndarray]:
        """(pages, blocks, values) with zeros after the last block, and lengths."""
        n = np.array([len(p[2]) for p in pages])
        x = np.zeros((len(pages), n.max(), 16 + 8 + N_COUNTS))
        for k, (paths, words, counts) in enumerate(pages):
            x[k, :n[k], :16] = _mean(self.p["path"], paths)
            x[k, :n[k], 16:24] = _mean(self.p["word"], words)
            x[k, :n[k], 24:] = counts
        return x, n

    def run(self, x: np.ndarray, n: np.ndarray):
        """Logits per block, and what the backward pass needs."""
        rows = np.arange(x.shape[1])
        there = rows < n[:, None]
        flip = np.where(there, n[:, None] - 1 - rows, rows)
        kept, hs = {}, []
        for way in "fb":
            z = x if way == "f" else np.take_along_axis(x, flip[..., None], 1)
            pre = z @ self.p[f"w{way}"] + self.p[f"c{way}"]
            h = c = np.zeros((len(x), HIDDEN))
            steps = []
            for t in range(x.shape[1]):
                g = pre[:, t] + h @ self.p[f"u{way}"]
                s = 1 / (1 + np.exp(-np.clip(g[:, :3 * HIDDEN], -30, 30)))
                i, f, o = s[:, :HIDDEN], s[:, HIDDEN:2 * HIDDEN], s[:, 2 * HIDDEN:]
                a = np.tanh(g[:, 3 * HIDDEN:])
                before, hb = c, h
                c = f * c + i * a
                tc = np.tanh(c)
                h = o * tc
                steps.append((i, f, o, a, before, tc, hb, h))
            out = np.stack([s[-1] for s in steps], 1)
            kept[way] = (z, steps)
            hs.append(out if way == "f" else np.take_along_axis(out, flip[..., None], 1))
        both = np.concatenate(hs, 2)
        return both @ self.p["out"] + x @ self.p["skip"] + self.p["bias"][0], (both, kept, flip, there)

    def logits(self, x: np.ndarray, n: np.ndarray, step: int = 2048) -> np.ndarray:
        """The logits of ``run`` alone: no states are kept, gates are made for ``step`` blocks at a time."""
        rows = np.arange(x.shape[1])
        flip = np.where(rows < n[:, None], n[:, None] - 1 - rows, rows)
        z = x @ self.p["skip"] + self.p["bias"][0]
        for k, way in enumerate("fb"):
            own = self.p["out"][k * HIDDEN:(k + 1) * HIDDEN]
            h = c = np.zeros((len(x), HIDDEN))
            told = np.empty(x.shape[:2])
            for at in range(0, x.shape[1], step):
                part = x[:, at:at + step] if way == "f" else np.take_along_axis(x, flip[:, at:at + step, None], 1)
                pre = part @ self.p[f"w{way}"] + self.p[f"c{way}"]
                for t in range(pre.shape[1]):
                    g = pre[:, t] + h @ self.p[f"u{way}"]
                    s = 1 / (1 + np.exp(-np.clip(g[:, :3 * HIDDEN], -30, 30)))
                    c = s[:, HIDDEN:2 * HIDDEN] * c + s[:, :HIDDEN] * np.tanh(g[:, 3 * HIDDEN:])
                    h = s[:, 2 * HIDDEN:] * np.tanh(c)
                    told[:, at + t] = h @ own
            z += told if way == "f" else np.take_along_axis(told, flip, 1)
        return z

    def gradients(self, pages, x, dlogit, kept, seen) -> dict[str, np.ndarray]:
        both, ways, flip, _ = kept
        g = {"out": np.einsum("pt,pth->h", dlogit, both), "skip": np.einsum("pt,ptd->d", dlogit, x), "bias": np.array([dlogit.sum()])}
        dx = dlogit[..., None] * self.p["skip"]
        for k, way in enumerate("fb"):
            z, steps = ways[way]
            dout = dlogit[..., None] * self.p["out"][k * HIDDEN:(k + 1) * HIDDEN]
            if way == "b":
                dout = np.take_along_axis(dout, flip[..., None], 1)
            dh = dc = np.zeros((len(x), HIDDEN))
            du, dpre = np.zeros_like(self.p[f"u{way}"]), np.zeros((len(x), x.shape[1], 4 * HIDDEN))
            for t in range(x.shape[1] - 1, -1, -1):
                i, f, o, a, before, tc, hb, _ = steps[t]
                dh = dh + dout[:, t]
                dc = dc + dh * o * (1 - tc * tc)
                dg = np.concatenate([dc * a * i * (1 - i), dc * before * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - a * a)], 1)
                dpre[:, t] = dg
                du += hb.T @ dg
                dh, dc = dg @ self.p[f"u{way}"].T, dc * f
            g |= {f"w{way}": np.einsum("ptd,ptg->dg", z, dpre), f"u{way}": du, f"c{way}": dpre.sum((0, 1))}
            back = dpre @ self.p[f"w{way}"].T
            dx = dx + (back if way == "f" else np.take_along_axis(back, flip[..., None], 1))
        dx[..., 16:24] *= seen
        for name, at, width in (("path", 0, 16), ("word", 16, 8)):
            g[name] = np.zeros_like(self.p[name])
            for k, page in enumerate(pages):
                for t, idx in enumerate(page[0] if name == "path" else page[1]):
                    if len(idx):
                        np.add.at(g[name], idx, dx[k, t, at:at + width] / len(idx))
        return g

    def fit(self, pages, labels, epochs: int, batch: int = 16, seed: int = 4) -> None:
        """Adam on the cross entropy of all blocks."""
        rng = np.random.default_rng(seed)
        m, v, t = {k: 0.0 for k in self.p}, {k: 0.0 for k in self.p}, 0
        for epoch in range(epochs):
            order = sorted(rng.permutation(len(pages)), key=lambda k: len(labels[k]) + rng.normal(0, 3))
            groups = [order[k:k + batch] for k in range(0, len(order), batch)]
            for k in rng.permutation(len(groups)):
                own = [pages[j] for j in groups[k]]
                x, n = self.inputs(own)
                # Words are hidden from most blocks in training: they must not outweigh place and path.
                seen = (rng.random(x.shape[:2]) < 0.3)[..., None]
                x[..., 16:24] *= seen
                z, kept = self.run(x, n)
                y = np.zeros_like(z)
                for r, j in enumerate(groups[k]):
                    y[r, :n[r]] = labels[j]
                p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
                d = np.where(kept[3], p - y, 0) / len(own)
                t += 1
                for name, grad in self.gradients(own, x, d, kept, seen).items():
                    grad = np.clip(grad, -5, 5)
                    m[name] = 0.9 * m[name] + 0.1 * grad
                    v[name] = 0.999 * v[name] + 0.001 * grad * grad
                    self.p[name] = self.p[name] - 5e-3 * (0.5 if epoch > epochs * 0.6 else 1) * (m[name] / (1 - 0.9 ** t)) / (np.sqrt(v[name] / (1 - 0.999 ** t)) + 1e-8)

    def main(self, pages) -> list[np.ndarray]:
        """Per page, which blocks are main text. Pages of like length run together."""
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        order = sorted((k for k in range(len(pages)) if len(pages[k][2])), key=lambda k: len(pages[k][2]))
        at = 0
        while at < len(order):
            # As many pages as keep the padded batch below 4096 blocks; a longer page runs alone.
            to = at + 1
            while to < len(order) and (to + 1 - at) * len(pages[order[to]][2]) <= 4096:
                to += 1
            group = order[at:to]
            x, n = self.inputs([pages[k] for k in group])
            z = self.logits(x, n)
            for r, k in enumerate(group):
                out[k] = z[r, :n[r]] > 0
            at = to
        return out


def _mean(table: np.ndarray, index: list[np.ndarray]) -> np.ndarray:
    """Mean of the rows of each index list; zeros for an empty one."""
    sizes = np.array([len(i) for i in index])
    out = np.zeros((len(index), table.shape[1]))
    full = sizes > 0
    if full.any():
        flat = table[np.concatenate([i for i in index if len(i)])]
        begins = np.concatenate(([0], np.cumsum(sizes[full])[:-1]))
        out[full] = np.add.reduceat(flat, begins, axis=0) / sizes[full][:, None]
    return out


# ------------------------------------------------------------- training pages

def said(b: Block) -> bool | None:
    """What a block's own elements say of it: main text, other, or nothing."""
    if set(b.path) & OTHER_TAGS or set(b.names) & set(OTHER_NAMES):
        return False
    return True if set(b.path) & MAIN_TAGS or set(b.names) & set(MAIN_NAMES) else None


def layouts(main: list[list[str]], other: list[str], count: int, seed: int) -> tuple[list[str], list[list[int]]]:
    """Random page layouts: source and the label of each block."""
    rng = np.random.default_rng(seed)
    pick = lambda xs: xs[rng.integers(len(xs))]
    esc = html.escape
    sources, labels = [], []
    wrap = [("nav", "", "menu"), ("div", "nav", "menu"), ("ul", "menu", "menu"), ("header", "", "head"), ("div", "header", "head"),
            ("div", "masthead", "head"), ("aside", "", "text"), ("div", "sidebar", "text"), ("div", "widget", "text"), ("div", "ad", "text"),
            ("div", "banner", "text"), ("section", "promo", "text"), ("div", "sponsor", "text"), ("div", "cookie-notice", "text"),
            ("div", "notice", "text"), ("div", "alert", "text"), ("div", "popup", "text"), ("form", "", "form"), ("form", "search", "form"),
            ("div", "newsletter", "form"), ("div", "related", "menu"), ("div", "share", "menu"), ("div", "breadcrumb", "menu")]
    after = [("footer", "", "foot"), ("div", "footer", "foot"), ("section", "comments", "talk"), ("div", "comments", "talk"),
             ("ol", "comment-list", "talk"), ("div", "copyright", "foot"), ("div", "pagination", "menu"), ("aside", "related", "menu")]

    def box(tag, name, kind):
        attr = f' {pick(["class", "class", "id"])}="{name}"' if name else ""
        some = [pick(other) for _ in range(int(rng.integers(1, 5)))]
        if kind == "menu":
            words = " ".join(some).split()[:int(rng.integers(2, 9))] or ["x"]
            item = "li" if tag == "ul" or rng.random() < 0.5 else "div"
            body = "".join(f'<{item}><a href="/{k}">{esc(w)}</a></{item}>' for k, w in enumerate(words))
            texts = words
        elif kind == "form":
            texts = [some[0][:60]]
            body = f'<p>{esc(texts[0])}</p><input name="q"><button>{esc(some[-1][:12])}</button>'
        elif kind == "talk":
            texts = [x for s in some for x in (s.split()[0] if s.split() else "x", pick(pick(main)))]
            body = "".join(f'<div class="comment"><b>{esc(a)}</b><p>{esc(b)}</p></div>' for a, b in zip(texts[::2], texts[1::2]))
        else:
            texts = some if kind == "text" else some[:1]
            body = "".join(f"<p>{esc(x)}</p>" for x in texts) if rng.random() < 0.6 or len(texts) > 1 else esc(texts[0])
            if kind == "foot":
                body = "&copy; " + body
        return f"<{tag}{attr}>{body}</{tag}>"

    for _ in range(count):
        paras = pick(main)
        tag, name = pick([("article", ""), ("article", ""), ("main", ""), ("div", "content"), ("div", "post"), ("div", "entry-content"),
                          ("div", "article-body"), ("section", "story"), ("div", ""), ("div", "main")])
        before = [box(*pick(wrap)) for _ in range(int(rng.integers(0, 5)))]
        behind = [box(*pick(wrap if rng.random() < 0.3 else after)) for _ in range(int(rng.integers(0, 4)))]
        inner = [f"<{pick(['h1', 'h2'])}>{esc(paras[0][:60])}</h1>"] if rng.random() < 0.7 else []
        inner += [f"<p>{esc(x)}</p>" if rng.random() < 0.85 else f"<p><b>{esc(x)}<br>" if rng.random() < 0.6 else
                  pick(["<li>{}</li>", "<blockquote>{}</blockquote>", "<div>{}</div>", "<h3>{}</h3>"]).format(esc(x)) for x in paras]
        if rng.random() < 0.25:  # something else in the midst of the text
            inner.insert(int(rng.integers(len(inner) + 1)), box(*pick([("aside", "", "text"), ("div", "ad", "text"), ("div", "related", "menu")])))
        attr = f' class="{name}"' if name else ""
        source = "".join(before) + f"<{tag}{attr}>" + "".join(inner) + f"</{tag}>" + "".join(behind)
        own = blocks(source)
        want = {" ".join(html.unescape(x).split()) for x in [paras[0][:60], *paras]}
        inside = _inside(own, tag, name)
        sources.append(source)
        labels.append([int(i and b.text in want and said(b) is not False) for b, i in zip(own, inside)])
    return sources, labels


def _inside(own: list[Block], tag: str, name: str) -> list[bool]:
    """Which blocks stand in the element that holds the text."""
    return [bool(b.path) and b.path[0] == tag and (not name or set(_NAME.findall(name)) <= set(b.names)) for b in own]


def fit(sample: list[str], count: int = 500, epochs: int = 8, seed: int = 6) -> Labeller:
    """A labeller trained on a bounded sample of pages: on those whose elements
    all say what they are, and on ``count`` random layouts of their blocks."""
    parsed = [blocks(p) for p in sample]
    own = [(p, [said(b) for b in p]) for p in parsed]
    main = [[b.text for b, y in zip(p, ys) if y] for p, ys in own]
    main = [m for m in main if m] or [[b.text for b in p] for p in parsed if p] or [["A text."]]
    other = [b.text for p, ys in own for b, y in zip(p, ys) if y is False] or [t for m in main for t in m]
    sources, labels = layouts(main, other, count, seed)
    train = [(blocks(x), y) for x, y in zip(sources, labels)]
    train += [(p, [int(y) for y in ys]) for p, ys in own if None not in ys]
    train = [(p, y) for p, y in train if p]
    net = Labeller()
    net.fit([vectors(p) for p, _ in train], [np.array(y) for _, y in train], epochs)
    return net


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", sample_pages: int = 250, **params) -> DataFrame:
    """``pages`` with ``text``, the main text (its blocks joined by line breaks
    in page order, empty if there is none), and ``n_blocks``, the number of
    blocks that the page has in all.

    ``sample_pages`` bounds the pages that train the labeller (those of
    smallest id hash); every page is labelled, whole. A null html counts as
    empty. Rows that repeat an id all come back; columns named ``text`` or
    ``n_blocks`` are replaced, other extra columns pass through. An empty table
    gives an empty result.
    """
    base = pages.select(*[F.col(f"`{c}`") for c in pages.columns if c.lower() not in ("text", "n_blocks")])
    schema = T.StructType([*base.schema, T.StructField("text", T.StringType()), T.StructField("n_blocks", T.IntegerType())])
    # First the ids, then their pages: no more than sample_pages texts meet in one task.
    ids = base.select(F.col(id_col).alias("id")).where("id is not null").distinct().orderBy(F.xxhash64("id"), "id").limit(sample_pages)
    picked = base.select(F.col(id_col).alias("id"), F.col(html_col).alias("html")).join(F.broadcast(ids), "id")
    net = fit([r["html"] or "" for r in picked.dropDuplicates(["id"]).orderBy(F.xxhash64("id"), "id").collect()], **params)
    at = base.columns.index(html_col)

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        own = [blocks(p) for p in b.column(at).to_pylist()]
        keep = net.main([vectors(p) for p in own])
        text = ["\n".join(x.text for x, k in zip(p, ks) if k) for p, ks in zip(own, keep)]
        return pa.RecordBatch.from_arrays([*b.columns, pa.array(text, pa.string()), pa.array([len(p) for p in own], pa.int32())],
                                          names=[f.name for f in schema])

    return arrow_map(base, run, schema)
