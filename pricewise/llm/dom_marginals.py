"""HTML extraction: a tree-structured graphical model over the DOM.

Every block element and every text block of a page is a binary variable, main
text or not; potentials come from the node itself and from each parent-child
pair. The page is a tree, so sum-product message passing, once upward and once
downward, gives exact marginals; text blocks above one half are the main text.
The weights maximise the likelihood of labelled pages, whose gradient takes the
same marginals. Pages are passed side by side, depth by depth, in numpy.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricewise.llm.common import sub_batches
from pricewise.llm.labelled_pages import labelled_pages
from pricewise.llm.page_tree import Tree, read_page

# Labelled pages used for fitting.
MAX_TRAIN_PAGES = 1_000

TAGS = """html body main article section div header footer nav aside form p h1 h2 h3 h4 h5 h6 ul ol li dl dd dt table
tr td th tbody blockquote pre figure figcaption address details summary menu fieldset hr""".split()
_TAG = {t: i for i, t in enumerate(TAGS)}

# What class, id and role names say (fixed values): words and beginnings (ending in *) a group.
HINTS = {
    "menu": "nav* menu* breadcrumb* pager pagination toc topmenu tabs toolbar skip",
    "header": "header masthead branding topbar top head banner logo hero",
    "footer": "footer foot bottom colophon copyright* legal imprint credits",
    "side": "side* aside widget* rail secondary complementary column",
    "ad": "ad ads adv advert* adsense adsbygoogle adslot dfp sponsor* promo* banner commercial",
    "notice": "cookie* notice* alert* consent gdpr popup modal dialog message* announcement* warning* overlay",
    "talk": "comment* commentlist repl* respon* disqus* discussion* thread feedback review*",
    "form": "form* subscribe* newsletter* search* login signup contact register",
    "more": "related recommend* more read next trending popular teaser* latest",
    "share": "share* social* follow*",
    "main": "content* article* post* entry* story main body text copy",
    "byline": "byline author meta date",
    "wrap": "wrap* container* page site inner row col grid layout outer",
}
_GROUPS = list(HINTS)
_EXACT = {w: i for i, g in enumerate(_GROUPS) for w in HINTS[g].split() if w[-1] != "*"}
_BEGIN = [(w[:-1], i) for i, g in enumerate(_GROUPS) for w in HINTS[g].split() if w[-1] == "*"]
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

_WORDS = np.array([1, 2, 4, 7, 12, 25, 60])
_DENSITY = np.array([1e-9, 0.15, 0.4, 0.7, 0.95])
_SHARE = np.array([0.01, 0.05, 0.2, 0.5, 0.8])
_PLACE = np.array([0.05, 0.15, 0.4, 0.7, 0.9])
_MEAN = np.array([2.0, 5, 10, 20, 50])
_DEPTH = np.array([1, 2, 3, 4, 6, 9])
_ALIKE = np.array([1, 2, 4, 8])
_KIND = {t: 1 for t in "p h1 h2 h3 h4 h5 h6 pre blockquote figcaption figure".split()}
_KIND.update({t: 2 for t in "ul ol li dl dd dt table tbody tr td th".split()})
_KIND.update({t: 3 for t in "main article section div".split()})
N_EDGES = 5 * 2 * 2


@lru_cache(maxsize=65536)
def hints(names: str) -> int:
    """Groups, as bits, that an element's class, id and role names belong to."""
    bits = 0
    for w in _NAME.findall(names):
        w = w.lower()
        if w in _EXACT:
            bits |= 1 << _EXACT[w]
        for begin, i in _BEGIN:
            if w.startswith(begin):
                bits |= 1 << i
    return bits


@dataclass
class Pages:
    """Trees of several pages side by side, without elements that hold no text. ``text`` is
    None for elements; ``page`` the page of each node."""

    parent: np.ndarray
    depth: np.ndarray
    page: np.ndarray
    text: list[str | None]
    x: np.ndarray
    edge: np.ndarray

    @property
    def leaf(self) -> np.ndarray:
        return np.array([t is not None for t in self.text], bool)


def _one_hot(values: np.ndarray, n: int, where: np.ndarray) -> np.ndarray:
    out = np.zeros((len(values), n), np.float32)
    out[np.flatnonzero(where), values[where]] = 1
    return out


def pages_of(trees: list[Tree]) -> Pages:
    """Nodes with text of all trees, their features and the kinds of their parent edges."""
    sizes = np.array([len(t.parent) for t in trees], np.int64)
    base = np.repeat(np.cumsum(sizes) - sizes, sizes)
    parent = np.concatenate([np.array(t.parent, np.int64) for t in trees] or [np.zeros(0, np.int64)])
    parent = np.where(parent < 0, -1, parent + base)
    depth = np.concatenate([np.array(t.depth, np.int64) for t in trees] or [np.zeros(0, np.int64)])
    page = np.repeat(np.arange(len(trees)), sizes)
    tag = [g for t in trees for g in t.tag]
    text = [s for t in trees for s in t.text]
    leaf = np.array([not g for g in tag], bool)
    # nodes are in page order, so a subtree is a run: it ends where a node as high follows
    full = leaf.copy()
    for d in range(int(depth.max()) if len(depth) else 0, 0, -1):
        at = np.flatnonzero((depth == d) & full)
        full[parent[at]] = True
    keep = np.flatnonzero(full)
    new = np.cumsum(full) - 1
    parent = np.where(parent[keep] < 0, -1, new[parent[keep]])
    depth, page, leaf = depth[keep], page[keep], leaf[keep]
    tag, text = [tag[i] for i in keep], [text[i] for i in keep]
    names = [s for t in trees for s in t.names]
    names = [names[i] for i in keep]
    linked = np.array([n for t in trees for n in t.linked], np.int64)[keep] if len(keep) else np.zeros(0, np.int64)
    bits = np.array([hints(s) if s else 0 for s in names], np.int64)
    x = _features(parent, depth, page, tag, text, names, linked, leaf, bits)
    kind = np.array([0 if not g else _KIND.get(g, 4) for g in tag], np.int64)
    over = np.where(parent < 0, 0, np.where(np.isin(kind[parent], (3, 4)), 1, 0)) if len(keep) else kind
    named = (bits & ~(1 << _GROUPS.index("wrap"))) != 0
    return Pages(parent, depth, page, [s if f else None for s, f in zip(text, leaf)], x, (kind * 2 + named) * 2 + over)


def _features(parent, depth, page, tag, text, names, linked, leaf, bits) -> np.ndarray:
    n = len(parent)
    if not n:
        return np.zeros((0, 0), np.float32)
    own = lambda f: np.array([f(s) if s else 0 for s in text], np.float64)
    stats = np.stack([own(len), own(lambda s: s.count(" ") + 1), linked.astype(float), leaf.astype(float),
                      own(lambda s: s[-1] in ".!?…。"), own(lambda s: "©" in s),
                      np.array([g == "h1" for g in tag], float)], 1)
    first = np.searchsorted(page, np.arange(page[-1] + 1))
    for d in range(int(depth.max()), 0, -1):
        at = np.flatnonzero(depth == d)
        np.add.at(stats, parent[at], stats[at])
    chars, words, link, blocks, ends, rights, heads = stats.T
    total = words[first][page]
    before = np.cumsum(np.where(leaf, words, 0)) - np.where(leaf, words, 0)
    place = (before - before[first][page]) / np.maximum(total, 1)
    is_h1 = np.array([g == "h1" for g in tag], float)
    seen = np.cumsum(is_h1) - is_h1
    after = seen - seen[first][page] > 0
    # siblings of the same tag and names
    like: dict = {}
    mine = [like.setdefault(k, len(like)) for k in zip(parent.tolist(), tag, names)]
    alike = np.bincount(mine)[mine]
    above = bits[np.maximum(parent, 0)]
    # the only element of its tag on the page
    here = page * (len(TAGS) + 1) + np.array([_TAG.get(g, len(TAGS)) for g in tag], np.int64)
    alone = (np.bincount(here)[here] == 1) & np.isin(tag, ["article", "main", "h1"])
    tags = np.array([_TAG.get(g, len(TAGS)) for g in tag], np.int64)
    groups = lambda b: ((b[:, None] >> np.arange(len(_GROUPS))) & 1).astype(np.float32)
    cut = lambda v, e, where: _one_hot(np.searchsorted(e, v, side="right"), len(e) + 1, where)
    every, inner = np.ones(n, bool), ~leaf
    return np.concatenate([
        np.ones((n, 1), np.float32), leaf[:, None], _one_hot(tags, len(TAGS) + 1, inner),
        _one_hot(tags[np.maximum(parent, 0)], len(TAGS) + 1, leaf),
        _one_hot(tags, len(TAGS) + 1, inner & alone)[:, [_TAG["article"], _TAG["main"], _TAG["h1"]]], groups(bits),
        groups(np.where(leaf, above, 0)),
        cut(words, _WORDS, leaf), cut(words, _WORDS, inner), cut(link / np.maximum(chars, 1), _DENSITY, leaf),
        cut(link / np.maximum(chars, 1), _DENSITY, inner), cut(words / np.maximum(blocks, 1), _MEAN, inner),
        cut(ends / np.maximum(blocks, 1), _SHARE, inner), cut(words / np.maximum(total, 1), _SHARE, inner),
        cut(place, _PLACE, every), cut(depth, _DEPTH, inner), cut(alike, _ALIKE, inner),
        np.stack([leaf & (ends > 0), leaf & (rights > 0), inner & (rights > 0), inner & (heads > 0), after & leaf,
                  after & inner, (tags == _TAG["form"]) & (heads == 0)], 1)], axis=1, dtype=np.float32)


# ------------------------------------------------------------------ sum-product

def marginals(unary: np.ndarray, pair: np.ndarray, parent: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact marginals of a forest of binary variables.

    Nodes are in page order (parents first, a parent's children neighbours in their depth).
    ``unary`` (nodes, 2) and ``pair`` (nodes, 2, 2: state of the parent, of the node) are log
    potentials; a root's pair is not read. Returns P(node) as (nodes, 2) and P(parent, node)
    as (nodes, 2, 2), zero for roots.
    """
    # nodes level after level, so that every level is a slice
    order = np.argsort(depth, kind="stable")
    cuts = np.searchsorted(depth[order], np.arange(int(depth.max()) + 2)) if len(depth) else np.zeros(1, int)
    levels = [slice(a, b) for a, b in zip(cuts[:-1], cuts[1:])]
    back = np.empty(len(order), np.int64)
    back[order] = np.arange(len(order))
    above = back[np.maximum(parent[order], 0)]
    pair = pair[order]
    inside = unary[order].astype(float)       # own potential and all messages from below
    up = np.zeros_like(inside)                # message to the parent
    for at in reversed(levels[1:]):
        both = inside[at][:, None, :] + pair[at]
        up[at] = _log_sum(both[..., 0], both[..., 1])
        # in page order the children of one parent are neighbours in their level
        first = np.flatnonzero(np.diff(above[at], prepend=-1))
        inside[above[at][first]] += np.add.reduceat(up[at], first)
    joint = np.zeros((len(order), 2, 2))
    for at in levels[1:]:
        # the parent with its message from above, without this child's message
        both = inside[above[at]] - up[at]
        both = both[:, :, None] + pair[at] + inside[at][:, None, :]
        inside[at] = _log_sum(both[:, 0], both[:, 1])
        joint[at] = both
    if levels:
        rest = joint[levels[0].stop:]
        high = np.maximum(np.maximum(rest[:, 0, 0], rest[:, 0, 1]), np.maximum(rest[:, 1, 0], rest[:, 1, 1]))
        np.exp(rest - high[:, None, None], out=rest)
        rest /= (rest[:, 0, 0] + rest[:, 0, 1] + rest[:, 1, 0] + rest[:, 1, 1])[:, None, None]
    one = 1 / (1 + np.exp(np.clip(inside[:, 0] - inside[:, 1], -700, 700)))
    return np.stack([1 - one, one], 1)[back], joint[back]


def _log_sum(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    high = np.maximum(a, b)
    return high + np.log1p(np.exp(-np.abs(a - b)))


@dataclass
class Model:
    node: np.ndarray   # weight of each feature for main text
    pair: np.ndarray   # (kinds of edge, 2, 2)

    def marginals(self, pages: Pages) -> tuple[np.ndarray, np.ndarray]:
        score = (pages.x @ self.node.astype(np.float32)).astype(float)
        return marginals(np.stack([np.zeros_like(score), score], 1), self.pair[pages.edge], pages.parent, pages.depth)


def fit(pages: Pages, y: np.ndarray, *, rounds: int = 150, rate: float = 0.15, l2: float = 1e-4) -> Model:
    """Maximum likelihood by gradient ascent with momentum per weight: the gradient is what the
    labels show less what the marginals expect."""
    model = Model(np.zeros(pages.x.shape[1]), np.zeros((N_EDGES, 2, 2)))
    inner = pages.parent >= 0
    shown = np.zeros((N_EDGES, 2, 2))
    np.add.at(shown, (pages.edge[inner], y[pages.parent[inner]], y[inner]), 1)
    n = max(len(y), 1)
    moves = [np.zeros_like(model.node), np.zeros_like(model.pair)]
    sizes = [np.zeros_like(model.node), np.zeros_like(model.pair)]
    for t in range(1, rounds + 1):
        p, joint = model.marginals(pages)
        expected = np.stack([np.bincount(pages.edge, joint[:, a, b], N_EDGES) for a in (0, 1) for b in (0, 1)],
                            1).reshape(N_EDGES, 2, 2)
        for w, g, m, s in zip((model.node, model.pair), ((y - p[:, 1]).astype(np.float32) @ pages.x, shown - expected), moves, sizes):
            g = g / n - l2 * w
            m += 0.1 * (g - m)
            s += 0.001 * (g * g - s)
            w += rate * (m / (1 - 0.9 ** t)) / (np.sqrt(s / (1 - 0.999 ** t)) + 1e-8)
    return model


# ------------------------------------------------------------------ Spark

def labels(tree: Tree, main: str | None) -> list[int]:
    """Per node of a labelled page: text blocks found, in page order, among the blocks of its
    main text are main text; an element is if most of its text is."""
    want = [" ".join(entities.unescape(b).split()) for b in (main or "").split("\n\n")]
    want, at = [w for w in want if w], 0
    got, all_ = [0] * len(tree.tag), [0] * len(tree.tag)
    for i, g in enumerate(tree.tag):
        if not g:
            all_[i] = len(tree.text[i])
            if at < len(want) and tree.text[i] == want[at]:
                got[i], at = all_[i], at + 1
    for i in range(len(tree.tag) - 1, 0, -1):
        got[tree.parent[i]] += got[i]
        all_[tree.parent[i]] += all_[i]
    return [int(2 * a >= b > 0) for a, b in zip(got, all_)]


def train(labelled: DataFrame, *, max_pages: int = MAX_TRAIN_PAGES, **params) -> Model:
    """Fit on at most ``max_pages`` rows of ``labelled`` (page_id, html, text: main text blocks
    joined by two line ends), the first in the order of a hash of the id.

    Pages are read in tasks; trees of the sample alone reach the driver. Null pages have no
    nodes; without any page all marginals are one half.
    """
    sample = (labelled.select(F.col("page_id").alias("_id"), "html", "text")
              .orderBy(F.xxhash64("_id"), "_id", "html").limit(max_pages))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = b.to_pylist()
            trees = [read_page(r["html"]) for r in rows]
            yield pa.record_batch(
                [pa.array([r["_id"] for r in rows], b.schema.field("_id").type),
                 *[pa.array([getattr(t, f) for t in trees], pa.list_(a)) for f, a in _FIELDS],
                 pa.array([labels(t, r["text"]) for t, r in zip(trees, rows)], pa.list_(pa.int64()))],
                names=["_id", *[f for f, _ in _FIELDS], "y"])

    kind = sample.schema["_id"].dataType.simpleString()
    schema = f"_id {kind}, " + ", ".join(f"{f} array<{'string' if pa.types.is_string(a) else 'long'}>" for f, a in _FIELDS)
    got = sample.mapInArrow(run, schema + ", y array<long>").toArrow().to_pylist()
    got.sort(key=lambda r: (str(r["_id"]), r["text"]))
    trees = [Tree(**{f: r[f] for f, _ in _FIELDS}) for r in got]
    pages = pages_of(trees)
    if not len(pages.parent):
        return Model(np.zeros(pages_of([read_page("<p>x")]).x.shape[1]), np.zeros((N_EDGES, 2, 2)))
    y = np.concatenate([np.array(r["y"], np.int64)[_with_text(t)] for r, t in zip(got, trees)])
    return fit(pages, y, **params)


_FIELDS = [("parent", pa.int64()), ("depth", pa.int64()), ("tag", pa.string()), ("names", pa.string()),
           ("text", pa.string()), ("linked", pa.int64())]


def _with_text(t: Tree) -> np.ndarray:
    full = np.array([not g for g in t.tag], bool)
    for i in range(len(t.tag) - 1, 0, -1):
        full[t.parent[i]] |= full[i]
    return full


def default_model(spark: SparkSession, max_pages: int = MAX_TRAIN_PAGES) -> Model:
    """The model of the invented labelled pages, fitted anew (no stored weights)."""
    return train(labelled_pages(spark, max_pages), max_pages=max_pages)


def extract(pages: DataFrame, model: Model, *, id_col: str = "page_id", html_col: str = "html",
            keep: tuple[str, ...] = ("url",), at_least: float = 0.5) -> DataFrame:
    """One row per row of ``pages``: id, the ``keep`` columns, text, n_chars (code points).

    ``text`` are the text blocks whose marginal reaches ``at_least``, in page order, white
    space in a block as one space, joined by two line ends. Null, empty and textless pages
    give an empty text; repeated rows are extracted alike; a page is judged by itself, so its
    place in the table does not matter. Other columns are not read. One map pass over whole
    pages, no shuffle; a task holds the trees of about 1 MB of markup, or of one page.
    """
    names = [f"_c{i}" for i in range(len(keep) + 1)]
    src = pages.select(F.col(f"`{html_col}`").alias("_html"),
                       *[F.col(f"`{c}`").alias(n) for c, n in zip((id_col, *keep), names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in sub_batches(whole, "_html", max_bytes=1 << 20, max_rows=1024):
                got = pages_of([read_page(h) for h in b.column("_html").to_pylist()])
                chosen: list[list[str]] = [[] for _ in range(b.num_rows)]
                if len(got.parent):
                    p, _ = model.marginals(got)
                    for i in np.flatnonzero(got.leaf & (p[:, 1] >= at_least)):
                        chosen[got.page[i]].append(got.text[i])
                text = ["\n\n".join(c) for c in chosen]
                yield pa.record_batch([*[b.column(n) for n in names], pa.array(text, pa.string()),
                                       pa.array([len(t) for t in text], pa.int64())], names=[*names, "text", "n_chars"])

    schema = ", ".join(f"{n} {src.schema[n].dataType.simpleString()}" for n in names)
    out = src.mapInArrow(run, schema + ", text string, n_chars long")
    return out.select(*[F.col(n).alias(c) for c, n in zip((id_col, *keep), names)], "text", "n_chars")
