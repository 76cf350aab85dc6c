"""Fill-in-middle, Merkle manifest and HTML extraction against brute force and on odd tables."""

import hashlib
import html
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricewise.llm import dom_marginals, fim_skiplist, labelled_pages, merkle_paths, page_tree, queries
from tests.conftest import SF001
from tests.llm.test_corpus_operators import ODD, documents, odd, tuples  # noqa: F401


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


# ------------------------------------------------------------------ 11 fill-in-middle

UNIT = re.compile("[\x20\x09-\x0d]*[^\x20\x09-\x0d]+|[\x20\x09-\x0d]+")
FIM = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]


def brute_fim(doc_id, text, rate=50):
    text = text or ""
    units = UNIT.findall(text)
    d = sha(f"42:{'' if doc_id is None else doc_id}")
    h = [int(d[8 * i:8 * i + 8], 16) for i in range(4)]
    lo, hi = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:lo]), "".join(units[lo:hi]), "".join(units[hi:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return doc_id, len(units), "plain", None, None, sha(text), sha(text)
    spm = h[3] % 100 < 80
    out = f"<S>{s}<P>{p}<M>{m}" if spm else f"<P>{p}<S>{s}<M>{m}"
    return doc_id, len(units), "spm" if spm else "psm", len(p), len(m), sha(out), sha(text)


def test_fim_query(spark, documents):
    rows = documents.select("doc_id", "text").collect()
    got = tuples(queries.QUERIES["op11_fill_in_middle"](spark, SF001), *FIM)
    assert got == sorted((brute_fim(*r) for r in rows), key=repr)
    assert {g[2] for g in got} == {"plain", "spm", "psm"}


@pytest.mark.parametrize("rate", [50, 100])
def test_fim_odd_rows(spark, odd, rate):
    got = tuples(fim_skiplist.digests(odd, rate=rate), *FIM)
    assert got == sorted((brute_fim(r[0], r[1], rate) for r in ODD), key=repr)
    assert fim_skiplist.digests(odd.limit(0)).count() == 0


def test_fim_tricky_texts(spark):
    rng = random.Random(5)
    parts = ["<", "P>", "<S", ">", "<M", "\n", "  ", "\x0b", "é", "日本", "a", "😀", " ", "\x1c", "word"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(400)]
    texts += ["<P>", "a <S> b", " ", "x", "x ", " x", " ", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = tuples(fim_skiplist.digests(df, rate=100), *FIM)
    assert got == sorted((brute_fim(i, t, 100) for i, t in enumerate(texts)), key=repr)
    assert sum(g[2] != "plain" for g in got) > 200


def test_descent_reaches_every_rank():
    rng = np.random.default_rng(1)
    counts = np.array([0, 1, 3, 700, 0, 64, 5000])
    widths = rng.integers(1, 9, counts.sum())
    lists = fim_skiplist.SkipLists(widths, counts)
    ends = np.concatenate(([0], np.cumsum(counts)))
    assert len(lists.lanes) > 4
    for _ in range(60):
        rank = np.array([rng.integers(0, c + 1) for c in counts])
        want = [widths[ends[i]:ends[i] + r].sum() for i, r in enumerate(rank)]
        assert lists.descend(rank).tolist() == want
    assert lists.descend(counts).tolist() == [widths[ends[i]:ends[i + 1]].sum() for i in range(len(counts))]
    with pytest.raises(ValueError):
        lists.descend(counts + 1)


# ------------------------------------------------------------------ 12 Merkle manifest

AUDIT = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def brute_leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def brute_paths(nodes):
    """(root, per node its siblings as (left, right) level by level)."""
    place, paths = list(range(len(nodes))), [[] for _ in nodes]
    while len(nodes) > 1:
        for i, p in enumerate(place):
            s = p - p % 3
            paths[i].append((nodes[s:p], nodes[p + 1:s + 3]))
            place[i] = p // 3
        nodes = [sha("".join(nodes[i:i + 3])) for i in range(0, len(nodes), 3)]
    return nodes[0], paths


def brute_audit(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""
    trees = {}
    for r in rows:
        trees.setdefault(r[1], []).append(r)
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    built, subroots = {}, []
    for s in order:
        trees[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, brute_leaf(r)))
        built[s] = brute_paths([brute_leaf(r) for r in trees[s]])
        subroots.append(built[s][0])
    root, top = brute_paths(subroots)
    for s, above in zip(order, top):
        for r, path in zip(trees[s], built[s][1]):
            path = path + above
            other = r
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None:
                other = (*r[:4], r[4].replace("\n", ""))
            h = brute_leaf(other)
            for left, right in path:
                h = sha("".join([*left, h, *right]))
            proof = sha("".join("".join(a + b) for a, b in path))
            yield r[0], brute_leaf(r), built[s][0], root, proof, h, h == root


def test_merkle_query(spark, documents):
    rows = [tuple(r) for r in documents.select(*merkle_paths.COLUMNS).collect()]
    got = tuples(queries.QUERIES["op12_merkle_manifest"](spark, SF001), *AUDIT)
    assert got == sorted(brute_audit(rows), key=repr)
    assert {g[-1] for g in got} == {True, False}


@pytest.mark.parametrize("height", [1, 2, 7])
def test_merkle_odd_rows_and_small_blocks(spark, odd, height):
    df = odd.select("doc_id", "source", F.lit(None).cast("string").alias("lang"), F.length("text").cast("long").alias("n_chars"),
                    "text", *[c for c in odd.columns if c not in ("doc_id", "source", "text")])
    more = spark.range(40).selectExpr("id as doc_id", "case when id < 25 then 'hot' else concat('s', id) end as source",
                                      "'x' as lang", "id as n_chars", "concat('a\\n', id, '\\nb') as text")
    df = df.unionByName(more, allowMissingColumns=True)
    rows = [tuple(r) for r in df.select(*merkle_paths.COLUMNS).collect()]
    got = tuples(merkle_paths.audit(df, height=height), *AUDIT)
    assert got == sorted(brute_audit(rows), key=repr)


def test_merkle_empty_single_and_copies(spark):
    empty = spark.createDataFrame([], "doc_id long, source string, lang string, n_chars long, text string")
    assert merkle_paths.manifest(empty).count() == 0
    one = spark.createDataFrame([(0, None, None, None, "a\nb")], empty.schema)
    (r,) = merkle_paths.manifest(one).collect()
    assert r.leaf == r.subroot == r.root and r.proof == [] and len(r.copied) == 1
    same = spark.createDataFrame([(1, "a", "x", 1, "t")] * 10, empty.schema)
    got = merkle_paths.manifest(same).collect()
    assert len(got) == 10 and len({r.root for r in got}) == 1 and {len(r.copied) for r in got} == {4}


def test_versions_share_untouched_nodes():
    leaves = [hashlib.sha256(bytes([i])).digest() for i in range(20)]
    tree = merkle_paths.PathTree(leaves)
    before = [list(level) for level in tree.levels]
    copies = tree.version(13, b"x" * 32)
    assert tree.levels == before
    other = merkle_paths.PathTree([*leaves[:13], b"x" * 32, *leaves[14:]])
    i = 13
    for level, (old, new) in enumerate(zip(tree.levels, other.levels)):
        assert [k for k in range(len(old)) if old[k] != new[k]] == [i] and new[i] == copies[level]
        i //= 3


# ------------------------------------------------------------------ 13 HTML extraction

def texts(page):
    t = page_tree.read_page(page)
    return [s for s, g in zip(t.text, t.tag) if not g]


@pytest.mark.parametrize("page,want", [
    (None, []), ("", []), ("plain text", ["plain text"]), ("<p>a<p>b<br>c</p>d", ["a", "b c", "d"]),
    ("<p><b>x &amp;amp; y<br><p>z</article>", ["x &amp; y", "z"]),
    ("<ul><li>a<ul><li>b</ul><li>c</ul>", ["a", "b", "c"]), ("<dl><dt>a<dd>b<dt>c</dl>", ["a", "b", "c"]),
    ("<table><tr><td>a<td>b<tr><td>c</table>d", ["a", "b", "c", "d"]),
    ("a<!-- <p>no --> b<!--> c<!x> d<?y> e</ f>", ["a b c d e"]), ("a <!-- open", ["a"]),
    ("<script>var t='</p><b>';</script>a<style>p{}</STYLE >b<textarea><p>no</textarea>c", ["abc"]),
    ("<script>never closed <p>a", []), ("<head><title>t<p></title><body>a", ["a"]), ("<head><meta><p>a", ["a"]),
    ('<a title="x>y" href=\'>\'>a</a><a title="open>b', ["ab"]), ("1 < 2 &lt; 3 &copy; &zz; &am", ["1 < 2 < 3 © &zz; &am"]),
    ("<div hidden>no</div><p style='display: none'>no</p><noscript>no</noscript><svg><text>no</text></svg>yes", ["yes"]),
    ("<p>a&nbsp; \n\t b</p>", ["a b"]), ("</div></p>a</b>", ["a"]), ("<a href=x><div>a</div></a>b", ["a", "b"]),
    ("<DIV>a<Span>b</SPAN></DIV>", ["ab"]), ("<td>a</td><p>b", ["a", "b"]), ("<p>cut <di", ["cut"])])
def test_tree_reading(page, want):
    assert texts(page) == want


def test_tree_reading_of_long_and_deep_pages():
    n = 30_000
    assert texts("<div>" * n + "a" + "</div>" * n) == ["a"]
    assert len(texts("<p>a" * n)) == n and len(texts("<b><p>a" * 3000)) == 3000
    assert texts("<!--" * n) == [] and texts("<a " * n) == []
    assert len(texts("<a b=\"" * n + "x")) == 0


def random_tree(rng, n):
    """Parents in page order."""
    parent, path = [-1], [0]
    for i in range(1, n):
        del path[rng.randint(1, len(path)):]
        parent.append(path[-1])
        path.append(i)
    return np.array(parent)


def test_marginals_equal_enumeration():
    rng, g = random.Random(2), np.random.default_rng(2)
    for n in (1, 2, 5, 9):
        parent = np.concatenate([random_tree(rng, n), random_tree(rng, n) + np.where(np.arange(n) > 0, n, 0)])
        depth = np.zeros(2 * n, int)
        for i, p in enumerate(parent):
            depth[i] = depth[p] + 1 if p >= 0 else 0
        unary, pair = g.normal(0, 2, (2 * n, 2)), g.normal(0, 2, (2 * n, 2, 2))
        p, joint = dom_marginals.marginals(unary, pair, parent, depth)
        for base in (0, n):
            nodes = range(base, base + n)
            want, both, total = np.zeros((2 * n, 2)), np.zeros((2 * n, 2, 2)), 0.0
            for state in itertools.product((0, 1), repeat=n):
                s = dict(zip(nodes, state))
                w = np.exp(sum(unary[i, s[i]] for i in nodes)
                           + sum(pair[i, s[parent[i]], s[i]] for i in nodes if parent[i] >= 0))
                total += w
                for i in nodes:
                    want[i, s[i]] += w
                    if parent[i] >= 0:
                        both[i, s[parent[i]], s[i]] += w
            assert np.allclose(p[base:base + n], want[base:base + n] / total)
            assert np.allclose(joint[base:base + n], both[base:base + n] / total)


def test_fit_follows_the_likelihood_gradient():
    """At the fitted weights the labels' counts equal the expected ones."""
    made = [labelled_pages.labelled_page(i) for i in range(30)]
    trees = [page_tree.read_page(h) for h, _ in made]
    pages = dom_marginals.pages_of(trees)
    y = np.concatenate([np.array(dom_marginals.labels(t, "\n\n".join(k)))[dom_marginals._with_text(t)]
                        for t, (_, k) in zip(trees, made)])
    start = dom_marginals.fit(pages, y, rounds=0)
    model = dom_marginals.fit(pages, y, rounds=600, rate=0.03, l2=0.01)
    p, _ = model.marginals(pages)
    slope = lambda m: np.abs((y - m.marginals(pages)[0][:, 1]) @ pages.x / len(y) - 0.01 * m.node).max()
    assert slope(model) < 0.02 * slope(start)
    assert (p[pages.leaf, 1].round() == y[pages.leaf]).mean() > 0.9


@pytest.fixture(scope="module")
def page_model(spark):
    return dom_marginals.default_model(spark)


def test_held_out_pages(spark, page_model):
    """Blocks of unseen layouts, speaking and meaningless names alike."""
    pages = labelled_pages.labelled_pages(spark, 300, seed=9).withColumn("url", F.lit("u"))
    got = {r.page_id: r.text for r in dom_marginals.extract(pages, page_model).collect()}
    right = wrong = lost = 0
    for r in pages.collect():
        want = [" ".join(html.unescape(b).split()) for b in r.text.split("\n\n")]
        want, have = Counter(w for w in want if w), Counter(b for b in got[r.page_id].split("\n\n") if b)
        right += sum((want & have).values())
        wrong += sum((have - want).values())
        lost += sum((want - have).values())
    assert right / (right + lost) > 0.95 and right / (right + wrong) > 0.97


PAGE = ('<html><head><title>T</title></head><body>{top}<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul></nav>'
        '{before}<article><h1>A title here</h1><p>First paragraph, it says something.</p>{inside}<p>Second.</p><ul><li>one</li><li>two</li></ul>'
        '</article>{after}<footer>&copy; Site</footer></body></html>')
STRANGE = {
    "top": ["", '<div class="cookie-banner">We use cookies to improve your stay. <button>OK</button></div>',
            '<header><a href="/">The Site</a><p>News every day.</p></header>'],
    "before": ["", '<div class="ad">Buy this now.</div>', '<form action="/s"><label>Search</label><input></form>',
               '<aside><h3>Popular</h3><ul><li><a href="/1">One story</a></li><li><a href="/2">Other story</a></li></ul></aside>'],
    "inside": ["", '<div class="advertisement">Advertisement: cheap things.</div>', "<script>var a='<p>no</p>';</script>",
               '<aside class="related"><a href="/r">Read this too</a></aside>'],
    "after": ["", '<section id="comments"><h2>2 comments</h2><div class="comment"><b>Ann</b><p>I liked it a lot, thanks.</p></div>'
              '<div class="comment"><b>Bob</b><p>Not so sure about this one. It could be longer.</p></div></section>',
              '<div class="sidebar"><h3>About</h3><p>This site is about many things.</p></div>',
              '<form class="newsletter"><p>Get our letter every week.</p><input><button>Go</button></form>'],
}


def test_parts_around_an_article_are_left_out(spark, page_model):
    want = "A title here\n\nFirst paragraph, it says something.\n\nSecond.\n\none\n\ntwo"
    pages = [PAGE.format(**dict(zip(STRANGE, c))) for c in itertools.product(*STRANGE.values())]
    df = spark.createDataFrame([(i, "u", p) for i, p in enumerate(pages)], "page_id long, url string, html string")
    wrong = dom_marginals.extract(df, page_model).where(F.col("text") != want).collect()
    assert len(wrong) <= len(pages) // 50, [w.text for w in wrong[:3]]


def test_pages_query(spark):
    rows = {r.page_id: r for r in spark.read.parquet(f"{SF001}/pages.parquet").collect()}
    got = queries.QUERIES["op13_page_text"](spark, SF001).collect()
    assert len(got) == len(rows)
    for r in got:
        article = re.search("<article>(.*?)</article>", rows[r.page_id].html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split("</?p>|</?h1>", article)]
        assert r.text == "\n\n".join(b for b in blocks if b) and r.n_chars == len(r.text) and r.url == rows[r.page_id].url


def test_pages_odd_rows(spark, page_model):
    long = "<article><h1>t</h1>" + "<p>many words in a paragraph.</p>" * 20_000 + "</article>"
    rows = [(1, "u", None), (2, None, ""), (None, "u", PAGE), (3, "u", "   "), (3, "u", "   "), (4, "u", long), (5, "u", "<nav><a>x</a></nav>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for c in ("_html", "_c0", "text", "n_chars", "_id", "_text"):
        df = df.withColumn(c, F.lit(f"extra {c}"))
    out = dom_marginals.extract(df, page_model)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    got = out.collect()
    assert len(got) == len(rows) and sum(r.text == "" and r.n_chars == 0 for r in got) >= 4
    (r,) = [r for r in got if r.page_id == 4]
    assert r.text.count("many words") == 20_000
    assert dom_marginals.extract(df.limit(0), page_model).count() == 0
    none = dom_marginals.train(labelled_pages.labelled_pages(spark, 5).limit(0))
    assert not none.node.any() and dom_marginals.extract(df, none).count() == len(rows)
