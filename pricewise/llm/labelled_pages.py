"""Labelled training pages: invented pages in many layouts with their main text.

The page model needs pages whose main text is known. Every page here is drawn
from a seeded grammar of page parts - site headers, menus, notices, adverts,
articles in several markups, sidebars, comments, footers - with speaking,
misleading or meaningless class names, and carries the text blocks of its article.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

_SYLLABLES = "an er on the in re ti es or en at ed nd to it al de la que ción é über sch ung ß ñ o i".split()

# Names a part may carry (fixed values): what site authors call these parts.
PARTS = {
    "header": "header site-header masthead top-bar branding page-head banner-top",
    "menu": "nav menu main-nav navbar navigation breadcrumbs topmenu pagination pager toc-links",
    "notice": "cookie-notice cookie-banner notice alert consent gdpr-bar popup modal message-bar announcement",
    "ad": "ad ads advert advertisement sponsored promo banner ad-slot adsbygoogle sponsor-box",
    "sidebar": "sidebar side widget widget-area aside rail right-column secondary side-panel",
    "related": "related related-posts recommended more-stories read-next trending popular",
    "share": "share social share-buttons social-links follow-us",
    "comments": "comments comment-list commentlist responses discussion replies disqus_thread reader-comments",
    "form": "subscribe newsletter search-form login signup contact-form",
    "footer": "footer site-footer bottom colophon page-foot copyright legal",
    "content": "content article post entry entry-content post-body story main-content article-body text body-copy page-content",
    "wrap": "wrapper container page site inner row col grid layout",
}


class _Maker:
    def __init__(self, rng: random.Random):
        self.r = rng
        self.opaque = rng.random() < 0.25
        self.loose = rng.random() < 0.25
        self.kept: list[str] = []

    # -------------------------------------------------------------- words
    def word(self) -> str:
        w = "".join(self.r.choice(_SYLLABLES) for _ in range(self.r.randint(1, 4)))
        return w + self.r.choice(["", "", "", "", "", "", ",", "***", "&amp;", "%"])

    def sentence(self, lo: int, hi: int) -> str:
        return " ".join(self.word() for _ in range(self.r.randint(lo, hi))).capitalize() + self.r.choice("....!?")

    def prose(self) -> str:
        n = self.r.choice([1, 1, 2, 3, 4, 6, 10])
        return " ".join(self.sentence(1, self.r.choice([3, 8, 25])) for _ in range(n))

    def label(self) -> str:
        return " ".join(self.word() for _ in range(self.r.randint(1, 4))).capitalize()

    # -------------------------------------------------------------- markup
    def attrs(self, part: str | None) -> str:
        x = self.r.random()
        if part is None or x < 0.06:
            return ""
        if self.opaque:
            return f' class="{self.r.choice("abcdefgxyz")}{self.r.randint(10, 9999)}"'
        name = self.r.choice(PARTS[part].split())
        if x < 0.16:
            return f' id="{name}"'
        return f' class="{name}{self.r.choice(["", "", " clearfix", " js-block", "-wrap", " col-8"])}"'

    def box(self, part: str | None, inner: str, tags: tuple = ("div", "div", "section")) -> str:
        tag = self.r.choice(tags)
        return f"<{tag}{self.attrs(part)}>{inner}</{tag}>"

    def keep(self, text: str) -> str:
        self.kept.append(text)
        return text

    def links(self, n: int, heading: bool = False) -> str:
        items = "".join(f'<li><a href="/{i}">{self.label()}</a>{"" if self.loose else "</li>"}' for i in range(n))
        head = f"<h{self.r.randint(2, 4)}>{self.label()}</h3>" if heading else ""
        if self.r.random() < 0.2:
            return head + " | ".join(f'<a href="/{i}">{self.label()}</a>' for i in range(n))
        return f"{head}<ul>{items}</ul>"

    # -------------------------------------------------------------- parts around the article
    def menu(self) -> str:
        return self.box("menu", self.links(self.r.randint(2, 9)), ("nav", "nav", "nav", "div", "div"))

    def header(self) -> str:
        inner = self.r.choice([f"<h1>{self.label()}</h1>", f'<a href="/">{self.label()}</a>', f"<p>{self.label()}</p>"])
        inner += self.r.choice(["", f"<p>{self.sentence(2, 9)}</p>", self.menu(), self.form()])
        return self.box("header", inner, ("header", "header", "div"))

    def notice(self) -> str:
        body = self.r.choice([self.sentence(4, 25), f"<p>{self.sentence(4, 25)}</p><button>{self.label()}</button>",
                              f'{self.sentence(4, 20)} <a href="/p">{self.label()}</a>'])
        role = self.r.choice(["", "", ' role="alert"', ' role="dialog"'])
        if self.opaque and not role:
            role = ' role="alert"'
        name = self.r.choice(PARTS["notice"].split())
        return f'<div class="{name}"{role}>{body}</div>' if not self.opaque else f"<div{role}>{body}</div>"

    def ad(self) -> str:
        body = self.r.choice([self.sentence(1, 14), f"<p>{self.sentence(3, 20)}</p>", f'<a href="//x">{self.sentence(2, 9)}</a>',
                              f"<span>{self.label()}</span> {self.sentence(2, 9)}"])
        name = self.r.choice(PARTS["ad"].split())
        return f'<{(t := self.r.choice(["div", "div", "aside"]))} class="{name}">{body}</{t}>'

    def form(self) -> str:
        return (f'<form{self.attrs("form")} action="/s"><label>{self.label()}</label><input name="q">'
                f'{self.r.choice(["", f"<p>{self.sentence(3, 15)}</p>", f"<div>{self.sentence(3, 15)}</div>"])}'
                f'<button>{self.label()}</button></form>')

    def sidebar(self) -> str:
        widgets = [self.r.choice([lambda: self.links(self.r.randint(3, 8), True), self.ad, self.form,
                                  lambda: f"<h3>{self.label()}</h3><p>{self.prose()}</p>"])()
                   for _ in range(self.r.randint(1, 4))]
        return self.box("sidebar", "".join(self.box("sidebar" if self.r.random() < 0.3 else None, w, ("div",)) for w in widgets),
                        ("aside", "aside", "div"))

    def related(self) -> str:
        if self.r.random() < 0.4:
            cards = "".join(f'<article><h3><a href="/{i}">{self.label()}</a></h3><p>{self.sentence(3, 15)}</p></article>'
                            for i in range(self.r.randint(2, 5)))
            return self.box("related", f"<h2>{self.label()}</h2>{cards}")
        return self.box("related", self.links(self.r.randint(3, 7), True))

    def comments(self) -> str:
        out = []
        item = self.r.choice(["li", "div", "div", "article"])
        name = self.r.choice(["comment", "comment-body", "reply", "response"])
        for i in range(self.r.randint(1, 8)):
            by = self.r.choice([f"<b>{self.label()}</b>", f'<a href="/u{i}">{self.label()}</a>',
                                f'<div class="comment-author">{self.label()}</div>', f"<p>{self.label()} {self.r.randint(1, 28)}.{self.r.randint(1, 12)}.</p>"])
            body = "".join(f"<p>{self.prose()}</p>" for _ in range(self.r.choice([1, 1, 1, 2, 3])))
            body = body if self.r.random() < 0.8 else self.prose()
            reply = self.r.choice(["", f'<a href="#r">{self.label()}</a>'])
            out.append(f'<{item} class="{name}">{by}{body}{reply}</{item}>')
        inner = "".join(out) if item != "li" else f"<ol>{''.join(out)}</ol>"
        head = self.r.choice(["", f"<h2>{self.label()}</h2>", f"<h3>{self.r.randint(1, 99)} {self.label()}</h3>"])
        own = self.r.choice(PARTS["comments"].split())
        where = self.r.choice([f' id="{own}"', f' class="{own}"'])
        tag = self.r.choice(["section", "div", "div"])
        return f'<{tag}{where}>{head}{inner}{self.form() if self.r.random() < 0.4 else ""}</{tag}>'

    def footer(self) -> str:
        inner = self.r.choice([f"&copy; {self.label()} &middot; {self.sentence(1, 14)}", f"<p>&copy; {self.label()}</p>",
                               f"<p>{self.sentence(3, 30)}</p>" + self.links(self.r.randint(2, 6)), self.links(self.r.randint(2, 8))])
        return self.box("footer", inner, ("footer", "footer", "footer", "div"))

    # -------------------------------------------------------------- the article
    def paragraph(self) -> str:
        text, x = self.prose(), self.r.random()
        end = "" if self.loose and self.r.random() < 0.6 else "</p>"
        if x < 0.1:
            a, b = self.label(), self.prose()
            self.kept.append(f"{text} {a} {b}")
            return f'<p>{text} <a href="/l">{a}</a> {b}{end}'
        if x < 0.2:
            self.kept.append(text)
            return f"<p><b>{text}<br>{end}" if self.loose else f"<p><b>{text}</b>{end}"
        if x < 0.25:
            a = self.label()
            self.kept.append(a)
            return f'<p><a href="/l">{a}</a>{end}'
        return f"<p>{self.keep(text)}{end}"

    def block(self) -> str:
        k = self.r.random()
        if k < 0.62:
            return self.paragraph()
        if k < 0.70:
            return f"<h{(n := self.r.randint(2, 4))}>{self.keep(self.label())}</h{n}>"
        if k < 0.78:
            tag = self.r.choice(["ul", "ol"])
            return f"<{tag}>" + "".join(f"<li>{self.keep(self.r.choice([self.label(), self.prose()]))}</li>"
                                        for _ in range(self.r.randint(1, 7))) + f"</{tag}>"
        if k < 0.82:
            return f"<blockquote><p>{self.keep(self.prose())}</p></blockquote>"
        if k < 0.86:
            return "<table>" + "".join("<tr>" + "".join(f"<td>{self.keep(self.label())}</td>" for _ in range(3)) + "</tr>"
                                       for _ in range(self.r.randint(1, 4))) + "</table>"
        if k < 0.89:
            return f'<figure><img src="/i.png" alt="x"><figcaption>{self.keep(self.sentence(2, 12))}</figcaption></figure>'
        if k < 0.92:
            return f"<pre>{self.keep(self.prose())}</pre>"
        if k < 0.96:
            return f"<div>{self.keep(self.prose())}</div>"
        return f"<div>{self.paragraph()}{self.paragraph()}</div>"

    def strange(self) -> str:
        """A part inside the article that is not of it."""
        return self.r.choice([self.ad, self.ad, self.notice, self.form, self.related,
                              lambda: self.box("share", self.links(self.r.randint(2, 5))),
                              lambda: f"<aside>{self.label()} <p>{self.sentence(3, 20)}</p></aside>",
                              lambda: f"<nav>{self.links(self.r.randint(2, 5))}</nav>"])()

    def article(self) -> str:
        out = []
        if self.r.random() < 0.85:
            title = self.keep(self.r.choice([self.label, self.prose, lambda: self.sentence(2, 12)])())
            h = f"<h1>{title}</h1>"
            if self.r.random() < 0.3:
                by = self.keep(self.label())
                h += self.r.choice([f'<p class="byline">{by}</p>', f'<div class="meta">{by}</div>', f'<div class="author">{by}</div>'])
            out.append(f"<header>{h}</header>" if self.r.random() < 0.15 else h)
            if self.r.random() < 0.15:  # the first words again, all the page says or not
                out.append(f"<p>{self.keep(title)}</p>")
        for _ in range(self.r.choice([0, 0, 1, 1, 1, 2, 3, 4, 6, 9, 14, 25])):
            out.append(self.block())
            if self.r.random() < 0.05:
                out.append(self.strange())
        if not self.kept:
            out.append(self.paragraph())
        inner = "".join(out)
        if self.r.random() < 0.12:
            inner += self.comments()
        x = self.r.random()
        if x < 0.55:
            return f"<article{self.r.choice(['', self.attrs('content')])}>{inner}</article>"
        if x < 0.92:
            return self.box("content", inner)
        return inner

    def page(self, i: int) -> str:
        if self.r.random() < 0.04:  # a page of links alone
            main = "".join(self.links(self.r.randint(3, 9), True) for _ in range(self.r.randint(1, 4)))
        else:
            main = self.article()
        if self.r.random() < 0.35:
            main = self.box("content", main, ("main", "main", "div"))
        some = lambda p, f: f() if self.r.random() < p else ""
        side = some(0.35, self.sidebar)
        after = some(0.1, self.form) + some(0.25, self.comments) + some(0.2, self.related) + some(0.08, self.form)
        if side and self.r.random() < 0.12:
            cells = [f"<td>{side}</td>", f"<td>{main}{after}</td>"]
            self.r.shuffle(cells)
            main = f"<table><tr>{''.join(cells)}</tr></table>"
        else:
            main = side + main + after if self.r.random() < 0.4 else main + after + side
        if self.r.random() < 0.4:
            main = self.box("wrap", main, ("div",))
        top = [some(0.6, self.header), some(0.7, self.menu), some(0.2, self.notice), some(0.4, self.ad)]
        if self.r.random() < 0.3:
            self.r.shuffle(top)
        body = "".join(top) + main + some(0.1, self.ad) + some(0.85, self.footer) + some(0.1, self.notice)
        if self.r.random() < 0.4:
            body = self.box("wrap", body, ("div",))
        if self.r.random() < 0.01:
            body = f'<form id="aspnetForm">{body}</form>'
        tail = "" if self.r.random() < 0.1 else "</body></html>"
        return (f"<!DOCTYPE html><html><head><title>{self.label()}</title><style>p{{margin:0}}</style>"
                f"<script>var a = '</p>' + {i};</script></head><body>{body}{tail}")


def labelled_page(seed: int) -> tuple[str, list[str]]:
    """(html, text blocks of the article) of one training page."""
    m = _Maker(random.Random(seed))
    page = m.page(seed)
    return page, m.kept


def labelled_pages(spark: SparkSession, n: int, seed: int = 0) -> DataFrame:
    """``n`` training pages: page_id, html, text (blocks joined by two line ends, as markup)."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            made = [labelled_page(seed * 1_000_003 + i) for i in f["id"]]
            yield pd.DataFrame({"page_id": f["id"], "html": [m[0] for m in made], "text": ["\n\n".join(m[1]) for m in made]})

    return spark.range(n).mapInPandas(run, "page_id long, html string, text string")
