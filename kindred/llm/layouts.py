"""Labelled pages: layouts drawn from a grammar of page parts.

An element carries ``data-label``, 1 for the article and 0 for everything else; what has none follows
its parent, and the page itself is 0. Parts are written with their own tags, with plain elements and
class names, or with neither, so that no single sign tells them apart.
"""

from __future__ import annotations

import random

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# Tags and class names that pages use for their parts.
PARTS = {
    "menu": (("nav", "ul", "div"), "nav menu navbar navigation topnav breadcrumb breadcrumbs links toolbar pagination"),
    "header": (("header", "div"), "header masthead top branding logo site hero"),
    "footer": (("footer", "div"), "footer bottom copyright legal colophon credits"),
    "sidebar": (("aside", "div", "section"), "sidebar side widget related recommended popular trending more rail"),
    "notice": (("div", "section", "dialog", "aside"), "cookie consent notice gdpr alert popup modal overlay message warning"),
    "advert": (("div", "aside", "section"), "ad ads advert advertisement sponsor sponsored promo promotion adsense commercial"),
    "form": (("form", "div"), "form search newsletter subscribe subscription signup login contact register"),
    "comments": (("section", "div", "ol", "aside"), "comments comment commentlist discussion responses replies disqus reader readers feedback thread"),
    "share": (("div", "ul"), "share social sharing tags buttons follow"),
    "article": (("article", "main", "div", "section"), "content article post entry main story body text prose"),
}
SYLLABLES = "an be cor da el fi gra ho in ja ka lor men no or pe qui ra sen ti un ver wa xe yo zu".split()


class _Writer:
    def __init__(self, seed: int):
        self.r = random.Random(seed)
        # Some articles are rough: lists of words, symbols between them, no sentences.
        self.rough = self.r.choice((" | ", " %%% ", " ", " / ", ", ", "*** ")) if self.r.random() < 0.15 else ""

    def word(self) -> str:
        return "".join(self.r.choices(SYLLABLES, k=self.r.choice((1, 1, 2, 2, 3))))

    def title(self, low: int = 1, high: int = 6) -> str:
        return " ".join(self.word() for _ in range(self.r.randint(low, high))).capitalize()

    def sentence(self) -> str:
        words = [self.word() for _ in range(self.r.randint(3, 25))]
        if len(words) > 8 and self.r.random() < 0.6:
            words[len(words) // 2] += ","
        return " ".join(words).capitalize() + self.r.choice("....?!")

    def prose(self, low: int, high: int) -> str:
        return " ".join(self.sentence() for _ in range(self.r.randint(low, high)))

    def link(self, low: int = 1, high: int = 3) -> str:
        return f'<a href="/{self.word()}">{self.title(low, high)}</a>'

    def part(self, kind: str, inner: str, label: int) -> str:
        """A part in one of its tags; plain elements mostly say by a name what they are."""
        tags, names = PARTS[kind]
        tag = self.r.choice(tags)
        name = ""
        if self.r.random() < (0.85 if tag in ("div", "section", "ul", "ol", "aside") else 0.4):
            name = self.r.choice(names.split())
            more = self.r.choice(("", "", "-box", "-wrapper", "_main", " block", "-1", " container"))
            name = f' {self.r.choice(("class", "class", "id"))}="{name}{more}"'
        if tag in ("ul", "ol") and "<li" not in inner:
            inner = f"<li>{inner}</li>"
        return f'<{tag}{name} data-label="{label}">{inner}</{tag}>'

    def links(self) -> str:
        items = [self.link() for _ in range(self.r.randint(2, 9))]
        if self.r.random() < 0.7:
            return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>"
        return self.r.choice((" ", " | ", " &middot; ")).join(items)

    def other(self, kind: str) -> str:
        r = self.r
        if kind == "menu":
            inner = self.links()
        elif kind == "header":
            inner = f"<{(h := r.choice(('h1', 'div', 'p', 'h2')))}>{self.title(1, 4)}</{h}>"
            inner += r.choice(("", f"<p>{self.sentence()}</p>", self.links()))
        elif kind == "footer":
            inner = r.choice(("&copy; ", "Copyright ", "", "&copy; 2024 ")) + self.title(1, 5)
            inner += r.choice(("", " &middot; " + self.prose(1, 2), self.links(), " | " + self.link()))
        elif kind == "sidebar":
            inner = f"<h3>{self.title(1, 3)}</h3>" + r.choice(
                (self.links(), "".join(f"<p>{self.link(3, 9)}</p>" for _ in range(4)), f"<p>{self.prose(1, 3)}</p>")
            )
        elif kind == "notice":
            inner = f"<p>{self.prose(1, 3)}</p>" + r.choice(("", f"<button>{self.title(1, 2)}</button>", self.link()))
        elif kind == "advert":
            inner = r.choice((self.prose(1, 2), f"<p>{self.prose(1, 3)}</p>", f"<a href='/x'>{self.prose(1, 1)}</a>"))
            inner = r.choice(("", "<small>Advertisement</small> ")) + inner
        elif kind == "form":
            inner = f"<label>{self.title(1, 3)}</label><input name=q>" + r.choice(("", f"<p>{self.sentence()}</p>"))
            inner += f"<button>{self.title(1, 1)}</button>"
        elif kind == "comments":
            one = [
                f'<div{r.choice(("", " class=comment"))}><b>{self.title(1, 2)}</b><p>{self.prose(1, 4)}</p></div>'
                for _ in range(r.randint(1, 6))
            ]
            inner = r.choice(("", f"<h3>{self.title(1, 2)}</h3>", f"<h2>Comments ({len(one)})</h2>")) + "".join(one)
        else:
            inner = " ".join(self.link(1, 1) for _ in range(r.randint(2, 5)))
        return self.part(kind, inner, 0)

    def words(self, low: int, high: int) -> str:
        """Prose of the article."""
        if not self.rough:
            return self.prose(low, high)
        return self.rough.join(self.title(1, 5) for _ in range(self.r.randint(1, 8 * high)))

    def article(self) -> str:
        r = self.r
        blocks = [f"<h1>{self.title(3, 12)}</h1>"] if r.random() < 0.8 else []
        for _ in range(r.choice((1, 2, 3, 5, 8, 13))):
            kind = r.random()
            if kind < 0.72:
                inner = self.words(1, r.choice((2, 4, 7)))
                if r.random() < 0.25:
                    inner += " " + self.link() + " " + self.sentence()
                blocks.append(r.choice((f"<p>{inner}</p>", f"<p>{inner}", f"<p><b>{inner}<br>")))
            elif kind < 0.82:
                blocks.append(f"<h2>{self.title(2, 7)}</h2><p>{self.words(1, 4)}</p>")
            elif kind < 0.9:
                blocks.append("<ul>" + "".join(f"<li>{self.sentence()}</li>" for _ in range(r.randint(2, 6))) + "</ul>")
            elif kind < 0.95:
                blocks.append(f"<blockquote><p>{self.words(1, 3)}</p></blockquote>")
            else:
                cells = "".join(f"<tr><td>{self.word()}</td><td>{self.title(1, 3)}</td></tr>" for _ in range(3))
                blocks.append(f"<table>{cells}</table>")
        for kind, share in (("advert", 0.25), ("share", 0.2), ("notice", 0.1), ("form", 0.08), ("sidebar", 0.1)):
            if r.random() < share:
                blocks.insert(r.randint(0, len(blocks)), self.other(kind))
        if r.random() < 0.2:
            blocks.append(self.other("comments"))
        inner = "".join(blocks)
        if r.random() < 0.3:
            inner = f"<div>{inner}</div>"
        return self.part("article", inner, 1)

    def page(self) -> str:
        r = self.r
        if r.random() < 0.05:
            return r.choice((self.article(), f'<div data-label="1">{self.words(1, 5)}</div>'))
        body = [self.article()]
        if r.random() < 0.5:
            body.append(self.other("sidebar"))
            r.shuffle(body)
            body = [f"<div{r.choice(('', ' class=wrapper', ' id=page', ' class=container'))}>{''.join(body)}</div>"]
        before = [k for k in ("notice", "header", "menu", "advert", "form") if r.random() < 0.5]
        after = [k for k in ("share", "advert", "comments", "sidebar", "form", "footer", "notice") if r.random() < 0.45]
        r.shuffle(before)
        body = [*map(self.other, before), *body, *map(self.other, after)]
        head = f"<title>{self.title(3, 8)}</title><style>p{{margin:0}}</style><script>f('<p>')</script>"
        return f"<!DOCTYPE html><html><head>{head}</head><body>{''.join(body)}</body></html>"


def labelled_pages(spark: SparkSession, n: int = 2000, seed: int = 7) -> DataFrame:
    """``n`` pages with a column ``html``; the same seed gives the same pages."""

    def run(batches):
        for batch in batches:
            pages = [_Writer(seed * 1_000_003 + i).page() for i in batch.column("id").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(pages)], ["html"])

    return spark.range(n, numPartitions=min(16, max(1, n // 100))).mapInArrow(run, "html string")
