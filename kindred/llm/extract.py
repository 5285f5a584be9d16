"""Main text of web pages: a tree-structured graphical model over the nodes of a page.

A page becomes a tree of its block elements with the blocks of text as leaves. Every node is content,
something else, or a mixture of both (a leaf is never a mixture). A node's potential comes from its
tag, its names, and the size, links and sentence ends of the text below it; a parent-child potential
depends on the child's tag. All are smoothed frequencies counted by Spark on labelled pages. Sum-product
messages go up from the leaves and down again, one level of all pages of a chunk at a time, and give
each leaf its marginal; content leaves are the text.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm.common import text_of
from kindred.llm.layouts import labelled_pages

OTHER, CONTENT, MIXED = range(3)
DEPTH = 512  # elements nested deeper become siblings, as in browsers
CHUNK = 4_000_000  # characters of pages
MEASURES = ("size", "links", "ends", "leaves", "marks")
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title iframe noembed noframes xmp".split())
SILENT = set("button canvas datalist noscript object select svg template audio video".split())
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup html legend li main menu nav ol p pre search "
    "section summary table tbody td tfoot th thead tr ul".split()
)
# An open element that a start tag closes, and where the search for it ends.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th"}, "th": {"td", "th"}}
LISTS = {"ul", "ol", "menu", "dir", "dl", "table", "body", "html"}
KEEP_P = {"html", "body", "td", "th", "tr"}

_NAME = re.compile(r"[^\s/>]+")
_UNQUOTED = re.compile(r"[^>\"']*")
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|style|data-label)\b(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_SENTENCE = re.compile(r"[.!?…。！？][\"'”’»)\]]*$")
_MARK = re.compile(r"©|copyright|all rights reserved", re.I)


def singular(word: str) -> str:
    return word[:-1] if len(word) > 2 and word.endswith("s") else word


class Page:
    """Nodes of a page in the order of their start; a node's parent stands before it."""

    def __init__(self, html: str):
        self.parent, self.tag, self.depth = [], [], []
        self.words, self.linked, self.ends, self.marks = [], [], [], []
        self.text, self.names, self.label = [], [], []
        self._open, self._over, self._inner, self._silent = Counter(), Counter(), Counter(), 0
        self._stack, self._run, self._link = [], [], False
        self._node("#page", [], 0)
        self._read(html)
        self._flush()

    def _node(self, tag, names, label, words=0, linked=0, text=None):
        at = len(self.parent)
        self.parent.append(self._stack[-1] if self._stack else -1)
        self.depth.append(len(self._stack))
        self.tag.append(tag)
        self.names.extend((at, w) for w in names)
        self.label.append(label)
        self.words.append(words)
        self.linked.append(linked)
        self.text.append(text)
        self.ends.append(bool(text and _SENTENCE.search(text[-8:])))
        self.marks.append(bool(text and _MARK.search(text[:40])))
        if text is None:
            self._stack.append(at)

    def _flush(self):
        """The text since the last block border becomes a leaf."""
        if not self._run:
            return
        pieces = [(unescape(t) if "&" in t else t, link) for t, link in self._run]
        self._run = []
        words = "".join(t for t, _ in pieces).split()
        if words:
            linked = sum(len(t.split()) for t, link in pieces if link)
            above = self._stack[-1]
            self._node(self.tag[above], [], self.label[above], len(words), min(linked, len(words)), " ".join(words))

    def _pop(self):
        tag = self.tag[self._stack.pop()]
        self._open[tag] -= 1
        if tag in SILENT:
            self._silent -= 1
            self._inner.clear()

    def _pop_to(self, at: int):
        while len(self._stack) > at:
            self._pop()

    def _start(self, tag: str, rest: str):
        if tag in SILENT or self._silent:
            # Nothing inside is read; its tags are counted, so that their ends close nothing outside.
            if self._silent or len(self._stack) >= DEPTH:
                self._inner[tag] += 1
            else:
                self._node(tag, [], 0)
                self._open[tag] += 1
                self._silent += 1
            return
        if tag == "a":
            self._link = True
        elif tag == "br":
            self._run.append((" ", False))
        elif tag == "hr":
            self._flush()
        if tag not in BLOCKS:
            return
        self._flush()
        self._link = self._link and tag not in ("li", "p", "td", "tr")
        if self._open["p"] and tag not in KEEP_P:
            while self._open["p"]:
                self._pop()
        if tag in CLOSES:
            for k in range(len(self._stack) - 1, 0, -1):
                above = self.tag[self._stack[k]]
                if above in CLOSES[tag]:
                    self._pop_to(k)
                    break
                if above in LISTS:
                    break
        if len(self._stack) >= DEPTH:
            self._over[tag] += 1
            return
        names, label = set(), self.label[self._stack[-1]]
        if rest:
            for key, value in _ATTRIBUTE.findall(rest):
                key = key.lower()
                if key == "data-label":
                    label = int(value.strip("\"'") == "1")
                elif key == "hidden" or (key == "style" and re.search(r"display\s*:\s*none", value)):
                    names.add("hidden")
                elif key != "style":
                    names.update(singular(w.lower()) for w in _WORD.findall(value))
        self._node(tag, sorted(names), label)
        self._open[tag] += 1

    def _end(self, tag: str):
        if self._silent and self._inner[tag]:
            self._inner[tag] -= 1
        elif tag == "a":
            self._link = False
        elif tag in BLOCKS or tag in SILENT:
            if tag in BLOCKS:
                self._flush()
            if self._over[tag]:
                self._over[tag] -= 1
            elif self._open[tag]:
                while self.tag[self._stack[-1]] != tag:
                    self._pop()
                self._pop()

    def _tag_end(self, html: str, at: int) -> int:
        """Where the tag ends that is read from ``at`` on; a ``>`` inside quotes does not end it."""
        end = html.find(">", at)
        part = html[at:end]
        if end < 0 or not (part.count('"') % 2 or part.count("'") % 2):
            return end
        while True:
            at = _UNQUOTED.match(html, at).end()
            if at >= len(html) or html[at] == ">":
                return at if at < len(html) else end
            # Quotes stand around values only; one that is never closed is a character like any other.
            before = at - 1
            while html[before].isspace():
                before -= 1
            close = html.find(html[at], at + 1) if html[before] == "=" else -1
            at = close + 1 if close >= 0 else at + 1

    def _read(self, html: str):
        at = 0
        while True:
            low = html.find("<", at)
            text = html[at : low if low >= 0 else len(html)]
            if text and not self._silent:
                self._run.append((text, self._link))
            if low < 0:
                return
            after = html[low + 1 : low + 2]
            closing = after == "/"
            first = html[low + 2 : low + 3] if closing else after
            if first.isascii() and first.isalpha():
                name = _NAME.match(html, low + 1 + closing)
                end = self._tag_end(html, name.end())
                if end < 0:
                    return
                tag, at = name[0].lower(), end + 1
                if closing:
                    self._end(tag)
                    continue
                if tag in RAW:
                    close = re.compile(f"</{tag}", re.I).search(html, at)
                    if not close:
                        return
                    at = close.start()
                    continue
                self._start(tag, html[name.end() : end])
            elif after == "!" and html.startswith("<!--", low):
                end = low + 4 if html.startswith(">", low + 4) else html.find("-->", low + 4)
                if end < 0:
                    return
                at = end + (1 if end == low + 4 and html[end] == ">" else 3)
            elif after in ("!", "?") or closing:
                at = html.find(">", low) + 1
                if not at:
                    return
            else:
                if not self._silent:
                    self._run.append(("<", self._link))
                at = low + 1


class Chunk:
    """Pages as one forest, with the values of all factors of its nodes."""

    def __init__(self, pages: list[Page]):
        sizes = [len(p.parent) for p in pages]
        starts = np.cumsum([0, *sizes])
        self.of = np.repeat(np.arange(len(pages)), sizes)
        self.n = int(starts[-1])

        def column(name, kind=np.int64):
            return np.array([x for p in pages for x in getattr(p, name)], kind)

        shift = np.repeat(starts[:-1], sizes)
        parent = column("parent")
        self.parent = np.where(parent < 0, -1, parent + shift)
        self.tags = column("tag", object)
        self.label = column("label")
        self.text = [t for p in pages for t in p.text]
        self.leaf = np.array([t is not None for t in self.text], bool)
        self.names = [(at + start, w) for p, start in zip(pages, starts) for at, w in p.names]
        depth = column("depth")
        order = np.argsort(depth, kind="stable")
        cuts = np.searchsorted(depth[order], np.arange(int(depth.max(initial=0)) + 2))
        self.levels = [order[i:j] for i, j in zip(cuts, cuts[1:])]
        # Sums over the leaves below each node.
        sums = np.stack(
            [column("words"), column("linked"), column("ends"), self.leaf, self.label * column("words")], 1
        ).astype(float)
        for level in self.levels[:0:-1]:
            np.add.at(sums, self.parent[level], sums[level])
        words, linked, ends, leaves, own = sums.T
        self.words = words
        self.state = np.where(own == 0, OTHER, np.where(own == words, CONTENT, MIXED))
        self.state[words == 0] = self.label[words == 0]
        # An unnamed element with an only child of the same tag is no more than that child.
        below = np.flatnonzero((words > 0) & (self.parent >= 0))
        children = np.bincount(self.parent[below], minlength=self.n)
        only = np.where(children == 1, np.bincount(self.parent[below], below, minlength=self.n), 0).astype(int)
        self.inert = (children == 1) & ~self.leaf[only] & (self.tags[only] == self.tags)
        self.inert[[at for at, _ in self.names]] = False
        share = lambda x, y: np.ceil(3 * x / np.maximum(y, 1)).astype(int)
        self.factors = {
            "size": np.log2(words + 1).astype(int),
            "links": share(linked, words),
            "ends": share(ends, leaves),
            "leaves": np.log2(leaves + 1).astype(int),
            "marks": np.where(self.leaf, column("marks"), 2),
        }


@dataclass(frozen=True)
class Model:
    """Log potentials: of tags and names by their word, of other factors by leaf and value, of edges."""

    tags: dict[tuple[bool, str], np.ndarray]
    names: dict[str, np.ndarray]
    factors: dict[tuple[str, bool], np.ndarray]
    edges: dict[str, np.ndarray]
    edge: np.ndarray  # of tags without an own one
    root: np.ndarray


COUNTS = "factor string, leaf boolean, value string, above int, state int, n long"


def _counted(batches):
    """Frequencies on labelled pages."""
    for batch in batches:
        chunk = Chunk([Page(h) for h in batch.column("html").to_pylist()])
        seen = chunk.words > 0
        counts = Counter()
        above = np.where(chunk.parent < 0, -1, chunk.state[chunk.parent])
        for i in np.flatnonzero(seen):
            leaf, state, tag = bool(chunk.leaf[i]), int(chunk.state[i]), chunk.tags[i]
            if above[i] < 0 or not chunk.inert[chunk.parent[i]]:
                counts["edge", leaf, "#text" if leaf else tag, int(above[i]), state] += 1
            if not chunk.inert[i]:
                counts["tag", leaf, tag, -1, state] += 1
                for name, values in chunk.factors.items():
                    counts[name, leaf, str(values[i]), -1, state] += 1
        for i, word in chunk.names:
            if seen[i]:
                counts["name", False, word, -1, int(chunk.state[i])] += 1
        if not counts:
            continue
        columns = list(zip(*(key + (n,) for key, n in counts.items())))
        kinds = [pa.string(), pa.bool_(), pa.string(), pa.int32(), pa.int32(), pa.int64()]
        names = [part.split()[0] for part in COUNTS.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def fit(labelled: DataFrame) -> Model:
    """Potentials from labelled pages (``html`` with ``data-label`` on elements).

    One row for each distinct value of a factor and state comes to the driver, so the class names of the
    labelled pages bound its size.
    """
    rows = (
        labelled.select(text_of("html").alias("html"))
        .mapInArrow(_counted, COUNTS)
        .groupBy("factor", "leaf", "value", "above", "state")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    tables: dict[tuple, np.ndarray] = {}
    edges = {}
    for r in rows:
        if r.factor == "edge":
            edges.setdefault(r.value, np.zeros((4, 3)))[r.above, r.state] += r.n
        else:
            tables.setdefault((r.factor, r.leaf, r.value), np.zeros(3))[r.state] += r.n
    of = lambda factor: {(x, v): t for (f, x, v), t in tables.items() if f == factor}
    nodes = {x: sum((t for (y, _), t in of("tag").items() if x == y), np.zeros(3)) for x in (False, True)}

    def potential(counts, leaf, values):
        return np.log((counts + 0.5) / (nodes[leaf] + 0.5 * values))

    tags = {k: potential(t, k[0], 60) for k, t in of("tag").items()}
    names = {v: potential(t, False, 2) for (_, v), t in of("name").items()}
    factors = {}
    for factor in MEASURES:
        for leaf in (False, True):
            known = {int(v): t for (x, v), t in of(factor).items() if x == leaf}
            width = max(known, default=0) + 1
            # Values beyond the greatest one seen count as that one.
            counts = np.array([known.get(v, np.zeros(3)) for v in range(width)])
            factors[factor, leaf] = potential(counts, leaf, width)
    total = sum(edges.values(), np.zeros((4, 3)))
    base = (total + 0.1) / (total + 0.1).sum(1, keepdims=True)
    given = {t: (c + 10 * base) / (c + 10 * base).sum(1, keepdims=True) for t, c in edges.items()}
    return Model(
        tags, names, factors, {t: np.log(p[:3]) for t, p in given.items()}, np.log(base[:3]), np.log(base[3])
    )


def _sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def marginals(chunk: Chunk, model: Model) -> np.ndarray:
    """Probabilities of the states of every node."""
    own = np.zeros((chunk.n, 3))
    leaf = chunk.leaf
    for (factor, of_leaf), table in model.factors.items():
        here = (leaf == of_leaf) & ~chunk.inert
        own[here] += table[np.minimum(chunk.factors[factor][here], len(table) - 1)]
    kinds, which = np.unique(chunk.tags.astype(str), return_inverse=True)
    for of_leaf in (False, True):
        table = np.array([model.tags.get((of_leaf, t), np.zeros(3)) for t in kinds])
        here = (leaf == of_leaf) & ~chunk.inert
        own[here] += table[which[here]]
    known = [(i, model.names[w]) for i, w in chunk.names if w in model.names]
    if known:
        np.add.at(own, np.array([i for i, _ in known]), np.array([p for _, p in known]))
    own[leaf, MIXED] = -1e9
    table = np.array([model.edges.get(t, model.edge) for t in [*kinds, "#text"]])
    edge = table[np.where(leaf, len(kinds), which)]  # [node, state above, state]
    edge[(chunk.parent >= 0) & chunk.inert[chunk.parent]] = np.where(np.eye(3), 0, -1e9)
    up, sent = np.zeros((chunk.n, 3)), np.zeros((chunk.n, 3))
    for level in chunk.levels[:0:-1]:
        sent[level] = _sum(edge[level] + (own[level] + up[level])[:, None, :], 2)
        np.add.at(up, chunk.parent[level], sent[level])
    down = np.zeros((chunk.n, 3))
    if chunk.levels:
        down[chunk.levels[0]] = model.root
    for level in chunk.levels[1:]:
        above = chunk.parent[level]
        rest = down[above] + own[above] + up[above] - sent[level]
        down[level] = _sum(edge[level] + rest[:, :, None], 1)
    belief = own + up + down
    belief = np.exp(belief - belief.max(axis=1, keepdims=True))
    return belief / belief.sum(axis=1, keepdims=True)


def main_texts(pages: list[str], model: Model) -> list[str]:
    """The text of each page: content blocks joined by line ends."""
    chunk = Chunk([Page(p) for p in pages])
    out = [[] for _ in pages]
    for i in np.flatnonzero(chunk.leaf & (marginals(chunk, model)[:, CONTENT] >= 0.5)):
        out[chunk.of[i]].append(chunk.text[i])
    return ["\n".join(blocks) for blocks in out]


def extract(
    pages: DataFrame, model: Model | None = None, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")
) -> DataFrame:
    """The columns ``keep`` of every page, its main ``text`` and ``n_chars``, the code points of that.

    Without a model, one is fitted to labelled pages drawn from :mod:`kindred.llm.layouts`. A null or empty
    page and one without content give an empty text. Rows are handled one by one, so repeated ids stay
    apart; other columns, also those named ``text`` or ``n_chars``, are not looked at. White space is what
    Unicode calls so. A line break inside a block is white space. A chunk of pages is held at a time, or
    one page that is longer.
    """
    model = model or fit(labelled_pages(pages.sparkSession))
    rows = pages.select(*(F.col(c) for c in keep), text_of(html_col).alias("html_"))
    kinds = [f"{c} {t}" for c, t in rows.dtypes[:-1]]

    def run(batches):
        for batch in batches:
            texts = batch.column("html_").to_pylist()
            low = 0
            while low < len(texts):
                high, size = low, 0
                while high < len(texts) and size < CHUNK:
                    size += len(texts[high])
                    high += 1
                found = main_texts(texts[low:high], model)
                columns = [batch.column(c).slice(low, high - low) for c in keep]
                columns += [pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, [*keep, "text", "n_chars"])
                low = high

    return rows.mapInArrow(run, ", ".join([*kinds, "text string", "n_chars long"]))
