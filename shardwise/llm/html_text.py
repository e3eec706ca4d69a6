"""Main text of HTML pages by a tree-structured graphical model.

A page becomes a tree of its block elements (and of inline elements with a class
or id).  Every node has a hidden label, content or boilerplate, with a unary
potential from its features (tag, words of its class and id, text length, link
share) and a 2x2 potential with its parent's label.  Sum-product messages pass
once upward and once downward and give each node's exact marginal; the text of
nodes with P(content) >= 1/2 is kept, in page order.  Scripts, styles and other
elements that never show text are not part of the tree.

Both kinds of potentials are trained by gradient ascent on the likelihood of
labelled pages (observed minus expected counts, the latter from the same message
passing), from prior weights of tags and of a word list, which stay in force
for what the sample does not hold, and from zero for every class and id word.
Labels come from pages whose own markup
names exactly one main part (``article`` or ``main``): what lies in it, outside of
navigation, asides, forms, headers and footers, is content.  The fit runs in one
task on a bounded sample (``MOST`` distinct pages and ``MOST_BYTES`` of html, chosen
by a hash of the html); pages are whole.  Class and id words are features by
their hash; the word list takes no part in the labels.

Defined results: null or empty html has an empty text; unclosed, misnested or
unknown markup is read leniently, in time proportional to the page; equal pages
give equal texts; without labelled pages the weights of ``prior_model`` are used;
input columns are kept, one called like the output column is replaced.
"""

from __future__ import annotations

import html as html_module
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import exp, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardwise.llm.common import hash_sample, ship, text_or_empty, text_slices

SLICE_CHARS = 1_000_000
MOST = 400  # distinct labelled pages in the training sample
MOST_BYTES = 32_000_000  # of html, in all of them
NAME_BITS = 18

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^"'<>]|"[^"]*"|'[^']*')*)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^<>]*)>""", re.S)
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
WORD = re.compile(r"[a-z]+")

#: elements whose content is no markup or never shown, up to their end tag
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "template", "head"}
#: elements whose text is left out, up to their end tag or that of the block they are in
HIDDEN = {"noscript", "svg", "canvas", "select", "button", "object", "datalist", "audio", "video"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "p", "pre", "search", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
#: a start tag of the key ends an open element of the value inside the same container
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"}}
SCOPES = {"ul", "ol", "dl", "table", "menu", "article", "main", "section", "nav", "aside", "body", "html"}

#: words of class, id and role that name page furniture or the main part
FURNITURE = {"ad", "ads", "advert", "adverts", "advertisement", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent", "contentinfo", "cookie", "cookies", "copyright", "discussion", "disqus", "dialog", "footer", "form", "gdpr", "header", "login", "masthead", "menu", "menubar", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "notification", "pagination", "pager", "popup", "promo", "promotion", "recommended", "related", "replies", "reply", "respond", "search", "share", "sharing", "sidebar", "signup", "social", "sponsor", "sponsored", "subscribe", "tags", "toolbar", "topbar", "widget", "alert", "overlay", "reactions", "teaser", "complementary"}
MAIN = {"article", "body", "content", "entry", "main", "post", "story", "text"}
UNLABELLED = {"nav", "aside", "footer", "form", "header"}

#: weights of the model that is used where no page is labelled
PRIOR = {"tag:nav": -5.0, "tag:footer": -4.0, "tag:aside": -5.0, "tag:form": -5.0, "tag:header": -3.0, "tag:menu": -4.0, "tag:dialog": -4.0, "tag:search": -4.0, "tag:fieldset": -2.0, "named:furniture": -8.0, "named:main": 1.5, "tag:article": 12.0, "tag:main": 12.0, "tag:p": 0.8, "tag:h1": 0.5, "tag:pre": 0.5, "tag:blockquote": 0.5, "tag:body": -0.5, "tag:html": -2.0, "links:most": -1.5, "length:long": 1.0, "length:middle": 0.4}
PAIR_PRIOR = ((0.5, -3.5), (0.0, 1.0))  # [parent's label][child's label]


@dataclass
class Page:
    parent: list[int] = field(default_factory=list)  # parents come before children
    tag: list[str] = field(default_factory=list)
    names: list[set] = field(default_factory=list)
    chars: list[int] = field(default_factory=list)  # of own text
    linked: list[int] = field(default_factory=list)  # of own text inside links
    events: list[tuple[int, str | None]] = field(default_factory=list)  # (node, text), or (_, None) at a block's edge


class Stack:
    """Open elements with their nodes.  The places of each name, of blocks, of
    scopes and of hidden elements are kept apart, so no tag searches the stack."""

    def __init__(self):
        self.items: list[tuple[str, int]] = []
        self.at: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.scopes: list[int] = []
        self.hidden = self.links = 0

    def push(self, name: str, node: int) -> None:
        i = len(self.items)
        self.items.append((name, node))
        self.at.setdefault(name, []).append(i)
        if name in BLOCK:
            self.blocks.append(i)
        if name in SCOPES:
            self.scopes.append(i)
        self.hidden += name in HIDDEN
        self.links += name == "a"

    def pop(self) -> str:
        name, _ = self.items.pop()
        self.at[name].pop()
        if name in BLOCK:
            self.blocks.pop()
        if name in SCOPES:
            self.scopes.pop()
        self.hidden -= name in HIDDEN
        self.links -= name == "a"
        return name

    def last(self, name: str) -> int:
        places = self.at.get(name)
        return places[-1] if places else -1

    def first_after(self, names: set, place: int) -> int:
        """The first open element of ``names`` behind ``place``, -1 without any."""
        found = [p[k] for p in (self.at.get(n, []) for n in names) if (k := bisect_right(p, place)) < len(p)]
        return min(found, default=-1)


def parse(source: str) -> Page:
    page, stack = Page(), Stack()

    def node(tag: str, names: set) -> int:
        page.parent.append(stack.items[-1][1] if stack.items else -1 if not page.tag else 0)
        for seq, x in ((page.tag, tag), (page.names, names), (page.chars, 0), (page.linked, 0)):
            seq.append(x)
        return len(page.tag) - 1

    root = node("html", set())

    def text(raw: str) -> None:
        if raw and not stack.hidden:
            at = stack.items[-1][1] if stack.items else root
            page.events.append((at, raw))
            n = len(raw.strip())
            page.chars[at] += n
            page.linked[at] += n if stack.links else 0

    def close(i: int) -> None:
        while len(stack.items) > i:
            if stack.pop() in BLOCK:
                page.events.append((0, None))

    at = 0
    endless: set[str] = set()  # raw elements without an end tag from some place on
    while m := TOKEN.search(source, at):
        text(source[at : m.start()])
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        if m[1] or m[4]:  # an end tag: ignored if nothing of that name is open, or if it would end a block around it
            i = stack.last(name)
            if i >= 0 and (name in BLOCK or not stack.blocks or stack.blocks[-1] < i):
                close(i)
            continue
        attributes = m[3] or m[6] or ""
        single = attributes.rstrip().endswith("/")
        if name in RAW and not single:
            end = None
            if name not in endless:
                end = re.compile(rf"</{re.escape(name)}\b[^<>]*>", re.I).search(source, at)
                if not end:
                    endless.add(name)
            at = end.end() if end else (len(source) if name in ("script", "style", "title", "textarea") else at)
            continue
        if name == "br":
            text("\n")
            continue
        if name == "hr":
            page.events.append((0, None))
        if name in VOID or name == "html" or (single and name in HIDDEN):
            continue
        if name in HIDDEN:
            i = stack.last(name)
            if i >= 0 and (not stack.blocks or stack.blocks[-1] < i):
                close(i)  # one that was never ended
        if name in BLOCK:
            i = stack.first_after({"p"} | ENDS.get(name, set()), stack.scopes[-1] if stack.scopes else -1)
            if i >= 0:
                close(i)
            page.events.append((0, None))
        named = {w for g in NAMES.findall(attributes) for x in g for w in WORD.findall(x.lower())}
        own = name in BLOCK or bool(named)
        stack.push(name, node(name, named) if own else (stack.items[-1][1] if stack.items else root))
    text(source[at:])
    return page


def node_features(page: Page) -> list[list[str]]:
    n = len(page.tag)
    chars, linked = page.chars[:], page.linked[:]
    for i in range(n - 1, 0, -1):
        chars[page.parent[i]] += chars[i]
        linked[page.parent[i]] += linked[i]
    out = []
    for i in range(n):
        f = ["bias", f"tag:{page.tag[i]}", *[f"name:{zlib.crc32(w.encode()) >> (32 - NAME_BITS)}" for w in sorted(page.names[i])]]
        if page.names[i] & FURNITURE:
            f.append("named:furniture")
        elif page.names[i] & MAIN:
            f.append("named:main")
        f.append("length:none" if not page.chars[i] else "length:short" if page.chars[i] < 25 else "length:middle" if page.chars[i] < 100 else "length:long")
        if chars[i]:
            share = linked[i] / chars[i]
            f.append("links:most" if share > 0.6 else "links:some" if share > 0.2 else "links:few")
        out.append(f)
    return out


def _lse(a: float, b: float) -> float:
    return (a + log1p(exp(b - a))) if a > b else (b + log1p(exp(a - b)))


def marginals(parent: list[int], unary: list[float], pair: list[list[float]]) -> tuple[list[float], list[list[float]]]:
    """P(content) of every node, and the summed marginals of the edges' label
    pairs.  unary: log-odds of content; pair[p][c]: log potential."""
    n = len(parent)
    up0, up1 = [0.0] * n, list(unary)  # log belief from below, for labels 0 and 1
    to0, to1 = [0.0] * n, [0.0] * n  # message to the parent's labels
    for i in range(n - 1, 0, -1):
        to0[i] = _lse(up0[i] + pair[0][0], up1[i] + pair[0][1])
        to1[i] = _lse(up0[i] + pair[1][0], up1[i] + pair[1][1])
        p = parent[i]
        up0[p] += to0[i]
        up1[p] += to1[i]
    down0, down1 = [0.0] * n, [0.0] * n
    prob, edges = [0.0] * n, [[0.0, 0.0], [0.0, 0.0]]
    for i in range(n):
        if i:
            p = parent[i]
            out0 = up0[p] + down0[p] - to0[i]  # the parent's belief without this child
            out1 = up1[p] + down1[p] - to1[i]
            down0[i] = _lse(out0 + pair[0][0], out1 + pair[1][0])
            down1[i] = _lse(out0 + pair[0][1], out1 + pair[1][1])
            joint = [[out0 + pair[0][0] + up0[i], out0 + pair[0][1] + up1[i]], [out1 + pair[1][0] + up0[i], out1 + pair[1][1] + up1[i]]]
            top = max(map(max, joint))
            weights = [[exp(x - top) for x in row] for row in joint]
            total = sum(map(sum, weights))
            for a in (0, 1):
                for b in (0, 1):
                    edges[a][b] += weights[a][b] / total
        d = (up1[i] + down1[i]) - (up0[i] + down0[i])
        prob[i] = 1 / (1 + exp(-d)) if d > -700 else 0.0
    return prob, edges


@dataclass
class Model:
    weights: dict[str, float]
    pair: list[list[float]]


def prior_model() -> Model:
    return Model(dict(PRIOR), [list(r) for r in PAIR_PRIOR])


def markup_labels(page: Page) -> list[int] | None:
    """Labels of a page whose markup names exactly one main part, else None."""
    mains = [i for i, t in enumerate(page.tag) if t in ("article", "main")]
    if len(mains) != 1:
        return None
    label = [0] * len(page.tag)
    for i in range(mains[0], len(page.tag)):
        inside = i == mains[0] or label[page.parent[i]] == 1
        label[i] = int(inside and page.tag[i] not in UNLABELLED)
    return label


def fit(sources: list[str], steps: int = 60, rate: float = 0.5, ridge: float = 0.002) -> Model:
    """Likelihood of the labelled pages, climbed from the prior's weights (zero
    for all that it does not name) with a weak pull back to them."""
    pages = [(p, y) for p in map(parse, sources) if (y := markup_labels(p)) is not None]
    if not pages:
        return prior_model()
    # equal nodes of equal pages count as often as they occur; features as numbers
    names: dict[str, int] = {}
    data = [(p.parent, [[names.setdefault(f, len(names)) for f in fs] for fs in node_features(p)], y) for p, y in pages]
    n = sum(len(y) for _, _, y in data)
    flat = np.array([f for _, feats, _ in data for fs in feats for f in fs])
    owner = np.repeat(np.arange(n), [len(fs) for _, feats, _ in data for fs in feats])
    label = np.array([x for _, _, y in data for x in y], dtype=float)
    seen = np.zeros((2, 2))
    for parent, _, y in data:
        for i in range(1, len(y)):
            seen[y[parent[i]], y[i]] += 1
    count = np.bincount(flat, minlength=len(names))
    prior, pair_prior = np.array([PRIOR.get(f, 0.0) for f in names]), np.array(PAIR_PRIOR)
    weights, pair = prior.copy(), pair_prior.copy()
    for _ in range(steps):
        unary = np.bincount(owner, weights[flat], minlength=n)
        prob, expected, at = np.zeros(n), np.zeros((2, 2)), 0
        for parent, _, y in data:
            own, edges = marginals(parent, unary[at : at + len(y)].tolist(), pair.tolist())
            prob[at : at + len(y)] = own
            expected += edges
            at += len(y)
        gradient = np.bincount(flat, (label - prob)[owner], minlength=len(names))
        # a step by the feature's own count, so that rare tags are learnt as well
        weights += rate * (4 * gradient / (count + 5) - ridge * (weights - prior))
        pair += rate * (10 * (seen - expected) / n - ridge * (pair - pair_prior))
    return Model(PRIOR | dict(zip(names, weights.tolist(), strict=True)), pair.tolist())


def main_text(source: str, model: Model) -> str:
    if not source:
        return ""
    page = parse(source)
    prob, _ = marginals(page.parent, [sum(model.weights.get(f, 0.0) for f in fs) for fs in node_features(page)], model.pair)
    blocks, run = [], []

    def flush() -> None:
        if run:
            line = " ".join(html_module.unescape("".join(run)).split())
            if line:
                blocks.append(line)
            run.clear()

    for at, raw in page.events:
        if raw is None:
            flush()
        elif prob[at] >= 0.5:
            run.append(raw)
    flush()
    return "\n".join(blocks)


def train(pages: DataFrame, html: str = "html", most: int = MOST, most_bytes: int = MOST_BYTES) -> Model:
    """Fit on at most ``most`` distinct pages that name one main part; only the
    weights come back."""
    ship(pages.sparkSession)
    source = pages.select(F.col(html).alias("_html")).where(F.lower("_html").rlike("<(article|main)[ >]") & (F.octet_length("_html") <= most_bytes // most))
    distinct = source.groupBy(F.xxhash64("_html").alias("_k")).agg(F.first("_html").alias("_html"))
    sample = hash_sample(distinct, F.col("_k"), most).select("_html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = fit(sorted(t for batch in batches for t in batch.column(0).to_pylist()))
        rows = sorted(model.weights.items()) + [(f"pair {a} {b}", model.pair[a][b]) for a in (0, 1) for b in (0, 1)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=["name", "weight"])

    got = dict(map(tuple, sample.coalesce(1).mapInArrow(run, "name string, weight double").collect()))  # bounded by the sample's bytes
    pair = [[got.pop(f"pair {a} {b}", PAIR_PRIOR[a][b]) for b in (0, 1)] for a in (0, 1)]
    return Model(got, pair) if got else prior_model()


def extract(df: DataFrame, model: Model, html: str = "html", out: str = "text") -> DataFrame:
    """``df`` with ``out``, the main text of each page."""
    ship(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast((model.weights, model.pair))

    @F.arrow_udf(T.StringType())
    def read(it: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = Model(*shared.value)
        for sources in it:
            parts = [pa.array([main_text(s, m) for s in part], type=pa.string()) for _, _, part in text_slices(sources, SLICE_CHARS)]
            yield pa.concat_arrays([pa.array([], type=pa.string()), *parts])

    return df.withColumn(out, read(text_or_empty(html)))
