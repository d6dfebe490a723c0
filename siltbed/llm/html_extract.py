"""Main text of web pages by a tree-structured graphical model (operator 6).

A page is parsed into a tree of block elements whose leaves are the blocks of text. Every node is content, boilerplate or (elements
only) mixed; features of a node give its unary potentials, and parent-child potentials connect it to its parent. Sum-product messages
up and down the tree give each leaf's marginal, and the leaves that are likelier content than not make the text. The
weights are trained by maximum likelihood on labelled pages: made by templates of many layouts, and a bounded
sample of the input's own pages that mark their article, labelled by that mark.

Defined cases: null or empty html gives an empty text; a page without blocks too; a tag that never closes is text; a very long page is read whole, in time in
proportion to its length; pages are judged one by one, so repeated rows get equal texts; null ids and urls stay null; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import html
import math
import random
import re
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltbed.llm.common import private, slices

# Fixed values of HTML: elements that begin a block, have no content, are not shown as text, or close others when they begin.
BLOCKS = set("address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
             "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option optgroup p pre section select summary table tbody td tfoot th thead tr ul".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = set("script style template noscript iframe svg canvas object head title textarea math audio video".split())
CLOSERS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
           "tbody": {"tr", "td", "th", "tbody", "thead"}, "tfoot": {"tr", "td", "th", "tbody", "thead"}}
BARRIERS = {"li": {"ul", "ol", "menu", "dir"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "tbody": {"table"}, "tfoot": {"table"}, "option": {"select"}}
KEEPS_P = set("a b i em strong span u s small sub sup code font br img label input mark abbr cite q time".split())

#: Tags and comments; possessive, so that each try is linear. The last kind is the beginning of one without an end.
TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<[!?][^>]*+>|<(?=/?[A-Za-z]|[!?])", re.S)
OPENING = re.compile(r"<(?:/?[A-Za-z]|[!?])")
ATTR = re.compile(r"""(class|id|role|style|hidden|aria-label|itemprop)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
SHOWN = re.compile(r"(?<![\w-])(?:class|id|role|style|hidden|aria-label|itemprop)(?![\w-])", re.I)

#: Words of class, id and role names.
GROUPS = {
    "main": "article articlebody content post entry main story body text prose blog page-content",
    "nav": "nav navbar navigation menu breadcrumb breadcrumbs pagination pager tabs toc links skip toolbar",
    "head": "header masthead banner topbar top logo branding hero-nav site-header",
    "foot": "footer foot copyright colophon legal bottom credits imprint",
    "side": "sidebar side aside widget related recommended recommend rail more complementary trending popular",
    "ad": "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner-ad dfp outbrain taboola",
    "note": "notice cookie cookies consent gdpr alert popup modal newsletter subscribe subscription paywall warning announcement message toast overlay",
    "form": "form login signin signup search register input contact-form",
    "talk": "comment comments reply replies respond discussion disqus thread feedback reviews commenter",
    "share": "share social sharing follow tweet facebook twitter tags tagged byline meta metadata author date",
    "hidden": "hidden display:none sr-only visually-hidden none",
}
GROUP_OF = {w: g for g, ws in GROUPS.items() for w in ws.split()}
TAG_GROUPS = {"nav": "nav", "menu": "nav", "header": "head", "footer": "foot", "aside": "side", "form": "form", "button": "form", "select": "form", "option": "form",
              "fieldset": "form", "legend": "form", "article": "main", "main": "main", "dialog": "note"}
CONTENT, BOILER, MIXED = 0, 1, 2


class Tags:
    """The tags of a page in order. One that never closes, or has a quote that doesn't, is text.

    Such tags are rare; after the first one of a page the marks that end no tag (``dead``) are remembered, as every later
    try that comes to one of them fails too, so that the whole page takes time in proportion to its length.
    """

    def __init__(self, source: str):
        self.source, self.marks, self.dead, self.name_end, self.lost = source, None, set(), -1, -1

    def after(self, at: int) -> tuple[int, int, str, str, str] | None:
        """Start, end, slash, name (none for comments) and attributes of the first tag from ``at`` on."""
        while self.marks is None:
            m = TAG.search(self.source, at)
            if not m:
                return None
            if m.end() > m.start() + 1:
                return m.start(), m.end(), m[1] or "", m[2] or "", m[3] or ""
            at = m.start()
            self.marks = [x.start() for x in re.finditer("[>\"']", self.source)]
            self.last = self.source.rfind(">")
        for m in OPENING.finditer(self.source, at):
            if found := self._tag(m.start()):
                return found
        return None

    def _tag(self, start: int) -> tuple[int, int, str, str, str] | None:
        source = self.source
        if source.startswith("<!--", start):
            end = source.find("-->", start + 4)
            return start, end + 3 if end >= 0 else len(source), "", "", ""
        if start > self.last:
            return None
        if source[start + 1] in "!?":
            return start, source.find(">", start) + 1, "", "", ""
        first = start + 1 + (source[start + 1] == "/")
        if first < self.lost:  # inside a name from which no tag closes
            return None
        if first >= self.name_end:
            m = re.compile(r"[\s/>]").search(source, first)
            self.name_end = m.start() if m else len(source)
        quotes = self.marks[bisect_left(self.marks, first):bisect_left(self.marks, self.name_end)]
        for cut in (self.name_end, *reversed(quotes)):  # a quote belongs to the name, or else begins the attributes
            end = self._closing(cut)
            if end >= 0:
                return start, end + 1, source[start + 1:first], source[first:cut], source[cut:end]
        self.lost = self.name_end
        return None

    def _closing(self, at: int) -> int:
        """Where the tag closes whose attributes begin at ``at``; -1: nowhere."""
        path, i = [], bisect_left(self.marks, at)
        while i < len(self.marks) and (p := self.marks[i]) not in self.dead:
            if self.source[p] == ">":
                return p
            path.append(p)
            partner = self.source.find(self.source[p], p + 1)
            if partner < 0:
                break
            i = bisect_left(self.marks, partner + 1)
        self.dead.update(path)
        return -1


class Page:
    """Nodes in page order: ``parent`` (-1: root), ``tag`` ("#" for a text block), ``groups`` of own names, ``text`` of a block, ``linked`` characters."""

    def __init__(self, source: str):
        self.parent, self.tag, self.groups, self.text, self.linked = [-1], ["html"], [frozenset()], [""], [0]
        self._parse(source)

    def _add(self, parent: int, tag: str, groups: frozenset, text: str = "", linked: int = 0) -> int:
        for row, x in ((self.parent, parent), (self.tag, tag), (self.groups, groups), (self.text, text), (self.linked, linked)):
            row.append(x)
        return len(self.tag) - 1

    def _parse(self, source: str) -> None:
        stack, names = [0], ["html"]  # open blocks
        places: dict[str, list[int]] = {}  # where each name is open, but for the root
        endless: set[str] = set()  # unseen elements that end nowhere from here on
        words: list[str] = []
        linked = links = 0

        def close_block():
            nonlocal linked
            text = " ".join(html.unescape("".join(words)).split()) if words else ""
            if text:
                self._add(stack[-1], "#", frozenset(), text, min(linked, len(text)))
            words.clear()
            linked = 0

        def cut(at: int) -> None:
            """Close all open blocks from the one at ``at`` on."""
            for name in names[at:]:
                places[name].pop()
            del stack[at:], names[at:]

        def nearest(wanted: set) -> int:
            return max((places[name][-1] for name in wanted if places.get(name)), default=-1)

        def close(name: str) -> None:
            if places.get(name):
                close_block()
                cut(places[name][-1])

        at, size, tags = 0, len(source), Tags(source)
        while at < size:
            m = tags.after(at)
            piece = source[at:m[0]] if m else source[at:]
            if piece:
                words.append(piece)
                linked += len(piece) if links else 0
            if not m:
                break
            _, at, slash, name, attributes = m
            name = name.lower()
            if not name:
                continue
            if slash:
                if name == "a":
                    links = max(0, links - 1)
                elif name in BLOCKS:
                    close(name)
                continue
            if name in UNSEEN:
                if name == "head" or not attributes.rstrip().endswith("/"):
                    end = None if name in endless else re.compile(rf"</{re.escape(name)}\s*>", re.I).search(source, at)
                    if end:
                        at = end.end()
                    else:
                        endless.add(name)
                        at = at if name == "head" else size
                continue
            if name == "br":
                words.append(" ")
            elif name == "a":
                links = 1
            if name not in BLOCKS:
                continue
            close_block()
            links = 0
            if names[-1] == "p":
                close("p")
            if name in CLOSERS:
                last = nearest(CLOSERS[name])
                if last > nearest(BARRIERS.get(name, set())):
                    cut(last)
            if name in VOID or name in ("html", "body"):
                continue
            stack.append(self._add(stack[-1], name, self._named(name, attributes)))
            places.setdefault(name, []).append(len(names))
            names.append(name)
        close_block()

    @staticmethod
    def _named(name: str, attributes: str) -> frozenset:
        found = {TAG_GROUPS[name]} if name in TAG_GROUPS else set()
        if attributes and SHOWN.search(attributes):
            for key, *values in ATTR.findall(attributes):
                value = "".join(values).lower()
                if key.lower() == "hidden":
                    found.add("hidden")
                if key.lower() == "style":
                    if re.search(r"display\s*:\s*none", value):
                        found.add("hidden")
                    continue
                for word in value.split():
                    for part in {word, *re.split(r"[-_:]", word)}:
                        if part in GROUP_OF:
                            found.add(GROUP_OF[part])
        return frozenset(found)

    def features(self) -> list[list[str]]:
        """Names of each node's features."""
        n = len(self.tag)
        size, linked, stops = [len(t) for t in self.text], list(self.linked), [int(t[-1:] in ".!?:;\"'”»") for t in self.text]
        blocks = [int(t == "#") for t in self.tag]
        for i in range(n - 1, 0, -1):
            p = self.parent[i]
            size[p] += size[i]
            linked[p] += linked[i]
            stops[p] += stops[i]
            blocks[p] += blocks[i]
        above: list[frozenset] = [frozenset()] * n
        out = []
        for i in range(n):
            p = self.parent[i]
            if i:
                near = {f"near-{g}" for g in self.groups[p]}
                above[i] = above[p] | self.groups[p]
            else:
                near = set()
            leaf = self.tag[i] == "#"
            kind = "leaf" if leaf else "element"
            f = ["any", kind, f"{kind}-size-{min(8, size[i].bit_length())}", f"{kind}-links-{round(4 * linked[i] / max(1, size[i]))}",
                 f"{kind}-stops-{round(2 * stops[i] / max(1, blocks[i]))}", f"{kind}-in-{self.tag[p] if i else ''}", f"tag-{self.tag[i]}"]
            f += [f"own-{g}" for g in self.groups[i]] + [f"under-{g}" for g in above[i]] + list(near)
            if leaf and self.text[i][:1] in "©":
                f.append("sign")
            out.append(f)
        return out


class Model:
    """Log-linear potentials: ``unary`` of feature and state, ``pair`` of parent state and child state, for elements and for leaves."""

    def __init__(self, names: list[str]):
        self.at = {f: i for i, f in enumerate(names)}
        self.unary = np.zeros((len(names), 3))
        self.pair = np.zeros((2, 3, 3))

    def potentials(self, page: Page) -> tuple[np.ndarray, list[list[int]], list[int]]:
        rows = [[self.at[f] for f in fs if f in self.at] for fs in page.features()]
        u = np.array([self.unary[r].sum(axis=0) for r in rows])
        leaf = [int(t == "#") for t in page.tag]
        u[np.array(leaf, bool), MIXED] = -1e9
        return u, rows, leaf

    def marginals(self, page: Page) -> tuple[np.ndarray, np.ndarray, float, list, list]:
        """Node marginals, edge marginals (of each node with its parent) and the log partition sum, by messages up and down."""
        u, rows, leaf = self.potentials(page)
        n, parent = len(leaf), page.parent
        pair = np.exp(self.pair).tolist()
        top = u.max(axis=1)
        own = np.exp(u - top[:, None]).tolist()
        log_z = float(top.sum())
        up: list = [None] * n
        below = [list(x) for x in own]
        for i in range(n - 1, 0, -1):
            b = below[i]
            t = pair[leaf[i]]
            message = [t[s][0] * b[0] + t[s][1] * b[1] + t[s][2] * b[2] for s in range(3)]
            scale = sum(message)
            log_z += math.log(scale)
            up[i] = message = [x / scale for x in message]
            q = below[parent[i]]
            for s in range(3):
                q[s] *= message[s]
            total = sum(q)
            if total < 1e-100:  # many children: keep the product in range
                for s in range(3):
                    q[s] /= total
                log_z += math.log(total)
        total = sum(below[0])
        log_z += math.log(total)
        node = [[x / total for x in below[0]]] + [None] * (n - 1)
        edge = [None] * n
        for i in range(1, n):
            t, b, m, w = pair[leaf[i]], below[i], node[parent[i]], up[i]
            joint = [[(m[s] / w[s] if w[s] > 0 else 0.0) * t[s][c] * b[c] for c in range(3)] for s in range(3)]
            total = sum(map(sum, joint)) or 1.0
            edge[i] = joint = [[x / total for x in r] for r in joint]
            node[i] = [joint[0][c] + joint[1][c] + joint[2][c] for c in range(3)]
        return node, edge, log_z, rows, leaf

    def text(self, source: str | None) -> str:
        if not source:
            return ""
        page = Page(source)
        node = self.marginals(page)[0]
        return "\n".join(page.text[i] for i in range(1, len(page.tag)) if page.tag[i] == "#" and node[i][CONTENT] >= 0.5)


def states(page: Page, is_content: list[bool]) -> list[int]:
    """States of all nodes from those of the leaves: an element is mixed if its leaves differ."""
    n = len(page.tag)
    seen = [[0, 0] for _ in range(n)]
    for i in range(n - 1, -1, -1):
        if page.tag[i] == "#":
            seen[i][0 if is_content[i] else 1] += 1
        if i:
            for k in (0, 1):
                seen[page.parent[i]][k] += seen[i][k]
    return [MIXED if a and b else CONTENT if a else BOILER for a, b in seen]


def fit(labelled: list[tuple[str, list[str]]], rounds: int = 8, rate: float = 0.15, ridge: float = 1e-4, seed: int = 5) -> Model:
    """Maximum likelihood by stochastic steps (AdaGrad) over pages, given as html and the texts of their content blocks."""
    pages = []
    for source, wanted in labelled:
        page, wanted = Page(source), set(wanted)
        pages.append((page, states(page, [t in wanted for t in page.text])))
    model = Model(sorted({f for page, _ in pages for fs in page.features() for f in fs}))
    g2u, g2p = np.full(model.unary.shape, 1e-2), np.full(model.pair.shape, 1e-2)
    order = random.Random(seed)
    for _ in range(rounds):
        order.shuffle(pages)
        for page, truth in pages:
            node, edge, _, rows, leaf = model.marginals(page)
            gu, gp = {}, np.zeros((2, 3, 3))
            for i, r in enumerate(rows):
                d = np.array(node[i])
                d[truth[i]] -= 1
                for f in r:
                    gu[f] = gu[f] + d if f in gu else d
                if i:
                    gp[leaf[i]] += edge[i]
                    gp[leaf[i], truth[page.parent[i]], truth[i]] -= 1
            k = list(gu)
            g = np.array([gu[f] for f in k]) + ridge * model.unary[k]
            g2u[k] += g * g
            model.unary[k] -= rate * g / np.sqrt(g2u[k])
            gp += ridge * model.pair
            g2p += gp * gp
            model.pair -= rate * gp / np.sqrt(g2p)
    return model


def template_pages(count: int = 400, seed: int = 11) -> list[tuple[str, list[str]]]:
    """Pages of many layouts with the texts of their content blocks."""
    r = random.Random(seed)
    syllables = "ta ri mo len sa ver in da co per lu na est or tion vi el mar".split()
    word = lambda: "".join(r.choice(syllables) for _ in range(r.randint(1, 4)))
    words = lambda a, b: " ".join(word() for _ in range(r.randint(a, b)))
    sentence = lambda: words(3, 16).capitalize() + r.choice([".", ".", ".", "!", "?"])
    out = []
    for _ in range(count):
        wanted: list[str] = []

        def keep(text: str, wanted=wanted) -> str:
            wanted.append(" ".join(text.split()))
            return text

        def named(tag: str, plain: str, r=r):
            """An element by its own tag, or a div with a telling class or id."""
            if tag and r.random() < 0.5:
                return tag, f"<{tag}>"
            key = r.choice(["class", "class", "id"])
            return "div", f'<div {key}="{r.choice(plain.split())}">'

        def box(tag: str, plain: str, inner: str) -> str:
            name, opening = named(tag, plain)
            return f"{opening}{inner}</{name}>"

        def links(n):
            a = [f'<a href="/{word()}">{words(1, 3)}</a>' for _ in range(n)]
            return "<ul>" + "".join(f"<li>{x}</li>" for x in a) + "</ul>" if r.random() < 0.6 else r.choice([" | ", " ", ""]).join(a)

        def paragraph() -> str:
            text = " ".join(sentence() for _ in range(r.choice([1, 1, 2, 4, 7])))
            if r.random() < 0.1:
                text = r.choice([words(1, 2).capitalize() + ".", " | ".join(words(1, 1) for _ in range(9)), " ".join([word()] * 12)])
            keep(text)
            if r.random() < 0.15:
                return f"<p><b>{text}<br>"
            if r.random() < 0.2:
                a, _, b = text.partition(" ")
                return f'<p>{a} <a href="/x">{b}</a></p>' if len(b) < 30 else f"<p><em>{a}</em> {b}</p>"
            return f"<p>{text}</p>" if r.random() < 0.8 else f"<div>{text}</div>"

        advert = lambda: box("", "ad ads advert sponsored promo banner-ad", r.choice([sentence(), f"<p>{sentence()}</p>", links(2)]))
        notice = lambda: box("dialog", "notice cookie-notice alert consent newsletter subscribe", f"<p>{sentence()}</p>" + r.choice(["", "<button>OK</button>"]))
        form = lambda: f"<form><label>{words(1, 3)}</label><input name=q><button>{word()}</button></form>" if r.random() < 0.7 else box("", "login search-form signup", f"<p>{sentence()}</p><input>")
        share = lambda: box("", "share social tags byline", links(3))
        side = lambda: box("aside", "sidebar side-bar related widget recommended", f"<h3>{words(1, 3)}</h3>" + r.choice([links(4), f"<p>{sentence()} {sentence()}</p>"]))
        talk = lambda: box("", "comments comment-list discussion", f"<h3>{words(1, 2)}</h3>" + "".join(
            f'<div class="{r.choice(["comment", "reply", "item"])}"><p>{" ".join(sentence() for _ in range(r.randint(1, 4)))}</p></div>' for _ in range(r.randint(1, 4))))
        body = []
        if r.random() < 0.85:
            body.append(f"<h1>{keep(words(1, 9).capitalize())}</h1>")
        for _ in range(r.choice([0, 1, 2, 3, 5, 8])):
            x = r.random()
            if x < 0.74:
                body.append(paragraph())
            elif x < 0.8:
                body.append(f"<h2>{keep(words(1, 5))}</h2>")
            elif x < 0.85:
                body.append("<ul>" + "".join(f"<li>{keep(words(1, 9))}</li>" for _ in range(3)) + "</ul>")
            elif x < 0.88:
                body.append(f"<blockquote><p>{keep(sentence())}</p></blockquote>")
            elif x < 0.9:
                body.append(f"<table><tr><td>{keep(words(1, 3))}</td><td>{keep(words(1, 3))}</td></tr></table>")
            elif x < 0.92:
                body.append(f"<pre>{keep(words(3, 9))}</pre>")
            else:
                body.append(r.choice([advert, notice, share, side, form])())
        if r.random() < 0.15:
            body.append(talk())
        article = "".join(body)
        name, opening = named(r.choice(["article", "article", "main", "section"]), "content post entry article-body story main-content")
        article = f"{opening}{article}</{name}>"
        if r.random() < 0.2:
            article = f'<div class="{r.choice(["wrapper", "container", "row"])}">{article}</div>'
        start = [box("header", "header masthead site-header top-bar", r.choice([words(1, 3), f"<p>{words(1, 4)}</p>"])) if r.random() < 0.4 else "",
                 box("nav", "menu navbar nav breadcrumb", links(r.randint(2, 7))) if r.random() < 0.8 else ""]
        start += [f() for f in (advert, notice, side, form) if r.random() < 0.3]
        end = [f() for f in (talk, side, share, notice, form, advert) if r.random() < 0.3]
        end.append(box("footer", "footer site-footer copyright", r.choice([f"&copy; {words(1, 3)} &middot; {sentence()}", links(3), f"<p>{sentence()}</p>"])) if r.random() < 0.8 else "")
        out.append((f"<!DOCTYPE html><html><head><title>{words(2, 5)}</title></head><body>{''.join(start)}{article}{''.join(end)}</body></html>",
                    [html.unescape(w) for w in wanted]))
    return out


def marked_blocks(source: str) -> list[str] | None:
    """Content blocks of a page with an article element: those in it and in no element named as boilerplate; None without one."""
    page = Page(source)
    inside, bad = [False] * len(page.tag), [False] * len(page.tag)
    for i in range(1, len(page.tag)):
        p = page.parent[i]
        inside[i] = inside[p] or page.tag[i] == "article"
        bad[i] = bad[p] or bool(page.groups[i] - {"main"})
    content = [page.text[i] for i in range(len(page.tag)) if page.tag[i] == "#" and inside[i] and not bad[i]]
    return content if any(t == "article" for t in page.tag) else None


def train(pages: DataFrame, sample: int = 150, templates: int = 400, longest: int = 20_000) -> Model:
    """The model from ``templates`` made pages and at most ``sample`` pages of the input that mark their article and are shorter
    than ``longest``, which bounds what reaches the driver; pages of any length are extracted."""
    marked = pages.where(F.col("html").contains("<article") & (F.length("html") < longest))
    ids = marked.select("page_id").orderBy(F.xxhash64("page_id"), "page_id").limit(sample)  # ids alone are sorted for the sample
    chosen = marked.select("page_id", "html").join(F.broadcast(ids.distinct()), "page_id", "left_semi").limit(sample).collect()
    own = [(r.html, marked_blocks(r.html)) for r in chosen]
    return fit([*template_pages(templates), *((h, w) for h, w in own if w is not None)])


def extract(pages: DataFrame, model: Model) -> DataFrame:
    """page_id, url, text and n_chars of every page."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, 256):
                texts = [model.text(h) for h in part.column(2).to_pylist()]
                yield pa.record_batch([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").alias(private("html")))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
