"""Main-text extraction with a tree-structured graphical model over the DOM.

Every element that holds text, and every run of text between block boundaries, is a
binary variable (content or not). Unary potentials score an element's tag and the words
of its class, id and role, and a run's length, link share and punctuation; parent-child
potentials connect the nodes. One upward and one downward sum-product pass give exact
marginals; runs whose marginal is at least one half are the article, joined in page
order. The potentials are trained by maximum likelihood on labelled pages
(:func:`labelled_pages`, a bounded set of layouts generated here). Pages on which no tag
or class names the article, and those on which the marks lead to no text, are scored by
shape instead: length, link share, punctuation, share among siblings and place beside the
longest runs, with potentials of their own (:func:`unmarked_pages`).

Results for odd input: null or empty html, and pages without an article, give an empty
text; unclosed and stray tags are tolerated (a page without ``</body>`` is read to its
end, a head ends where its content does); repeated rows give equal results. Only script,
style, template and the page's title are dropped before the model; MathML, SVG text and
the fallback text of noscript, object, canvas, audio, video and iframe are scored as the
text around them.
"""

from __future__ import annotations

import math
import random
import re
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import release, small_batches

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset("script style template title".split())
#: A head without its end tag ends at any other tag (or at text).
IN_HEAD = frozenset("html head base link meta noscript script style template title".split())
FOREIGN = frozenset({"math", "svg"})
INLINE = frozenset("a abbr acronym audio b bdi bdo big canvas cite code data del dfn em font i iframe img ins kbd label mark math noscript object q s samp small span strike strong sub sup svg time tt u var video wbr".split())
#: An opening tag ends these open elements, up to the given containers.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
TAGS = "html body main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table tbody tr td th blockquote pre figure figcaption nav header footer aside form fieldset button select option textarea dialog details summary address menu center".split()
#: Word starts in class, id and role that belong together.
GROUPS = {
    "ad": ("ad", "ads", "advert", "sponsor", "promo", "banner", "commercial", "dfp"),
    "notice": ("cookie", "consent", "gdpr", "notice", "alert", "warning", "popup", "modal", "overlay", "announce", "toast", "paywall"),
    "nav": ("nav", "menu", "breadcrumb", "toc", "pagin", "pager", "skip", "tabs", "navigation"),
    "head": ("head", "masthead", "topbar", "logo", "brand"),
    "foot": ("foot", "copyright", "legal", "imprint", "contentinfo", "credits"),
    "side": ("side", "aside", "widget", "rail", "related", "recommend", "trending", "popular", "teaser", "complementary", "latest"),
    "comment": ("comment", "reply", "replies", "disqus", "discuss", "thread", "review", "respond", "feedback", "guestbook", "opinion", "cmt", "talkback"),
    "form": ("form", "login", "signup", "subscri", "newsletter", "search", "contact", "register"),
    "share": ("share", "sharing", "social", "follow", "tool", "print", "rating", "tags"),
    "hidden": ("hidden", "invisible", "sr"),
    "text": ("article", "content", "main", "post", "entry", "story", "body", "text", "prose", "page", "container", "wrapper"),
}
TABLE = frozenset("html body table thead tbody tfoot tr td th caption template".split())
CELLS = ("td", "th", "caption", "template")
FEATURES = ["element", *("tag:" + t for t in TAGS), "tag:other", *("group:" + g for g in GROUPS), "hidden", "header in article", "footer in article", "run", "run:long", "run:links", "run:points", "run:words"]
AT = {f: i for i, f in enumerate(FEATURES)}
#: Shape of an element or run: its share of the plain text, links, length, marks, and place
#: beside the page's longest runs. Used where no mark names the article.
SHAPE = ["share", "of siblings", "links below", "long below", "prose below", "points below", "before prose", "after prose", "run alone", "run of siblings", "run before", "run after"]
SHAPE_AT = {f: len(FEATURES) + i for i, f in enumerate(SHAPE)}
PROSE = 80  # characters of a run that counts as prose
POINTS = ".,;:!?\u3002\uff0c\u3001\uff01\uff1f\uff1b\u061f\u060c\u0964"
#: Words of classes, ids and roles that name the article itself.
NAMES = {"article", "content", "main", "post", "entry", "story", "prose"}
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


class Page(HTMLParser):
    """Text-bearing part of a page's element tree. ``nodes`` are (parent, features)
    in page order, parents first; ``runs`` maps a run's node to its text. Only blocks and
    dropped elements are stacked, places of open tags are kept by name and a node is made
    once, so the time is linear in the page however deep it nests."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.nodes: list[tuple[int, tuple]] = []
        self.runs: dict[int, str] = {}
        #: tag, attributes, node, dropped, within article or main, open link, open MathML and SVG
        self.stack: list[list] = []
        self.at: dict[str, list[int]] = {}  # places on the stack by tag
        self.placed = 0  # entries of the stack that have their node
        self.dropped = 0
        self.foreign = 0
        self.held: list[tuple[str, bool]] = []
        self.feed(html)
        self.close()
        self.flush()

    def place(self) -> int:
        """Node of the innermost open element; makes the missing ones."""
        for i in range(self.placed, len(self.stack)):
            entry = self.stack[i]
            self.nodes.append((self.stack[i - 1][2] if i else -1, (entry[0], entry[1], entry[4] and entry[0] in ("header", "footer"))))
            entry[2] = len(self.nodes) - 1
        self.placed = len(self.stack)
        return self.stack[-1][2] if self.stack else -1

    def flush(self) -> None:
        """End the current run of text."""
        if self.held:
            text = " ".join("".join(t for t, _ in self.held).split())
            if text:
                linked = sum(len(t) for t, inside in self.held if inside) / max(1, sum(len(t) for t, _ in self.held))
                self.nodes.append((self.place(), (None, text, linked)))
                self.runs[len(self.nodes) - 1] = text
            self.held = []

    def last(self, tags) -> int:
        """Place of the innermost open element of these tags, or -1."""
        return max((self.at[t][-1] for t in tags if self.at.get(t)), default=-1)

    def pop_to(self, at: int) -> None:
        if not self.dropped:
            self.flush()
        while len(self.stack) > at:
            entry = self.stack.pop()
            self.at[entry[0]].pop()
            self.dropped -= entry[3]
            self.foreign -= entry[6]
        self.placed = min(self.placed, at)

    def end_head(self) -> None:
        if self.at.get("head"):
            self.pop_to(self.at["head"][0])

    def handle_starttag(self, tag, attrs):
        if tag not in IN_HEAD and not self.dropped:
            self.end_head()
        if tag == "br":
            self.held.append(("\n", False))
            return
        drop = tag in DROPPED and not (tag == "title" and self.foreign)
        # MathML and SVG elements are parts of a line; HTML blocks within them stay blocks
        if not drop and (tag in INLINE or self.foreign > 0 and tag not in TAGS):
            if self.stack and not self.dropped:
                self.stack[-1][5] |= tag == "a"
                self.stack[-1][6] += tag in FOREIGN
            self.foreign += tag in FOREIGN and bool(self.stack) and not self.dropped
            return
        if not drop:
            if self.stack and self.stack[-1][0] == "p":  # a block ends an open paragraph
                self.pop_to(len(self.stack) - 1)
            if tag in CLOSES:
                ends, within = CLOSES[tag]
                if (at := self.last(ends)) > self.last(within):
                    self.pop_to(at)
            if not self.dropped:
                self.flush()
        if tag in VOID:
            return
        marks = " ".join(v for k, v in attrs if v and k in ("class", "id", "role"))
        hidden = any(k == "hidden" or k == "aria-hidden" and v == "true" or k == "style" and v and "display:none" in v.replace(" ", "") for k, v in attrs)
        above = self.stack[-1] if self.stack else None
        inside = above is not None and (above[4] or above[0] in ("article", "main"))
        self.at.setdefault(tag, []).append(len(self.stack))
        self.stack.append([tag, (marks, hidden), None, drop, inside, above is not None and above[5], 0])
        self.dropped += drop

    def handle_endtag(self, tag):
        if tag in INLINE or self.foreign and tag not in TAGS and not self.at.get(tag):
            if self.stack and not self.dropped:
                if tag == "a":
                    self.stack[-1][5] = False
                elif tag in FOREIGN and self.stack[-1][6]:
                    self.stack[-1][6] -= 1
                    self.foreign -= 1
                elif self.foreign and tag in ("text", "title", "desc"):  # labels of a drawing
                    self.held.append((" ", False))
        elif self.at.get(tag):
            at = self.at[tag][-1]
            if tag in TABLE or at > self.last(CELLS):  # cells keep what is open outside them
                if self.stack[at][3] and at == len(self.stack) - 1:  # a script within a line does not end it
                    self.at[tag].pop()
                    self.stack.pop()
                    self.dropped -= 1
                    self.placed = min(self.placed, at)
                else:
                    self.pop_to(at)

    def handle_data(self, data):
        if not self.dropped:
            if data.strip():
                self.end_head()
            self.held.append((data, bool(self.stack) and self.stack[-1][5]))


def features(node: tuple) -> list[tuple[int, float]]:
    """Sparse features of a node."""
    tag, what, extra = node
    if tag is None:
        words = what.count(" ") + 1
        points = sum(map(what.count, ".,;:!?"))
        return [(AT["run"], 1.0), (AT["run:long"], min(1.0, math.log1p(len(what)) / 6)), (AT["run:links"], extra), (AT["run:points"], min(1.0, points / words)), (AT["run:words"], min(1.0, words / 12))]
    out = [(AT["element"], 1.0), (AT.get("tag:" + tag, AT["tag:other"]), 1.0)]
    words = [w.lower() for w in WORD.findall(what[0])]
    for group, starts in GROUPS.items():
        if any(w in starts or any(len(s) > 3 and w.startswith(s) for s in starts) for w in words):
            out.append((AT["group:" + group], 1.0))
    if what[1]:
        out.append((AT["hidden"], 1.0))
    if extra:
        out.append((AT[f"{tag} in article"], 1.0))
    return out


def marked(page: Page) -> bool:
    """Whether an element names the article by its tag or a word of its marks."""
    return any(
        tag in ("article", "main") or tag is not None and not NAMES.isdisjoint(w.lower() for w in WORD.findall(what[0]))
        for _, (tag, what, _) in page.nodes
    )


def shapes(page: Page) -> list[list[tuple[int, float]]]:
    """Features of all nodes with those of their shape, by one pass up and one down."""
    n = len(page.nodes)
    plain, linked, prose, points, runs, start = ([0.0] * n for _ in range(6))
    longest = max((len(t) for t in page.runs.values()), default=1)
    place, bounds = 0, []
    for i in range(n):
        start[i] = place
        tag, what, extra = page.nodes[i][1]
        if tag is None:
            size = len(what)
            linked[i] = size * extra
            plain[i] = size - linked[i]
            prose[i] = plain[i] if size >= PROSE else 0.0
            points[i], runs[i] = sum(map(what.count, POINTS)), 1
            if size >= longest / 2 and extra < 0.5:
                bounds.append((place, place + size))
            place += size
    for i in range(n - 1, -1, -1):
        p = page.nodes[i][0]
        if p >= 0:
            for v in (plain, linked, prose, points, runs):
                v[p] += v[i]
    most: dict[int, float] = {}
    for i in range(n):
        p = page.nodes[i][0]
        most[p] = max(most.get(p, 1.0), plain[i])
    total = max(1.0, sum(plain[i] for i in range(n) if page.nodes[i][0] < 0))
    first, last = (bounds[0][0], bounds[-1][1]) if bounds else (0, place)
    at, out = SHAPE_AT, []
    for i, (p, node) in enumerate(page.nodes):
        size = plain[i] + linked[i]
        before, after = float(start[i] + size <= first), float(start[i] >= last)
        f = features(node)
        if node[0] is None:
            f += [(at["run alone"], float(p < 0 or runs[p] == 1)), (at["run of siblings"], plain[i] / most[p]), (at["run before"], before), (at["run after"], after)]
        else:
            f += [
                (at["share"], plain[i] / total), (at["of siblings"], plain[i] / most[p]), (at["links below"], linked[i] / max(1.0, size)),
                (at["long below"], min(1.0, math.log1p(plain[i] / runs[i]) / 6)), (at["prose below"], prose[i] / max(1.0, size)),
                (at["points below"], min(1.0, points[i] / max(1.0, size / 60))), (at["before prose"], before), (at["after prose"], after),
            ]
        out.append(f)
    return out


def marginals(parents: list[int], unary: list[float], pair: list[list[float]]) -> tuple[list[float], list[float]]:
    """Exact marginals P(content) of all nodes, and each node's P(parent content, node
    content) - by one upward and one downward pass. ``unary`` are log-odds;
    ``pair[x][y]`` is the potential of parent state x and child state y."""
    n = len(parents)
    e = [[math.exp(v) for v in row] for row in pair]
    up = [math.exp(max(-30.0, min(30.0, u))) for u in unary]  # belief ratio from below
    to_parent = [1.0] * n
    for i in range(n - 1, -1, -1):
        b = up[i]
        to_parent[i] = (e[1][0] + e[1][1] * b) / (e[0][0] + e[0][1] * b)
        if parents[i] >= 0:
            up[parents[i]] = min(1e30, max(1e-30, up[parents[i]] * to_parent[i]))
    full, both = [0.0] * n, [0.0] * n
    for i in range(n):
        p = parents[i]
        if p < 0:
            full[i] = up[i] / (1 + up[i])
            continue
        on = full[p]
        rest = on / max(1e-30, 1 - on) / to_parent[i]  # parent's ratio without this child
        on1 = rest * (e[1][1] * up[i])
        on0, off1, off0 = rest * e[1][0], e[0][1] * up[i], e[0][0]
        total = on1 + on0 + off1 + off0
        both[i] = on1 / total
        full[i] = min(1 - 1e-15, max(1e-15, (on1 + off1) / total))
    return full, both


class Model:
    """Two sets of potentials: for pages that mark their article, and by shape for the others
    (and where the marks lead to no text)."""

    def __init__(self):
        self.weights = np.zeros(len(FEATURES))
        self.pair = [[0.0, 0.0], [0.0, 0.0]]
        self.shape_weights = np.zeros(len(FEATURES) + len(SHAPE))
        self.shape_pair = [[0.0, 0.0], [0.0, 0.0]]
        self.known: dict[tuple, float] = {}

    def unary(self, node: tuple) -> float:
        if node[0] is None:
            return sum(self.weights[i] * v for i, v in features(node))
        score = self.known.get(node)
        if score is None:
            score = self.known[node] = float(sum(self.weights[i] * v for i, v in features(node)))
            if len(self.known) > 50_000:
                self.known.clear()
        return score

    def text(self, html: str | None) -> str:
        """Main text of a page."""
        page = Page(html or "")
        if not page.runs:
            return ""
        parents, text = [p for p, _ in page.nodes], ""
        if marked(page):
            full, _ = marginals(parents, [self.unary(n) for _, n in page.nodes], self.pair)
            text = " ".join(t for i, t in page.runs.items() if full[i] >= 0.5)
        if not text:
            w = self.shape_weights
            full, _ = marginals(parents, [sum(w[i] * v for i, v in f) for f in shapes(page)], self.shape_pair)
            text = " ".join(t for i, t in page.runs.items() if full[i] >= 0.5)
        return text


def labelled_pages(pages: int = 360, seed: int = 11) -> list[tuple[str, set[str]]]:
    """Labelled training pages: ``(html, article runs)``. Layouts vary in tags, class
    names and order; text lengths overlap, so that structure has to decide."""
    rng = random.Random(seed)
    made = 0

    def words(lo: int, hi: int) -> str:
        nonlocal made
        made += 1
        body = ["".join(rng.choice("abdeilnorstuw") for _ in range(rng.randint(2, 9))) for _ in range(rng.randint(lo, hi))]
        body.insert(0, f"x{made}")
        return " ".join(w + (rng.choice(".,.") if rng.random() < 0.12 else "") for w in body).rstrip(",.") + rng.choice([".", ".", ""])

    def block(tag: str, inner: str, marks: str = "") -> str:
        return f"<{tag}{marks}>{inner}" + ("" if tag in ("p", "li") and rng.random() < 0.1 else f"</{tag}>")

    def mark(*names: str) -> str:
        return f' {rng.choice(["class", "class", "id"])}="{rng.choice(names)}"' if names else ""

    def links(tag: str = "ul") -> str:
        return block(tag, "".join(block("li", f'<a href="/x">{words(0, 3)}</a>') for _ in range(rng.randint(2, 6))))

    def boiler(kind: str) -> str:
        filler = lambda: rng.choice([block("p", words(2, 40)), words(1, 30), block("div", words(1, 25)), block("p", f"<b>{words(1, 9)}</b> {words(1, 20)}")])
        if kind == "nav":
            return rng.choice([block("nav", links()), block("nav", rng.choice([words(0, 6), block("p", words(0, 6)), block("span", words(0, 3)), "".join(f'<a href="/z">{words(0, 2)}</a> ' for _ in range(3))])), block("div", links(), mark("menu", "main-nav", "navbar", "breadcrumbs", "site-navigation", "nav content")), block("ul", block("li", f"<a href='/'>{words(0, 2)}</a>"), mark("menu", "pagination"))])
        if kind == "head":
            return rng.choice([block("header", filler() + links()), block("header", block("h1", words(1, 6)), mark("site-header", "page-header")), block("div", filler(), mark("header", "masthead", "topbar")), block("header", filler())])
        if kind == "foot":
            return rng.choice([block("footer", "&copy; " + words(1, 25)), block("footer", filler() + links()), block("div", filler(), mark("footer", "site-footer", "page-footer", "copyright", "legal"))])
        if kind == "side":
            return rng.choice([block("aside", block("h3", words(1, 5)) + filler()), block("aside", links()), block("div", block("h2", words(1, 4)) + filler() + links(), mark("sidebar", "side-bar", "widget", "related-articles", "content-sidebar", "recommended", "right-rail"))])
        if kind == "notice":
            return rng.choice([block("div", filler() + block("button", words(0, 2)), mark("cookie-notice", "cookie-banner", "consent", "notice", "alert", "popup", "gdpr-overlay")), block("dialog", filler()), block("section", filler(), mark("notice", "cookies")), block("p", words(3, 30), mark("notice", "cookie"))])
        if kind == "ad":
            return rng.choice([block("div", words(2, 40), mark("ad", "ads", "advert", "ad-slot", "advertisement", "sponsored", "promo")), block("section", filler(), mark("sponsor", "ad")), block("aside", filler(), mark("ad", "promo")), block("p", words(2, 20), mark("ad", "advert")), block("ins", block("div", filler()), mark("ads"))])
        if kind == "form":
            return rng.choice([block("form", filler() + f"<label>{words(0, 3)}</label><input name=q>" + block("button", words(0, 2))), block("div", block("form", filler()), mark("newsletter", "subscribe", "login")), block("form", block("select", block("option", words(0, 2)) * 2) + block("textarea", words(0, 6)))])
        if kind == "share":
            return block("div", filler(), mark("share", "social-links", "sharing", "post-tags", "tools"))
        item = lambda: rng.choice([block("li", filler(), mark("comment")), block("div", block("p", words(2, 45)), mark("comment", "comment-body", "reply", "comment-content")), block("article", block("p", words(2, 45)), mark("comment")), block("p", words(3, 45)), block("div", block("h4", words(0, 2)) + block("p", words(2, 30)))])
        return block(rng.choice(["div", "section", "ol", "aside"]), rng.choice(["", block("h2", words(0, 4)), block("h3", words(0, 3))]) + "".join(item() for _ in range(rng.randint(1, 4))), mark("comments", "comment-list", "post-comments", "user-comments", "discussion", "reviews", "replies", "disqus_thread"))

    out = []
    for _ in range(pages):
        article: set[str] = set()

        def text(lo: int, hi: int, kept: set[str] = article) -> str:
            t = words(lo, hi)
            kept.add(t)
            return t

        def body() -> str:
            r = rng.random()
            if r < 0.66:
                t = words(0, 60)
                parts = t.split(" ")
                article.add(t)
                if len(parts) > 3 and rng.random() < 0.4:
                    k = rng.randrange(1, len(parts) - 1)
                    parts[k] = rng.choice([f"<b>{parts[k]}</b>", f'<a href="/y">{parts[k]}</a>', f"<em>{parts[k]}</em>"])
                return block("p", " ".join(parts), rng.choice(["", "", "", mark("text", "lead", "paragraph")]))
            if r < 0.74:
                return block(rng.choice(["h2", "h3", "h4"]), text(0, 7))
            if r < 0.81:
                return block(rng.choice(["ul", "ol"]), "".join(block("li", text(0, 18)) for _ in range(rng.randint(1, 4))))
            if r < 0.86:
                return block("blockquote", rng.choice([text(2, 30), block("p", text(2, 30))]))
            if r < 0.89:
                return block("pre", text(2, 12))
            if r < 0.92:
                return block("figure", "<img src=x>" + block("figcaption", text(1, 12)))
            if r < 0.95:
                return block("table", "".join(block("tr", block("td", text(0, 4)) + block("td", text(0, 4))) for _ in range(2)))
            return block(rng.choice(["div", "section"]), block("p", text(1, 50)) + block("p", text(1, 50)), rng.choice(["", mark("text", "section", "body")]))

        title = rng.choice([block("h1", text(1, 9)), block("header", block("h1", text(1, 9))), "", block("h1", text(1, 9))])
        main = title + "".join(body() + (boiler(rng.choice(["ad", "share", "side", "form", "notice", "comment"])) if rng.random() < 0.12 else "") for _ in range(rng.randint(1, 8)))
        if rng.random() < 0.2:
            main += boiler(rng.choice(["foot", "comment", "share"]))
        main = rng.choice([
            lambda: block("article", main), lambda: block("article", main, mark("post", "story", "entry")), lambda: block("main", block("article", main)),
            lambda: block("div", main, mark("content", "article", "post", "main-content", "entry-content", "story-body")),
            lambda: block("main", main), lambda: block("article", block("div", main, mark("body", "text", "content"))), lambda: block("section", main, mark("content", "article-body")),
        ])()
        kinds = ["nav", "head", "foot", "side", "notice", "ad", "form", "share", "comment"]
        before = "".join(boiler(rng.choice(kinds)) for _ in range(rng.randint(0, 4)))
        after = "".join(boiler(rng.choice(kinds)) for _ in range(rng.randint(0, 4)))
        page = before + main + after
        if rng.random() < 0.3:
            page = block("div", page, mark("page", "wrapper", "container"))
        out.append((f"<!DOCTYPE html><html><head><title>{words(1, 5)}</title><script>var a='<p>';</script></head><body>{page}" + rng.choice(["</body></html>", ""]), article))
    return out


def unmarked_pages(pages: int = 400, seed: int = 12) -> list[tuple[str, set[str]]]:
    """Labelled training pages whose article no tag or class names: marks are missing or
    random words, landmarks are kept on some pages only. Here length, links, punctuation
    and order have to decide, so an article has sentences and what surrounds it is shorter
    or linked."""
    rng = random.Random(seed)
    made = 0

    def words(lo: int, hi: int, points: float) -> str:
        nonlocal made
        made += 1
        body = [f"x{made}"] + ["".join(rng.choice("abdeilnorstuw") for _ in range(rng.randint(1, 9))) for _ in range(rng.randint(lo, hi))]
        return " ".join(w + (rng.choice(".,.") if rng.random() < points else "") for w in body).rstrip(",.")

    out = []
    for _ in range(pages):
        article: set[str] = set()
        landmarks, marks = rng.random() < 0.5, rng.random() < 0.4

        def block(tag: str, inner: str) -> str:
            name = "".join(rng.choice("bcdfgkmqvxz") for _ in range(5))
            return f"<{tag}" + (f' class="{name}"' if marks and rng.random() < 0.6 else "") + f">{inner}</{tag}>"

        def named(tag: str, inner: str) -> str:
            return block(tag if landmarks else rng.choice(["div", "div", "section"]), inner)

        def kept(lo: int, hi: int, points: float) -> str:
            t = words(lo, hi, points) + ("." if points else "")
            article.add(t)
            return t

        def links(tag: str = "li") -> str:
            inner = "".join(block(tag, f"<a href=/x>{words(0, 3, 0)}</a>") for _ in range(rng.randint(2, 8)))
            return block("ul", inner) if tag == "li" else block("div", inner)

        def paragraph() -> str:
            r = rng.random()
            if r < 0.72:
                t = kept(9, 90, 0.13)
                parts = t.split(" ")
                if rng.random() < 0.3:
                    k = rng.randrange(1, len(parts) - 1)
                    parts[k] = rng.choice([f"<a href=/y>{parts[k]}</a>", f"<b>{parts[k]}</b>"])
                return block(rng.choice(["p", "p", "p", "div"]), " ".join(parts))
            if r < 0.82:
                return block(rng.choice(["h2", "h3"]), kept(0, 6, 0)) + block("p", kept(12, 70, 0.13))
            if r < 0.9:
                return block("ul", "".join(block("li", kept(2, 16, 0.1)) for _ in range(rng.randint(2, 4))))
            return block("blockquote", kept(6, 40, 0.13))

        def comments() -> str:
            def one() -> str:
                by = rng.choice(["", block("b", words(0, 1, 0)), block("h4", words(0, 2, 0)), block("span", words(0, 2, 0))])
                return block(rng.choice(["div", "li"]), by + block("p", words(2, 25, 0.1)))

            return named("aside", rng.choice(["", block("h3", words(0, 2, 0))]) + "".join(one() for _ in range(rng.randint(1, 5))))

        def side() -> str:
            return rng.choice([
                lambda: named("aside", block("h3", words(0, 3, 0)) + links()), lambda: named("aside", links("div")), lambda: block("div", words(1, 14, 0.03)),
                lambda: block("form", block("label", words(0, 2, 0)) + block("button", words(0, 1, 0))), lambda: block("div", block("p", words(2, 14, 0.06)) + block("button", words(0, 1, 0))),
            ])()

        if rng.random() < 0.15:  # no article at all
            main = ""
        elif rng.random() < 0.22:  # one plain block of text
            main = rng.choice([lambda: block("div", kept(9, 200, 0.13)), lambda: block("p", kept(9, 200, 0.13)), lambda: kept(9, 120, 0.13), lambda: block("div", block("div", kept(12, 200, 0.13)))])()
        else:
            title = rng.choice([block("h1", kept(1, 8, 0)), block("h2", kept(1, 8, 0)), ""])
            main = title + "".join(paragraph() + (side() if rng.random() < 0.06 else "") for _ in range(rng.randint(1, 8)))
            main = rng.choice([main, block("div", main), block("div", block("div", main))])
        menu = lambda: block("nav", rng.choice([links(), links("span"), words(0, 4, 0)])) if landmarks else named("nav", links())
        before = "".join(rng.choice([menu, lambda: named("header", block("div", words(0, 4, 0)) + links()), side])() for _ in range(rng.randint(0 if main else 1, 3)))
        after = "".join(rng.choice([comments, lambda: named("footer", "&copy; " + words(1, 10, 0.05)), lambda: named("footer", links("p")), side])() for _ in range(rng.randint(0, 3)))
        page = before + main + after
        if rng.random() < 0.3:
            page = block("div", page)
        out.append((f"<html><head><title>{words(1, 5, 0)}</title></head><body>{page}</body></html>", article))
    return out


def fit(pages: list[tuple[str, set[str]]], describe, width: int, epochs: int, rate: float, seed: int) -> tuple[np.ndarray, list]:
    """Maximum likelihood by stochastic gradient steps, one page at a time. An element
    counts as content if a run below it does."""
    data = []
    for html, article in pages:
        page = Page(html)
        parents = [p for p, _ in page.nodes]
        label = [page.runs.get(i) in article if i in page.runs else False for i in range(len(parents))]
        for i in range(len(parents) - 1, -1, -1):
            if label[i] and parents[i] >= 0:
                label[parents[i]] = True
        data.append((parents, describe(page), label))
    rng, order = random.Random(seed), list(range(len(data)))
    w, pair = np.zeros(width), [[1.0, -3.0], [0.0, 0.0]]
    for epoch in range(epochs):
        rng.shuffle(order)
        lr = rate / (1 + 0.25 * epoch)
        for k in order:
            parents, feats, label = data[k]
            full, both = marginals(parents, [sum(w[i] * v for i, v in f) for f in feats], pair)
            step = [[0.0, 0.0], [0.0, 0.0]]
            for i, f in enumerate(feats):
                d = label[i] - full[i]
                for j, v in f:
                    w[j] += lr * 0.2 * d * v
                p = parents[i]
                if p >= 0:
                    want = (label[p], label[i])
                    got = {(1, 1): both[i], (1, 0): full[p] - both[i], (0, 1): full[i] - both[i], (0, 0): 1 - full[p] - full[i] + both[i]}
                    for (a, b), q in got.items():
                        step[a][b] += ((a, b) == want) - q
            for a in (0, 1):
                for b in (0, 1):
                    pair[a][b] += lr * 0.05 * step[a][b]
            w *= 1 - 1e-4 * lr
    return w, pair


def train(pages: list[tuple[str, set[str]]] | None = None, unmarked: list[tuple[str, set[str]]] | None = None, epochs: int = 14, rate: float = 0.25, seed: int = 3) -> Model:
    """Both sets of potentials, from pages that mark their article and pages that do not."""
    model = Model()
    pages = labelled_pages() if pages is None else pages
    model.weights, model.pair = fit(pages, lambda page: [features(n) for _, n in page.nodes], len(FEATURES), epochs, rate, seed)
    unmarked = unmarked_pages() if unmarked is None else unmarked
    model.shape_weights, model.shape_pair = fit(unmarked, shapes, len(FEATURES) + len(SHAPE), epochs, rate, seed)
    return model


def extract(pages: DataFrame, model: Model, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    shared = pages.sparkSession.sparkContext.broadcast((model.weights.tolist(), model.pair, model.shape_weights.tolist(), model.shape_pair))

    def run(batches):
        release()
        m = Model()
        m.weights, m.pair, m.shape_weights, m.shape_pair = shared.value
        for batch in batches:
            texts = [m.text(h.as_py()) for h in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    kinds = [pages.schema[c].dataType.simpleString() for c in (id_col, url_col)]
    return pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html")).transform(small_batches).mapInArrow(
        run, f"page_id {kinds[0]}, url {kinds[1]}, text string, n_chars bigint"
    )
