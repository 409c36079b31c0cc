"""Main-text extraction by a tree-structured graphical model over DOM nodes.

Each block element is a node with a label, content or not. Node potentials come from its features,
edge potentials from the labels of parent and child; sum-product messages go up to the root and
down again, one tree level at a time for all pages of a batch, and give each node's marginal. The
weights are fitted to labelled pages by the exact gradient of their likelihood.

Labelled pages are those of a bounded sample that mark their article themselves, with some of
these marks hidden so that other evidence gets weight too, and a few written out below.

Scale: pages are parsed and judged one Arrow batch at a time, without a shuffle.
"""

from __future__ import annotations

import bisect
import html
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE = 200  # pages that a model is fitted on, at most

#: a tag without angle brackets in its attributes, so a try ends at the next bracket; others go through ``_Tags``
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/<>]*+)((?:[^<>"']++|"[^"<>]*+"|'[^'<>]*+')*+)>""")
_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
_QUOTE = re.compile(r"""["'>]""")
_ATTRIBUTE = re.compile(r"""\b(class|id|role|itemprop|data-main|data-rest|hidden|aria-hidden|style)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
#: fixed values: elements by their part in a page
RAW = frozenset("script style template textarea title select datalist".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("html body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul caption legend".split())
REST_TAGS = frozenset("nav aside footer header form menu dialog search fieldset".split())
MAIN_TAGS = frozenset("article main".split())
PROSE = frozenset("p pre blockquote h1 h2 h3 h4 h5 h6 figcaption dd dt td".split())
LISTS = frozenset("ul ol li dir menu".split())
CLOSES_P = BLOCK - frozenset("html body dd dt li td th tr tbody thead tfoot caption legend summary".split())
IMPLIED = {"li": ("li", ("ul", "ol", "menu", "dir")), "dd": ("dd dt", ("dl",)), "dt": ("dd dt", ("dl",)), "tr": ("tr td th", ("table",)), "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table"))}
REST_WORDS = re.compile(r"(?:^|[\s_-])(?:ads?|adverts?|advertisement|advertising|sponsor(?:ed)?|promo(?:tion|ted)?|banner|cookies?|consent|gdpr|notices?|alerts?|popup|modal|overlay|nav|navbar|navigation|menu|breadcrumbs?|header|masthead|topbar|footer|foot|bottombar|sidebar|side|aside|rail|widgets?|related|recommended|recommendations|trending|popular|share|sharing|social|subscribe|subscription|newsletter|signup|login|form|search|comments?|commentlist|replies|reply|respond|disqus|discussion|toolbar|pagination|pager|copyright|legal|disclaimer|contentinfo|complementary|dialog|skip|hidden|sr-only|tags|toc)(?:$|[\s_-]|\d)", re.I)
MAIN_WORDS = re.compile(r"(?:^|[\s_-])(?:article|articlebody|main|content|post|entry|story|body|text|prose|hentry)(?:$|[\s_-]|\d)", re.I)
FEATURES = ("one", "main_tag", "rest_tag", "main_word", "rest_word", "prose", "list", "own_text", "all_text", "link_share", "no_text", "sentence", "hidden")

#: pages with their main part (data-main) and what inside it is not (data-rest)
LABELLED = (
    '<body><header class="site-header"><a href="/">Daily</a></header><div class="layout"><div class="content" data-main><h1>A long day at sea</h1><p>The boat left the harbour at six, and nobody spoke for an hour.</p><p>By noon the wind had turned. We put the sails down and waited.</p><div class="share" data-rest><a href="#">Share</a><a href="#">Mail</a></div></div><div class="sidebar"><h3>Popular</h3><ul><li><a href="/1">One story that many people read</a></li><li><a href="/2">Two more of them</a></li></ul></div></div><div class="footer"><p>All rights reserved by the owner of this site.</p></div></body>',
    '<body><nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul></nav><main data-main><h1>Rain again</h1><p>It has rained for nine days, and the river is as high as it was in spring.</p><form class="newsletter" data-rest><p>Get our letter each week in your mail box.</p><input><button>Send</button></form><p>The bridge will stay closed until the water falls, said the town.</p></main><section id="comments"><h2>Comments</h2><div class="comment"><p>I saw this too, and it was much worse on our side of town.</p></div><div class="comment"><p>Thank you for writing about it, we had no idea.</p></div></section><footer>Contact</footer></body>',
    '<body><div id="cookie-notice"><p>We use cookies to make this page better for you and all others.</p><button>Fine</button></div><div id="menu"><a href="/x">Start</a> <a href="/y">About</a></div><div id="page" data-main><h2>How bread is made</h2><p>Flour, water and salt are mixed and left alone for a night.</p><ul><li>Flour, a kilo of it at least.</li><li>Salt, as much as you like.</li></ul><p>In the morning the dough is shaped, and then it is baked until it is brown.</p><div class="ad" data-rest>Buy the best oven there is, only this week.</div></div><div class="related"><h4>Read also</h4><p><a href="/r">How cheese is made in the hills</a></p></div></body>',
    '<body><article data-main><h1>Notes</h1><p>Short note on a small matter.</p><aside data-rest><p>More by this writer, who lives in the north and likes long walks.</p></aside><p>And a second one, which is a little longer than the first was.</p><footer data-rest>Filed under notes</footer></article><div class="comments"><article class="comment"><p>Good note, I liked it and sent it to all my friends.</p></article></div></body>',
    '<body><div class="top-banner ad"><p>Fly for less to any place you can think of.</p></div><table><tr><td class="left menu"><a href="/1">One</a><br><a href="/2">Two</a></td><td data-main><h1>Old page</h1><p>This page was made a long time ago, when tables were used for all of it.</p>It still has text that stands in no paragraph, and that is fine.</td></tr></table><div class="footer">Made by hand</div></body>',
    '<body><div><div><a href="/">Home</a><a href="/n">News</a><a href="/s">Sport</a></div><div data-main><h1>No names at all</h1><p>Here no element says what it is for, so just the text can tell.</p><p>A few full sentences stand side by side, with commas, and with stops. Links are rare.</p><p>The end is near, as one can see from here.</p></div><div><a href="/p">Privacy</a><a href="/t">Terms</a></div></div></body>',
    '<body><header role="banner"><h2>The Post</h2></header><div role="main" class="post-content" data-main><h1>Trains</h1><p>There will be more trains from May, and they will run later at night.</p><blockquote>We have waited for this, said a driver.</blockquote></div><div class="alert notice"><p>You have two free stories left this month, please sign up.</p></div><div class="search-form"><form><label>Find</label><input></form></div></body>',
)


@dataclass
class Page:
    """Nodes in page order, parents first, and text blocks with their node."""

    parent: list[int] = field(default_factory=list)
    tag: list[str] = field(default_factory=list)
    hints: list[tuple] = field(default_factory=list)  # (main word, rest word, hidden, data-main, data-rest)
    own: list[int] = field(default_factory=list)  # characters
    linked: list[int] = field(default_factory=list)
    blocks: list[list[tuple[int, str]]] = field(default_factory=list)  # pieces of (node, text): an inline element may be a node of its own


_hints: dict[str, tuple] = {}


def _hint(attributes: str) -> tuple:
    got = _hints.get(attributes)
    if got is None:
        main = rest = hidden = is_main = is_rest = False
        for name, a, b, c in _ATTRIBUTE.findall(attributes):
            name, value = name.lower(), a or b or c
            if name in ("class", "id", "role", "itemprop"):
                main, rest = main or bool(MAIN_WORDS.search(value)), rest or bool(REST_WORDS.search(value))
            elif name == "style":
                hidden = hidden or "display:none" in value.replace(" ", "").lower()
            elif name in ("data-main", "data-rest"):
                is_main, is_rest = is_main or name == "data-main", is_rest or name == "data-rest"
            else:
                hidden = hidden or value.lower() != "false"
        got = (main and not rest, rest, hidden, is_main, is_rest)
        if len(_hints) > 50_000:
            _hints.clear()
        _hints[attributes] = got
    return got


class _Tags:
    """Where tags with brackets in quoted attributes end: the first > outside quotes, else the first > at all.

    Read from the last quote or bracket to the first, once for a page, so that no text, however odd, is scanned again and again.
    """

    def __init__(self, text: str):
        self.text, self.at, self.end = text, None, None

    def stop(self, start: int) -> int:
        """The position of the > that ends the tag whose name ends at ``start``, -1 where none does."""
        if self.at is None:
            marks = [(m.start(), m[0]) for m in _QUOTE.finditer(self.text)]
            end, again = [-1] * (len(marks) + 1), {'"': -1, "'": -1}
            for j in range(len(marks) - 1, -1, -1):
                where, what = marks[j]
                if what == ">":
                    end[j] = where
                else:
                    end[j] = end[again[what] + 1] if again[what] >= 0 else -1
                    again[what] = j
            self.at, self.end = [w for w, _ in marks], end
        j = bisect.bisect_left(self.at, start)
        return self.end[j] if self.end[j] >= 0 else self.text.find(">", start)


def _tokens(text: str):
    """(start, end, name, whether it ends an element, attributes) of each piece of markup; no name for comments and declarations."""
    at, tags, closed = 0, _Tags(text), True
    while (at := text.find("<", at)) >= 0:
        if m := _TAG.match(text, at):
            at = (yield at, m.end(), m[2].lower(), bool(m[1]), m[3]) or m.end()
            continue
        if text.startswith("<!--", at):
            stop = text.find("-->", at + 4)
            at = (yield at, len(text) if stop < 0 else stop + 3, "", False, "") or (len(text) if stop < 0 else stop + 3)
            continue
        m = _NAME.match(text, at)
        if closed and (m or text[at + 1 : at + 2] in ("!", "?", "/")):
            stop = tags.stop(m.end()) if m else text.find(">", at)
            if stop >= 0:
                at = (yield at, stop + 1, m[2].lower() if m else "", bool(m and m[1]), text[m.end() : stop] if m else "") or stop + 1
                continue
            closed = False  # no > from here on
        at += 1


def parse(text: str) -> Page:
    """A forgiving reader: implied ends of p, li, dt, dd, tr and td; stray ends ignored; what is open at the end closes there.

    Its time grows with the text, whatever that is: elements by name are kept with their depth, and no end tag is looked for twice.
    """
    page = Page([-1], ["html"], [(False,) * 5], [0], [0], [])
    stack: list[tuple[str, int]] = [("html", 0)]  # (tag, node that text goes to)
    opened: dict[str, list[int]] = {"html": [0]}  # depths
    run: list[tuple[int, str]] = []
    links = 0
    endless: set[str] = set()

    def flush() -> None:
        pieces = [(node, piece) for node, piece in run if piece]
        run.clear()
        if any(not piece.isspace() for _, piece in pieces):
            page.blocks.append(pieces)
            for node, piece in pieces:
                page.own[node] += len(" ".join(piece.split()))

    def say(piece: str, literal: bool = False) -> None:
        if piece:
            if not literal and "&" in piece:
                piece = html.unescape(piece)
            run.append((stack[-1][1], piece))
            if links:
                page.linked[stack[-1][1]] += len(piece)

    def close(depth: int) -> None:
        nonlocal links
        while len(stack) > depth:
            name, _ = stack[-1]
            if name in BLOCK:
                flush()
            stack.pop()
            opened[name].pop()
            links -= name == "a"

    def last(names: tuple, stop: tuple = ()) -> int:
        """The depth of the innermost open element of ``names``, 0 where one of ``stop`` is further in."""
        deep = max((opened[n][-1] for n in names if opened.get(n)), default=0)
        return 0 if any(opened[n][-1] > deep for n in stop if opened.get(n)) else deep

    at, in_head, in_body = 0, False, False
    tokens = _tokens(text)

    def following(skip: int | None) -> tuple | None:
        """The next piece of markup, that from ``skip`` on where it is given; None where there is none."""
        try:
            return tokens.send(skip)
        except StopIteration:
            return None

    token = following(None)
    while token:
        start, end, name, ends, attributes = token
        if not in_head:
            say(text[at:start])
        at, skip = end, None
        if not name:
            pass
        elif ends:
            if name == "head":
                in_head = False
            elif opened.get(name):
                close(last((name,)) or len(stack))
        elif name in RAW or name == "xmp":  # up to its end tag nothing is markup
            stop = None if name in endless else re.compile(rf"</{name}(?=[\s/>])[^>]*+>", re.I).search(text, at)
            if stop:
                at = skip = stop.end()
                if name == "xmp" and not in_head:
                    flush()
                    say(text[end : stop.start()], True)
                    flush()
            else:
                endless.add(name)
                if name in ("script", "style"):
                    at = skip = len(text)
            if name != "title" and not in_head:
                run.append((stack[-1][1], " "))
        elif name == "head":
            in_head = not in_body  # once the body has begun, such a tag means nothing
        elif name in ("html", "body"):
            in_head, in_body = False, in_body or name == "body"
        elif name in VOID:
            if name == "hr":
                flush()
            elif name in ("br", "img", "input"):
                run.append((stack[-1][1], " "))
        else:
            in_head, in_body = False, True
            if name in CLOSES_P and opened.get("p"):
                if i := last(("p",), ("table", "td", "th", "button")):
                    close(i)
            if name in IMPLIED:
                names, stops = IMPLIED[name]
                names = tuple(names.split())
                while i := last(names, stops):  # of tr and td both may be open
                    close(i)
            hint = _hint(attributes) if attributes and not attributes.isspace() else (False,) * 5
            node = stack[-1][1]
            if name in BLOCK:
                flush()
            if name in BLOCK or hint[1] or hint[2]:
                page.parent.append(node)
                page.tag.append(name)
                page.hints.append(hint)
                page.own.append(0)
                page.linked.append(0)
                node = len(page.parent) - 1
            if not attributes.endswith("/") or name in BLOCK:
                opened.setdefault(name, []).append(len(stack))
                stack.append((name, node))
                links += name == "a"
        token = following(skip)
    if not in_head:
        say(text[at:])
    close(1)
    flush()
    return page


def features(page: Page) -> np.ndarray:
    n = len(page.parent)
    own, linked = np.array(page.own, float), np.array(page.linked, float)
    everything, all_linked = own.copy(), linked.copy()
    for i in range(n - 1, 0, -1):
        everything[page.parent[i]] += everything[i]
        all_linked[page.parent[i]] += all_linked[i]
    sentence = np.zeros(n)
    for pieces in page.blocks:
        for node, words in pieces:
            sentence[node] = max(sentence[node], float(len(words) > 25 and any(c in words for c in ".!?;:。")))
    x = np.zeros((n, len(FEATURES)))
    x[:, 0] = 1
    for i, (tag, h) in enumerate(zip(page.tag, page.hints, strict=True)):
        x[i, 1], x[i, 2], x[i, 3], x[i, 4] = tag in MAIN_TAGS, tag in REST_TAGS, h[0], h[1]
        x[i, 5], x[i, 6], x[i, 12] = tag in PROSE, tag in LISTS, h[2]
    x[:, 7], x[:, 8] = np.log1p(own) / 5, np.log1p(everything) / 8
    x[:, 9] = np.minimum(1, all_linked / np.maximum(1, everything))
    x[:, 10], x[:, 11] = everything == 0, sentence
    return x


def marked(page: Page) -> np.ndarray | None:
    """Labels of a page that marks its main part (data-main, else its only article), without what its marks take out; None if it has no mark."""
    n = len(page.parent)
    roots = [i for i in range(n) if page.hints[i][3]] or [i for i in range(n) if page.tag[i] == "article" and not page.hints[i][1]]
    if len(roots) != 1:
        return None
    own = page.hints[roots[0]][3]
    y = np.zeros(n, int)
    for i in range(n):
        p = page.parent[i]
        out = page.hints[i][4] if own else (page.tag[i] in REST_TAGS or page.hints[i][1])
        y[i] = i == roots[0] or (p >= 0 and y[p] and not out)
    return y


@dataclass
class Forest:
    """Pages side by side: parents, and node numbers by depth."""

    parent: np.ndarray
    levels: list[np.ndarray]

    @staticmethod
    def of(parents: list[list[int]]) -> Forest:
        sizes = np.cumsum([0, *map(len, parents)])
        parent = np.concatenate([np.where(np.array(p) < 0, -1, np.array(p) + base) for p, base in zip(parents, sizes[:-1].tolist(), strict=True)])
        depth = np.zeros(len(parent), int)
        for i, p in enumerate(parent.tolist()):
            if p >= 0:
                depth[i] = depth[p] + 1
        order = np.argsort(depth, kind="stable")
        edges = np.searchsorted(depth[order], np.arange(depth.max() + 2))
        return Forest(parent, [order[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)])

    def infer(self, unary: np.ndarray, edge: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """(marginals of nodes, joint marginals of (parent, child), log partition) by sum-product up and down."""
        up, message = unary.copy(), np.zeros_like(unary)
        for level in self.levels[:0:-1]:
            message[level] = np.logaddexp.reduce(edge[None] + up[level][:, None, :], axis=2)
            np.add.at(up, self.parent[level], message[level])
        down = np.zeros_like(unary)
        joint = np.zeros((len(unary), 2, 2))
        for level in self.levels[1:]:
            p = self.parent[level]
            outside = up[p] + down[p] - message[level]  # the parent's belief without this child
            both = outside[:, :, None] + edge[None] + up[level][:, None, :]
            down[level] = np.logaddexp.reduce(outside[:, :, None] + edge[None], axis=1)
            both = np.exp(both - both.max((1, 2), keepdims=True))
            joint[level] = both / both.sum((1, 2), keepdims=True)
        belief = up + down
        p = np.exp(belief - np.logaddexp.reduce(belief, axis=1)[:, None])
        return p, joint, float(np.logaddexp.reduce(up[self.levels[0]], axis=1).sum())


@dataclass
class Model:
    weight: np.ndarray  # of features, for content
    edge: np.ndarray  # [parent, child]

    def content(self, pages: list[Page]) -> list[np.ndarray]:
        """The marginal of content for each node of each page."""
        if not pages:
            return []
        unary = np.concatenate([features(p) for p in pages]) @ self.weight
        got = Forest.of([p.parent for p in pages]).infer(np.stack([np.zeros(len(unary)), unary], 1), self.edge)[0][:, 1]
        return np.split(got, np.cumsum([len(p.parent) for p in pages])[:-1])


def fit(pages: list[Page], steps: int = 300, ridge: float = 0.002, seed: int = 0) -> Model:
    """Weights of greatest likelihood (with a small ridge) on ``pages`` that mark their main part and on LABELLED."""
    draw = np.random.default_rng(seed)
    xs, ys, parents = [], [], []

    def add(page: Page, times: int, hide: bool) -> None:
        y = marked(page)
        if y is None:
            return
        for k in range(times):
            x = features(page)
            if hide and k:  # some marks hidden: what they say must be told from the rest
                x[draw.random(len(x)) < 0.7, 1] = 0
                off = draw.random(len(x)) < 0.5
                x[off, 2], x[off, 4] = 0, 0
            xs.append(x)
            ys.append(y)
            parents.append(page.parent)

    for page in pages:
        add(page, 2, True)
    few = max(1, len(xs) // 6)
    for text in LABELLED:
        add(parse(text), few, False)
    x, y, forest = np.concatenate(xs), np.concatenate(ys), Forest.of(parents)
    child = np.flatnonzero(forest.parent >= 0)
    told = np.zeros((2, 2))
    np.add.at(told, (y[forest.parent[child]], y[child]), 1)
    w, edge = np.zeros(x.shape[1]), np.zeros((2, 2))
    speed, square = [np.zeros(w.size + 4) for _ in range(2)]
    for step in range(1, steps + 1):
        p, joint, _ = forest.infer(np.stack([np.zeros(len(x)), x @ w], 1), edge)
        g = np.concatenate([x.T @ (y - p[:, 1]), (told - joint[child].sum(0)).ravel()]) / len(y) - ridge / 10 * np.concatenate([w, edge.ravel()])
        speed, square = 0.9 * speed + 0.1 * g, 0.99 * square + 0.01 * g * g
        move = 0.1 * (speed / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-9)
        w, edge = w + move[: w.size], edge + move[w.size :].reshape(2, 2)
    return Model(w, edge)


def train(pages: DataFrame, sample: int = SAMPLE, id_col: str = "page_id", html_col: str = "html", longest: int = 200_000, **how) -> Model:
    """Fit on ``sample`` pages at most, those whose ids hash lowest among pages of at most ``longest`` characters."""
    rows = pages.where(F.col(html_col).isNotNull() & (F.length(html_col) <= longest)).orderBy(F.xxhash64(F.col(id_col)), html_col).limit(sample).select(F.col(html_col).alias("h"))
    return fit([parse(r.h) for r in rows.toLocalIterator()], **how)


def main_text(page: Page, content: np.ndarray) -> str:
    """The blocks' pieces whose node is content, white space inside a block as one space, blocks joined by a blank line."""
    blocks = (" ".join("".join(piece for node, piece in pieces if content[node] >= 0.5).split()) for pieces in page.blocks)
    return "\n\n".join(b for b in blocks if b)


def extract(pages: DataFrame, model: Model, columns: tuple[str, ...] = ("page_id", "url"), html_col: str = "html") -> DataFrame:
    """``columns`` of each row of ``pages`` with text (blocks of main text joined by a blank line, else empty) and n_chars.

    Null and empty pages have no text. Pages are read whole, however long; rows, repeated or with
    null ids, each get their text. Scripts, styles, templates, titles and form choices hold no text; that of formulas,
    drawings, fallbacks (noscript, object, video ...) and xmp is judged as any other. An inline element that isn't main text
    doesn't cut its block. A new column whose name is among ``columns`` takes a leading
    underscore; other columns of ``pages`` are ignored.
    """
    from pyspark.sql.types import LongType, StringType, StructField, StructType

    from framelake.llm._spark import fresh

    rows = pages.select(*columns, F.col(html_col).alias("__html"))
    held = pages.select(*columns)
    text, size = fresh(held, "text"), fresh(held, "n_chars")
    names = list(columns)

    def run(batches):
        for b in batches:
            out = []
            column = b.column(len(names))
            for i in range(0, b.num_rows, 64):
                parsed = [parse(h or "") for h in column.slice(i, 64).to_pylist()]
                out += [main_text(p, c) for p, c in zip(parsed, model.content(parsed), strict=True)]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(names))), pa.array(out, pa.string()), pa.array([len(x) for x in out], pa.int64())], [*names, text, size])

    return rows.mapInArrow(run, StructType([*held.schema.fields, StructField(text, StringType()), StructField(size, LongType())]))
