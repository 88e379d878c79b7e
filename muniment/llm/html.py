"""Main text of HTML pages: boosted trees score DOM nodes, a tree decoding makes the scores agree.

A page is parsed into a tree. Each element gets features of its own (tag, attribute tokens, depth, siblings) and of its subtree (text,
link and tag density, punctuation, paragraphs, share of the page). A small gradient-boosted model gives the
log-odds that the element holds article text. An element may be kept only if its parent is kept, so the best consistent choice is found
bottom up: dropping an element drops its subtree, keeping it leaves each child its better choice.

The model is trained when the operator is called, on at most ``SAMPLE`` pages of the table and a few fixed skeletons. Labels come from
pages that name their article (``article`` or ``main``); the sample is those of least hash, so it hangs neither on the files nor on a retry. Each is also used in rewritten forms: tags
and class names swapped; lists, tables, quotes, code and figures put into the article; more boilerplate around it; the article as plain text in the body; and no article at
all. So the model doesn't hang on single tags. The sample only fits the model; every page is extracted whole.

Defined results: a null or empty page, and one without article text, has an empty text; a text without any tag is its own article; equal pages get equal texts; unclosed and stray tags are
closed as a browser would; an empty table gives an empty result; extra columns don't matter.
"""

from __future__ import annotations

import random
import re
from html import unescape

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from muniment.llm.common import map_texts

#: Most labelled pages that the model is fitted on.
SAMPLE = 150

ADDED = "text string, n_chars long, n_blocks long"

# Element groups of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe".split())
#: Parsed like others, but their text is not shown. One that is never closed by its own end tag counts as a plain element.
HIDDEN = frozenset("noscript template svg".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
NEVER = frozenset("script style head noscript template iframe svg form button select textarea input title object embed".split())
#: Text directly in these is put into implied blocks.
LOOSE = frozenset(("#page", "html", "body"))
#: A start tag closes an open element of these tags, up to the nearest element of the last group.
CLOSES = {t: frozenset({"p"}) for t in "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()}
CLOSES |= {"li": frozenset({"li", "p"}), "dt": frozenset({"dt", "dd", "p"}), "dd": frozenset({"dt", "dd", "p"}), "tr": frozenset({"tr", "td", "th", "p"}), "td": frozenset({"td", "th", "p"}), "th": frozenset({"td", "th", "p"}), "option": frozenset({"option"})}
SCOPE = frozenset("html body article aside blockquote div footer header main nav section table ul ol dl form td th fieldset".split())

# Words in class, id and role attributes.
GOOD_TOKENS = frozenset("article body content entry main page post story text prose copy blog".split())
BAD_TOKENS = frozenset(
    "ad ads advert advertisement aside banner breadcrumb breadcrumbs button comment comments consent cookie copyright discussion disqus feedback footer form guestbook header login "
    "masthead menu modal nav navbar navigation newsletter notice opinions pagination pager popup promo related reply replies respond responses reviews search share sharing shop sidebar "
    "signup skip social sponsor sponsored subscribe tag tags toolbar topbar widget".split()
)

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"<]*\"|'[^'<]*'|[^'\">])*+>|[^>]*>)|<[!?][^>]*>", re.S)
_ATTRIBUTE = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_WORD = re.compile(r"[a-z]+")
_PUNCTUATION = re.compile(r"[.,;:!?。，]")


#: Implied block around a run of text and inline elements that stands outside of all elements below the body.
RUN = "#run"
#: Stands at article text of a training page whose article has no element of its own.
SIGN = "\ue000"


class Page:
    """Elements in page order with their parents, and texts and breaks in page order. Text directly in the body gets implied blocks."""

    def __init__(self, html: str):
        self.tags, self.parents, self.tokens = ["#page"], [0], [()]
        self.texts: list[tuple[int, str]] = []  # (element, text); a text of None marks a block's edge
        at = end = 0
        size = len(html)
        shut: list[bool] = [False]  # by element: its own end tag was met
        for m in iter(lambda: _TOKEN.search(html, end), None):
            if m.start() > end:
                text = html[end : m.start()]
                if self.tags[at] in LOOSE and text.strip():
                    at = self._run(at, shut)
                self.texts.append((at, text))
            end = m.end()
            if m[2] is None:
                continue
            tag = m[2].lower()
            if m[1]:
                node = at
                while node and self.tags[node] != tag:
                    node = self.parents[node]
                if node:
                    if tag not in INLINE:
                        self.texts.append((at, None))
                    at, shut[node] = self.parents[node], True
                continue
            closes, node = CLOSES.get(tag, ()), at
            while closes and node and self.tags[node] not in HIDDEN and (self.tags[node] in closes or self.tags[node] not in SCOPE):
                if self.tags[node] in closes:
                    at = self.parents[node]
                node = self.parents[node]
            if tag == "br":
                self.texts.append((at, " "))
                continue
            if tag not in INLINE:
                if self.tags[at] == RUN:
                    at = self.parents[at]
                self.texts.append((at, None))
            elif self.tags[at] in LOOSE:
                at = self._run(at, shut)
            self.tags.append(tag)
            self.parents.append(at)
            shut.append(False)
            self.tokens.append(tuple(t for a in _ATTRIBUTE.findall(m[3]) for t in _WORD.findall("".join(a).lower())) if "=" in m[3] else ())
            closed = m[3].endswith("/>")
            if tag in RAW and not (closed and self._in_svg(at)):
                close = re.compile(f"</{re.escape(tag)}\\s*>", re.I).search(html, end)
                end = close.end() if close else size
            elif tag not in VOID and not closed:
                at = len(self.tags) - 1
            else:
                shut[-1] = True
        if end < size:
            if self.tags[at] in LOOSE and html[end:].strip():
                at = self._run(at, shut)
            self.texts.append((at, html[end:]))
        self._hide(shut)

    def _run(self, at: int, shut: list[bool]) -> int:
        """A new implied block in ``at``."""
        self.texts.append((at, None))
        self.tags.append(RUN)
        self.parents.append(at)
        self.tokens.append(())
        shut.append(True)
        return len(self.tags) - 1

    def _in_svg(self, node: int) -> bool:
        while node and self.tags[node] != "svg":
            node = self.parents[node]
        return node > 0

    def _hide(self, shut: list[bool]) -> None:
        """Leave out texts in closed elements that aren't shown; unclosed ones become plain elements."""
        if HIDDEN.isdisjoint(self.tags):
            return
        hidden = [False] * len(self.tags)
        for i in range(1, len(self.tags)):
            if self.tags[i] in HIDDEN and not shut[i]:
                self.tags[i] = "#open"
            hidden[i] = hidden[self.parents[i]] or self.tags[i] in HIDDEN
        self.texts = [(i, t) for i, t in self.texts if not hidden[i]]


def features(page: Page) -> np.ndarray:
    """One row per element; see the names beside the columns."""
    tags, parents = page.tags, page.parents
    n = len(tags)
    parent = np.array(parents)
    own_chars, own_marks = [0] * n, [0] * n
    for node, text in page.texts:
        if text:
            own_chars[node] += len(text)
            own_marks[node] += len(_PUNCTUATION.findall(text))
    depth, link, order, seen = [0] * n, [False] * n, [0] * n, [0] * n
    good, bad, above_good, above_bad = [0] * n, [0] * n, [0] * n, [0] * n
    alike: dict[tuple[int, str], int] = {}
    for i in range(1, n):
        p = parents[i]
        depth[i], link[i] = depth[p] + 1, link[p] or tags[i] == "a"
        order[i] = seen[p]
        seen[p] += 1
        alike[p, tags[i]] = alike.get((p, tags[i]), 0) + 1
        if page.tokens[i]:
            good[i], bad[i] = len(GOOD_TOKENS.intersection(page.tokens[i])), len(BAD_TOKENS.intersection(page.tokens[i]))
        above_good[i] = above_good[p] + good[p] + (tags[p] in ("article", "main"))
        above_bad[i] = above_bad[p] + bad[p] + (tags[p] in ("nav", "footer", "aside", "header"))
    chars, links, marks = list(own_chars), [c if x else 0 for c, x in zip(own_chars, link)], list(own_marks)
    nodes, paragraphs = [1] * n, [int(t == "p") for t in tags]
    for i in range(n - 1, 0, -1):  # children stand behind their parents
        p = parents[i]
        chars[p] += chars[i]
        links[p] += links[i]
        marks[p] += marks[i]
        nodes[p] += nodes[i]
        paragraphs[p] += paragraphs[i]
    before, after, last_child = [0] * n, [0] * n, [0] * n
    for i in range(1, n):
        if last := last_child[parents[i]]:
            before[i], after[last] = chars[last], chars[i]
        last_child[parents[i]] = i
    c = np.array(chars, float)
    size, total = np.maximum(c, 1), max(1.0, c[0])
    count = np.array(seen, float)
    is_tag = lambda *names: np.array([t in names for t in tags], float)
    return np.stack([
        is_tag("article", "main"), is_tag("nav", "menu"), is_tag("footer", "header", "aside"), is_tag("p", "blockquote", "pre"),
        is_tag("li", "ul", "ol", "dl"), is_tag("h1", "h2", "h3", "h4", "h5", "h6"), is_tag("a"), is_tag("div", "section"), is_tag(RUN),
        np.array(good, float), np.array(bad, float), np.array(above_good, float), np.array(above_bad, float),
        np.minimum(np.array(depth, float), 30), np.array(order) / np.maximum(count[parent], 1), np.minimum(count[parent], 50),
        np.array([0.0] + [float(min(50, alike[parents[i], tags[i]])) for i in range(1, n)]),
        np.log1p(c), np.array(links) / size, np.array(nodes) / size, np.array(marks) / size,
        np.log1p(np.array(paragraphs, float)), c / total, c / size[parent], np.log1p(c[parent]),
        # Neighbours: their sizes, the share of links around, the size beside the mean of the parent's children.
        np.log1p(np.array(before, float)), np.log1p(np.array(after, float)), (np.array(links) / size)[parent], c * np.maximum(count[parent], 1) / size[parent],
        is_tag("table", "tr", "td", "th", "tbody", "thead"), is_tag("figure", "figcaption", "code"),
    ], axis=1)


class BoostedTrees:
    """Gradient boosting for the logistic loss, on features cut into quantile bins; trees are arrays."""

    def __init__(self, rounds: int = 60, depth: int = 4, rate: float = 0.3, bins: int = 24):
        self.rounds, self.depth, self.rate, self.bins = rounds, depth, rate, bins

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        self.cuts = [np.unique(np.quantile(f, np.linspace(0, 1, self.bins + 1)[1:-1])) for f in x.T]
        binned = np.stack([np.searchsorted(c, f, side="left") for c, f in zip(self.cuts, x.T)], axis=1)
        rate = float(np.clip(y.mean(), 0.01, 0.99))
        self.base, self.trees = float(np.log(rate / (1 - rate))), []
        score, width = np.full(len(y), self.base), self.bins + 1
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-score))
            g, h = p - y, p * (1 - p)
            node, feature, cut = np.zeros(len(y), np.int64), np.zeros(2**self.depth - 1, np.int64), np.full(2**self.depth - 1, np.inf)
            for level in range(self.depth):
                first, n = 2**level - 1, 2**level
                best = np.full(n, 1e-6)
                for f in range(x.shape[1]):
                    key = (node - first) * width + binned[:, f]
                    gs, hs = (np.bincount(key, w, n * width).reshape(n, width).cumsum(axis=1) for w in (g, h))
                    gain = gs**2 / (hs + 1) + (gs[:, -1:] - gs) ** 2 / (hs[:, -1:] - hs + 1) - gs[:, -1:] ** 2 / (hs[:, -1:] + 1)
                    gain = gain[:, : len(self.cuts[f])]
                    if gain.shape[1]:
                        at = gain.argmax(axis=1)
                        for k in np.flatnonzero(gain.max(axis=1) > best):
                            best[k], feature[first + k], cut[first + k] = gain[k, at[k]], f, self.cuts[f][at[k]]
                node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > cut[node])
            leaf = node - (2**self.depth - 1)
            value = -self.rate * np.bincount(leaf, g, 2**self.depth) / (np.bincount(leaf, h, 2**self.depth) + 1)
            self.trees.append((feature, cut, value))
            score = score + value[leaf]
        return self

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        score, rows = np.full(len(x), self.base), np.arange(len(x))
        for feature, cut, value in self.trees:
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            score += value[node - (2**self.depth - 1)]
        return score


def decode(page: Page, log_odds: np.ndarray) -> list[bool]:
    """The likeliest choice of kept elements in which every kept element's parent is kept."""
    n = len(page.tags)
    score = log_odds.tolist()
    never = [t in NEVER for t in page.tags]
    tied = [False] * n  # words in bold and the like share the fate of their implied block
    for i in range(1, n):
        p = page.parents[i]
        tied[i] = (tied[p] or page.tags[p] == RUN) and page.tags[i] in INLINE and page.tags[i] != "a" and BAD_TOKENS.isdisjoint(page.tokens[i])
    gain = [0.0] * n  # of keeping against dropping the subtree, children at their better choice
    for i in range(n - 1, 0, -1):
        own = -1e9 if never[i] else 0.0 if tied[i] else score[i]
        gain[i] += own
        if gain[i] > 0:
            gain[page.parents[i]] += gain[i]
    kept = [True] * n
    if all(t in ("#page", RUN) for t in page.tags):  # no tag at all
        return kept
    for i in range(1, n):
        kept[i] = kept[page.parents[i]] and (gain[i] > 0 or tied[i] or page.tags[i] in ("html", "body"))
    return kept


def blocks(page: Page, kept: list[bool]) -> list[str]:
    """Texts of the kept elements, by block, with single blanks."""
    out, held = [], []
    for node, text in [*page.texts, (0, None)]:
        if text is None:
            block = " ".join(unescape("".join(held)).split()) if held else ""
            held = []
            if block:
                out.append(block)
        elif kept[node]:
            held.append(text)
    return out


def label(page: Page) -> np.ndarray | None:
    """1 for elements that are, hold or lie in the named article, 0 for the rest; None if no article is named."""
    n = len(page.tags)
    inside = [False] * n
    signed = {i for i, text in page.texts if text and SIGN in text}
    for i in range(1, n):
        bad = page.tags[i] in NEVER | {"nav", "aside", "footer", "header"} or bool(BAD_TOKENS.intersection(page.tokens[i]))
        inside[i] = (inside[page.parents[i]] or page.tags[i] in ("article", "main") or "TRUE" in page.tags[i] or i in signed) and not bad
    if not any(inside):
        return None
    holds = list(inside)
    for i in range(n - 1, 0, -1):
        holds[page.parents[i]] = holds[page.parents[i]] or holds[i]
    return np.array(holds, float)


#: A plain page, for tables that name no article. Its words have no meaning.
SKELETON = (
    "<html><head><title>a</title></head><body><header><a href=x>Home</a></header><nav><ul>" + "<li><a href=x>Item</a></li>" * 6 + "</ul></nav><article><h1>Some heading of a text</h1>"
    + "<p>This is a paragraph of plain text, with a few marks, and some more words. It goes on for a while.</p>" * 5 + "</article><aside><p>Read also this.</p></aside><footer>Some rights. A note.</footer></body></html>"
)


def rewritten(html: str, dice: random.Random) -> str:
    """The page in another form: other tags and names for its parts, more boilerplate between them."""
    words = re.sub(r"<[^>]*>", " ", html).split() or ["word"]
    some = lambda n: " ".join(dice.choice(words) for _ in range(n))
    pick = dice.choice
    extra = {
        "top": [f'<header class="{pick(["site-header", "masthead", "topbar", ""])}"><a href="/">{some(2)}</a> {some(3)}</header>', f'<div id="{pick(["cookie-notice", "consent-banner"])}"><p>{some(12)}.</p><button>{some(1)}</button></div>', f'<form><input><label>{some(3)}</label></form>'],
        "end": [f'<{pick(["section", "div"])} class="{pick(["comments", "comment-list", "replies"])}"><h3>{some(1)}</h3>' + "".join(f'<div class="comment"><p>{some(dice.randint(5, 40))}.</p></div>' for _ in range(dice.randint(1, 5))) + pick(["</section>", "</div>"]), f'<aside class="{pick(["sidebar", "related", "widget"])}"><h3>{some(2)}</h3><ul>' + "".join(f"<li><a href=x>{some(4)}</a></li>" for _ in range(4)) + "</ul></aside>", f'<div class="{pick(["ad", "advert", "promo", "newsletter", "share"])}"><p>{some(10)}.</p></div>'],
    }
    html = re.sub(r"(<body[^>]*>)", lambda m: m[1] + "".join(x for x in extra["top"] if dice.random() < 0.5), html, count=1)
    after = "".join(x for x in extra["end"] if dice.random() < 0.5)
    html = re.sub(r"</article>", lambda m: "</article>" + after, html, count=1) if dice.random() < 0.5 else re.sub(r"</body>", lambda m: after + "</body>", html, count=1)
    if dice.random() < 0.6:  # the article without its name; the label is kept in a tag that is put back by ``renamed``
        html = re.sub(r"<article[^>]*>", f'<{MARK} class="{pick(["content", "entry-content", "post-body", "story", "col-8", "x1"])}">', html).replace("</article>", f"</{MARK}>")
    if dice.random() < 0.5:
        html = re.sub(r"<nav[^>]*>", f'<div class="{pick(["menu", "navbar", "links", "x2"])}">', html).replace("</nav>", "</div>")
    if dice.random() < 0.5:
        html = re.sub(r"<footer[^>]*>", f'<div class="{pick(["footer", "copyright", "bottom", "x3"])}">', html).replace("</footer>", "</div>")
    if dice.random() < 0.3:
        html = re.sub(r"(<body[^>]*>)", r'\1<div id="page"><div class="wrap">', html, count=1)
    return html


MARK = "divTRUE"


def enriched(html: str, dice: random.Random) -> str:
    """The page with lists, tables, quotes, code, figures and headings inside of its article, and readers' comments under some name behind it."""
    words = re.sub(r"<[^>]*>", " ", html).split() or ["word"]
    some = lambda low, high: " ".join(dice.choice(words) for _ in range(dice.randint(low, high)))
    many = lambda low, high, fn: "".join(fn() for _ in range(dice.randint(low, high)))
    link = lambda: f"<a href=x>{some(1, 3)}</a>" if dice.random() < 0.2 else ""
    kinds = [
        lambda: f"<ul>{many(2, 7, lambda: f'<li>{some(1, 12)} {link()}</li>')}</ul>", lambda: f"<ol>{many(2, 5, lambda: f'<li><p>{some(2, 15)}.</p></li>')}</ol>",
        lambda: f"<table><tr><th>{some(1, 2)}</th><th>{some(1, 2)}</th></tr>{many(1, 5, lambda: f'<tr><td>{some(1, 3)}</td><td>{some(1, 4)}</td></tr>')}</table>",
        lambda: f"<table><tbody>{many(1, 4, lambda: f'<tr><td>{some(1, 3)}</td><td>{some(1, 2)}</td><td>{some(1, 2)}</td></tr>')}</tbody></table>",
        lambda: f"<blockquote>{some(5, 30)}.</blockquote>", lambda: f"<blockquote><p>{some(5, 30)}.</p></blockquote>", lambda: f"<pre>{some(3, 20)}</pre>", lambda: f"<pre><code>{some(3, 20)}</code></pre>",
        lambda: f"<figure><img src=x><figcaption>{some(2, 12)}</figcaption></figure>", lambda: f"<{(t := dice.choice(['h2', 'h3', 'h4']))}>{some(1, 6)}</{t}>",
        lambda: f"<dl>{many(1, 4, lambda: f'<dt>{some(1, 2)}</dt><dd>{some(2, 9)}</dd>')}</dl>", lambda: f"<p>{some(1, 5)}</p>", lambda: f"<div>{some(4, 20)}.</div>",
        lambda: f"<section><h2>{some(1, 4)}</h2><p>{some(10, 40)}.</p></section>",
    ]
    parts = re.search(r"(?is)^(.*?<article[^>]*>)(.*)(</article>.*)$", html)
    if parts is None:
        return ""
    head, inner, after = parts.groups()
    if dice.random() < 0.25:  # a short article, or one of little but such parts
        inner = inner[: inner.find("</p>") + 4] if "</p>" in inner else inner
        inner += many(1, 4, lambda: dice.choice(kinds)())
    inner = re.sub(r"(?i)</p>", lambda m: m[0] + (many(1, 2, lambda: dice.choice(kinds)()) if dice.random() < 0.4 else ""), inner)
    if dice.random() < 0.6:
        name = dice.choice(["feedback", "reader-feedback", "discussion", "thoughts", "x9", "responses", "guestbook", "said", ""])
        item = dice.choice([
            lambda: f"<div><p>{some(3, 40)}.</p></div>", lambda: f"<div class=item><b>{some(1, 2)}</b> <span>{some(1, 2)}</span><p>{some(3, 40)}.</p><a href=x>{some(1, 1)}</a></div>",
            lambda: f"<li><p>{some(3, 30)}.</p></li>", lambda: f"<p>{some(3, 30)}.</p>",
        ])
        tag = dice.choice(["section", "div", "ul"])
        comments = f'<{tag} {dice.choice(["id", "class"])}="{name}"><h3>{some(1, 2)}</h3>{many(1, 6, item)}</{tag}>' if name else ""
        if dice.random() < 0.4 and name not in ("said", "x9", "thoughts"):
            inner += comments
        else:
            after = after.replace("</article>", "</article>" + comments, 1)
    return head + inner + after


def without_article(html: str, dice: random.Random) -> str:
    """What is left of a page without its article: menus, notices and the like, alone or with a few loose words."""
    words = re.sub(r"<[^>]*>", " ", html).split() or ["word"]
    some = lambda low, high: " ".join(dice.choice(words) for _ in range(dice.randint(low, high)))
    bare = re.sub(r"(?is)<(article|main)\b.*</\1>", "", html)
    links = " | ".join(some(1, 2) for _ in range(dice.randint(1, 6)))
    loose = dice.choice(["", links, f"{links} <a href=x>{some(1, 2)}</a>", f"<p>{some(1, 4)}</p>", f"<div>{some(1, 3)}</div><p>{some(2, 5)}</p>", f"<ul><li>{some(1, 2)}</li><li>{some(1, 2)}</li></ul>"])
    if dice.random() < 0.3:
        return f"<html><body>{loose or links}</body></html>"
    return re.sub(r"(?i)</body>", lambda m: loose + m[0], bare, count=1)


def flattened(html: str, dice: random.Random) -> str:
    """The page with its article as plain text in the body, breaks between paragraphs, and loose boilerplate around it."""
    words = re.sub(r"<[^>]*>", " ", html).split() or ["word"]
    some = lambda n: " ".join(dice.choice(words) for _ in range(n))
    parts = re.search(r"(?is)^(.*?<body[^>]*>)(.*?)<article[^>]*>(.*?)</article>(.*)$", html)
    if parts is None:
        return ""
    head, before, inner, after = parts.groups()
    for wrap in ("main", "div", "section"):  # open around the article
        extra = len(re.findall(f"(?i)<{wrap}\\b", before)) - len(re.findall(f"(?i)</{wrap}\\b", before))
        for _ in range(max(0, extra)):
            at = [m for m in re.finditer(f"(?i)<{wrap}\\b[^>]*>", before)][-1]
            before = before[: at.start()] + before[at.end() :]
    some_kept = dice.choice([0.0, 0.3, 0.6])  # paragraphs left as elements between the loose ones
    inner = re.sub(r"(?is)<p\b[^>]*>(.*?)</p>", lambda m: f"<p>{SIGN}{m[1]}</p>{SIGN}" if dice.random() < some_kept else f"{SIGN}{m[1]}<br><br>", inner)
    inner = re.sub(r"(?i)<p>(?!" + SIGN + ")", SIGN, inner)
    inner = re.sub(r"(?i)(<h[1-6]\b[^>]*>)", rf"\1{SIGN}", re.sub(r"(?i)(</h[1-6]>)", rf"\1{SIGN}", inner))
    inline = lambda: f"<{(t := dice.choice(['b', 'i', 'em', 'a', 'span', 'code']))}>{some(dice.randint(1, 4))}</{t}>"
    inner = re.sub("<br><br>", lambda m: f" {inline()} {some(dice.randint(1, 12))}{m[0]}" if dice.random() < 0.5 else m[0], inner)
    links = " | ".join(f"<a href=x>{some(1)}</a>" for _ in range(dice.randint(1, 6)))
    top = dice.choice(["", "", f"{links}<hr>", f"{some(3)} | {links}<hr>"])
    end = dice.choice(["", "", f"<hr>(c) {some(4)}", f"<hr>{links} {some(2)}"])
    return f"{head}{before}{top}{SIGN}{inner}{end}{after}"


def train(pages: list[str], seed: int = 7) -> BoostedTrees:
    """A model from pages that name their article, as they are and rewritten; pages that name none are left out."""
    dice, rows, labels = random.Random(seed), [], []
    for html in [*pages, *[SKELETON] * 10]:
        html = html.replace(SIGN, "")
        rich = enriched(html, dice) or html
        for form in (html, rewritten(html, dice), rewritten(html, dice), flattened(html, dice), flattened(html, dice), rich, rewritten(rich, dice), enriched(html, dice) or html, rewritten(enriched(html, dice) or html, dice)):
            page = Page(form)
            page.tags = [t if t != MARK.lower() else MARK for t in page.tags]
            y = label(page)
            if y is not None and len(y) > 1:
                page.texts = [(i, t and t.replace(SIGN, "")) for i, t in page.texts]
                page.tags = [t if t != MARK else "div" for t in page.tags]
                rows.append(features(page)[1:])
                labels.append(y[1:])
        for form in (without_article(html, dice), without_article(html, dice), rewritten(without_article(html, dice), dice)):
            page = Page(form)
            if len(page.tags) > 1:
                rows.append(features(page)[1:])
                labels.append(np.zeros(len(page.tags) - 1))
    return BoostedTrees(rounds=100, depth=5).fit(np.concatenate(rows), np.concatenate(labels))


def extract(texts: list[bytes], model: BoostedTrees) -> list[list[str]]:
    """Blocks of article text of each page."""
    pages = [Page(t.decode("utf-8", "replace")) for t in texts]
    if not pages:
        return []
    scores = model.log_odds(np.concatenate([features(p) for p in pages]))
    ends = np.cumsum([len(p.tags) for p in pages]).tolist()
    return [blocks(p, decode(p, scores[b - len(p.tags) : b])) for p, b in zip(pages, ends)]


def main_text(pages: DataFrame, keep: tuple[str, ...] = ("page_id", "url"), html_col: str = "html", sample: int = SAMPLE) -> DataFrame:
    """The columns ``keep``, the main text of each page, its code points and its blocks. One bounded sample, then map only."""
    html = F.col(f"`{html_col}`").cast("string")
    named = pages.select(html.alias("h")).where(F.lower("h").rlike("<(article|main)[\\s>]"))
    # Hashes first: only the pages of the least ones are sent on, each text once.
    named = named.select(F.xxhash64("h").alias("x"), "h")
    least = [r.x for r in named.select("x").distinct().orderBy("x").limit(sample).collect()]
    rows = named.where(F.col("x") <= max(least)).groupBy("x").agg(F.min("h").alias("h")).orderBy("x").collect() if least else []
    model = train([r.h for r in rows])

    def setup():
        def fn(texts: list[bytes]) -> dict:
            found = extract(texts, model)
            joined = ["\n".join(x) for x in found]
            return {"text": joined, "n_chars": [len(x) for x in joined], "n_blocks": [len(x) for x in found]}

        return fn

    return map_texts(pages, list(keep), html_col, ADDED, setup)
