"""Main text of web pages by gradient-boosted trees over DOM nodes.

A page is parsed into block elements and runs of text; a run is the text between
two block borders, with inline markup dissolved. Every node is described by its
tag, its attribute tokens and those of its ancestors, its depth, the density of
its subtree, its links, and how it stands among its siblings. Boosted trees give
the log-odds that a node holds main text. The decoder then picks the set of
nodes with the greatest sum of log-odds in which no node is kept below one that
is dropped, so an ancestor and a descendant never contradict each other.

The trees are trained here, on generated pages with labelled nodes (``training``):
page furniture in many layouts, in semantic and in plain markup, with names that
tell, that tell nothing and that mislead.

Defined cases: null or empty html gives empty text; a page without markup is one
block; unclosed and crossed elements end with the element around them (head with
the first text or element that cannot stand in it, other raw elements at the next
block, script, style, textarea and title with the page); what
follows an unfinished tag is markup; rows with equal or null page_id stay
separate; an empty table gives no rows; extra columns are ignored. A quote inside an
unquoted attribute value is part of it; a quoted value ends at the next quote of its
kind or, without one, as if it were unquoted. Mathematics and a button inside a
paragraph are text; other buttons are parts of forms.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Elements of the HTML standard by role.
VOID = set("area base br col embed hr img input link meta source track wbr".split())
RAW = set("script style textarea title noscript iframe template svg annotation annotation-xml select button head object audio video canvas".split())
# To the end of the page if left open; elements that can stand in head, whose end tag may be left out.
TO_END = set("script style textarea title".split())
IN_HEAD = set("title meta link base script style noscript template".split())
BLOCK = set(
    "html body article main section div nav header footer aside form ul ol li dl dt dd p h1 h2 h3 h4 h5 h6 blockquote pre "
    "table thead tbody tfoot tr td th caption figure figcaption details summary fieldset legend address center hr dialog menu".split()
)
ENDS_P = BLOCK - {"html", "body", "td", "th", "tr", "thead", "tbody", "tfoot", "caption"}
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table", "tbody", "thead", "tfoot"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
}
TAGS = "# article main section div nav header footer aside form ul ol li p h1 h2 h3 blockquote pre table td figure figcaption address".split()
# Attribute tokens by what they tell about a node.
TOKENS = {
    "nav": "nav menu navbar navigation breadcrumb breadcrumbs toolbar pager pagination tabs links sitemap skip",
    "foot": "footer foot copyright legal bottom colophon imprint",
    "head": "header masthead topbar logo branding top",
    "side": "sidebar aside rail widget related recommended recommendations trending popular secondary complementary more",
    "ad": "ad ads adv advert advertisement adsense sponsor sponsored promo promoted promotion banner dfp",
    "comment": "comment comments reply replies discussion respond disqus responses feedback",
    "notice": "cookie cookies consent notice alert gdpr modal popup overlay newsletter subscribe subscription paywall disclaimer warning hidden none",
    "share": "share sharing social follow tags tag meta byline author",
    "form": "form search login signup signin register input poll",
    "main": "article content main post entry story body text page prose",
}
_FLAG = {word: 1 << i for i, words in enumerate(TOKENS.values()) for word in words.split()}
_TAG_FLAG = {"nav": "nav", "footer": "foot", "header": "head", "aside": "side", "form": "form", "article": "main", "main": "main"}
TAG_FLAG = {tag: 1 << list(TOKENS).index(group) for tag, group in _TAG_FLAG.items()}
_LABEL_FLAG = 1 << 20
#: A name that is one telling word and nothing else; such a word may be chance in a longer name ("more-text").
_WHOLE = 1 << len(TOKENS)

# An attribute's name, and its value: quoted up to the next quote of its kind, or else up to white space or the tag's end.
_NAMED = r"[^\s/>][^\s/>=]*+"
_VALUE = r"\"[^\"]*\"|'[^']*'|[^\s>]*+"
_MARK = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?:[!?]|/(?![A-Za-z]))[^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*+)((?:[\s/]++|{_NAMED}(?:\s*+=\s*+(?:{_VALUE}))?+)*+)(?:>|\Z)", re.S
)
_ATTRIBUTE = re.compile(rf"({_NAMED})(?:\s*+=\s*+({_VALUE}))?+")
_TELLING = {"class", "id", "role", "style", "aria-label", "itemprop"}
_UNQUOTED_END = re.compile(r"=\s*[^\s\"'>][^\s>]*\Z|=\s*/\Z")
_WORD = re.compile(r"[a-z]+")
_RAW_END = {tag: re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I) for tag in RAW}
_TEXT = re.compile(r"[^\s<]")


def _closes_itself(said: str | None) -> bool:
    """Whether a tag ends in a slash that is no part of an attribute's value."""
    return bool(said) and said.endswith("/") and not _UNQUOTED_END.search(said)


def _raw_end(source: str, tag: str, at: int, around: set[str]) -> int:
    """Where a raw element that begins before ``at`` ends.

    One without an end tag goes as far as the end of a block ``around`` it or the next
    of its kind, head as far as body, and ends at the first block on the way, head at
    the first text or element that cannot stand in it.
    """
    if tag in TO_END:
        end = _RAW_END[tag].search(source, at)
        return end.end() if end else len(source)
    opened, misfit, head = [], None, tag == "head"
    while True:
        m = _MARK.search(source, at)
        if head and misfit is None and (said := _TEXT.search(source, at, m.start() if m else len(source))):
            misfit = said.start()
        if not m:
            return len(source) if misfit is None else misfit
        at, found = m.end(), (m[2] or "").lower()
        if m[1]:
            if found == tag:
                return at
            if found in opened:
                del opened[len(opened) - 1 - opened[::-1].index(found) :]
            elif found in around or found in ("body", "html"):
                return m.start() if misfit is None else misfit
        elif found:
            if found == tag or found == "body":
                return m.start() if misfit is None else misfit
            if misfit is None and (found not in IN_HEAD if head else found in BLOCK):
                misfit = m.start()
            if found in BLOCK and found not in VOID:
                opened.append(found)
            if found in (IN_HEAD & RAW if head else TO_END) and not _closes_itself(m[3]):
                at = _raw_end(source, found, at, around | {"head"})


@dataclass
class Page:
    """Nodes in page order: parent (-1 above the root), tag number, own flags, text of runs, link characters."""

    parent: list[int]
    tag: list[str]
    flags: list[int]
    text: list[str | None]
    linked: list[int]


def parse(source: str | None) -> Page:
    """Block elements and runs of text of a page; raw elements and markup leave nothing."""
    page = Page([-1], ["html"], [0], [None], [0])
    stack, run, links, depth = [0], [], 0, 0
    at, source = 0, source or ""

    def node(tag: str, flags: int, text: str | None = None, linked: int = 0) -> int:
        page.parent.append(stack[-1])
        page.tag.append(tag)
        page.flags.append(flags)
        page.text.append(text)
        page.linked.append(linked)
        return len(page.tag) - 1

    def close_run() -> None:
        nonlocal run, links
        if run:
            said = " ".join(html.unescape("".join(run)).split())
            if said:
                node("#", 0, said, min(links, len(said)))
            run, links = [], 0

    while True:
        m = _MARK.search(source, at)
        piece = source[at : m.start() if m else len(source)]
        if piece:
            run.append(piece)
            if depth:
                links += len(piece)
        if not m:
            break
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag in BLOCK:
                for i in range(len(stack) - 1, 0, -1):
                    if page.tag[stack[i]] == tag:
                        close_run()
                        del stack[i:]
                        depth = 0
                        break
            elif tag == "a":
                depth = 0
            continue
        if tag in RAW and not (tag == "button" and page.tag[stack[-1]] == "p"):
            if not _closes_itself(m[3]):
                at = _raw_end(source, tag, at, {page.tag[i] for i in stack[1:]})
            continue
        if tag == "a":
            depth = 1
        elif tag == "br":
            run.append(" ")
        if tag not in BLOCK:
            continue
        close_run()
        if tag in ("html", "body") and len(stack) == 1:
            if tag == "body":
                stack.append(node("body", 0))
            continue
        if tag in ENDS_P:
            for i in range(len(stack) - 1, 0, -1):
                above = page.tag[stack[i]]
                if above == "p":
                    del stack[i:]
                    break
                if above in BLOCK:
                    break
        if tag in CLOSES:
            same, limit = CLOSES[tag]
            for i in range(len(stack) - 1, 0, -1):
                above = page.tag[stack[i]]
                if above in limit:
                    break
                if above in same:
                    del stack[i:]
                    break
        flags = TAG_FLAG.get(tag, 0)
        if m[3]:
            for name, value in _ATTRIBUTE.findall(m[3]):
                name = name.lower()
                if name == "data-y":
                    flags |= _LABEL_FLAG
                elif name == "hidden":
                    flags |= _FLAG["hidden"] | _WHOLE
                elif name in _TELLING:
                    for part in value.lower().strip("\"'").split():
                        found = _WORD.findall(part)
                        for word in found:
                            flags |= _FLAG.get(word, 0)
                        if len(found) == 1 and found[0] in _FLAG and found[0] not in TOKENS["main"]:
                            flags |= _WHOLE
        made = node(tag, flags)
        if tag not in VOID:
            stack.append(made)
    close_run()
    return page


GROUPS = len(TOKENS)
_TAG_PLACE = {t: i for i, t in enumerate(TAGS)}
FEATURES = len(TAGS) + 1 + 2 * (GROUPS + 1) + 16
_FLAG_BITS = (1 << np.arange(GROUPS + 1)).astype(np.int64)


def features(page: Page) -> np.ndarray:
    """A row per node."""
    n = len(page.tag)
    parent = page.parent
    chars, signs, words = [0] * n, [0] * n, [0] * n
    linked, elements, runs = list(page.linked), [0] * n, [0] * n
    for i, text in enumerate(page.text):
        if text is not None:
            chars[i] = len(text)
            signs[i] = text.count(".") + text.count(",")
            words[i] = text.count(" ") + 1
            runs[i] = 1
    for i in range(n - 1, 0, -1):
        p = parent[i]
        chars[p] += chars[i]
        signs[p] += signs[i]
        words[p] += words[i]
        linked[p] += linked[i]
        runs[p] += runs[i]
        elements[p] += elements[i] + 1
    above, depth, place, count, heavy = [0] * n, [0] * n, [0] * n, [0] * n, [0] * n
    alike: dict[tuple[int, str], int] = {}
    for i in range(1, n):
        p = parent[i]
        above[i] = above[p] | page.flags[p]
        depth[i] = depth[p] + 1
        place[i] = count[p]
        count[p] += 1
        heavy[p] = max(heavy[p], chars[i])
        key = p, page.tag[i]
        alike[key] = alike.get(key, 0) + 1
    up = np.maximum(np.array(parent), 0)
    c, k = np.array(chars, dtype=float), np.array(linked, dtype=float)
    s, w, e = np.array(signs, dtype=float), np.array(words, dtype=float), np.array(elements, dtype=float)
    r, d, siblings = np.array(runs, dtype=float), np.array(depth, dtype=float), np.array(count, dtype=float)
    same = np.array([1] + [alike[parent[i], page.tag[i]] for i in range(1, n)], dtype=float)
    x = np.zeros((n, FEATURES), dtype=np.float32)
    x[np.arange(n), [_TAG_PLACE.get(t, len(TAGS)) for t in page.tag]] = 1
    at = len(TAGS) + 1
    x[:, at : at + GROUPS + 1] = (np.array(page.flags)[:, None] & _FLAG_BITS) > 0
    at += GROUPS + 1
    x[:, at : at + GROUPS + 1] = (np.array(above)[:, None] & _FLAG_BITS) > 0
    at += GROUPS + 1
    one = np.maximum(c, 1)
    shown = np.column_stack([
        d, np.log1p(c), k / one, s / one, w / one, c / (e + 1), np.log1p(e), r, siblings, siblings[up], same / np.maximum(siblings[up], 1),
        c / np.maximum(c[up], 1), c / np.maximum(np.array(heavy, dtype=float)[up], 1), np.array(place) / np.maximum(siblings[up], 1),
        k[up] / np.maximum(c[up], 1), c / max(c[0], 1),
    ])
    x[:, at:] = shown
    return x


@dataclass
class Trees:
    """Boosted trees of fixed depth: per tree and inner node a feature and a cut, per leaf a value."""

    base: float
    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        found = np.full(len(x), self.base)
        rows, inner = np.arange(len(x)), self.feature.shape[1]
        for f, c, v in zip(self.feature, self.cut, self.value):
            at = np.zeros(len(x), dtype=np.int64)
            while at.size and at[0] < inner:
                at = 2 * at + 1 + (x[rows, f[at]] > c[at])
            found += v[at - inner]
        return found


def fit_trees(x: np.ndarray, y: np.ndarray, trees: int = 150, depth: int = 5, rate: float = 0.2, bins: int = 24, ridge: float = 2.0) -> Trees:
    """Gradient boosting of the logistic loss with second-order leaf values, over quantile bins."""
    n, d = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(d)]
    marks = {j: np.flatnonzero(x[:, j]) for j in range(d) if ((x[:, j] == 0) | (x[:, j] == 1)).all()}
    coded = {j: np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges) if j not in marks}
    base = float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    odds, inner, wide = np.full(n, base), (1 << depth) - 1, bins + 1
    feature, cut, value = (np.zeros((trees, inner), dtype=np.int64), np.full((trees, inner), np.inf), np.zeros((trees, inner + 1)))
    for t in range(trees):
        p = 1 / (1 + np.exp(-odds))
        g, h = y - p, p * (1 - p)
        at = np.zeros(n, dtype=np.int64)
        for level in range(depth):
            first, width = (1 << level) - 1, 1 << level
            best, base_at = np.full(width, 1e-3), at - first
            ga, ha = np.bincount(base_at, g, width)[:, None], np.bincount(base_at, h, width)[:, None]
            for j in range(d):
                if j in marks:
                    # A mark has one cut; the rows that have it give the right side.
                    rows, cuts = marks[j], np.zeros(1)
                    gs = ga - np.bincount(base_at[rows], g[rows], width)[:, None]
                    hs = ha - np.bincount(base_at[rows], h[rows], width)[:, None]
                else:
                    key, cuts = base_at * wide + coded[j], edges[j]
                    gs = np.bincount(key, g, width * wide).reshape(width, wide).cumsum(axis=1)[:, : len(cuts)]
                    hs = np.bincount(key, h, width * wide).reshape(width, wide).cumsum(axis=1)[:, : len(cuts)]
                gain = gs**2 / (hs + ridge) + (ga - gs) ** 2 / (ha - hs + ridge) - ga**2 / (ha + ridge)
                top = gain.argmax(axis=1)
                better = gain[np.arange(width), top] > best
                best[better] = gain[np.arange(width), top][better]
                feature[t, first : first + width][better] = j
                cut[t, first : first + width][better] = cuts[top[better]]
            at = 2 * at + 1 + (x[np.arange(n), feature[t][at]] > cut[t][at])
        leaf = at - inner
        value[t] = rate * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + ridge)
        odds += value[t][leaf]
    return Trees(base, feature, cut, value)


def decode(parent: list[int], odds: np.ndarray) -> np.ndarray:
    """Kept nodes: the set, closed upwards, with the greatest sum of log-odds."""
    n = len(parent)
    worth = odds.tolist()
    for i in range(n - 1, 0, -1):
        if worth[i] > 0:
            worth[parent[i]] += worth[i]
    kept = np.zeros(n, dtype=bool)
    kept[0] = worth[0] > 0
    for i in range(1, n):
        kept[i] = kept[parent[i]] and worth[i] > 0
    return kept


# ---- training pages -----------------------------------------------------------------


LETTERS = "aeiourstnlmdk"


def generated_page(r: np.random.Generator, silent: bool = False) -> str:
    """A page in a random layout; elements marked ``data-y`` hold only main text, or nothing below them counts.

    The names of a ``silent`` page may tell nothing or mislead, its article may have no
    element of its own, and may hold lists of links.
    """
    def words(n: int) -> str:
        sizes = r.integers(2, 9, size=max(1, n)).tolist()
        letters = iter(r.integers(0, len(LETTERS), size=sum(sizes)).tolist())
        return " ".join("".join(LETTERS[next(letters)] for _ in range(k)) for k in sizes)

    def sentence(n: int) -> str:
        text = words(n)
        return text.capitalize() + ("." if r.random() < 0.9 else "")

    def paragraph() -> str:
        return " ".join(sentence(int(r.integers(3, 18))) for _ in range(int(r.choice([1, 1, 2, 4, 7]))))

    def pick(group: str) -> str:
        return str(r.choice(TOKENS[group].split()))

    def box(group: str, tags: str, inside: str) -> str:
        tag = str(r.choice(tags.split()))
        telling = tag in TAG_FLAG and tag not in ("article", "main")
        if silent and group in ("nav", "foot", "head") and r.random() < 0.25:
            return f"<{tag}{neutral()}>{inside}</{tag}>"
        said = f' {r.choice(["class", "id"])}="{pick(group)}{r.choice(["", " x1", "-wrap", " col-3"])}"' if not telling or r.random() < 0.5 else ""
        return f"<{tag}{said}>{inside}</{tag}>"

    def neutral() -> str:
        """No name, or one that tells nothing."""
        return str(r.choice(["", "", f' id="{words(1)}"', f' class="{words(1)}"', f' id="{words(1)}-{r.integers(9)}"']))

    def chance() -> str:
        """Now and then a name in which a telling word stands by chance."""
        if not silent:
            return ""
        if r.random() > 0.3:
            return neutral() if r.random() < 0.3 else ""
        word, other = pick(str(r.choice(list(TOKENS)))), str(r.choice("text note intro lead block first x big".split()))
        said = f"{word}-{other}" if r.random() < 0.6 else f"{other}-{word}"
        return f' {r.choice(["class", "id"])}="{said}"'

    def link(n: int = 2) -> str:
        return f'<a href="/x">{words(int(r.integers(1, n + 1)))}</a>'

    def link_list() -> str:
        items = [link() for _ in range(int(r.integers(2, 9)))]
        return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>" if r.random() < 0.7 else " | ".join(items)

    def furniture(where: str) -> str:
        kind = str(r.choice(where.split()))
        if kind == "nav":
            return box("nav", "nav nav div ul", link_list())
        if kind == "head":
            return box("head", "header header div", (f"<h2>{words(2)}</h2>" if r.random() < 0.5 else words(3)) + (link_list() if r.random() < 0.5 else ""))
        if kind == "foot":
            return box("foot", "footer footer div", (f"<p>{sentence(6)}</p>" if r.random() < 0.4 else "&copy; " + sentence(int(r.integers(2, 20)))) + (link_list() if r.random() < 0.4 else ""))
        if kind == "ad":
            return box("ad", "div div section aside", (f"<p>{paragraph()}</p>" if r.random() < 0.4 else sentence(int(r.integers(2, 14)))) + (link(4) if r.random() < 0.4 else ""))
        if kind == "side":
            return box("side", "aside aside div section", f"<h3>{words(2)}</h3>" + (link_list() if r.random() < 0.6 else f"<p>{paragraph()}</p>"))
        if kind == "comment":
            many = "".join(f"<{t}><p>{paragraph()}</p></{t}>" for t in [str(r.choice(["div", "li", "article"]))] for _ in range(int(r.integers(1, 5))))
            return box("comment", "section div ol", (f"<h3>{words(1)}</h3>" if r.random() < 0.5 else "") + many)
        if kind == "notice":
            return box("notice", "div div section dialog", f"<p>{paragraph()}</p>" if r.random() < 0.6 else sentence(9))
        if kind == "share":
            return box("share", "div ul p", link_list())
        return "<form>" + (f"<p>{sentence(7)}</p>" if r.random() < 0.5 else sentence(4)) + "<label>" + words(2) + '</label><input type="text"></form>'

    def main() -> str:
        parts = [f"<h1 data-y>{words(int(r.integers(2, 12)))}</h1>"] if r.random() < 0.9 else []
        for _ in range(int(r.choice([1, 2, 3, 6, 12]))):
            if short:
                parts.append(f"<p data-y>{sentence(int(r.integers(2, 8)))}</p>")
                break
            kind = r.random()
            if kind < 0.66:
                body = paragraph()
                body = f"<b>{body}" if r.random() < 0.1 else body
                body = f"{body} {link(3)} {words(4)}" if r.random() < 0.15 else body
                parts.append(f"<p{chance()} data-y>{body}" + ("</p>" if r.random() < 0.85 else ""))
            elif kind < 0.73:
                parts.append(f"<h2 data-y>{words(4)}</h2>")
            elif kind < 0.88:
                tag, linked = str(r.choice(["ul", "ol"])), silent and r.random() < 0.6
                items = [link(6) + (f" {words(3)}" if r.random() < 0.3 else "") if linked else sentence(6) for _ in range(int(r.integers(2, 7)))]
                parts.append(f"<{tag}{chance()} data-y>" + "".join(f"<li data-y>{x}</li>" for x in items) + f"</{tag}>")
            elif kind < 0.92:
                parts.append(f"<blockquote data-y>{paragraph()}</blockquote>")
            elif kind < 0.93:
                parts.append("<dl data-y>" + "".join(f"<dt data-y>{words(2)}</dt><dd data-y>{sentence(5)}</dd>" for _ in range(3)) + "</dl>")
            elif kind < 0.945:
                parts.append(f"<pre data-y>{words(8)}</pre>")
            elif kind < 0.96:
                parts.append("<table data-y>" + "".join(f"<tr data-y><td data-y>{words(2)}</td><td data-y>{words(1)}</td></tr>" for _ in range(3)) + "</table>")
            else:
                parts.append(f"<div{chance()} data-y>{paragraph()}</div>")
        if silent and r.random() < 0.15:
            parts = [f"<div{neutral()} data-y>{x}</div>" for x in parts]
        for _ in range(int(r.choice([0, 0, 1, 2]))):
            parts.insert(int(r.integers(1, len(parts) + 1)), furniture("ad share notice side form comment"))
        tag = str(r.choice(["article", "article", "article", "main", "div", "section", *(["div", ""] if silent else [])]))
        if not tag:
            return "".join(parts)
        said = f' class="{pick("main")}"' if r.random() < ((0.5 if silent else 1) if tag in ("div", "section") else 0.3) else chance()
        return f"<{tag}{said} data-y>" + "".join(parts) + f"</{tag}>"

    short = silent and r.random() < 0.1
    before = [furniture("head nav nav ad notice form side") for _ in range(int(r.integers(0, 5)))]
    after = [furniture("comment foot foot side ad nav notice form share") for _ in range(int(r.integers(0, 5)))]
    body = main()
    wrap = r.random()
    if wrap < 0.25:
        body = "<div data-y>" + body + (furniture("side ad") if r.random() < 0.5 else "") + "</div>"
    elif wrap < 0.4:
        body = "<main data-y>" + body + "</main>"
    return f"<html><head><title>{words(4)}</title></head><body data-y>" + "".join(before) + body + "".join(after) + "</body></html>"


def labels(page: Page) -> np.ndarray:
    """1 for marked elements and the runs right below them, for the root, 0 for all else."""
    own = [bool(f & _LABEL_FLAG) for f in page.flags]
    own[0] = True
    y = [x or t == "body" for x, t in zip(own, page.tag)]
    for i in range(1, len(y)):
        if page.text[i] is not None:
            y[i] = own[page.parent[i]]
        y[i] = y[i] and y[page.parent[i]]
    return np.array(y, dtype=float)


def training(pages: int = 1500, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Feature rows and labels of generated pages, two of three silent."""
    r = np.random.default_rng(seed)
    found = [parse(generated_page(r, silent=i % 3 > 0)) for i in range(pages)]
    return np.vstack([features(p) for p in found]), np.concatenate([labels(p) for p in found])


@lru_cache(1)
def train() -> Trees:
    """The trees used by the query; the same on every run, fitted once in a process."""
    return fit_trees(*training())


def main_text(page: Page, odds: np.ndarray) -> str:
    """Kept runs in page order, a line each."""
    kept = decode(page.parent, odds)
    return "\n".join(t for t, k in zip(page.text, kept) if t is not None and k)


def extract(pages: DataFrame, trees: Trees | None = None) -> DataFrame:
    """Per page: page_id, url, text, n_chars. No shuffle; the trees are a few kilobytes."""
    model = trees or train()

    def run(sources: pd.Series) -> pd.Series:
        out = []
        sources = list(sources)
        for a in range(0, len(sources), 64):
            parsed = [parse(s) for s in sources[a : a + 64]]
            odds = model.log_odds(np.vstack([features(p) for p in parsed]))
            at = 0
            for p in parsed:
                out.append(main_text(p, odds[at : at + len(p.tag)]))
                at += len(p.tag)
        return pd.Series(out, dtype=object)

    found = pages.select("page_id", "url", F.pandas_udf(run, "string")(F.col("html").cast("string")).alias("text"))
    return found.withColumn("n_chars", F.length("text").cast("bigint"))
