"""A page as a tree of DOM nodes: a forgiving parser and the features of each node."""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: Elements whose content is never text of the page.
SILENT = {"head", "title", "script", "style", "noscript", "template", "svg", "iframe", "select", "textarea", "button", "canvas",
          "audio", "video", "annotation", "annotation-xml"}
#: Elements that can stand in a head; any other one, or text, ends it.
HEAD_TAGS = {"base", "basefont", "bgsound", "link", "meta", "noframes", "noscript", "script", "style", "template", "title"}
INLINE = {"a", "abbr", "b", "bdi", "bdo", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label",
          "mark", "q", "ruby", "s", "samp", "small", "span", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "input",
          "object", "math", "mi", "mn", "mo", "ms", "mtext", "mrow", "msub", "msup", "msubsup", "mfrac", "msqrt", "mroot", "mover", "munder",
          "munderover", "mtable", "mtr", "mtd", "mstyle", "mspace", "mpadded", "mphantom", "menclose", "mmultiscripts", "semantics"}
#: A start tag closes open elements of its row up to the nearest of the second set.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
          "option": ({"option"}, {"select"})}
#: Attribute tokens that speak for the frame of a page, and for its main text.
FRAME_WORDS = frozenset("""ad ads advert advertisement advertising aside banner breadcrumb breadcrumbs byline comment comments
    consent cookie cookies copyright disclaimer discussion feedback foot footer form gdpr header login masthead menu meta modal nav
    navbar navigation newsletter notice notification pagination pager popup privacy promo promoted promotion recommended related
    replies reply respond search share sharing sidebar signup skip social sponsor sponsored subscribe tags teaser toolbar topbar
    warning widget""".split())
TEXT_WORDS = frozenset("article articlebody blog body content entry main post postbody story text".split())
FRAME_TAGS = frozenset("nav footer header aside form menu dialog fieldset".split())
TEXT_TAGS = frozenset("article main".split())
TAG_KINDS = [{"p"}, {"h1", "h2", "h3", "h4", "h5", "h6"}, {"li", "dt", "dd"}, {"ul", "ol", "dl"}, {"div", "section"}, TEXT_TAGS,
             FRAME_TAGS, {"a"}, {"blockquote", "pre", "table", "tr", "td", "th", "figure", "figcaption"}, {"#text"}]
#: Start tags that end an unclosed ``button`` or ``select``.
PARTS = TEXT_TAGS | FRAME_TAGS | {"section", "table", "h1", "h2", "h3", "h4", "h5", "h6"}
ROOTS = {"#page", "html", "body"}
N_FEATURES = len(TAG_KINDS) + 18
WORDS = re.compile(r"[a-z]+")


class Page:
    """Nodes in page order; a node stands after its parent. Text nodes have the tag ``#text``."""

    def __init__(self):
        self.parent, self.tag, self.words, self.text, self.block = [-1], ["#page"], [frozenset()], [""], [0]
        self.now = 0

    def add(self, parent: int, tag: str, words: frozenset, text: str = "") -> int:
        self.parent.append(parent)
        self.tag.append(tag)
        self.words.append(words)
        self.text.append(text)
        self.block.append(self.now)
        return len(self.tag) - 1

    def children(self) -> list[list[int]]:
        out = [[] for _ in self.tag]
        for i, p in enumerate(self.parent[1:], 1):
            out[p].append(i)
        return out


def attribute_words(attrs) -> frozenset:
    found = set()
    for name, value in attrs:
        if value and name in ("class", "id", "role", "itemprop", "data-role", "aria-label"):
            found.update(WORDS.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower()))
    return frozenset(found)


class Reader(HTMLParser):
    """Builds a page; end tags may be missing, stray or wrongly nested."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.page, self.open, self.silent = Page(), [0], []

    def close_from(self, at: int) -> None:
        del self.open[at:]

    def close_open(self, tags: set, limit: set) -> None:
        for at in range(len(self.open) - 1, 0, -1):
            tag = self.page.tag[self.open[at]]
            if tag in limit:
                return
            if tag in tags:
                self.close_from(at)

    def leave_silence(self, tag: str) -> None:
        """What cannot stand in a head ends it, and a body in any part of it; parts of a page end a button or a list of options."""
        first = self.silent[0]
        if first == "head" and (tag == "body" or (len(self.silent) == 1 and tag not in HEAD_TAGS | {"head", "html"})):
            self.silent.clear()
        elif first in ("button", "select") and (tag == first or tag in PARTS):
            self.silent.clear()

    def handle_starttag(self, tag, attrs):
        if self.silent:
            self.leave_silence(tag)
        if self.silent:
            if tag in ("head", "html"):
                return
            if tag not in VOID:
                self.silent.append(tag)
            return
        if tag == "body" and any(self.page.tag[i] == "body" for i in self.open):
            return
        if tag == "head" and any(self.page.tag[i] not in ROOTS - {"body"} for i in self.open):
            return
        if tag in SILENT:
            self.silent.append(tag)
            return
        if tag not in INLINE:
            self.page.now += 1
            self.close_open({"p"}, {"table", "button", "caption", "td", "th", "li", "div", "section", "article"})
        if tag in CLOSES:
            self.close_open(*CLOSES[tag])
        if tag == "br":
            self.handle_data(" ")
        node = self.page.add(self.open[-1], tag, attribute_words(attrs)) if tag not in VOID else -1
        if node >= 0:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        if tag in VOID or tag not in SILENT:
            self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in SILENT and not self.silent:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if self.silent:
            if tag in self.silent:
                while self.silent.pop() != tag:
                    pass
                return
            if tag not in ("html", "body") and all(self.page.tag[i] != tag for i in self.open):
                return
            self.silent.clear()  # the end of a parent ends what it holds
        if tag not in INLINE:
            self.page.now += 1
        for at in range(len(self.open) - 1, 0, -1):
            if self.page.tag[self.open[at]] == tag:
                self.close_from(at)
                return

    def handle_data(self, data):
        if self.silent == ["head"] and data.strip():
            self.silent.clear()
        if not self.silent:
            self.page.add(self.open[-1], "#text", frozenset(), data)


def read_page(html: str | None) -> Page:
    """The tree of a page; null is an empty one. An unclosed ``head`` ends where the body, or anything of it, begins."""
    reader = Reader()
    reader.feed(html or "")
    reader.close()
    return reader.page


def features(page: Page) -> np.ndarray:
    """One row per node."""
    n = len(page.tag)
    chars = [len(t.strip()) if g == "#text" else 0 for t, g in zip(page.text, page.tag)]
    stops = [t.count(".") + t.count(",") + t.count("!") + t.count("?") + t.count("。") if g == "#text" else 0
             for t, g in zip(page.text, page.tag)]
    total, linked, tags, marks, paragraphs = list(chars), [0] * n, [1] * n, list(stops), [0] * n
    for i in range(n - 1, 0, -1):
        if page.tag[i] == "a":
            linked[i] = total[i]
        p = page.parent[i]
        total[p] += total[i]
        linked[p] += linked[i]
        tags[p] += tags[i] if page.tag[i] != "#text" else 0
        marks[p] += marks[i]
        paragraphs[p] += paragraphs[i] + (page.tag[i] == "p")
    siblings, same, index = [0] * n, [0] * n, [0] * n
    for own in page.children():
        kinds: dict[str, int] = {}
        for k, i in enumerate(own):
            kinds[page.tag[i]] = kinds.get(page.tag[i], 0) + 1
            index[i] = k
        for i in own:
            siblings[i], same[i] = len(own), kinds[page.tag[i]]
    depth, above_frame, above_text, in_link, kind_above = [0] * n, [0] * n, [0] * n, [0] * n, [0] * n
    out = np.zeros((n, N_FEATURES))
    page_chars = max(total[0], 1)
    for i in range(n):
        tag, words, p = page.tag[i], page.words[i], page.parent[i]
        frame = int(tag in FRAME_TAGS or bool(words & FRAME_WORDS))
        text = int((tag in TEXT_TAGS or bool(words & TEXT_WORDS)) and not frame)
        if p >= 0:
            depth[i] = depth[p] + 1
            above_frame[i], above_text[i], in_link[i] = above_frame[p], above_text[p], in_link[p]
            parent_total, parent_tag = max(total[p], 1), page.tag[p]
            link_above = linked[p] / parent_total
        else:
            parent_total, parent_tag, link_above = page_chars, "", 0.0
        above_frame[i] += frame
        above_text[i] += text
        in_link[i] += tag == "a"
        size = max(total[i], 1)
        out[i] = [float(tag in kind) for kind in TAG_KINDS] + [
            frame, text, min(above_frame[i], 3), min(above_text[i], 3), in_link[i] > 0, depth[i], index[i], siblings[i],
            same[i] / max(siblings[i], 1), np.log1p(total[i]), total[i] / page_chars, total[i] / parent_total, total[i] / tags[i],
            linked[i] / size, link_above, marks[i] / size * 100, paragraphs[i], float(parent_tag in ROOTS)]
    return out
