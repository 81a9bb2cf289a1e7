"""A page as a tree of block elements with features, for `html_extract`."""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span "
    "strike strong sub sup time tt u var wbr img br acronym output math semantics mrow mi mn mo ms mtext "
    "msup msub msubsup mfrac msqrt mroot mover munder munderover mstyle mpadded mspace mfenced menclose "
    "mphantom mtable mtr mtd".split()
)
SILENT = set("script style noscript template iframe object svg canvas title audio video".split())
#: Elements that can be in a head; any other start tag or text ends it.
IN_HEAD = SILENT - set("iframe object svg canvas audio video".split()) | set("html head base link meta".split())
#: What math adds besides its text.
MATH_SILENT = {"annotation", "annotation-xml"}
CONTROLS = set("input button select textarea option".split())
#: An element that ends an open one of these kinds.
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"},
}
SCOPES = set("ul ol dl table select article section div body main aside nav form".split())
KINDS = [
    {"nav", "menu"}, {"header"}, {"footer", "address"}, {"aside"}, {"article", "main"},
    {"form", "fieldset", "button", "select", "textarea", "option", "legend", "datalist"}, {"p"},
    {"h1", "h2", "h3", "h4", "h5", "h6"}, {"ul", "ol", "dl", "li", "dt", "dd"},
    {"table", "tr", "td", "th", "tbody", "thead", "caption"}, {"section", "div"}, {"dialog"},
    {"figure", "figcaption", "details", "summary"}, {"blockquote", "pre"}, {"html", "body"},
]
#: Words of class, id and role that speak against or for a part being the article.
AGAINST = set(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs header masthead banner footer foot contentinfo "
    "copyright legal sidebar aside side complementary rail widget widgets ad ads advert adverts advertisement "
    "advertising sponsor sponsored promo promoted promotion affiliate cookie cookies consent gdpr notice notices "
    "alert popup modal overlay newsletter subscribe subscription signup login paywall comment comments reply "
    "replies respond discussion disqus thread share sharing social follow related recommended recommendations "
    "more trending popular pagination pager search form hidden tags toolbar skip".split()
)
FOR = set("article content contents post entry story body main prose hentry maincontent".split())
#: Tags that say the same by themselves. A header may be the article's own.
TAGS_AGAINST = KINDS[0] | KINDS[2] | KINDS[3] | KINDS[5] | KINDS[11]
TAGS_FOR = KINDS[4]
_TOKEN = re.compile(r"[A-Za-z][a-z]*|[A-Z]+(?![a-z])")
FEATURES = 16 + 3 * len(KINDS)


class Page(HTMLParser):
    """Block elements in page order, each with its parent, and the text blocks they own."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.tags, self.parents = ["#"], [-1]
        self.against, self.favour = [0], [0]
        self.blocks: list[tuple[int, str, int]] = []
        self.stack: list[tuple[str, int]] = [("#", 0)]
        self.controls = [0]
        self.links = self.link_chars = 0
        self.head = False
        #: Open silent elements, and elements open inside the outermost of them.
        self.silent: list[str] = []
        self.buffer: list[str] = []
        self.feed(html)
        self.close()
        self._flush()

    def _flush(self):
        text = " ".join("".join(self.buffer).split())
        if text:
            self.blocks.append((self.stack[-1][1], text, min(self.link_chars, len(text))))
        self.buffer, self.link_chars = [], 0

    def _pop_to(self, kinds: set[str], scopes: set[str]) -> None:
        """Close open elements down to the nearest of `kinds` inside the nearest of `scopes`."""
        for k in range(len(self.stack) - 1, 0, -1):
            if self.stack[k][0] in kinds:
                self._flush()
                del self.stack[k:]
                return
            if self.stack[k][0] in scopes:
                return

    def handle_starttag(self, tag, attrs):
        if tag == "head" and not self.silent:
            self.head = True
            return
        if self.head and tag not in IN_HEAD and not self.silent:
            self.head = False  # a head that was not closed
        if self.silent or tag in SILENT or tag in MATH_SILENT:
            if tag not in VOID:
                self.silent.append(tag)
            return
        if tag in CONTROLS:
            self.controls[self.stack[-1][1]] += 1
        if tag in INLINE or tag in VOID:
            if tag == "a":
                self.links = 1
            if tag in ("br", "hr", "img"):
                self.buffer.append(" ")
            return
        if tag in ENDS:
            self._pop_to(ENDS[tag], SCOPES - {"select"} if tag != "option" else {"select"})
        else:
            self._pop_to({"p"}, SCOPES | {"td", "th", "li", "button"})
        self._flush()
        self.links = 0
        self._open(tag, attrs)

    def _open(self, tag, attrs):
        words = self._words(attrs)
        self.stack.append((tag, len(self.tags)))
        self.parents.append(self.stack[-2][1])
        self.tags.append(tag)
        self.controls.append(0)
        self.against.append(len(words & AGAINST) + (tag in TAGS_AGAINST))
        self.favour.append(len(words & FOR) + (tag in TAGS_FOR))

    @staticmethod
    def _words(attrs) -> set[str]:
        found = set()
        for name, value in attrs:
            if name in ("class", "id", "role"):
                found |= {w.lower() for w in _TOKEN.findall(value or "")}
            if name == "hidden" or (name == "aria-hidden" and value == "true"):
                found.add("hidden")
            if name == "style" and re.search(r"display\s*:\s*none", value or ""):
                found.add("hidden")
        return found

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in INLINE and tag != "head":
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag == "head":
            self.head = False
            return
        if self.silent:
            if tag in self.silent:
                del self.silent[len(self.silent) - 1 - self.silent[::-1].index(tag) :]
                return
            # the end of an element around an unclosed silent one ends that, too
            if all(tag != name for name, _ in self.stack):
                return
            self.silent.clear()
        if tag in SILENT or tag in MATH_SILENT:
            return
        if tag == "a":
            self.links = 0
        elif tag not in INLINE and tag not in VOID:
            self._pop_to({tag}, {"table"} if tag in ENDS else set())

    def handle_data(self, data):
        if self.head and data.strip() and not self.silent:
            self.head = False
        if not self.silent and not self.head:
            if len(self.stack) == 1 and data.strip():
                self._open("body", [])  # text outside all elements is in a body that is not named
            self.buffer.append(data)
            if self.links:
                self.link_chars += len(data.strip())

    def features(self) -> np.ndarray:
        """One row per element; see the names beside each column."""
        n = len(self.tags)
        parent = np.array(self.parents)
        own, own_links, marks, segments, words = (np.zeros(n) for _ in range(5))
        before = np.full(n, -1.0)
        total = 0.0
        for node, text, links in self.blocks:
            own[node] += len(text)
            own_links[node] += links
            marks[node] += sum(map(text.count, ".,;!?"))
            segments[node] += 1
            words[node] += text.count(" ") + 1
            if before[node] < 0:
                before[node] = total
            total += len(text)
        sums = np.stack([own, own_links, marks, segments, words, np.array(self.controls, float)])
        depth, kind = np.zeros(n), np.full(n, -1)
        for k, tag in enumerate(self.tags):
            depth[k] = depth[parent[k]] + 1 if k else 0
            kind[k] = next((i for i, group in enumerate(KINDS) if tag in group), -1)
        paragraphs = np.zeros(n)
        # children come after their parents, so one pass backwards adds up the subtrees
        for k in range(n - 1, 0, -1):
            sums[:, parent[k]] += sums[:, k]
            if kind[k] == 6:
                paragraphs[parent[k]] += 1
            if 0 <= before[k] and (before[parent[k]] < 0 or before[k] < before[parent[k]]):
                before[parent[k]] = before[k]
        chars, links, marks, segments, words, controls = sums
        against, favour = np.array(self.against, float), np.array(self.favour, float)
        over_against, over_favour = np.zeros(n), np.zeros(n)
        over_kind = np.zeros((n, len(KINDS)))
        for k in range(1, n):
            p = parent[k]
            over_against[k] = max(over_against[p], against[p])
            over_favour[k] = max(over_favour[p], favour[p])
            over_kind[k] = over_kind[p]
            if kind[p] >= 0:
                over_kind[k, kind[p]] = 1
        children = np.bincount(parent[1:], minlength=n) if n > 1 else np.zeros(1)
        place, seen = np.zeros(n), np.zeros(n)
        for k in range(1, n):
            place[k], seen[parent[k]] = seen[parent[k]], seen[parent[k]] + 1
        siblings = children[parent]
        some = np.maximum(chars, 1)
        columns = [
            depth, place / np.maximum(siblings, 1), siblings, np.log1p(chars), np.log1p(own), links / some,
            chars / max(total, 1), marks / some, words / np.maximum(segments, 1), paragraphs,
            controls / np.maximum(segments, 1), against, favour, over_against, over_favour,
            np.maximum(before, 0) / max(total, 1),
        ]
        one_hot = (kind[:, None] == np.arange(len(KINDS))).astype(float)
        parent_hot = one_hot[np.maximum(parent, 0)]
        return np.concatenate([np.stack(columns, axis=1), one_hot, parent_hot, over_kind], axis=1)

    def taught(self) -> np.ndarray | None:
        """Labels by the page's own marks: 1 for the article and what leads to it. None if unmarked."""
        n = len(self.tags)
        label, inside, outside = np.zeros(n, int), np.zeros(n, bool), np.zeros(n, bool)
        for k in range(1, n):
            p = self.parents[k]
            article = self.favour[k] and not self.against[k]
            out = bool(self.against[k]) or (self.tags[k] == "header" and not inside[p])
            outside[k] = outside[p] or out
            inside[k] = (inside[p] or article) and not outside[k]
            label[k] = inside[k]
        if not inside.any():
            return None
        for k in range(n - 1, 0, -1):
            if label[k]:
                label[self.parents[k]] = 1
        return label
