"""Pages as trees: block elements and the blocks of text in them, with what tells content from the rest."""

from __future__ import annotations

import re
from functools import lru_cache
from html.parser import HTMLParser

# HTML's elements by how they are laid out
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr picture q rp rt ruby s samp small source span strike strong sub sup time tt u var".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset("script style title template noscript svg math iframe object canvas audio video select textarea button datalist".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dd dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre search section table ul body".split())
#: What an element closes when it opens, and what it does not reach beyond.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}
TAGS = "html body main article section div header footer nav aside form fieldset ul ol li dl dt dd p h1 h2 h3 h4 h5 h6 blockquote pre table tbody thead tr td th figure figcaption address details summary center menu dialog hgroup".split()
TAG = {t: k for k, t in enumerate(TAGS)}
OTHER, LEAF = len(TAGS), len(TAGS) + 1

# Beginnings of words in class, id and role that say what an element is for; those of up to four letters are whole words
HINTS = {
    "content": "article articlebody content contents main mainbody post entry story text prose body",
    "menu": "nav navbar navigation menu breadcrumb crumbs pagination pager toc tabs toolbar skip sitemap",
    "header": "header head masthead topbar logo branding brand tagline",
    "footer": "footer foot copyright colophon legal bottom imprint",
    "side": "sidebar side aside rail widget related recommend trending popular complementary teaser",
    "advert": "ad ads advert sponsor promo dfp adsense commercial affiliate outbrain taboola",
    "notice": "cookie consent gdpr notice alert popup modal overlay banner paywall disclaimer warning announcement newsletter subscribe subscription privacy",
    "form": "form login signin signup register search contact feedback contentinfo",
    "comment": "comment disqus reply replies discussion respons review respond thread",
    "share": "share sharing social follow tags tag tweet facebook print",
}
GROUPS = tuple(HINTS)
_WHOLE = {w: k for k, words in enumerate(HINTS.values()) for w in words.split() if len(w) <= 4}
_BEGINNING = re.compile("|".join(f"(?P<{g}>{'|'.join(w for w in words.split() if len(w) > 4)})" for g, words in HINTS.items()))
_PIECES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")
_SECTION = re.compile(r"<!\[[^>]*>")


@lru_cache(4_096)
def hints(names: str) -> int:
    """A bit for each group that the names of an element speak of."""
    out = 0
    for word in _PIECES.findall(names):
        word = word.lower()
        if word in _WHOLE:
            out |= 1 << _WHOLE[word]
        elif found := _BEGINNING.match(word):
            out |= 1 << GROUPS.index(found.lastgroup)
    return out


class Page(HTMLParser):
    """The tree of a page, in page order: node 0 is the page itself.

    parent, tag (of TAGS, OTHER or LEAF), hint (bits of GROUPS), hidden, truth (of a training page's own attribute, else -1) by node;
    block, words, linked (words in links) of leaves. Leaves are the runs of text between the bounds of block elements; elements that are never seen
    as text are no nodes. A missing or stray end tag closes or leaves open what HTML says, by and large.
    """

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.parent, self.tag, self.hint, self.hidden, self.truth = [-1], [OTHER], [0], [False], [-1]
        self.block: dict[int, str] = {}
        self.words: dict[int, int] = {}
        self.linked: dict[int, int] = {}
        self.open: list[tuple[str, int]] = [("", 0)]  # elements, and the node of the nearest block element
        self.unseen: str | None = None
        self.inside: list[str] = []  # what is open in an unseen element
        self.links = self.in_links = 0
        self.run: list[str] = []
        if "<![" in html:
            html = _SECTION.sub(" ", html)
        self.feed(html)
        self.close()
        self.flush()

    def flush(self) -> None:
        """Ends a run of text."""
        text = " ".join("".join(self.run).split())
        if text:
            at = self.node(LEAF, 0, False, self.truth[self.open[-1][1]])
            self.block[at], self.words[at], self.linked[at] = text, text.count(" ") + 1, self.in_links
        self.run, self.in_links = [], 0

    def node(self, tag: int, hint: int, hidden: bool, truth: int) -> int:
        self.parent.append(self.open[-1][1])
        self.tag.append(tag)
        self.hint.append(hint)
        self.hidden.append(hidden)
        self.truth.append(truth)
        return len(self.parent) - 1

    def pop(self, depth: int) -> None:
        """Closes all elements from a depth of the stack on."""
        if any(t not in INLINE for t, _ in self.open[depth:]):
            self.flush()
        self.links -= sum(t == "a" for t, _ in self.open[depth:])
        del self.open[depth:]

    def closed(self, tags: set[str] | frozenset, bounds: set[str]) -> None:
        """Closes the innermost open element of `tags` that no element of `bounds` parts from here."""
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k][0] in tags:
                return self.pop(k)
            if self.open[k][0] in bounds:
                return None

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if self.unseen:
            if tag not in VOID:
                self.inside.append(tag)
            return
        if tag in UNSEEN:
            if tag not in ("script", "style", "title", "noscript", "template"):
                self.run.append(" ")
            self.unseen = tag
            return
        if tag == "head":
            return
        if tag in CLOSES_P:
            self.closed({"p"}, {"td", "th", "table", "button"})
        if tag in CLOSES:
            self.closed(*CLOSES[tag])
        if tag in ("br", "wbr", "img", "input"):
            self.run.append("" if tag == "wbr" else " ")
            return
        if tag in VOID:
            if tag == "hr":
                self.flush()
            return
        if tag == "a" and self.links:
            self.closed({"a"}, set(TAGS))
        inline = tag in INLINE or "-" in tag
        at = self.open[-1][1]
        if not inline:
            self.flush()
            given = dict(attrs)
            names = " ".join(v for k in ("class", "id", "role", "itemprop") if (v := given.get(k)))
            hidden = "hidden" in given or given.get("aria-hidden") == "true" or bool(_HIDDEN.search(given.get("style") or ""))
            truth = given.get("data-truth")
            at = self.node(TAG.get(tag, OTHER), hints(names) if names else 0, hidden, self.truth[at] if truth is None else int(truth))
        self.links += tag == "a"
        self.open.append((tag, at))

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        """A slash at the end of a start tag says nothing in HTML, but for elements of other kinds."""
        self.handle_starttag(tag, attrs)
        if tag in ("svg", "math"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if self.unseen:
            if tag in self.inside:
                while self.inside.pop() != tag:
                    pass
                return
            if tag != self.unseen and not any(t == tag for t, _ in self.open):
                return
            ended, self.unseen, self.inside = self.unseen, None, []
            if tag == ended:
                return
        inline = tag in INLINE or "-" in tag
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k][0] == tag:
                return self.pop(k)
            if inline and self.open[k][0] not in INLINE and "-" not in self.open[k][0]:
                return None
        if tag == "p":
            self.flush()  # it stands for an empty paragraph
        return None

    def handle_data(self, data: str) -> None:
        if self.unseen is None:
            self.run.append(data)
            if self.links:
                self.in_links += len(data.split())
