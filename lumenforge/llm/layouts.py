"""Labelled pages to train on: page layouts of many kinds, filled with words of the given pages.

Every element says in `data-truth` whether it is content (1) or not (0); elements without it are as the one around them.
"""

from __future__ import annotations

import random

CONTENT = (
    ("article", ""), ("article", 'class="post"'), ("main", ""), ("div", 'class="content"'), ("div", 'id="main-content"'), ("div", 'class="entry-content"'), ("div", 'class="post-body"'),
    ("section", 'class="story"'), ("div", 'role="main"'), ("div", 'class="article-text"'), ("div", ""), ("div", 'class="{x}"'), ("section", ""), ("td", ""), ("div", 'class="{x} text"'),
)
MENUS = (("nav", ""), ("div", 'class="menu"'), ("ul", 'id="navigation"'), ("div", 'class="breadcrumbs"'), ("nav", 'class="{x}"'), ("div", 'id="navbar"'), ("div", 'class="pagination"'))
HEADERS = (("header", ""), ("div", 'id="header"'), ("div", 'class="masthead"'), ("div", 'class="site-header"'), ("header", 'class="{x}"'))
FOOTERS = (("footer", ""), ("div", 'class="footer"'), ("div", 'id="site-footer"'), ("footer", 'class="{x}"'), ("div", 'class="copyright"'))
SIDES = (("aside", ""), ("div", 'class="sidebar"'), ("div", 'id="sidebar"'), ("aside", 'class="{x}"'), ("div", 'class="related"'), ("div", 'class="widget"'), ("section", 'class="recommended"'))
ADVERTS = (("div", 'class="ad"'), ("div", 'class="ads"'), ("div", 'class="advert"'), ("div", 'id="ad-top"'), ("div", 'class="sponsored"'), ("section", 'class="promo"'), ("aside", 'class="ad"'), ("div", 'class="ad {x}"'), ("p", 'class="ad"'))
NOTICES = (("div", 'class="cookie-notice"'), ("div", 'id="consent"'), ("div", 'class="notice"'), ("div", 'class="alert"'), ("section", 'class="newsletter"'), ("div", 'class="cookie-banner"'), ("div", 'role="alert"'), ("p", 'class="notice"'), ("dialog", ""))
FORMS = (("form", ""), ("form", 'class="search"'), ("div", 'class="login"'), ("form", 'id="contact"'), ("form", 'class="{x}"'))
COMMENTS = (("section", 'id="comments"'), ("div", 'class="comments"'), ("ol", 'class="commentlist"'), ("div", 'id="disqus_thread"'), ("section", 'class="comments-area"'), ("div", 'class="responses"'), ("ul", 'class="comments"'))
SHARES = (("div", 'class="share"'), ("ul", 'class="social"'), ("div", 'class="tags"'))


class Layouts:
    """Random labelled pages from a stock of words; equal seeds make equal pages."""

    def __init__(self, words: list[str], seed: int):
        self.words, self.pick = words or ["word"], random.Random(seed)

    def said(self, low: int, high: int) -> str:
        """`low` to `high` words, more often few."""
        n = int(low * (high / low) ** self.pick.random())
        return " ".join(self.pick.choice(self.words) for _ in range(n))

    def element(self, kinds, inner: str, truth: int | None = None) -> str:
        tag, names = self.pick.choice(kinds)
        names = names.replace("{x}", "".join(self.pick.choice("abcdefghklmnprstvwxz") for _ in range(3)) + str(self.pick.randrange(99)))
        mark = "" if truth is None else f' data-truth="{truth}"'
        if tag in ("ul", "ol") and "<li" not in inner:
            inner = f"<li>{inner}</li>"
        if tag == "td":
            return f'<table data-truth="0"><tr data-truth="0"><td {names}{mark}>{inner}</td></tr></table>'
        if tag == "p":
            inner = self.said(2, 20) + "."
        return f"<{tag} {names}{mark}>{inner}</{tag}>"

    def links(self, low: int, high: int) -> str:
        wrap = self.pick.choice(("<li>{}</li>", "{} ", "<p>{}</p>", "<div>{}</div>", "<li>{}", "{} | "))
        each = [wrap.format(f'<a href="/{k}">{self.said(1, 5)}</a>') for k in range(self.pick.randint(low, high))]
        return f"<ul>{''.join(each)}</ul>" if wrap.startswith("<li") else "".join(each)

    def paragraph(self) -> str:
        text = self.said(1, 150) + self.pick.choice((".", ".", ".", "!", "?", ""))
        if self.pick.random() < 0.15:
            text = text.replace(" ", f' <a href="#">{self.said(1, 3)}</a> ', 1)
        kind = self.pick.random()
        if kind < 0.7:
            return f"<p>{text}</p>"
        if kind < 0.78:
            return f"<p><b>{text}<br>"
        if kind < 0.84:
            return f"<div>{text}</div>"
        if kind < 0.88:
            return f"<h2>{self.said(1, 8)}</h2>"
        if kind < 0.92:
            return "<ul>" + "".join(f"<li>{self.said(1, 20)}</li>" for _ in range(self.pick.randint(2, 6))) + "</ul>"
        if kind < 0.95:
            return f"<blockquote><p>{text}</p></blockquote>"
        if kind < 0.97:
            return "<table>" + "".join(f"<tr><td>{self.said(1, 4)}</td><td>{self.said(1, 4)}</td></tr>" for _ in range(3)) + "</table>"
        return f"<p>{text}"

    def comments(self) -> str:
        one = self.pick.choice(("<div class='comment'><p>{}</p><p>{}</p></div>", "<li><p>{}</p><p>{}</p></li>", "<div><h4>{}</h4><p>{}</p></div>", "<p>{}: {}</p>", "<li><cite>{}</cite> {}</li>"))
        return f"<h3>{self.said(1, 3)}</h3>" * self.pick.randint(0, 1) + "".join(one.format(self.said(1, 3), self.said(2, 80) + ".") for _ in range(self.pick.randint(1, 8)))

    def stray(self, inside: bool) -> str:
        """Something that is no content: such as stands among paragraphs too, if `inside`."""
        text, line = self.said(2, 40) + ".", self.said(2, 25)
        made = [
            lambda: self.element(ADVERTS, self.pick.choice((text, line, f"<p>{text}</p>", f'<a href="#">{line}</a>')), 0),
            lambda: self.element(NOTICES, self.pick.choice((text, f"<p>{text}</p><button>{self.said(1, 2)}</button>", f"<p>{text} <a href='#'>{self.said(1, 3)}</a></p>")), 0),
            lambda: self.element(FORMS, self.pick.choice((f"<label>{self.said(1, 4)}</label><input><p>{line}</p>", f"<p>{text}</p><input><button>{self.said(1, 2)}</button>", f"{self.said(1, 3)} <input type=text>")), 0),
            lambda: self.element(SHARES, self.links(2, 6), 0),
            lambda: self.element(SIDES, f"<h3>{self.said(1, 4)}</h3>{self.pick.choice((self.links(2, 8), f'<p>{text}</p>', self.links(1, 3) + f'<p>{text}</p>'))}", 0),
            lambda: self.element(COMMENTS, self.comments(), 0),
            lambda: self.element(MENUS, self.links(2, 12), 0),
        ]
        return self.pick.choice(made[:6] if inside else made)()

    def page(self) -> str:
        pick = self.pick
        body = [f"<h1>{self.said(1, 14)}</h1>"] * pick.choice((0, 1, 1)) + [self.paragraph() for _ in range(pick.choice((1, 2, 3, 5, 8, 13)))]
        if pick.random() < 0.1:
            body = [f"{self.said(10, 100)}.<br><br>{self.said(10, 100)}."]
        if pick.random() < 0.5:
            for _ in range(pick.randint(1, 2)):
                body.insert(pick.randint(1, len(body)), self.stray(True))
        inner = "".join(body)
        if pick.random() < 0.2:
            inner = f"<div>{inner}</div>"
        main = self.element(CONTENT, inner, 1)
        for _ in range(pick.choice((0, 0, 1, 2))):
            main = f'<div {pick.choice(("", "class=wrap", "id=page", "class=row", "id=container", "class=layout"))} data-truth="0">{self.stray(False) * pick.randint(0, 1)}{main}{self.stray(False) * pick.randint(0, 1)}</div>'
        head = self.element(HEADERS, self.pick.choice((f"<h1>{self.said(1, 5)}</h1>", f"<div>{self.said(1, 6)}</div>", f'<a href="/">{self.said(1, 3)}</a>')) + pick.choice(("", f"<p>{self.said(2, 12)}</p>", self.links(2, 6))), 0)
        foot = self.element(FOOTERS, pick.choice((f"&copy; {self.said(1, 12)}.", f"<p>{self.said(2, 20)}.</p>", self.links(2, 8) + f"<p>&copy; {self.said(1, 8)}</p>")), 0)
        parts = [head] * pick.randint(0, 1) + [self.element(MENUS, self.links(3, 12), 0)] * pick.choice((0, 1, 1)) + [self.stray(False) for _ in range(pick.choice((0, 0, 1, 2)))] + [main]
        parts += [self.stray(False) for _ in range(pick.choice((0, 0, 1, 2)))] + [foot] * pick.choice((0, 1, 1))
        return f'<html data-truth="0"><body data-truth="0">{"".join(parts)}</body></html>'
