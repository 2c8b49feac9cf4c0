import html as htmllib
import itertools
import re

import numpy as np
import pyarrow as pa
import pytest

from lumenforge.llm import pages as pg
from lumenforge.llm.layouts import Layouts
from lumenforge.llm.markup import LEAF, TAG, Page, hints
from tests.llm.conftest import SMALL


@pytest.fixture(scope="module")
def model(spark):
    return pg.train(spark.read.parquet(f"{SMALL}/pages.parquet"))


def by_template(page: str) -> str:
    """What the given pages' own template holds in its article, by another way than a tree."""
    body = page[page.index("<article>") + 9 :].split("</article>")[0]
    blocks = (" ".join(htmllib.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", body))
    return "\n".join(b for b in blocks if b)


def test_given_pages_are_told_exactly(spark):
    pages = {(r["page_id"], r["url"]): r["html"] for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    got = {(r["page_id"], r["url"]): r for r in pg.op13_page_text(spark, SMALL).collect()}
    assert got.keys() == pages.keys()
    for key, page in pages.items():
        assert got[key]["text"] == by_template(page) and got[key]["n_chars"] == len(got[key]["text"])


A, B, C = "The committee met on Tuesday to look at the plans for the old harbour, which had been put off twice.", "Nobody spoke against them. The work begins in May & takes a year.", "Short end."
PAGES = {
    "article with strays": (f"<body><header><a href=/>Town News</a><p>Since 1901</p></header><nav><ul><li><a href=/a>Home</a><li><a href=/b>Sport</a></ul></nav><div class='cookie-banner'><p>We use cookies to make this site work better for you.</p><button>Accept</button></div><article><h1>Harbour plans</h1><p>{A}</p><div class='ad'>Buy two shoes and get the third one for free today.</div><p>{B}</p></article><aside class='sidebar'><h3>Most read</h3><ul><li><a href=1>One thing that happened</a></li><li><a href=2>Another</a></li></ul></aside><footer><p>© Town News. All rights kept.</p></footer>", ["Harbour plans", A, B]),
    "plain containers": (f"<body><div id=header><div class=logo>Town News</div></div><div class=menu><a href=1>Home</a> <a href=2>Sport</a> <a href=3>Weather</a></div><div class=wrap><div class='post-content'><h1>Harbour plans</h1><p>{A}</p><p>{B}</p><p>{C}</p></div><div class=sidebar><div class=widget><p>Sign up now and never miss a thing again.</p></div></div></div><div class=footer>© 2020 Town News</div>", ["Harbour plans", A, B, C]),
    "comments": (f"<body><main><h1>Harbour plans</h1><p>{A}<p>{B}</main><section id=comments><h3>2 comments</h3><div class=comment><p>anna</p><p>I think that this was long overdue, and I am glad that it is done now.</p></div><div class=comment><p>bert</p><p>Me too.</p></div></section><form class=search><label>Search</label><input name=q><p>Find what you need on this site.</p></form>", ["Harbour plans", A, B]),
    "comments inside": (f"<body><article><p>{A}</p><p>{B}</p><div class=share><a href=1>Share</a> <a href=2>Tweet</a></div><ol class=commentlist><li><p>anna</p><p>I think that this was long overdue.</p></li><li><p>bert</p><p>Me too, and so do all of my neighbours.</p></li></ol></article>", [A, B]),
    "nothing named": (f"<body><div><a href=1>Home</a> <a href=2>Sport</a> <a href=3>Weather</a> <a href=4>Contact</a></div><div><h1>Harbour plans</h1><p>{A}</p><p>{B}</p><p>{A}</p><p>{B}</p></div><footer>© Town News</footer>", ["Harbour plans", A, B, A, B]),
    "scripts and styles": (f"<head><title>x</title><style>p{{}}</style></head><body><script>document.write('<p>no</p>')</script><article><p>{A}</p><script>var a = 1 < 2;</script><style>b{{}}</style><p>{B}</p><noscript>Turn scripts on.</noscript></article>", [A, B]),
    "lists and tables": (f"<body><nav><a href=1>Home</a></nav><article><h2>Steps</h2><p>{A}</p><ul><li>Take the first road on the left.<li>Go on to the bridge.</ul><table><tr><td>May<td>dry</table><blockquote><p>{B}</p></blockquote></article>", ["Steps", A, "Take the first road on the left.", "Go on to the bridge.", "May", "dry", B]),
}


@pytest.mark.parametrize("name", PAGES)
def test_pages_of_other_kinds(model, name):
    page, blocks = PAGES[name]
    assert model.texts([Page("<!DOCTYPE html><html>" + page.replace("& takes", "&amp; takes"))]) == ["\n".join(blocks)]


def test_layouts_that_were_not_trained_on(model):
    pages = [Page(Layouts("some words to fill a page with when nothing else is there".split(), seed).page()) for seed in range(50_000, 50_300)]
    forest = pg.Forest(pages)
    right = (model.marginals(forest)[forest.leaf] > 0.5) == (forest.truth[forest.leaf] == 1)
    assert right.mean() > 0.95


def test_marginals_are_exact():
    """Against the sum over all labellings of small trees."""
    rng = np.random.default_rng(2)
    pages = [Page("<article><p>a<b>b</b><ul><li>c<li>d</ul></article><div>e"), Page(""), Page("<nav>x</nav>")]
    forest = pg.Forest(pages)
    n = len(forest.tag)
    own, pair = rng.standard_normal((n, 2)), rng.standard_normal((4, 2, 2)) * 2
    node, both = pg.sum_product(forest, own, pair)
    for k in range(len(pages)):
        at = np.flatnonzero(forest.page == k)
        total, want, want_both = 0.0, np.zeros((n, 2)), np.zeros((n, 2, 2))
        for labels in itertools.product((0, 1), repeat=len(at)):
            y = dict(zip(at.tolist(), labels, strict=True))
            score = sum(own[i, y[i]] for i in y) + sum(pair[pg.PAIR[forest.tag[i]], y[forest.parent[i]], y[i]] for i in y if not forest.root[i])
            total += np.exp(score)
            for i in y:
                want[i, y[i]] += np.exp(score)
                want_both[i, y.get(forest.parent[i], 0), y[i]] += np.exp(score)
        assert np.allclose(node[at], want[at] / total)
        inner = at[~forest.root[at]]
        assert np.allclose(both[inner], want_both[inner] / total)


def test_trees():
    page = Page("<div class='AdSlot navBar'>a<ul><li>b<li>c <a href=x>d e</a></ul><p>x<table><tr><td>1<td>2</table>y &amp; z<br>w&nbsp;v<!-- no --><svg><p>n</svg>u<hr>t</p>s<button>q<p>r</div>last")
    assert list(page.block.values()) == ["a", "b", "c d e", "x", "1", "2", "y & z w v u", "t", "s", "last"]
    assert sum(page.linked.values()) == 2 and all(u < k for k, u in enumerate(page.parent))
    assert page.hint[1] == hints("ad nav") and page.tag[1] == TAG["div"] and page.tag[2] == LEAF
    assert list(Page("<![if x]>a<![endif]><![CDATA[b]]>c<p/>d</b></p>e&am").block.values()) == ["a c", "d", "e&am"]
    assert list(Page("<p><b>one<br><p>two</b> three").block.values()) == ["one", "two three"]
    deep = Page("<div>" * 3_000 + "x")
    assert pg.Forest([deep]).words[0] == 1 and len(pg.Forest([deep]).levels) == 3_002


def test_odd_pages(spark, folder):
    long = "<article>" + "".join(f"<p>Paragraph {k} of a very long page, which goes on and on.</p>" for k in range(20_000)) + "</article>"
    htmls = [None, "", "   ", "no markup at all", "<", "<p", "&", long, "<article><p>Same text here, on two pages.</p></article>", "<article><p>Same text here, on two pages.</p></article>", "<nav><a href=1>Home</a></nav>", "<article><p>café \U0001f600 &#x1F600; is what it says here.</p></article>"]
    rows = {"page_id": pa.array([None, *range(1, len(htmls))], pa.int64()), "url": pa.array([None] * len(htmls), pa.string()), "html": pa.array(htmls, pa.string())}
    rows |= {c: pa.array([1] * len(htmls)) for c in ("text", "n_chars")}
    got = {r["page_id"]: r for r in pg.op13_page_text(spark, folder(pages=pa.table(rows))).collect()}
    assert len(got) == len(htmls) and [got[k]["text"] for k in (None, 1, 2)] == [""] * 3 and got[None]["n_chars"] == 0
    assert got[7]["text"].count("\n") == 19_999 and got[8]["text"] == got[9]["text"] == "Same text here, on two pages." and got[10]["text"] == ""
    assert got[11]["text"] == "café \U0001f600 \U0001f600 is what it says here." and got[11]["n_chars"] == len(got[11]["text"])
    none = pa.table({"page_id": pa.array([], pa.int64()), "url": pa.array([], pa.string()), "html": pa.array([], pa.string())})
    assert pg.op13_page_text(spark, folder(pages=none)).count() == 0
