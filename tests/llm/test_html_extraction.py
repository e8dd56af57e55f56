"""Main text of pages: the given pages against their marked article, and hand-written pages of other makes."""

from __future__ import annotations

import html
import re

import pytest

from vulnatlas.llm.html_extraction import main_text, main_texts

LONG = "This is a sentence of the article, with a comma, long enough to be told from a menu entry. "
OTHER = "Another paragraph follows here, which says more, and still more, about the subject at hand. "


def marked(source):
    """The blocks of the page's only article: what stands between paragraph and heading tags."""
    article = re.search("<article>(.*?)</article>", source, re.S)[1]
    blocks = (" ".join(html.unescape(re.sub("<br>", " ", b).replace("<b>", "").replace("</b>", "")).split()) for b in re.split("</?(?:p|h1)>", article))
    return "\n".join(filter(None, blocks))


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_given_pages(spark, size):
    pages = spark.read.parquet(f"/root/testdata/{size}/pages.parquet")
    got = {r.page_id: (r.url, r.text, r.n_chars) for r in main_texts(pages).collect()}
    want = {r.page_id: (r.url, marked(r.html), len(marked(r.html))) for r in pages.collect()}
    assert got == want


PAGES = {
    # Containers without semantic tags, told by points and by names.
    f"""<html><body class="has-sidebar"><div id="top-bar"><a href=/>Home</a> <a href=/b>News</a></div>
        <div id="wrap"><div class="col1"><h1>The &amp; Title</h1><div class="text"><p>{LONG}<p>{OTHER * 3}</div></div>
        <div class="sidebar"><p>{LONG}</p></div></div><div id="footer">(c) 2020, all rights, all of them</div></body></html>""":
        f"The & Title\n{LONG.strip()}\n{(OTHER * 3).strip()}",
    # Notices, adverts, forms, share buttons and reader comments inside the article.
    f"""<main><article class="post"><header><h1>Title</h1><p class="byline">By me, today</p></header><p>{LONG * 2}</p>
        <div class="ad-box">Buy this, now, and that, too, because it is cheap</div><aside>{OTHER}</aside><p>{OTHER * 2}</p>
        <form><p>Your name, please</p><input name=x><button>Go</button></form><ul class="share-links"><li><a href=#>Tweet</a></ul>
        <section id="comments"><h2>3 comments</h2><article><p>{LONG * 9}</p></article></section><footer>Filed under x</footer></article></main>""":
        f"Title\n{(LONG * 2).strip()}\n{(OTHER * 2).strip()}",
    # Ends left out, references without semicolon, comments, scripts that hold tags, a list and a table.
    f"""<!doctype html><title>No</title><script>if (a < b) document.write("</p><p>no")</script><style>p {{}}</style>
        <article><h2>Caf&eacute &#8211; &#x41;<p>{LONG}<!-- no <p>no</p> --> 1 < 2<br>next&nbsp;line<ul><li>one, two<li>three <b>bo</b>ld</ul>
        <table><tr><td>cell<td>other<tr><th>third</table><pre>a
          b</pre>""": f"Café – A\n{LONG}1 < 2 next line\none, two\nthree bold\ncell\nother\nthird\na b",
    # A menu of links without a telling name, and a paragraph that is one link.
    f"""<body><ul><li><a href=1>One thing, here</a><li><a href=2>Two things, there</a></ul><div><p>{LONG * 2}</p>
        <ul><li><a href=3>See this</a><li><a href=4>See that</a></ul><p><a href=5>A closing link.</a></p></div>""":
        f"{(LONG * 2).strip()}\nA closing link.",
    # Hidden text, a page that is one form, and a cookie notice longer than the text.
    f"""<form action=x><div class="cookie-notice"><p>{LONG * 9}</p></div><h1>Shop</h1><div><p>{OTHER}</p><p style="display:none">no</p>
        <p hidden>no</p><select><option>no</select></div></form>""": f"Shop\n{OTHER.strip()}",
    # Only a word, only text, only a menu, nothing.
    "<article><h1>Hi</h1><p>there</p></article>": "Hi\nthere",
    "no tags, but a sentence &lt;here&gt;": "no tags, but a sentence <here>",
    f"<div class='comment'><p>{LONG}</p></div>": LONG.strip(),
    "<script>alert('a')</script><nav>menu</nav>": "", "": "", " \n": "", "<": "<", "<p": "", "<!--": "",
    f"<p>{LONG}</p><p>{OTHER}</p><p>Short.</p>": f"{LONG.strip()}\n{OTHER.strip()}\nShort.",
    f"<p title='a > b' class=x data-y=it's>{LONG}</p></div></p></br>{OTHER}": f"{LONG.strip()}\n{OTHER.strip()}",
}


@pytest.mark.parametrize("source", PAGES, ids=range(len(PAGES)))
def test_other_pages(source):
    assert main_text(source) == PAGES[source]


def test_deep_and_long_pages():
    deep = "<div>" * 30_000 + f"<p>{LONG}</p>" + "</div>" * 30_000
    assert main_text(deep) == LONG.strip()
    assert main_text("<b>" * 30_000 + LONG) == LONG.strip()
    many = "".join(f"<p>{k} {LONG}" for k in range(20_000))
    assert main_text(f"<div>{many}</div>").count("\n") == 19_999


def test_awkward_rows(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "v", f"<p>{LONG}</p>"), (3, "v", f"<p>{LONG}</p>"), (None, None, f"<p>{LONG}</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS text", "2 AS n_chars")
    got = sorted(map(tuple, main_texts(pages).collect()), key=repr)
    text = LONG.strip()
    assert got == sorted([(1, "u", "", 0), (2, None, "", 0), *[(3, "v", text, len(text))] * 2, (None, None, text, len(text))], key=repr)
    assert main_texts(pages.limit(0)).collect() == []
