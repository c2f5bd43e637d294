import itertools
import random

import pytest

from pricelake.llm import html_main as H


@pytest.fixture(scope="module")
def model():
    return H.train(H.labelled())


def test_unseen_layouts_come_out_exactly(model):
    good = n = 0
    for page, labels in H.labelled(300, seed=4242):
        gold = "\n\n".join(H.text_of(b) for b, y in zip(H.blocks_of(page), labels, strict=True) if y)
        n += 1
        good += H.extract(page, model) == gold
    assert good >= 0.95 * n


def test_one_scan_finds_the_best_run():
    r = random.Random(3)
    for _ in range(300):
        s = [r.randint(-5, 5) for _ in range(r.randint(0, 12))]
        best = max([sum(s[a:b]) for a, b in itertools.combinations(range(len(s) + 1), 2)] + [0])
        first, end = H.main_region(s)
        assert sum(s[first:end]) == best


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var x="</p><p>no";</script></head><body>
<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul></nav>
<div class="cookie-notice">We use cookies on this site to do things.</div>
<article><h1>The  title &amp; more</h1><p><b>First&nbsp;paragraph with <a href="x">a link</a> in it,<br>and a break.
<p>Second one, &lt;quoted&gt; &#233;.</p><div class="ad">Buy now, this is an advert.</div><p>Es.</p></article>
<aside class="sidebar"><p>Popular stories are listed here for you.</p></aside>
<section id="comments"><h3>Comments</h3><p>I liked the story a lot, thanks for it.</p></section>
<form><input name=q>Subscribe to us</form><footer>&copy; the site 2024, all rights reserved.</footer></body></html>"""


def test_a_page_with_all_kinds_of_clutter(model):
    assert H.extract(PAGE, model) == ("The title & more\n\nFirst paragraph with a link in it, and a break.\n\n"
                                      "Second one, <quoted> é.\n\nEs.")


def test_edge_cases(spark, model):
    long = "<article>" + "<p>many words stand in this paragraph of the text</p>" * 20_000 + "</article>"
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<script>x"), (4, "u", "<nav><a href='/'>only menu</a></nav>"),
            (5, "u", "<article><p>a < b and 3 > 2 are said here in words"), (None, "u", PAGE), (6, "u", long), (6, "u", long)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string")
    got = H.main_text(df, model=model).collect()
    assert [r.page_id for r in got] == [r[0] for r in rows]
    assert [r.text for r in got[:4]] == [""] * 4
    assert got[4].text == "a < b and 3 > 2 are said here in words"
    assert got[5].text.startswith("The title & more")
    assert got[6].text == got[7].text and got[6].text.count("\n\n") == 19_999
    assert H.main_text(df.limit(0), model=model).count() == 0


def test_test_pages_give_their_article(spark, model):
    import re
    from html import unescape
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    for r in H.main_text(pages, model=model).join(pages.select("page_id", "html"), "page_id").collect():
        body = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        parts = (" ".join(unescape(re.sub(r"</?b>", "", re.sub(r"<br>", " ", x))).split()) for x in re.split(r"</?(?:h1|p)>", body))
        assert r.text == "\n\n".join(p for p in parts if p)


def test_custom_elements_and_self_closed_icons_do_not_end_the_page(model):
    said = "<article><p>Hello, this paragraph of many words is the article of the page.</p></article></body>"
    for early in ('<svg-icon name="m"></svg-icon>', '<svg class="i"/>', '<svg aria-label="a>b" />', "<math/>", "<button-group></button-group>",
                  "<title-bar></title-bar>", "<template-x></template-x>", "<svg class='i'>", "<div><button>Menu</div>",
                  "<svg><path d='M0'/></svg >", "<SVG>x</SVG>", "<button type=button>Menu</button>", '<script src="a/"></script >',
                  "<div><select><option>one</div>", "<noscript>Turn it on</noscript>"):
        assert H.extract("<body>" + early + said, model) == "Hello, this paragraph of many words is the article of the page.", early
    assert [H.text_of(b) for b in H.blocks_of("<p>One <svg/> two <svg><path/></svg> three <script/>four")] == ["One two three"]


def test_many_unclosed_elements_take_linear_time():
    assert len(H.blocks_of("<div><svg><button>x</div><p>said</p>" * 30_000)) == 30_000


def test_pages_of_other_makers(model):
    """Layouts that ``labelled`` does not draw, with neutral names, forms and other languages."""
    long = " ".join(f"word{k}" for k in range(40))
    more = " ".join(f"other{k}" for k in range(60))
    menu = '<ul id="hauptmenu"><li><a href="/a">Start</a></li><li><a href="/b">Neues</a></li></ul>'
    foot = "<footer><p>All rights reserved by the owner of this page.</p></footer>"
    want = "\n\n".join([long, "A short one here.", "Title two", more])
    body = f"<p>{long}</p><p>A short one here.</p><h2>Title two</h2><p>{more}</p>"
    for page in (f'<body>{menu}<div class="wrapper"><div class="col-8">{body}</div></div>{foot}</body>',
                 f'<body><form action="/x" method="post">{menu}<main>{body}</main>{foot}</form></body>',
                 f'<body><nav>{menu}</nav><div class="css-1x2y3z"><div class="css-9q">{body}</div></div>{foot}</body>',
                 f'<body><nav>{menu}</nav><article>{body}</article><div class="kommentare"><h3>Kommentare</h3><p>Das hat mir sehr gut gefallen, danke '
                 f'für den schönen Beitrag.</p></div>{foot}</body>',
                 f"<body><nav>{menu}</nav><table><tr><td><div>{body}</div></td></tr></table>{foot}</body>"):
        assert H.extract(page, model) == want, page


@pytest.mark.parametrize("piece", ["<svg ", "<a ", '<a title="', "<a title='x", "<svg>x</svg ", "<!", "<button ", '<script "', "<![CDATA[", "<!--"])
def test_pages_that_never_close_a_tag_take_linear_time(piece, model):
    import time
    page = "<p>said</p>" + piece * (1_000_000 // len(piece))
    t = time.process_time()
    H.extract(page, model)
    assert time.process_time() - t < 5
