import itertools
import random
import time

from pyspark.sql import functions as F

from linkloom.llm import html_content as hc

LONG = "This is a sentence of the article that goes on for a while, as sentences of articles do."
PAGE = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a = "<p>no</p>";</script></head>
<body class="has-sidebar nav-open"><header><h1>Site name</h1></header><nav><ul><li><a href="/">Home</a></li><li><a href="/b">More things to read</a></li></ul></nav>
<div class="cookie-notice"><p>We use cookies to make this site better for you and everybody else. Do you agree?</p></div>
<article><h1>Title &amp; more</h1><p>{LONG}<br>Next&nbsp;line &lt;b&gt;.</p><div class="ad">Buy this now!</div><p>Short.</p><ul><li>One<li>Two</ul>
<p>{LONG}</p><footer>Share this</footer></article>
<aside><p>{LONG}</p></aside><form><label>Name</label><input><button>Send</button></form>
<section id="comments"><article class="comment"><p>{LONG} I think so too.</p></article></section><footer><p>&copy; 2020. {LONG}</p></footer></body></html>"""


def test_a_page():
    assert hc.main_text(PAGE) == "\n\n".join(["Title & more", f"{LONG} Next line <b>.", "Short.", "One", "Two", LONG])


def test_self_closed_icons_hide_nothing():
    article = f"<article><p>{LONG}</p><svg><path d='M0'></path><title/></svg><p>{LONG}</p></article>"
    for icon in ("<svg class='icon'/>", "<svg width=5 />", "<SVG/>", "<math/>", "<svg><svg/><path/><title/><style/></svg>", "<svg><math/></svg>", "<svg></svg>"):
        assert hc.main_text(f"<body><div>{icon}</div>{article}</body>") == f"{LONG}\n\n{LONG}", icon
    assert hc.main_text(f"<body><svg width=5/>hidden</svg>{article}</body>") == f"{LONG}\n\n{LONG}"  # the slash is the value's
    assert hc.main_text(f"<body><article><div/><p>{LONG}</p></article></body>") == LONG


def test_given_pages_give_their_articles(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    found = {r.page_id: r.text for r in hc.extract(rows, carry={"page_id": F.col("page_id")}).collect()}
    import html
    import re

    for r in rows.collect():
        article = re.search(r"<article>(.*?)(</article>|<footer>|$)", r.html, re.S)[1]
        parts = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>|<br>", " ", article))
        assert found[r.page_id] == "\n\n".join(t for t in (re.sub(r"\s+", " ", html.unescape(p)).strip() for p in parts) if t)


def test_the_cut_is_the_cheapest_labelling(monkeypatch):
    draw = random.Random(7)
    for _ in range(60):
        made = [hc.Block("x", "p", draw.randint(0, 2), draw.randint(1, 3)) for _ in range(draw.randint(1, 9))]
        odds = {id(b): draw.uniform(-3, 3) for b in made}
        monkeypatch.setattr(hc, "content_odds", lambda b: odds[id(b)])

        def price(kept):
            total, last = 0.0, {}
            for k, b in enumerate(made):
                total += max(0, odds[id(b)]) if not kept[k] else max(0, -odds[id(b)])
                if k and kept[k] != kept[k - 1]:
                    total += 1 / (1 + abs(b.depth - made[k - 1].depth))
                if b.container in last and kept[last[b.container]] != kept[k]:
                    total += 1
                last[b.container] = k
            return total

        best = min(price(kept) for kept in itertools.product([True, False], repeat=len(made)))
        assert abs(price(hc.content(made)) - best) < 1e-6


def test_large_pages_take_linear_time():
    draw = random.Random(1)
    took = []
    for n in (4000, 8000):
        page = "<body>" + "".join(f"<div{draw.choice(['', ' class=ad'])}><p>{'word ' * draw.randint(1, 30)}</p>{draw.choice(['', '</div>'])}" for _ in range(n))
        started = time.time()
        hc.main_text(page)
        took.append(time.time() - started)
    for bad in ("<a " * 30000, "<head>" * 30000, "<!" * 30000, "<p" * 30000, "&" * 100000, "<script>" * 30000, "<ul><li>" * 3000):
        started = time.time()
        hc.main_text(bad)
        took.append(time.time() - started)
    assert max(took) < 10, took


def test_odd_rows(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "plain words without markup, but quite a few of them so that they count."), (3, "u", "<p>"), (None, "v", PAGE),
            (5, "w", "<nav>only</nav>"), (6, "x", "<article><p>left open")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("x")).withColumn("n_chars", F.lit(1))
    found = sorted(((r.page_id or 0, r.text, r.n_chars) for r in hc.extract(pages, carry={"page_id": F.col("page_id")}).collect()))
    assert [(i, n) for i, _, n in found] == [(0, len(hc.main_text(PAGE))), (1, 0), (2, 0), (3, 0), (3, len(rows[2][2])), (5, 0), (6, 9)]
    assert hc.extract(pages.limit(0)).count() == 0


def test_names_of_the_layout_lose_no_article():
    body = f"<h1>Title</h1><p>{LONG}</p><p>{LONG}</p>"
    text = f"Title\n\n{LONG}\n\n{LONG}"
    comments = f'<section id="comments"><article class="comment"><p>{LONG} {LONG} {LONG}</p></article></section>'
    for page in (
        f'<div class="layout sidebar-right"><article>{body}</article></div>', f'<article class="post comments-open">{body}</article>{comments}',
        f'<main class="menu-open">{body}</main>', f'<article id="post-alert-on-banner-law">{body}</article>',
        f'<div class="layout sidebar-right"><div class="content">{body}</div></div>', f'<div id="page" class="nav-fixed"><div>{body}</div></div>',
    ):
        whole = f'<body><nav><a href="/">Home</a></nav>{page}<div class="site-footer"><p>All of it belongs to somebody.</p></div></body>'
        assert hc.main_text(whole) == text, page
    inside = f'<body><article>{body}</article><div class="cookie-notice"><p>{LONG}</p></div><div class="sidebar"><article><p>{LONG}</p></article></div></body>'
    assert hc.main_text(inside) == text


def test_formulas_objects_and_authors_stay():
    page = f"<body><article><p>The sum is <math><mi>x</mi><mo>+</mo><mn>1</mn><annotation>x+1</annotation></math> here. {LONG}</p><address>By A. Writer</address><p><object data=f>See the figure.</object> {LONG}</p></article><address>Office</address></body>"
    assert hc.main_text(page) == f"The sum is x+1 here. {LONG}\n\nBy A. Writer\n\nSee the figure. {LONG}"


def test_the_cut_changes_labels_against_their_own_price():
    block = lambda text, linked=0: hc.Block(text, "p", 1, 2, linked=linked)
    odd = block("Read on here", 12)
    assert hc.content_odds(odd) < 0
    assert hc.content([block(LONG), odd, block(LONG)]) == [True, True, True]  # its neighbours keep it
    assert hc.content([odd]) == [False]
