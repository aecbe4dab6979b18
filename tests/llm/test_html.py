import html as entities
import random
import re
import time

import duckdb
import pytest
from pyspark.sql import functions as F
from rows import SF

from ratewell.llm.html_text import extract_text, main_text, region_of

PAGE = """<!doctype html><html><head><title>T</title><style>p{}</style></head><body>
<header class="site"><h1>Site name</h1><nav><a href=/>Home</a></nav></header>
<div class="cookie-notice">We use cookies on this website to make everything better for everybody who reads.</div>
<div id="wrap"><main><article><header><h1>Title &amp; more</h1></header>
<p>First  para with <a href=x>link</a> text that is quite
long and has words.</p><ul><li>one<li>two items</ul><script>var x="<p>no</p>";</script>
<p>Second para, also long enough to count as text.<div class="ad">Buy now the best</div><p>Be.</p>
<form><label>Mail me</label><input></form><section><h2>Part</h2><p>Inside a section<br>of it.</p></section></article>
<section class="comments"><h2>Comments</h2><p>A long reader comment that is longer than the article perhaps but must stay out.</p></section>
</main><aside>Related stuff to read</aside></div><footer>&copy; me</footer></body></html>"""


def test_a_page():
    assert main_text(PAGE).split("\n\n") == [
        "Title & more", "First para with link text that is quite long and has words.", "one", "two items",
        "Second para, also long enough to count as text.", "Be.", "Part", "Inside a section of it.",
    ]


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("plain text", "plain text"), ("<p>a<p>b", "a\n\nb"), ("<nav>only a menu</nav>", ""), ("<p>&lt;b&gt; &eacute;&#x41;", "<b> éA"),
    ("<p>unclosed <b>bold", "unclosed bold"), ("</div></p>odd ends", "odd ends"), ("<!-- c --><p>x<!-- y -->z", "xz"), ("<<<>>> <p", "<<<>>>"),
    ("<div class=menu>Home</div><div class=content><p>Long paragraph of text here.</p><p>Short.</p></div>", "Long paragraph of text here.\n\nShort."),
    ("<p>a&nbsp; b", "a b"), ("<div>" * 3000 + "deep" + "</div>" * 3000, "deep"),
])
def test_odd_pages(page, text):
    found = main_text(page)
    assert found == text or page == "<<<>>> <p" and found.startswith("<<<>>>")


LONG, SHORT = "long text " * 100, "short text " * 20


@pytest.mark.parametrize("page, texts", [
    (f"<body><div><p>{SHORT}</p><div><p>{LONG}</p></div></div></body>", [SHORT, LONG]),
    (f"<body><main><h1>Title</h1><section><p>{LONG}</p></section><section><p>Brief.</p></section></main></body>", ["Title", LONG, "Brief."]),
    (f"<body><p>{SHORT}</p><table><tr><td>{LONG}</td><td>{LONG}</td></tr></table><p>{SHORT}</p></body>", [SHORT, LONG, LONG, SHORT]),
    (f"<main><article><p>{LONG}</p></article><section><a href=x>More</a></section></main>", [LONG]),
    (f"<body><div class=menu>{LONG}</div><div><p>{LONG}</p></div><div><p>{SHORT}</p></div></body>", [LONG, SHORT]),
])
def test_pages_without_one_article_keep_all_clusters(page, texts):
    assert main_text(page).split("\n\n") == [x.strip() for x in texts]


@pytest.mark.parametrize("page, text", [
    ("<html><head><title>T</title><body><article><p>Text of it.</article>", "Text of it."), ("<head><title>T</title><p>a<p>b", "a\n\nb"),
    ("<html><head><meta charset=utf-8><link href=x><script>var x;</script><style>p{}</style><div>in body</div>", "in body"),
    ("<head><title>T</title> \n bare words", "bare words"), ("<head><noscript><body><p>a", "a"), ("<head><title>T</title><img src=x>a<br>b", "a b"),
    ("<head><noscript><p>off</p></noscript></head><body><p>on", "on"), ("<head><template><div>off</div></template></head><p>on", "on"),
    ("<table><tr><td>a<td>b<tr><td>c</table>", "a\n\nb\n\nc"), ("<dl><dt>a<dd>b<dt>c<dd>d</dl><ul><li>e<li>f</ul>", "a\n\nb\n\nc\n\nd\n\ne\n\nf"),
])
def test_omitted_end_tags(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize("page, texts", [
    (f"<main><header><h1>Title</h1></header><p>{LONG}</p></main>", ["Title", LONG]),
    (f'<article><p>{LONG}</p><section class="related-work"><p>{SHORT}</p></section><section id="share-prices">{SHORT}</section></article>', [LONG, SHORT, SHORT]),
    (f'<article><p>{LONG}</p><div class="related-posts">See <a href=x>one more post</a> <a href=y>and another</a></div></article>', [LONG]),
    (f'<article><p>{LONG}</p><div class="share">{SHORT}<div class="social"><a href=x>{SHORT * 2}</a></div></div></article>', [LONG]),
    (f'<article><p>{LONG}</p><div class="ad-slot-2">Buy this</div><div class="x reader-comments">{SHORT}</div><p class="notice">Note</p></article>', [LONG]),
    (f'<article><p>{LONG}</p><p class="comments-on-method">{SHORT}</p></article>', [LONG, SHORT]),
    (f'<div class="related-work">{LONG}</div><div>{SHORT}</div>', [SHORT]),
])
def test_names_inside_an_article(page, texts):
    assert main_text(page).split("\n\n") == [x.strip() for x in texts]


def test_region_is_that_of_a_plain_search():
    rng = random.Random(2)
    for _ in range(500):
        n = rng.randint(1, 30)
        parents = [-1] + [rng.randrange(k) for k in range(1, n)]
        above = lambda k: [k, *(above(parents[k]) if k else [])]
        depth = [len(above(k)) for k in range(n)]
        within = [False] + [rng.random() < 0.3 for _ in range(1, n)]
        seeds = [rng.randrange(n) for _ in range(rng.randint(1, 4))]
        common = [k for k in range(n) if all(k in above(s) for s in seeds) and not within[k]]
        assert region_of(seeds, parents, depth, within) == max(common, key=lambda k: depth[k])


@pytest.mark.parametrize("page", [
    "<div>" * 16_000 + "deep" + "</div>" * 16_000, "<div>" * 16_000 + "deep" + "</section>" * 16_000, "<article>" * 8_000 + "<p>deep" * 8_000,
])
def test_many_nested_tags_take_little_time(page):
    began = time.process_time()
    assert main_text(page).startswith("deep") and time.process_time() - began < 1


def article(page):
    body = re.sub("<br>", " ", re.search("<article>(.*?)</article>", page, re.S)[1])
    blocks = [" ".join(entities.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:p|h1)>", body)]
    return "\n\n".join(b for b in blocks if b)


def test_all_pages_of_the_smallest_table(spark):
    found = {r.page_id: r for r in extract_text(spark.read.parquet(f"{SF}/pages.parquet")).collect()}
    for page, html in duckdb.sql(f"SELECT page_id, html FROM '{SF}/pages.parquet'").fetchall():
        assert found[page].text == article(html) and found[page].n_chars == len(found[page].text)


def test_awkward_rows(spark):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (None, "v", ""), (3, "w", "<p>" + "long " * 400_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash")).withColumn("n_chars", F.lit(1))
    found = extract_text(df).collect()
    assert sorted((str(r.page_id), str(r.url), r.n_chars) for r in found) == sorted(
        (str(i), str(u), len(main_text(h))) for i, u, h in rows
    )
    assert extract_text(df.limit(0)).collect() == []
