"""Main text of hand-made pages."""

import html
import random
import re
import time

import pyarrow.parquet as pq

from waymark.llm.line_blocks import SURGE, WINDOW, extract_text, main_text, spans

ARTICLE = """<!DOCTYPE html><html><head><title>T</title><style>p{a:"</p>"}</style><script>var t="</p><p>no";</script></head><body class="menu search">
<header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav><!-- <p>hidden</p> --><div class="ad">Buy</div>
<article class="post"><header><h1>Title&nbsp;one</h1></header><p><b>First &amp; second.<br><p>Be.<p class='x>y'>A <i>b</i>c  d\n e</p>
<aside>Side</aside><div class="related-posts">More</div><ul><li>item 1<li>item <a href=x>two</a></ul><table><tr><td>1<td>2</table><form><p>Name <input></form>
<p>Caf&eacute; &#233; &lt;tag&gt; 1 < 2</p><section id="comments"><article><p>Reader says</p></article></section></article>
<div class="cookie-notice">We use cookies</div><footer>&copy; me</footer>"""


def test_marked_article():
    assert main_text(ARTICLE) == "Title one First & second. Be. A bc d e item 1 item two 1 2 Café é <tag> 1 < 2"


def test_pages_without_article():
    long = "Enough words to make a surge in the sums of the lines, as an article's paragraph does. " * 3
    page = f"<body><div class=nav><a>x</a></div><div><a href=1>link</a><a href=2>link</a></div><hr><h2>Head</h2><p>{long}</p><p>Short.</p><p>{long}</p><div class='footer'>foot</div></body>"
    assert main_text(page) == f"Head {long.strip()} Short. {long.strip()}"
    assert main_text("<p>tiny</p>") == "tiny"
    assert main_text("no markup at all") == "no markup at all"
    assert main_text('<div class="widget"><p>all in a widget</p></div>') == "all in a widget"


def test_odd_input():
    for page in (None, "", "<", "<p", "<!--", "<script>x", "</p></div>", "<a href='", "&am", "<article></article>"):
        assert isinstance(main_text(page), str)
    start = time.time()
    for page in ('<a ">" ' * 150_000, '<a b=">" ' * 120_000, "<a b='" * 150_000, "<p>" + '<a ">" ' * 150_000, "<!" * 500_000, "</" * 500_000, "<a b=" + " =" * 400_000, "<div>" * 50_000, "<p>" * 50_000 + "x", "<a href='" * 5_000, "<b>x" * 30_000 + "</p>" * 30_000, "<" * 50_000, "<!--" * 20_000):
        main_text(page)
    assert time.time() - start < 20


def test_rows(spark):
    rows = [(1, "u", ARTICLE, "x"), (1, "u", ARTICLE, "x"), (None, None, None, None), (2, "", "", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = extract_text(spark, df).collect()
    assert len(got) == 4 and all(r.n_chars == len(r.text) for r in got) and sum(r.text == "" for r in got) == 2
    assert extract_text(spark, df.limit(0)).count() == 0


def test_windows_by_brute_force():
    rng = random.Random(3)
    for _ in range(400):
        sizes = [rng.choice([0, 0, 0, 5, 20, 40, 90]) for _ in range(rng.randrange(0, 40))]
        sums = [sum(sizes[i : i + WINDOW]) for i in range(len(sizes))]
        least = max(1, min(SURGE, max(sums, default=0)))
        kept, open_ = set(), False
        for i, total in enumerate(sums):
            open_ = total > 0 and (open_ or total >= least)
            if open_:
                kept |= {k for k in range(i, min(len(sizes), i + WINDOW)) if sizes[k]}
        got = {k for a, b in spans(sizes, [False] * len(sizes)) for k in range(a, b) if sizes[k]}
        assert got == kept


def test_windows_decide_inside_and_outside_of_articles():
    prose = "Words of a paragraph that is long enough to make a surge of its own, with no links in it at all. "
    scrap = f"<article><p>{prose}</p><nav>menu</nav><p>Hm</p><nav>menu</nav><p>{prose}</p></article>"
    assert main_text(scrap) == f"{prose.strip()} {prose.strip()}"  # a scrap between menus makes no surge
    assert main_text(f"<article><h1>A</h1><p>B.</p><p>Go</p><p>{prose}</p></article>") == f"A B. Go {prose.strip()}"
    part = "<article><p>{0}</p><div class='social'>{1}</div><p>{0}</p></article>"
    assert main_text(part.format(prose, prose.upper())) == " ".join([prose.strip(), prose.upper().strip(), prose.strip()])
    assert main_text(part.format(prose, "<a href=1>Follow us</a> <a href=2>Like us</a>")) == f"{prose.strip()} {prose.strip()}"
    assert main_text(f"<article><p class='social search'>{prose}</p><fieldset>{prose}</fieldset><math>x</math></article>") == f"{prose.strip()} {prose.strip()} x"


def test_supplied_pages_with_and_without_marks():
    """Windows alone, on the pages with their article element renamed, find nearly all of what the marked pages hold, and no menu."""
    pages = pq.read_table("/root/testdata/sf0.01/pages.parquet").column("html").to_pylist()
    exact = 0
    for page in pages:
        marked, plain = main_text(page), main_text(re.sub(r"<(/?)article", r"<\1div", page))
        body = re.search("<article>(.*?)</article>", page, re.S)[1]
        assert sum(map(len, html.unescape(re.sub("<[^>]*>", "", body)).split())) * 0.9 < sum(map(len, marked.split()))
        exact += plain == marked
        assert not set(re.findall("<li><a[^>]*>(.*?)</a>", page)[:1]) & {plain.split(" ")[0]} or plain[:20] == marked[:20]
    assert exact > 0.9 * len(pages)
