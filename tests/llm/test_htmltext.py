from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from dimstar.llm import htmltext
from dimstar.llm.htmltext import common_lines, extract, lines, main_text


def lcs(a, b):
    """Length of the longest common subsequence, by the table of all prefixes."""
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("abcd"), max_size=14), st.lists(st.sampled_from("abcd"), max_size=14))
def test_common_lines_are_a_longest_common_subsequence(a, b):
    for most in (1 << 27, 3):
        kept = [a[i] for i in htmltext._align(a, b, most)]
        assert len(kept) == lcs(a, b)
        rest = iter(b)
        assert all(x in rest for x in kept)
    kept = [a[i] for i in sorted(common_lines(a, b))]
    assert len(kept) == lcs(a, b)
    rest = iter(b)
    assert all(x in rest for x in kept)


def test_long_lists_of_equal_lines():
    assert len(common_lines(["x"] * 3000 + ["y"], ["z"] + ["x"] * 2000)) == 2000


ARTICLE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{a:"</p>"}</style><script>var t="</p><article>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav><!-- <article> --><div class="ad">Buy</div>
<article><h1>A  title</h1><p><b>One &lt;two&gt; &eacute;<br>three<p>Four</p><div class="share-bar">Tweet</div>
<section id="comments"><p>First!</p><article>nested</article></section><form><p>Name</p><input value=">"></form><p>Last&amp</article>
<aside>More</aside><div id=cookie-notice><p>Cookies</p></div><footer>&copy; x</footer></body></html>"""


def test_an_article():
    text, shared = main_text(lines(ARTICLE), None)
    assert text == "A title\n\nOne <two> é three\n\nFour\n\nLast&" and shared == 0


@pytest.mark.parametrize("html, text", [
    (None, ""), ("", ""), ("<", "<"), ("plain  text", "plain text"), ("<p>a<p>b", "a\n\nb"), ("a &lt;b> c", "a <b> c"),
    ("<article><p>x<p>cut <b", "x\n\ncut"), ("<nav>menu<article>body</article>", "body"), ("<script>a<b", ""), ("<p>a</p><!-- never closed <p>b", "a"),
    ("<article></article><p>only</p>", "only"), ("<main>m</main><p>other</p>", "m"), ("<p title='a>b\"'>c</p>", "c"), ("<p title='a>never closed</p>", "never closed"), ("1 < 2 > 0", "1 < 2 > 0"),
    ("<head><title>x</title><body><p>y", "y"), ("<div class=\"sidebar\">s</div>rest", "rest"), ("<article class=comment>c</article>d", "d"),
])
def test_odd_pages(html, text):
    assert main_text(lines(html), None)[0] == text


@pytest.mark.parametrize("html, text", [
    ("<html class='no-js sidebar'><body class='has-sidebar single'><nav>n</nav><article>a</article>", "a"),
    ("<body class=sidebar><p>a", "a"),
    ("<div class='page-with-nav'><p>a</p><nav>n</nav></div>", "a"),
    ("<div class='nav-open'><p>x</p><article><header>a</header><p>b</p><div class=share>s</div></article></div>", "a\n\nb"),
    ("<p>Skip</p><div id='sidebar-left'><main>a</main></div>", "a"),
    ("<article class='post has-comments'>a</article><p>x</p>", "a"),
    ("<article class='post tag-social'>a</article>", "a"),
    ("<div class=sidebar><article>a</article></div>", "a"),
    ("<p>text</p><div class=comments><article>c</article></div>", "text"),
    ("<article>a</article><div class='related-posts'><article>r</article></div>", "a"),
])
def test_marks_do_not_swallow_the_article(html, text):
    assert main_text(lines(html), None)[0] == text


@pytest.mark.parametrize("html, text", [
    ("<article><p>One <span class='ad-label'>Ad</span> two</p></article>", "One two"),
    ("<article><p>Real text <button>b</p><p>next</p></article>", "Real text\n\nnext"),
    ("<article><p>A <label>l</label><b>b</b></p><button>go</button></article>", "A b"),
    ("<p>x <span class=share>s</span>y</p>", "x y"),
])
def test_furniture_inside_a_line(html, text):
    assert main_text(lines(html), None)[0] == text


def test_many_unclosed_elements_take_linear_time():
    for name in ("svg", "iframe", "head", "title"):
        assert main_text(lines(f"<p>a</p>{f'<{name}>' * 40_000}<p>b"), None)[0].startswith("a")
    long = "<article>" + "".join(f"<p>line {i % 97} of a very long page</p>" for i in range(60_000)) + "</article>"
    assert main_text(lines(long), lines(long.replace("line 5 ", "row 5 ")))[0].count("\n\n") == 59_999


def article(*own):
    return f"<nav>Menu</nav><article>{''.join(f'<p>{x}</p>' for x in own)}</article><div class=ad>Advert</div><footer>Foot</footer>"


def test_the_difference_deletes_all_shared_lines_but_body_lines():
    quoted = "a paragraph that many pages of the host quote word for word and in full"
    a, b = (lines(article(quoted, f"text {x}", "Quoted too")) for x in "ab")
    # Menu, advert and footer go by the difference, quoted paragraphs of the article stay.
    assert main_text(a, b) == (f"{quoted}\n\ntext a\n\nQuoted too", 3)
    assert main_text(a, None) == (f"{quoted}\n\ntext a\n\nQuoted too", 0)


def nearest(rows, at):
    """The nearest page of other lines before or after a page, by trying all."""
    host, path, own = rows[at]
    before = next((r for r in rows[:at][::-1] if r[2] != own or r[0] != host), None)
    after = next((r for r in rows[at + 1 :] if r[2] != own or r[0] != host), None)
    near = [(len(_common(path, r[1])), -k, r[2]) for k, r in enumerate((before, after)) if r is not None and r[0] == host != ""]
    return max(near)[2] if near else None


def _common(a, b):
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return a[:n]


def test_pairing_against_all_neighbours():
    import random

    rnd = random.Random(6)
    rows = sorted((rnd.choice(["h", "i", ""]), f"/{rnd.choice('ab')}/{rnd.randint(0, 30)}", lines(page(rnd.choice(["x", "y"]), f"t{rnd.randint(0, 5)}"))) for _ in range(400))
    # Between two groups of copies the last and the first member are the neighbours.
    got = list(htmltext._extract(((i, ""), *r) for i, r in enumerate(rows)))
    assert [g[0] for g in got] == list(range(400))
    for i, (host, _, own) in enumerate(rows):
        want = nearest(rows, i)
        assert got[i][2] == main_text(own, want)[0]


def test_copies_over_partitions_have_one_text(spark):
    rows = [(i, f"http://h/p/{i % 4}?q={i}", page("alpha", "beta")) for i in range(300)] + [(1000 + i, f"http://h/q/{i}", page(f"own {i}")) for i in range(300)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    got = {r["page_id"]: r["text"] for r in extract(pages).collect()}
    assert all(got[1000 + i] in (f"own {i}", f"Site name\n\nown {i}\n\nContact") for i in range(300))
    assert sum(got[1000 + i] == f"own {i}" for i in range(300)) >= 284
    assert all("alpha\n\nbeta" in got[i] for i in range(300))


def page(*own):
    return "".join(f"<div>{x}</div>" for x in ("Site name", *own, "Contact"))


def test_pages_without_marks_lose_what_the_nearest_page_has(spark):
    rows = [(1, "http://h/a/1", page("alpha", "beta")), (2, "http://h/a/2", page("gamma")), (3, "http://h/zz", page("delta")),
            (4, "http://other/a/1", page("alone")), (5, None, page("no url")), (6, "http://h/a/1", page("alpha", "beta")),
            (7, "http://h/n", None), (None, "http://e/", "")]
    pages = spark.createDataFrame([(*r, "x", 9) for r in rows], "page_id long, url string, html string, text string, n_chars int").coalesce(1)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        got = {r["page_id"]: r for r in extract(pages).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert {k: r["text"] for k, r in got.items()} == {
        1: "alpha\n\nbeta", 6: "alpha\n\nbeta", 2: "gamma", 3: "Site name\n\ndelta\n\nContact", 4: "Site name\n\nalone\n\nContact",
        5: "Site name\n\nno url\n\nContact", 7: "", None: ""}
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())
    assert got[2]["n_shared"] == 2 and got[2]["url"] == "http://h/a/2"
    assert extract(pages.limit(0)).count() == 0


def test_every_row_once_over_many_partitions(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    many = pages.union(pages).repartition(7)
    got = extract(many).collect()
    assert Counter(r["page_id"] for r in got) == Counter({r["page_id"]: 2 for r in pages.collect()})
    for r in got:
        assert "\n\n\n" not in r["text"] and "<p>" not in r["text"]
