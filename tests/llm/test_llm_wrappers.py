import html
import random
import re

from pyspark.sql import functions as F

from stationflow.llm import wrappers

SHOP = """<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var a="<p>no</p>";</script></head><body>
<div id="top-menu"><a href="/">Home</a> <a href="/x">Other</a></div><div class="page"><div class="notice">We use cookies</div>
<div class="post-text"><h2>Title {n} &amp; more</h2>{body}</div><ul class="comments"><li>First!</li></ul><div class="sidebar">Popular {n}</div></div>
<form><input name=q>Find</form><footer>&copy; 2020</footer></body></html>"""


def shop(n):
    return SHOP.format(n=n, body="".join(f"<p>Paragraph <b>{n}</b>.{i}\n &eacute;&nbsp;end" for i in range(n % 4 + 1)))


def shop_text(n):
    return f"Title {n} & more " + " ".join(f"Paragraph {n}.{i} é end" for i in range(n % 4 + 1))


def frame(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, _page string, _text string, host string")


def row(i, url, page):
    return (i, url, page, "a", "b", "c")


def test_hosts_without_article_elements(spark):
    rows = [row(i, f"https://shop.example.com/{i}?q#x", shop(i)) for i in range(40)]
    found = wrappers.extract(frame(spark, rows).repartition(5)).select("_page.page_id", "_text").collect()
    assert {r.page_id: r["_text"] for r in found} == {i: shop_text(i) for i in range(40)}
    w = wrappers.infer(frame(spark, rows).repartition(5)).collect()
    assert [(r.host, r.place) for r in w] == [("shop.example.com", "div.posttext")]
    assert re.search(r'\(<p> "Paragraph" <b> # </b> # </p>\)\+', w[0].expression)


def test_generated_pages(spark, small_dir):
    pages = spark.read.parquet(f"{small_dir}/pages.parquet")
    for r in wrappers.extract(pages).select("_page.html", "_text").collect():
        article = r.html[r.html.index("<article>") + 9:r.html.index("</article>")]
        expected = html.unescape(re.sub(r"<[^>]+>", " ", re.sub("</?b>", "", article))).split()
        assert r["_text"] == " ".join(expected)


def text_of(spark, pages, host="h.example"):
    rows = [row(i, f"https://{host}/{i}", p) for i, p in enumerate(pages)]
    return [r["_text"] for r in wrappers.extract(frame(spark, rows)).orderBy("_page.page_id").select("_text").collect()]


def test_marks_do_not_drop_the_article(spark):
    side, foot = '<div class="sidebar">Popular now</div>', "<footer>foot</footer>"
    layouts = {
        "a": '<div class="page has-sidebar"><article><p>Text {n} of it</p></article>' + side + "</div>" + foot,
        "b": '<div class="social layout"><div><p>Text {n} of it</p></div>' + side + "</div><p>Oh</p>" + foot,
        "c": '<div><article class="post category-search"><p>Text {n} of it</p></article></div><p>Outside {n}</p>' + side,
        "d": '<main id="search"><p>Text {n} of it</p></main><p>Outside</p>' + side,
        "e": '<div class="widget page"><article><p>Text {n} of it</p></article></div><ul class="comments"><li><article class="comment">Long talk {n} on and on</article></li></ul>',
        "f": '<div class="ad">Text {n} of it</div>',
    }
    for host, page in layouts.items():
        assert text_of(spark, [page.format(n=n) for n in range(3)], host) == [f"Text {n} of it" for n in range(3)], host
    # a mark that only some of the host's articles carry
    pages = [f'<article class="post{" category-search" * (n == 1)}"><p>Text {n} of it</p></article><p>Outside</p>' for n in range(3)]
    assert text_of(spark, pages) == [f"Text {n} of it" for n in range(3)]
    # longer comments and adverts stay boilerplate
    page = '<article><p>Short</p></article><div class="ad">A long advert here</div><div class="comments"><article>Much longer talk</article></div>'
    assert text_of(spark, [page]) == ["Short"]


def test_articles_must_hold_most_of_the_text(spark):
    card = '<article class="card"><p>Teaser {n}</p></article>'
    layouts = {
        "a": '<main><h1>Text {n}</h1><p>that is longer than all teasers together, more than once</p></main>' + card * 2,
        "b": '<div class="text"><h1>Text {n}</h1><p>that is longer than all teasers together, more than once</p></div>' + card * 2,
        "c": '<article class="lead"><h1>Text {n}</h1></article><hr><article class="body"><p>that is longer than all teasers together, more than once</p></article>',
        "d": '<article class="post"><h1>Text {n}</h1><p>that is longer than all teasers together, more than once</p></article>' + card * 2,
    }
    expected = [f"Text {n} that is longer than all teasers together, more than once" for n in range(3)]
    for host, page in layouts.items():
        assert text_of(spark, [page.format(n=n) for n in range(3)], host) == expected, host
    # two templates of one host that meet on a page, and a page whose text stands beside the host's article
    long_ = "<p>" + "long text of the usual kind " * 9 + "</p>"
    pages = [f'<article class="post">{long_}</article>'] * 4 + [
        '<article class="post"><p>One</p></article><article class="news"><p>Two, a little longer</p></article>',
        '<article class="post"><p>One</p></article><div class="text"><h2>Two</h2><p>and a little longer</p></div>']
    assert text_of(spark, pages)[4:] == ["One Two, a little longer", "One Two and a little longer"]


def test_what_all_pages_show_is_no_article(spark):
    legal = '<div class="lower"><p>' + "fixed words of the house that are longer than any article here " * 6 + "</p><p>and a second line of them</p></div>"
    prose = '<div class="prose"><p>Story {n} tells of {n} things</p><p>and ends on day {n}</p></div>'
    expected = [f"Story {n} tells of {n} things and ends on day {n}" for n in range(20)]
    outside, inside = legal + prose, "<article><h2>The story</h2>" + prose + legal + "</article>"
    assert text_of(spark, [outside.format(n=n) for n in range(20)], "a") == expected
    assert text_of(spark, [inside.format(n=n) for n in range(20)], "b") == [f"The story {t}" for t in expected]
    # without telling names or elements
    plain = "<center><div><div>{legal}</div></div></center><div><div><p>Story {n} tells of {n} things</p><p>and ends on day {n}</p></div></div>"
    assert text_of(spark, [plain.format(n=n, legal="the same words on each page " * 9) for n in range(20)], "c") == expected
    # equal pages, and a host of one page, have no slots
    assert text_of(spark, ["<div><p>Only text</p></div>"] * 6, "d") == ["Only text"] * 6


def test_the_order_of_pages_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(wrappers, "PAGES_A_PART", 5)
    rows = [row(i, "https://shop.example/", shop(i * 7 % 5) if i % 3 else shop(i).replace("<h2>", "<hr><p>New</p><h2>")) for i in range(30)]
    found = set()
    for seed in range(3):
        again = frame(spark, random.Random(seed).sample(rows, len(rows))).repartition(1 + 3 * seed)
        found.add(wrappers.infer(again).select("wrapper").first()[0])
    assert len(found) == 1


def test_long_lists_are_aligned_exactly():
    draw = random.Random(3)
    for n, m, kinds in ((300, 200, 3), (150, 400, 40), (2000, 2000, 400), (101, 100, 1), (1, 12000, 5)):
        xs, ys = ([f"k{draw.randrange(kinds)}" for _ in range(k)] for k in (n, m))
        pairs = wrappers.common(xs, ys)
        assert all(xs[i] == ys[j] for i, j in pairs) and all(a < c and b < d for (a, b), (c, d) in zip(pairs, pairs[1:]))
        row = [0] * (m + 1)
        for x in xs:
            before = 0
            for j, y in enumerate(ys):
                before, row[j + 1] = row[j + 1], before + 1 if x == y else max(row[j], row[j + 1])
        assert len(pairs) == row[m]


def test_deep_articles_keep_their_place(spark):
    page = "<div>" * 900 + "<article><p>Text {n} and more of it</p></article>" + "</div>" * 900 + "<p>Outside {n}</p>"
    assert text_of(spark, [page.format(n=n) for n in range(3)]) == [f"Text {n} and more of it" for n in range(3)]


def test_odd_pages(spark):
    deep = "<div>" * 3000 + "deep text" + "</div>" * 3000
    pages = {
        1: None, 2: "", 3: "no tags at all", 4: "<article>a<p>b<article class='comment'>no</article></article>", 5: "<<<>>>", 6: deep,
        7: "<main><h1>T</h1>x<br>y<script>z</script><!-- no --></main>", 8: "<p>one<p>two<nav>menu</nav>", 9: "<article><p>" + "long " * 60000 + "</p></article>",
        10: "<body><article>a&lt;b &#233; &bogus; &amp</article>", 11: "<article>  </article><p>outside</p>", 12: "<article hidden><p>a</p><aside>b</aside><form>c</form>d</article",
    }
    rows = [row(i, None if i % 2 else "not a url", p) for i, p in pages.items()]
    rows += [row(7, "http://User@Host.example:80/x", pages[7])] * 2
    found = {}
    for r in wrappers.extract(frame(spark, rows)).select("_page.page_id", "_text").collect():
        found.setdefault(r.page_id, []).append(r["_text"])
    assert found[1] == found[2] == [""] and found[3] == ["no tags at all"] and found[4] == ["a b"] and found[6] == ["deep text"]
    assert found[7] == ["T x y"] * 3 and found[8] == ["one two"] and found[9] == [("long " * 60000).strip()]
    assert found[10] == ["a<b é &bogus; &"] and found[11] == ["outside"] and found[12] == ["a d"]


def test_alignment_makes_optional_and_repeated_parts():
    w = None
    for page in ("<ul><li>a</li><li>b</li></ul><p>x</p>", "<ul><li>a</li></ul><hr><p>y</p>", "<ul><li>c</li></ul><p>x</p><dl><dt>k<dd>v<dt>k<dd>w</dl>"):
        own = wrappers.wrapper_of(wrappers.parse(page))
        w = own if w is None else wrappers.merged(w, own)
    text = wrappers.expression(w)
    assert '(<li> # </li>)+' in text and "(<hr>)?" in text and "(<dl>" in text and "</dl>)?" in text and "<p> # </p>" in text
    assert '(<dt> "k" </dt> <dd> # </dd>)+' in text


def test_hosts(spark):
    df = spark.createDataFrame([("https://u:p@A.b.C:8080/x",), ("a.b",), (None,), ("ftp://h",)], "u string")
    assert [r[0] for r in df.select(wrappers.host_of(F.col("u"))).collect()] == ["a.b.c", "", "", "h"]


def test_empty_table(spark):
    assert wrappers.extract(frame(spark, [])).count() == 0
