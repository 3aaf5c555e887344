import re

import duckdb

from skyflow.llm import html_extract as hx


def text(page):
    return hx.extract(hx.parse(page), set())


def test_small_pages():
    assert text("<p>a<b>b</b> c<p>d &amp; &lt;e&gt;  \n f&nbsp;g<br>h") == "ab c d & <e> f g h"
    assert text("<head><title>t</title></head><body><nav><li>x</nav><article><header><h1>T</h1></header><p>one</p><div class='comments'>no</div></article><footer>f") == "T one"
    assert text("<script>var a='</p><p>'; if(a<b){}</script>x<!-- y -- ><p>z --> w") == "x w"
    assert text("a <style>p{} unclosed") == "a" and text("") == "" and text("plain &#233; 1 < 2") == "plain é 1 < 2"
    assert text("<div role=navigation>n</div><div id='main-sidebar'>s</div><div class=story>ok</div>") == "ok"
    assert text("<div>" * 5000 + "deep") == "deep"


def test_quotes_depth_inline_and_class_words():
    assert text("<p title=don't>Hello there</p>") == "Hello there"
    assert text("<p title=it's>Lost text</p><p>Bob's house</p><p>end</p>") == "Lost text Bob's house end"
    assert text("<p title='a>b' data-x=\"c>d\">x</p><p title=\"open>y</p>") == "x y"
    assert text("super<wbr>cali<img src=x>fragi") == "supercalifragi"
    for name in ("search-results-article", "story with-comments", "related-work", "skip-intro", "no-sidebar", "adventure"):
        assert text(f"<div class='{name}'>stays</div>") == "stays", name
    for name in ("main-sidebar", "comment-list", "x site-footer", "ad-slot", "share_buttons", "cookie-banner-wrapper"):
        assert text(f"<div class='{name}'>goes</div>") == "", name
    assert text("<div class=page-menu>n<article>stays</article></div>") == "n stays" and text("<p hidden>h</p><p>v</p>") == "v"
    assert text("<div>" * 205 + "<nav>MENU</nav>ok") == "ok" and text("<article>" + "<div>" * 210 + "<aside>AD</aside>ok") == "ok"
    deep = hx.parse("<div>" * 20_000 + "x" + "</b>" * 20_000)
    assert len(hx.subtree_hashes(deep)) == 20_000


def test_templates_of_a_large_host_and_either_join(spark, monkeypatch):
    rows = [(i, f"http://big.a/{i}", f"<div>{'<ul><li>Menu of a section</ul>' if i % 20 == 0 else ''}<p>Own text {i}</p></div>") for i in range(300)]
    rows += [(1000 + i, f"http://h{i}.b/", f"<p>Page {i}</p>") for i in range(40)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    want = {i: f"Own text {i}" for i in range(300)} | {1000 + i: f"Page {i}" for i in range(40)}
    assert {r.page_id: r.text for r in hx.extract_text(df).collect()} == want
    monkeypatch.setattr(hx, "BROADCAST_TEMPLATES", 0)
    assert {r.page_id: r.text for r in hx.extract_text(df).collect()} == want


def test_templates_go_and_articles_stay(spark):
    rows = [(i, "http://a.b/x", f"<div><div class=x>Same box <a href=/{i}>go</a></div><p>Body {i}</p></div>", "t") for i in range(8)]
    rows += [(20, "http://c.d/", "<div><div class=x>Same box <a>go</a></div><p>Body</p></div>", "t"), (21, None, None, None), (22, "http://a.b/", "", None)]
    rows += [(30 + i, "http://e.f/", "<article><p>Same article</p></article>", None) for i in range(9)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = {r.page_id: r.text for r in hx.extract_text(df).collect()}
    assert got == {i: f"Body {i}" for i in range(8)} | {20: "Same box go Body", 21: "", 22: ""} | {30 + i: "Same article" for i in range(9)}
    assert hx.extract_text(df.limit(0)).collect() == []


def test_generated_pages_against_their_article():
    import html

    rows = duckdb.sql("select html from '/root/testdata/sf0.01/pages.parquet'").fetchall()
    for (page,) in rows:
        body = re.search(r"<article>(.*?)(</article>|<footer>|$)", page, re.S)[1]
        body = re.sub(r"<(p|/p|br|h1|/h1)>", " ", body)
        want = " ".join(html.unescape(re.sub(r"<[^>]*>", "", body)).split())
        assert " ".join(text(page).split()) == want


def test_near_copies_without_an_article_keep_their_text(spark):
    body = "<h1>A title</h1><p>First paragraph with a good many words in it.</p><p>Second one.</p>"
    copies = [(i, "http://copy.a/", f"<div id=page><ul><li>Menu</ul><div class=story>{body}</div><p>posted {i}</p></div>") for i in range(6)]
    inside = [(10 + i, "http://date.a/", f"<div class=story><p>posted {i}</p>{body}</div>") for i in range(6)]
    others = [(30 + i, "http://copy.a/", f"<div id=page><ul><li>Menu</ul><div class=story><p>A text of its own, number {i}.</p></div></div>") for i in range(6)]
    df = spark.createDataFrame(copies + inside + others, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in hx.extract_text(df).collect()}
    text = "A title First paragraph with a good many words in it. Second one."
    assert got == {i: f"{text} posted {i}" for i in range(6)} | {10 + i: f"posted {i} {text}" for i in range(6)} | {30 + i: f"A text of its own, number {i}." for i in range(6)}


def test_class_words_inside_an_article():
    page = "<article><p class=related>Solve</p><p id=search>for</p><div class=notice>x in</div><p><math><mi>x</mi><msup><mn>2</mn></msup></math> = 4 <object>now</object></p><div class=ad>BUY</div><div id=comments>no</div></article>"
    assert text(page) == "Solve for x in x2 = 4 now"


def test_menus_of_small_hosts(spark):
    rows = [(i, "http://four.a/", f"<div><ul><li>Home<li>About</ul><p>Own text of page {i}</p></div>") for i in range(4)]
    rows += [(10 + i, "http://two.a/", f"<div><ul><li>Home</ul><p>Own text of page {i}</p></div>") for i in range(2)]
    rows += [(20 + i, "http://some.a/", f"<div>{'<ul><li>Part</ul>' if i else ''}<p>Own text of page {i}</p></div>") for i in range(4)]
    got = {r.page_id: r.text for r in hx.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: f"Own text of page {i}" for i in range(4)} | {10 + i: f"Home Own text of page {i}" for i in range(2)} | {20: "Own text of page 0"} | {20 + i: f"Part Own text of page {i}" for i in range(1, 4)}
