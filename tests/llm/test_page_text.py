"""Main text of pages."""

from __future__ import annotations

import re
import time
from html import unescape

import pytest

from proofmark.llm import page_text as p
from proofmark.llm import queries
from proofmark.llm.common import prepare
from tests.llm import data


@pytest.mark.parametrize(
    "html, text",
    [
        ("", ""), ("plain &amp; text", "plain & text"), ("<p>a<p>b", "a b"), ("x<b>y</b>z<br>w", "xyz w"), ("<p> a \n\t b </p>", "a b"),
        ("<script>if (a<b) x='</p>'</script>t<style>p{}</style>", "t"), ("<!-- <p>no</p> -->yes<!-- open", "yes"), ("a < b > c", "a < b > c"),
        ('<a href="x>y" title=\'>\'>z</a>', "z"), ("&lt;p&gt; caf&eacute; &#x41;&#66; &nope;", "<p> café AB &nope;"), ("<ul><li>a<li>b</ul><td>c", "a b c"),
        ("<nav>n</nav><div>d</div><footer>f</footer><aside>s</aside><form><input>q</form>", "d"),
        ("<body class='no-sidebar'><main><p>m</p></main><p>out</p></body>", "m"),
        ("<div class=wrap-sidebar><article><h1>T</h1><p>x</p><div class='ad'>buy</div></article></div><div>out</div>", "T x"),
        ("<article><p>x</p><section id=comments><article class=comment>hi</article></section></article>", "x"),
        ("<div id='cookie-notice'>c</div><div role=navigation>n</div><p>t</p>", "t"), ("<head><title>t</title></head><body>b", "b"), ("<p>one</b></i></p></div>two", "one two"),
        ("<article><p><b>t<br><p>u</p></article><footer>f", "t u"), ("<ARTICLE><P>A</P></ARTICLE>", "A"), ("<textarea>no</textarea><noscript>no</noscript>yes", "yes"),
    ],
)
def test_text_of_markup(html, text):
    assert p.main_text(html) == text


def pages(spark, rows):
    rows = [(i, u, h, "x", "y", "z") for i, (u, h) in enumerate(rows)]
    return spark.createDataFrame(rows, "page_id long, url string, html string, host string, salt string, templates string")


def test_templates_of_a_site_go_and_its_articles_stay(spark):
    prepare(spark)
    box = "<div class=x1><p>Read our paper every day</p></div>"
    rows = [("http://a.com/%d" % i, f"<body><div><p>own text {i} {data.words(30, i)}</p></div>{box}</body>") for i in range(20)]
    rows += [("http://b.com/%d" % i, f"<body><p>other {i} {data.words(30, i)}</p>{box}</body>") for i in range(3)]
    rows += [("HTTP://C.com/%d" % i, "<body><div><p>the very same article on each page of it</p></div></body>") for i in range(9)]
    rows += [(None, None), ("odd", "<p>x</p>"), ("", "")]
    found = {r.page_id: r for r in p.extract(pages(spark, rows)).collect()}
    assert len(found) == len(rows)
    for i in range(20):
        assert found[i].text == f"own text {i} {data.words(30, i)}" and found[i].n_chars == len(found[i].text)
    assert all(found[20 + i].text.endswith("Read our paper every day") for i in range(3))
    assert all(found[23 + i].text == "the very same article on each page of it" for i in range(9))
    assert [(found[i].url, found[i].text, found[i].n_chars) for i in (32, 33, 34)] == [(None, "", 0), ("odd", "x", 1), ("", "", 0)]
    assert p.extract(pages(spark, rows).where("false")).count() == 0
    twice = pages(spark, rows).where("page_id = 33")
    assert [r.text for r in p.extract(twice.unionByName(twice)).collect()] == ["x", "x"]


def test_copies_of_a_page_leave_its_article_whole(spark):
    prepare(spark)
    article = "<article><p>%s</p><ul><li>one</li><li>two</li></ul><table><tr><td>cell</table></article>"
    ad = "<div class=x9><p>Read our paper</p></div>"
    rows = [("http://d.com/c%d" % i, f"<body><div>at {i}</div>{article % 'the same long article in all of these copies'}</body>") for i in range(5)]
    rows += [("http://d.com/%d" % i, f"<body>{article.split('<ul>')[0] % data.words(30, i)}</article></body>") for i in range(20)]
    rows += [("http://e.com/%d" % i, f"<body><p>own {i} {data.words(30, i)}</p>{ad if i % 10 == 0 else ''}</body>") for i in range(1000)]
    found = {r.page_id: r.text for r in p.extract(pages(spark, rows)).collect()}
    assert all(found[i] == "the same long article in all of these copies one two cell" for i in range(5))
    assert all(found[25 + i] == f"own {i} {data.words(30, i)}" for i in range(1000))


def test_keys_tell_subtrees_apart():
    key = lambda html: list(p.page_subtrees(html + "<p>" + "long text of the page " * 9)[1])
    assert key("<div>a<p>b</div>") == key("<div class=z> a <p>b</p></div>") != key("<div>a b</div>")
    assert key("<div>a</div>") != key("<section>a</section>") and key("<div>a</div>") != key("<article><div>a</div></article>")
    assert len(key("<div><div>a</div>b</div><div>a</div>")) == 2


def test_deep_pages_take_linear_time():
    began = time.perf_counter()
    own, found = p.page_subtrees("<div>x" * 16_000)
    assert len(found) > 5_000 and p.main_text("<div>x" * 16_000, {1}) == " ".join("x" * 16_000)
    assert time.perf_counter() - began < 5


def test_long_and_nested_pages():
    assert p.main_text("<div>" * 3000 + "x") == "x"
    assert len(p.main_text("<p>word</p>" * 50_000)) == 50_000 * 5 - 1
    assert p.main_text('<a title="' * 300 + "x").count("x") <= 1


def test_query_on_the_table(spark, sf_dir):
    want = {}
    for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect():
        inside = re.search(r"<article>(.*?)</article>", r.html or "", re.S)
        plain = re.sub(r"</?(?:p|h1|br)>", " ", inside[1]).replace("<b>", "").replace("</b>", "") if inside else ""
        want[r.page_id] = (r.url, " ".join(unescape(plain).split()))
    rows = queries.QUERIES["op4_page_text"](spark, sf_dir).collect()
    assert {r.page_id: (r.url, r.text) for r in rows} == want and all(r.n_chars == len(r.text) for r in rows)
