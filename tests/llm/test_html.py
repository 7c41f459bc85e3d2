"""Main text of pages: a plain version on the given table, templates per host, and single pages of all kinds."""
import re
from html import unescape

import pytest
from pyspark.sql import functions as F

from netkpi.llm import html
from netkpi.llm.shared import table

SCHEMA = "page_id long, url string, html string"


def text(source):
    page = html.Page(source)
    return page.text(page.dropped())


def test_given_pages_equal_a_plain_version(spark):
    pages = table(spark, "/root/testdata/sf0.01", "pages")
    got = {r.page_id: r.main_text for r in html.main_text(pages).collect()}
    for page_id, _, source in pages.collect():
        body = re.search("<article>(.*?)</article>", source, re.S)[1]
        blocks = (" ".join(unescape(re.sub("<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split("</?(?:p|h1)>", body))
        assert got[page_id] == "\n".join(b for b in blocks if b)


@pytest.mark.parametrize("source, want", [
    ("", ""), ("plain", "plain"), ("<article></article><p>outside", ""), ("<p>a<p>b  \n c<br>d", "a\nb c d"),
    ("<article><h1>T</h1><p>a <b>b</b><i>c</i>d<p>x &lt;y&gt; &amp;amp; &#233;&nbsp;&copy;</article>", "T\na bcd\nx <y> &amp; é ©"),
    ("<article>&amp</article>", "&"), ("<ARTICLE><P CLASS=x>A</P></ARTICLE>", "A"),
    ("<title>t</title><body><header>h</header><nav>n</nav><p>x</p><footer>f</footer><script>if(a<b)'</p>'</script><style>p{}</style>", "x"),
    ("<article><p>a</p><script>x</script ><p>b</p><!-- <p>no</p> --><aside>no</aside><form><p>no<input></form><div class='ad'>no</div></article>", "a\nb"),
    ("<article><header><h1>T</h1><p>by me</p></header><p>a</article>", "T\na"),
    ("<article><p>a</p><section id=comments><article class=comment>me too</article></section></article>", "a"),
    ("<form><div class='modal wrapper'><article><p>a</p></article></div></form>", "a"),
    ("<main><p>a long first part of the text</p><article><p>card</p></article></main>", "a long first part of the text\ncard"),
    ("<main><article><p>the article itself</p></article><p>more</p></main>", "the article itself"),
    ("<article><ul><li>a<li>b</ul><table><tr><td>c<td>d<tr><td>e</table></article>", "a\nb\nc\nd\ne"),
    ("<article><p>it's 3 < 4 <a title='x > y' href=\"q\">l</a></p></article>", "it's 3 < 4 l"),
    ("<article><p>unclosed <b>bold</article><div class='site-footer'>no</div>", "unclosed bold"),
    ("<article hidden>no</article><div class=CookieNotice>no</div><p style='display: none'>no</p><p>yes", "yes"),
    ("<article><p>a</p><div role=navigation>no</div></article><script>never closed <article>no</article>", "a"),
    ("<a " * 3000 + '="', ""), ("<article><p>x</p>" + "<div>" * 20000 + "deep" + "</b>" * 2000, "x\ndeep"),
])
def test_single_pages(source, want):
    assert text(source) == want


def site():
    """A host with a template in and around its articles, copies of one article, and a host of one page."""
    menu = "<div><p>Home</p><p>About us</p></div>"
    box = "<div><p>Like what you read? Tell others.</p></div>"
    out = [(i, f"https://Big.example.org/{i}", f"<body>{menu}<article><p>Text number {i}.</p><p>Yes.</p>{box}</article>") for i in range(12)]
    out += [(20 + i, f"//big.example.org:80/c{i}", "<article><div><p>A copy.</p></div></article>") for i in range(30)]
    out += [(60 + i, f"http://plain.example.org/{i}", f"{menu}<p>Only {i}.</p>") for i in range(9)]
    out += [(80, "http://one.example.org/", f"{menu}<p>One.</p>"), (81, None, f"{menu}<p>None.</p>"), (82, "no host", None), (83, "http://e.example.org", "")]
    return out + [(0, "https://Big.example.org/0", out[0][2])] * 2


def wanted(i, url):
    if i < 12:
        return f"Text number {i}.\nYes."
    if i < 60:
        return "A copy."
    if i < 80:
        return f"Only {i - 60}."
    return {80: "Home\nAbout us\nOne.", 81: "Home\nAbout us\nNone."}.get(i, "")


@pytest.mark.parametrize("most", [html.BROADCAST_BYTES, 0])
def test_templates_go_and_articles_stay(spark, most):
    pages = spark.createDataFrame(site(), SCHEMA).repartition(4)
    pages = pages.withColumns({c: F.lit("mine") for c in ("host", "gone", "_key", "subtrees", "content", "main_text", "_c0")})
    out = html.main_text(pages, most_bytes=most)
    assert out.columns == [*[c for c in pages.columns if c != "main_text"], "main_text"]
    got = out.collect()
    assert len(got) == len(site()) and all(r["host"] == r["_c0"] == "mine" for r in got)
    assert {(r.page_id, r.main_text) for r in got} == {(i, wanted(i, u)) for i, u, _ in site()}


def test_empty_table(spark):
    assert html.main_text(spark.createDataFrame([], SCHEMA)).collect() == []
