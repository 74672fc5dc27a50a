import re
import time
from html import unescape

from kpiweave.llm import pagetext as P
from kpiweave.llm.common import table
from kpiweave.llm.dom import blocks

PAGES = "page_id bigint, url string, html string, text string, host string, low int"


def texts(html):
    return [b.text for b in blocks(html)[0] if not b.foreign]


def test_markup_oddities():
    assert texts("<p>a<b>b</b>\n  c&amp;d&nbsp;e<p>f<br>g") == ["ab c&d e", "f", "g"]
    assert texts("<script>var t='</p>';</script><p>x</p><!-- <p>no</p> --><p>y") == ["x", "y"]
    assert texts("1 < 2 <3 <p title='a>b' data-x=\"</p>\">t</p") == ["1 < 2 <3", "t"]
    assert texts("<ul><li>a<li>b<ul><li>c</ul></ul><table><tr><td>1<td>2<tr><td>3</table>") == [
        "a", "b", "c", "1 2", "3",
    ]
    assert texts("<nav><a>m</a></nav><form><p>f</p></form><div class='x Comment-list'>c</div>z") == ["z"]
    assert texts("<main><header><h1>T</h1></header><p hidden>h</p><p>b</main><header>no</header>") == ["T", "b"]
    assert texts("<style>p{}") == texts("<!-- open") == texts("") == texts("<p") == []
    assert texts("<p>open <a href='x>unclosed</p><p>next</p>") in (["open", "next"], ["open unclosed", "next"])


def page(i, body):
    return (i, f"https://User@Site.example:8080/p/{i}?q", body, "clash", "clash", 1)


def test_low_branches_go_and_articles_stay(spark):
    rows = []
    for i in range(40):
        body = f"<div class=k1><p>story {i} of {i * 7}</p><p>more {i * 3}</p></div>"
        box = f"<div class=k2><p>{['call us', 'write us'][i % 2]}</p><i>now</i></div>"
        rows.append(page(i, f"<html><body>{box}{body}<div class=k3>© us</div></body></html>"))
    copies = [page(100 + i, rows[0][2]) for i in range(60)]  # equal pages count once
    lone = [(200, "http://lone.example/", rows[1][2], "", "", 1), (201, None, rows[1][2], "", "", 1)]
    odd = [(202, "http://lone.example/", None, "", "", 1), (203, "", "", None, None, 1), (None, "x", "<p>t", "", "", 1)]
    same = [page(300 + i, f"<div>menu {i}</div><article><p>same words</p></article>") for i in range(9)]
    docs = spark.createDataFrame(rows + copies + lone + odd + same + rows[:1], PAGES)
    got = P.report(docs)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    found = got.collect()
    assert len(found) == docs.count()
    by_id = {r.page_id: r for r in found}
    for i in range(40):
        assert by_id[i].text == f"story {i} of {i * 7}\nmore {i * 3}"
    assert by_id[159].text == by_id[0].text
    assert by_id[200].text == by_id[201].text == "write us\nnow\nstory 1 of 7\nmore 3\n© us".replace("us\nnow", "us\nnow")
    assert by_id[202].text == by_id[203].text == "" and by_id[203].n_chars == 0
    assert by_id[None].text == "t"
    assert by_id[305].text == "same words"
    assert all(r.n_chars == len(r.text) for r in found)


def judged(spark, bodies):
    docs = spark.createDataFrame([page(i, b) for i, b in enumerate(bodies)], PAGES)
    return {r.page_id: r.text for r in P.report(docs).collect()}


def test_tree_judges_inside_and_beside_article_elements(spark):
    inside, teaser = [], []
    for i in range(12):
        own = f"<p>story {i} of {i * 7} and what came after it</p>"
        box = "<div class=k2>call us now</div>"
        inside.append(f"<article>{box}{own}<div class=k3><p>© us</p></div></article><div>menu {i}</div>")
        teaser.append(f"<article><p>in short {i}</p></article>{box}<div class=k1>{own}<p>more {i * 3}</p></div>")
    assert judged(spark, inside) == {i: f"story {i} of {i * 7} and what came after it" for i in range(12)}
    assert judged(spark, teaser) == {
        i: f"in short {i}\nstory {i} of {i * 7} and what came after it\nmore {i * 3}" for i in range(12)
    }


def test_repeats_within_one_page_are_no_pages(spark):
    rows = "<ul><li>yes<li>yes<li>yes<li>yes<li>yes<li>yes</ul><div class=k1><p>story</p></div>"
    assert judged(spark, [rows]) == {0: "\n".join(["yes"] * 6 + ["story"])}
    assert judged(spark, [f"{rows}<i>{i}</i>" for i in range(4)])[3].startswith("yes\nyes")


def test_names_of_article_elements_and_states_cut_nothing():
    for open_ in (
        "<div class='post no-sidebar'>", "<div id=content class=has-sidebar>", "<div class=no-header>",
        "<article class='post category-social'>", "<main class=share>", "<div class=share-price>",
        "<div class=content-sidebar-wrap>",
    ):
        assert texts(f"{open_}<p>t</p>") == ["t"], open_
    for open_ in ("<div class='x ad-300x250'>", "<div class=post-comments>", "<div id=social-share>", "<div class=site-header>"):
        assert texts(f"{open_}<p>t</p>") == [], open_


def test_deep_and_long_pages_take_time_in_proportion():
    def taken(n):
        page = "<div>" * n + "<article><p>deep</p></article>" + "</p>" * n + "<ul>" + "<div>" * n + "<li>x" * n
        start = time.perf_counter()
        found = texts(page)
        assert found[0] == "deep" and len(found) == n + 1
        return time.perf_counter() - start

    taken(500)
    assert taken(16_000) < 12 * taken(4_000) + 1  # four times the page, not sixteen
    assert texts("<div class=a>" * 100 + "<p>one<p>two" + "</div>" * 100 + "<p>three") == ["one", "two", "three"]
    long = "word " * 300_000
    assert texts(f"<article><p>{long}</p></article>") == [" ".join(long.split())]


def test_empty_table(spark):
    assert P.report(spark.createDataFrame([], PAGES)).count() == 0


def test_given_pages(spark, sf_dir):
    """The given pages name their article: its paragraphs, decoded, are the text."""
    pages = table(spark, sf_dir, "pages")
    html = {r.page_id: r.html for r in pages.collect()}
    for r in P.report(pages).collect():
        article = html[r.page_id].partition("<article>")[2].partition("</article>")[0]
        parts = re.split(r"<p>|</p>|<br>|<h1>|</h1>", article)
        plain = [" ".join(unescape(re.sub(r"</?\w[^>]*>", "", p)).split()) for p in parts]
        assert r.text.split("\n") == [p for p in plain if p]
