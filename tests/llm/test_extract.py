import html
import re

import pytest

from footfall.llm import extract

CASES = [
    ("", ""), ("plain text only", "plain text only"), ("<p>a<p>b", "a\nb"),
    ("<script>var t='<p>x</p>'</script><style>p{}</style><!-- c -->", ""),
    ("<body><nav><ul><li><a href=x>menu</a></nav><main><h1>T &amp; U</h1><p>First&nbsp;one &eacute;<br>here.<p>Short."
     "<aside>no</aside></main><footer>no</footer>", "T & U\nFirst one é here.\nShort."),
    ("<body class='has-sidebar'><div id=cookie-notice>We use cookies and a lot of words about them, on and on.</div>"
     "<div class=content><h2>Title</h2><div><p>The first paragraph of the page, long enough to be content.</p>"
     "<p>A second one.</p></div></div><section id=comments><p>A reader's comment that is longer than the article and "
     "goes on and on and on and on and on.</p></section><div class='sidebar'><p>side</p></div>"
     "<form><p>Sign up</p></form></body>",
     "Title\nThe first paragraph of the page, long enough to be content.\nA second one."),
    ("<article><header><h1>Head</h1><p>menu</p></header><p>Text of it.</p></article>"
     "<article class=comment><p>no</p></article>", "Head\nText of it."),
    ("<p hidden>a</p><p style='display: none'>b</p><p>c</p>", "c"),
    ("<div>" * 3000 + "deep" + "</div>" * 10, "deep"),
]


@pytest.mark.parametrize("page, text", CASES)
def test_cases(page, text):
    assert extract.main_text(page) == text


def test_articles_of_the_test_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    rows = pages.select("html", extract.extracted("html").alias("found")).collect()
    for r in rows:
        inner = r.html[r.html.index("<article>") + 9:r.html.index("</article>")]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split("</?(?:p|h1)>", inner)]
        assert r.found == "\n".join(b for b in blocks if b)


def test_odd_rows(spark):
    pages = spark.createDataFrame([(None, None, "x"), (1, "", "x"), (1, "", "x"), (2, "<p>" + "word " * 200_000, "x")],
                                  "page_id long, html string, text string")
    rows = pages.select("page_id", "text", extract.extracted("html").alias("found")).collect()
    assert sorted(len(r.found) for r in rows) == [0, 0, 0, 999_999]
    assert pages.limit(0).select(extract.extracted("html")).count() == 0
