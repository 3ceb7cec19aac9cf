from __future__ import annotations

import html
import os
import re

import pandas as pd
import pytest

from etafeat.llm import html_text as op

TREE = op.train()
WORDS = "some words of a longer paragraph that is plainly main text of the page and nothing else "


def test_tree_fits_its_table():
    assert all(op.is_main(TREE, row[:-1]) == bool(row[-1]) for row in op.LABELLED)


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("<p", ""), ("<!-- all", ""), ("<nav>menu only</nav>", ""),
    ("<article>x <script>'</article>'</script>y<!-- z --></article>", "x y"),
    ("<article><h1>A</h1><p>b<b>old</b> c<br>d<p>e &lt;f&gt; &amp g &#233;</article><footer>no</footer>", "A bold c d e <f> & g é"),
    ("<ARTICLE><P>up</P>\n\n<DIV>  per \t case </DIV></ARTICLE>", "up per case"),
    ("<header>site</header><article><header><h1>T</h1></header><p>body</p><footer>by</footer></article>", "T body"),
    ("<article><p>a</p><aside>side</aside><p>b</p><div class='ad-box'>buy</div><p>c</p></article>", "a b c"),
    ("<article>a</article><section id=comments><article class=comment>reader</article></section>", "a"),
    ("<div class='cookie-notice'>we use cookies</div><form><label>Name</label><input></form><main><p>kept</p></main>", "kept"),
    ("<div class='layout sidebar'><article><p>in</p></article></div>", "in"),
    ("<aside><article>teaser</article></aside><article><p>in <a href='x'>a link</a></p></article>", "in a link"),
    ("<article><p title='a > b'>quoted</p><style>p{}</style><noscript>no</noscript><p>a < b</article>", "quoted a < b"),
    ("<body class='has-comments sidebar'><article>x</article></body>", "x"),
    ("<article><p>open<p>to the end <b", "open to the end"),
    ("<ul><li><a href=a>Home</a><li><a href=b>News</a></ul><div><p>" + WORDS + "</p><p>" + WORDS * 2 + "</p></div>",
     " ".join((WORDS * 3).split())),
])
def test_pages(page, text):
    assert op.main_text(page, TREE) == text


def test_all_rows_against_the_article_element(spark):
    """The given pages name their article: what it holds is the text, whole."""
    d = "/root/testdata/sf0.01"
    if not os.path.exists(d):
        pytest.skip("no test tables")
    got = op.op9_html_extraction(spark, d).toPandas().set_index("page_id")
    pages = pd.read_parquet(f"{d}/pages.parquet")
    assert len(got) == len(pages)
    for i, page in zip(pages.page_id, pages.html):
        body = re.search(r"<article>(.*?)(</article>|$)", page, re.S)[1]
        body = re.sub(r"</?(p|h1)>", "\0", re.sub(r"<br>", " ", re.sub(r"</?b>", "", body)))
        want = " ".join(x for x in (" ".join(html.unescape(b).split()) for b in body.split("\0")) if x)
        assert got.text[i] == want and got.n_chars[i] == len(want)


def test_long_page_repeated_rows_and_no_rows(spark):
    page = "<article>" + "<p>word &amp; word</p>" * 20_000 + "</article>"
    schema = "page_id long, url string, html string, text string"
    rows = [(1, None, page, "mine"), (1, None, page, "mine"), (2, "u", None, None)]
    got = op.extract(spark.createDataFrame(rows, schema)).collect()
    assert [len(r.text) for r in got] == [len("word & word ") * 20_000 - 1] * 2 + [0]
    assert op.extract(spark.createDataFrame([], schema)).collect() == []
