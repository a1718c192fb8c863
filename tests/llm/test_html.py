import html as entities
import re

from lacuna.llm import html


def truth(page):
    body = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    lines = (" ".join(entities.unescape(re.sub("</?b>", "", x)).split()) for x in re.split(r"</?(?:p|h1|br)[^>]*>", body))
    return "\n".join(x for x in lines if x)


def test_every_page_of_the_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    want = {r.page_id: truth(r.html) for r in pages.collect()}
    assert {r.id: r.text for r in html.main_text(pages).collect()} == want


def test_labelled_pages_come_back():
    weights = html.learn()
    assert weights.tag < 0 < weights.start
    for page in html.LABELLED:
        got = html.extract(page, weights)
        marked = [" ".join(p.text.split()) for p in html.pieces(page) if p.text and p.text.strip()]
        assert got and not re.search("Share Tweet|half the price|grandmother|cookies|Sponsored|reserved|Leave a reply", got)
        assert all(line.split()[0] in " ".join(marked) for line in got.split("\n"))


def test_broken_markup_and_odd_signs():
    w = html.learn()
    assert html.extract("<p>One two three &amp; four<p>five &eacute; six <b>seven", w) == "One two three & four\nfive é six seven"
    assert html.extract("plain 3 < 4 words", w) == "plain 3 < 4 words"
    assert html.extract("<div>a b c<!-- x > y --> d e<script>if (a<b) {}</SCRIPT> f</div>", w) == "a b c d e f"
    assert html.extract("<p>text here and more<!-- never closed <p>gone", w) == "text here and more"
    assert html.extract("<nav><a>only</a><a>menu</a></nav>", w) == ""
    for page in ("<" * 50_000, '<a "' * 50_000, "<p>x" * 20_000, "<div>" * 2000 + "x", "</div>" * 50_000):
        html.extract(page, w)


def test_odd_rows(spark):
    df = spark.createDataFrame([(1, None, 1), (1, "", 2), (None, "<p>hello there you all</p>", 3)], "page_id long, html string, text int")
    got = sorted((r.id or 0, r.text, r.row.text) for r in html.main_text(df, with_row=True).collect())
    assert got == [(0, "hello there you all", 3), (1, "", 1), (1, "", 2)]
    assert html.main_text(df.where("false")).collect() == []
