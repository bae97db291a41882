"""Copies of a page are one page of the style tree."""

from glossaflow.llm import html_extraction


def extracted(spark, rows):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    return {r["page_id"]: r["text"] for r in html_extraction.extract(pages).collect()}


def test_copies_and_unique_pages_of_one_host(spark):
    menu = "<div class=x9><p>Always the same line</p></div>"
    page = lambda i: f"<body>{menu}<div class=text><h1>Title {i}</h1><p>Body of {i}</p></div></body>"
    rows = [(i, f"http://h.example/{i}", page("copy" if i < 1000 else i)) for i in range(1050)]
    rows += [(2000 + i, "http://few.example/", "<article><h1>Only</h1><p>one text</p></article>") for i in range(8)]
    found = extracted(spark, rows)
    for i in range(1050):
        name = "copy" if i < 1000 else i
        assert found[i] == f"Title {name}\nBody of {name}"
    assert all(found[2000 + i] == "Only\none text" for i in range(8))


def test_near_copies_of_an_article_keep_it(spark):
    same = "".join(f"<p>The same long paragraph number {n} of the article.</p>" for n in range(20))
    share = "<div class=y7>Tell your friends</div>"
    rows = [(i, "http://n.example/", f"<article><p>Variant {i}</p>{same}{share}</article>") for i in range(100)]
    rows += [(i, "http://n.example/", f"<article><p>Other text {i}</p>{share}</article>") for i in range(100, 110)]
    found = extracted(spark, rows)
    assert all(f"Variant {i}" in found[i] and "paragraph number 19" in found[i] for i in range(100))
    assert all(f"Other text {i}" in found[i] for i in range(100, 110))
