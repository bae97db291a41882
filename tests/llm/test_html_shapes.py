"""Wrappers around the main text, cut-off markup, very deep pages, and entropies against a plain computation."""

import math
import time
import tracemalloc
from collections import Counter

import pytest

from glossaflow.llm import html_extraction
from glossaflow.llm.html_extraction import parse


@pytest.mark.parametrize("source, expected", [
    ("<div class='search related'><main><p>Real article</p></main></div><p>Other line</p>", ["Real article"]),
    ("<p>Skip to content</p><div id='page' class='modal'><article><p>Body of the article</p></article></div>",
     ["Body of the article"]),
    ("<article><p>Body</p><div class=comments><article><p>A remark</p></article></div></article>", ["Body"]),
    ("<article><p>Body</p></article><div id=comments><article><p>A remark</p></article></div>", ["Body"]),
    ("<div><p>Body</p></div><div id=comments><article><p>A much longer remark</p></article></div>", ["Body"]),
    ("<div><p>Body of the page</p></div><div class=related><article>Teaser</article></div>", ["Body of the page"]),
    ("<div class=modal><nav>x</nav><main><div class=ad>buy</div><p>Text</p></main></div>", ["Text"]),
    ("hello<div class=", ["hello"]), ("<p>one</p><p>two <a href='x", ["one", "two"]),
    ("<p>1 < 2 and a &lt;b&gt;</p>", ["1 < 2 and a <b>"]),
    ("<p>x</p><!-- never closed", ["x"]), ("", []), (None, []),
])
def test_shapes(source, expected):
    assert parse(source).texts() == expected


def test_a_page_of_unclosed_tags_takes_time_and_memory_of_its_length():
    source = "<font color=red>a" * 60000 + "<h1>t</h1>" * 1000
    assert len(source) > 1_000_000
    tracemalloc.start()
    start = time.process_time()
    page = parse(source)
    spent, (_, peak) = time.process_time() - start, tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert page.texts()[0] == "a" * 60000 and len(page.texts()) == 1001
    assert peak < 200 << 20 and spent < 60, (peak, spent)


def test_importance_equals_plain_entropies(spark):
    rows = [(h, f"http://{h}/", f"<div><p>{'same' if i % 3 else i}</p>{'<p>more</p>' * (i % 4)}</div>")
            for h in ("a", "b") for i in range(20 if h == "a" else 9)]
    pages = spark.createDataFrame(rows, "page_id string, url string, html string")
    pages = pages.withColumn("host", html_extraction._host())
    found = {(r["host"], r["place"]): (r["pages"], r["importance"])
             for r in html_extraction.importance(html_extraction.style_counts(pages)).collect()}
    expected = {}
    for host in ("a", "b"):
        parsed = [parse(source) for source in sorted({r[2] for r in rows if r[0] == host})]
        for place, parent in {(p, q) for page in parsed for p, q, _ in page.declared()}:
            texts = Counter(t for page in parsed for t in {t for p, _, t in page.declared() if p == place})
            standing = sum(any(p == place for p, *_ in page.declared()) for page in parsed)
            content = sum(n * (1 - math.log(n) / math.log(standing)) for n in texts.values()) / texts.total()
            layouts = Counter(c for page in parsed for c in {c for p, c in page.layouts if p == parent})
            total = layouts.total()
            layout = -sum(n / total * math.log(n / total) for n in layouts.values()) / math.log(max(total, 2)) if total else 0
            expected[host, place] = (standing, content + (1 - content) * layout)
    assert found.keys() == expected.keys()
    assert all(found[k][0] == n and abs(found[k][1] - v) < 1e-9 for k, (n, v) in expected.items())
