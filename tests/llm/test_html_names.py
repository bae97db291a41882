"""Names of elements that are no main text, and names that only look like them."""

import pytest

from glossaflow.llm.html_extraction import parse


@pytest.mark.parametrize("start, end", [
    ("<body class='has-sidebar'>", "</body>"), ("<body class='search-results'>", "</body>"),
    ("<body class='search'><main class='related'>", "</main></body>"),
    ("<article class='post category-social'>", "</article>"), ("<article id='comments'>", "</article>"),
    ("<div class='no-sidebar'>", "</div>"), ("<section class='related-work'>", "</section>"),
    ("<div class='widgets-of-the-world'>", "</div>"), ("<div class='search'>", "</div>"),
])
def test_main_text_below_such_names_stays(start, end):
    page = parse(f"<html>{start}<h1>Title</h1><p>Main text</p>{end}</html>")
    assert page.texts() == ["Title", "Main text"]


@pytest.mark.parametrize("name", ["ad", "sidebar", "main-menu", "share-buttons", "cookie-notice", "site-footer",
                                  "related-posts", "comment-list", "post-tags", "search_form", "ad-banner"])
def test_named_parts_go(name):
    page = parse(f"<body><p>Main text</p><div class='x {name}'><p>other</p></div></body>")
    assert page.texts() == ["Main text"]
