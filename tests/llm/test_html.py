"""Block rules on small pages."""

import time

from tastegraph.llm import html

PROSE = "The cat sat on the mat and it was glad that they had come for it with some of the food that was in the house. " * 3


def test_article_without_its_surroundings():
    page = f"""<html><head><title>T</title><style>p{{}}</style><script>var x="</p>";</script></head><body>
    <nav><ul><li><a href="/">Home</a></ul></nav><div class="cookie-notice">We use cookies</div><article><header><h1>A  &amp; B</h1></header>
    <p>one<br>two<p>{PROSE}</p><aside>Buy</aside><div class="comments"><p>{PROSE}</p></div><form>Sign<p>up</p></form><p>last &lt;b&gt;</article>
    <!-- ad --><footer>&copy; x</footer></body></html>"""
    assert html.main_text(page) == "\n\n".join(["A & B", "one two", PROSE.strip(), "last <b>"])


def test_rules_without_marked_article():
    menu = "<div><a href='/a'>Alpha page</a> <a href='/b'>Beta page of the site</a></div>"
    page = f"{menu}<div>Headline</div><div>{PROSE}</div><div>short</div><div>{PROSE}</div>{menu}<div>tail</div>"
    # the headline is as near to the menu as to the text, and the one before wins; the tail has a menu only
    assert html.main_text(page) == "\n\n".join([PROSE.strip(), "short", PROSE.strip()])


def test_neighbours():
    t, f, n = True, False, None
    assert html.second_pass([n, t, n, n, f, n]) == [t, t, t, f, f, f]
    assert html.second_pass([t, n, f]) == [t, t, f]
    assert html.second_pass([n, n]) == [t, t]
    assert html.second_pass([]) == []


def test_a_marked_block_decides_for_itself_only():
    other = PROSE.replace("cat", "dog").strip()
    for mark in ('<h1 class="entry-title">Head</h1>', '<div class="post-meta">Head</div>', '<li class="main-item">Head</li>', '<div class="content">Head</div>',
                 "<article>Head</article>"):
        assert html.main_text(f"{mark}<p>{PROSE}</p><div><p>{other}</p></div>") == "\n\n".join(["Head", PROSE.strip(), other])
    menu = "<ul><li><a href='/a'>Alpha page</a><li><a href='/b'>Beta page</a></ul>"
    assert html.main_text(f"<article><h1><a href='/'>Head</a></h1><p>{PROSE}</p>{menu}</article><p>{other}</p>") == "\n\n".join(["Head", PROSE.strip(), other])


def test_wrappers_named_after_what_they_hold():
    for wrapper in ("layout-with-sidebar", "no-sidebar", "has-banner wide"):
        assert html.main_text(f'<div class="{wrapper}"><p>{PROSE}</p></div>') == PROSE.strip()
    assert html.main_text(f'<div class="sidebar"><article><p>{PROSE}</p></article></div>') == PROSE.strip()
    assert html.main_text(f'<div class="comments"><article><p>{PROSE}</p></article></div>') == ""
    assert html.main_text(f'<div class="site-footer"><p>{PROSE}</p></div><p>x') == "x"


def test_words_of_class_and_id_inside_longer_tokens():
    for name in ("related-posts", "user-comments", "comments-section", "comment-thread", "post-comments", "cookie-consent-wrapper", "sidebar-left",
                 "site-footer-inner", "ad-container", "relatedPosts", "commentsSection", "header-inner", "site-notice"):
        for attribute in ("class", "id"):
            assert html.main_text(f'<article><p>{PROSE}</p></article><div {attribute}="{name}"><p>{PROSE}</p></div>') == PROSE.strip(), name
    for name in ("article-header", "section-header", "no-comments", "with-sidebar", "content-sidebar-wrap", "adaptive", "formal", "information", "shared-value"):
        assert html.main_text(f'<div class="{name}"><p>{PROSE}</p></div>') == PROSE.strip(), name


def test_depth_costs_no_more_than_length():
    start = time.perf_counter()
    for page in ("<div>" * 100_000 + "x" + "</span>" * 100_000, "<div><p>" * 50_000 + "</div>" * 50_000 + "x", "<div>" + "<span class='ad'>" * 50_000 + "<p></p>" * 50_000,
                 "<h1>" * 50_000 + "<li>x" * 50_000):
        html.main_text(page)
    assert time.perf_counter() - start < 8  # a search of all open tags at each tag takes minutes


def test_languages_without_known_stop_words():
    foreign = "Kissa istui matolla ja oli iloinen, koska talossa oli ruokaa kaikille, jotka tulivat sinne illalla. " * 3
    menu = "<div><a href='/a'>Etusivu</a> <a href='/b'>Uutiset ja muut</a></div>"
    assert html.main_text(f"{menu}<p>{foreign}</p>{menu}") == foreign.strip()


def test_broken_markup_never_fails():
    for page in ("", "<", "<a", "<!--", "<script>", "</p></p>", "a < b > c", "<p class='x", "<b>" * 5000 + "x", "&#xFFFFFFF;&bogus;&am", "<p hidden>x</p>y"):
        assert isinstance(html.main_text(page), str)
    assert html.main_text("plain words") == "plain words"
    assert html.main_text("<p hidden>x</p><p>y") == "y"


def test_rows(spark):
    rows = [(1, None, None, 5), (2, "u", "", 5), (None, "u", "<p>a</p><p>b  c</p>", 5), (2, "u", "", 5), (3, "u", "<p>" + "word of the day " * 50000, 5)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = html.extracted(pages)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    found = sorted((r.page_id or 0, r.n_chars) for r in got.collect())
    assert found == [(0, 6), (1, 0), (2, 0), (2, 0), (3, 799999)]
    assert html.extracted(pages.where("false")).count() == 0
