"""Main text of hand-written pages: nothing of the article is lost, whatever its elements are called."""

from __future__ import annotations

import pytest

from traitloom.llm.html_text import main_text

MENU = "<div><ul><li><a href=a>Home</a></li><li><a href=b>News</a></li><li><a href=c>About</a></li></ul></div>"


def prose(length):
    return ("plain words of an article " * (length // 26 + 1))[: length - 1].strip() + "."


def page(body):
    return f"<html><head><title>T</title></head><body>{body}</body></html>"


LONG = [prose(400 + 10 * i) for i in range(4)]
PARAGRAPHS = "".join(f"<p>{text}</p>" for text in LONG)


@pytest.mark.parametrize(
    "body, want",
    [
        (f"<div><p>{prose(300)}</p></div><div><p>{prose(100)}</p></div>", [prose(300), prose(100)]),
        (f"<div><h1>title</h1></div><div>{PARAGRAPHS}</div><div>closing line</div>", ["title", *LONG, "closing line"]),
        (
            "".join(f"<section><h2>part {n}</h2><p>{prose(n)}</p></section>" for n in (600, 150, 120)),
            [text for n in (600, 150, 120) for text in (f"part {n}", prose(n))],
        ),
        (
            "<table>" + "".join(f"<tr><td>{prose(n)}</td></tr>" for n in (500, 60, 200)) + "</table>",
            [prose(500), prose(60), prose(200)],
        ),
        (f"<article><p>{prose(300)}</p></article><article><p>{prose(50)}</p></article>", [prose(300), prose(50)]),
        (f"<h1>title</h1><div>{PARAGRAPHS}</div><p>closing line</p>", ["title", *LONG, "closing line"]),
    ],
    ids=["divs", "title-and-closing", "sections", "table", "articles", "loose-lines"],
)
def test_whole_article_is_kept(body, want):
    assert main_text(page(body))[0] == " ".join(want)
    assert main_text(page(MENU + "<nav>menu</nav>" + body))[0] == " ".join(want)


def test_link_lists_stay_with_the_article_that_holds_them():
    links = "<ul><li><a href=a>source one</a></li><li><a href=b>source two</a></li></ul>"
    assert main_text(page(MENU + f"<div>{PARAGRAPHS}{links}</div>" + MENU))[0] == " ".join([*LONG, "source one source two"])


@pytest.mark.parametrize("mark", ['class="page no-sidebar"', 'class="content-with-sidebar"', 'class="elementor-widget-container"',
                                  'id="search-engines"', 'class="widget"', 'class="sidebar-right"'])
def test_a_mark_never_takes_the_article(mark):
    body = MENU + f"<div {mark}><h1>title</h1>{PARAGRAPHS}</div><div class=\"cookie-notice\">we use cookies</div>"
    assert main_text(page(body))[0] == " ".join(["title", *LONG])


def test_a_name_that_only_holds_a_part_word_marks_nothing():
    body = f'<section><p>{prose(600)}</p></section><section id="search-engines"><p>{prose(200)}</p></section>'
    assert main_text(page(body))[0] == " ".join([prose(600), prose(200)])


@pytest.mark.parametrize(
    "more",
    [
        f'<article class="comment"><p>{prose(90)}</p></article>',
        f'<div class="comments"><article><p>{prose(90)}</p></article></div>',
        f"<aside><article><h2>more</h2><p>{prose(90)}</p></article></aside>",
        f'<article class="teaser"><p>{prose(90)}</p></article>',
        f'<article id="c1" class="Comment depth_1"><p>{prose(90)}</p></article>' * 9,
    ],
)
def test_comments_and_teasers_stay_out(more):
    assert main_text(page(f"<main><h1>title</h1>{PARAGRAPHS}</main>" + more))[0] == " ".join(["title", *LONG])


def test_what_was_not_closed_does_not_take_the_article():
    for before in ('<div class="ad">buy', "<nav><a href=x>home</a>", "<form><select><option>one"):
        assert main_text(page(before + f"<article><h1>title</h1>{PARAGRAPHS}</article>"))[0] == " ".join(["title", *LONG])


def test_names_alone_never_leave_a_page_empty():
    body = "<nav>menu</nav>" + "".join(f'<div class="widget"><p>{prose(200)}</p></div>' for _ in range(3))
    assert main_text(page(body))[0] == " ".join([prose(200)] * 3)
    assert main_text(page("<nav><a href=a>menu</a></nav>"))[0] == ""


NAMES = [
    "user-comments", "comment-thread", "comments-wrapper", "post-comments", "sidebar-widget", "cookie-banner__text",
    "advertisement-block", "newsletter-box", "promo-box", "related-content", "site-notice", "commentList", "CookieConsent", "ad",
    "article-comments", "social_share_links", "left-sidebar", "footer-widgets", "search-box",
]


def comments(n):
    return "".join(f"<div><b>reader {i}</b><p>{prose(200 + i)}</p></div>" for i in range(n))


@pytest.mark.parametrize("name", NAMES)
@pytest.mark.parametrize("frame", ["<main>{}</main>", "<article>{}</article>", "<div>{}</div>", "<main><article>{}</article></main>"])
def test_parts_are_left_out_however_long_they_are(name, frame):
    body = f'<h1>title</h1>{PARAGRAPHS}<div class="{name}">{comments(12)}</div>'
    assert main_text(page(MENU + frame.format(body)))[0] == " ".join(["title", *LONG])


@pytest.mark.parametrize("part", ["<aside>{}</aside>", "<footer>{}</footer>", "<form>{}</form>", "<nav>{}</nav>", '<section role="complementary">{}</section>'])
def test_long_elements_that_are_no_article_are_left_out(part):
    for frame in ("<main>{}</main>", "<article>{}</article>", "<div>{}</div>"):
        body = f"<h1>title</h1>{PARAGRAPHS}{part.format(comments(12))}"
        assert main_text(page(frame.format(body)))[0] == " ".join(["title", *LONG])


def test_comments_as_articles_without_an_article():
    body = f'<div><h1>title</h1>{PARAGRAPHS}</div><div class="comments">' + "<article><p>" + prose(900) + "</p></article>" * 5 + "</div>"
    assert main_text(page(body))[0] == " ".join(["title", *LONG])


@pytest.mark.parametrize("name", ["search-engines", "no-sidebar", "content-with-sidebar", "main-content", "share-price", "nature-notes", "shadow", "header-image"])
def test_names_that_say_something_else_mark_nothing(name):
    body = f'<article><h1>title</h1>{PARAGRAPHS}<section class="{name}"><p>{prose(120)}</p></section></article>'
    assert main_text(page(body))[0] == " ".join(["title", *LONG, prose(120)])


def test_ratios_decide_inside_a_landmark_too(spark):
    """Boxes of links around the text of an article, without any name, are told from it by their ratio, in the query as well."""
    from traitloom.llm.html_text import extract

    links = "".join(f"<div><a href=x{i}>more to read number {i}</a></div>" for i in range(6))
    body = f"<article><div>{links}</div><div><h1>title</h1></div><div>{PARAGRAPHS}</div><div>{links}</div><div>closing line</div></article>"
    want = " ".join(["title", *LONG, "closing line"])
    assert main_text(page(body))[0] == want
    rows = spark.createDataFrame([(1, page(body))], "page_id long, html string")
    found = extract(rows).first()
    assert found["text"] == want and found["n_lines"] > found["n_content_lines"] == 6


def test_short_article_beside_a_longer_advert():
    body = f'<div class="ad">{prose(200)}</div><article><h1>Of.</h1></article><footer>{prose(100)}</footer>'
    assert main_text(page(body))[0] == "Of."


def test_very_long_and_repeated_pages(spark):
    from traitloom.llm.html_text import extract

    long = page("<nav><a href=x>home</a></nav><article>" + "".join(f"<p>{prose(300)}</p>" for _ in range(5_000)) + "</article>")
    rows = [(1, long, "x"), (1, long, "x"), (2, None, "y"), (2, None, "y")]
    found = extract(spark.createDataFrame(rows, "page_id long, html string, TEXT string")).collect()
    assert sorted(len(r["text"]) for r in found) == [0, 0, *[len(" ".join([prose(300)] * 5_000))] * 2]
