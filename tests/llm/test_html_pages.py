"""Main-text extraction: ordinary class names, long and broken pages, host votes."""

import random
import time

import pytest

from martlet.llm import html

BODY = "".join(f"<p>Paragraph {i} of the story tells what happened on that day.</p>" for i in range(16))
TEXT = "\n".join(f"Paragraph {i} of the story tells what happened on that day." for i in range(16))
MENU, FOOT = "<nav><ul><li><a href=/>Home</a><li><a href=/x>About us</a></ul></nav>", "<footer>All rights reserved</footer>"


@pytest.mark.parametrize("article", [
    *(f"<article class='{c}'>{BODY}</article>" for c in (
        "post-12 post type-post category-advertising", "post tag-search", "hentry category-popular",
        "post category-sharing-economy", "story hidden-print", "article share")),
    f"<form id=aspnetForm action=/>{BODY}</form>", f"<div id=popup-story>{BODY}</div>",
    f"<div class='site'><div class='modal-page'>{BODY}</div></div>"])
def test_class_words_do_not_empty_a_page(article):
    assert html.extract_page(f"<body>{MENU}{article}{FOOT}") == TEXT


@pytest.mark.parametrize("aside", [
    "<div class='comment-list'><p>{}</p></div>", "<div id=comments><p>{}</p></div>", "<div class='site-footer'><p>{}</p></div>",
    "<div class='left-sidebar'><p>{}</p></div>", "<div class='main-navigation'><p>{}</p></div>", "<section class=related><p>{}</p></section>",
    "<form class=search><p>{}</p></form>", "<div class='cookieBar'><p>{}</p></div>", "<div style='display: none'><p>{}</p></div>",
    "<div role=banner><p>{}</p></div>", "<p class=advertisement>{}</p>"])
def test_marked_asides_go(aside):
    noise = aside.format("Some words that are not the story. " * 4)
    assert html.extract_page(f"<body>{MENU}<div class=content>{BODY}</div>{noise}{FOOT}") == TEXT
    assert html.extract_page(f"<body>{MENU}<article>{BODY}{noise}</article>{FOOT}") == TEXT


def test_many_comments_do_not_win():
    comments = "<div class='post-comments'>" + "".join(f"<p>Reader {i} says that it was so.</p>" for i in range(200)) + "</div>"
    assert html.extract_page(f"<body><div class=story>{BODY}</div>{comments}") == TEXT


@pytest.mark.parametrize("page", [
    "<a " * (5_000_000 // 3), "<a '<a \"" * 200_000, "<" * 1_000_000, "<!-- " * 300_000, "<head>" * 200_000, "<![CDATA[" * 200_000,
    "<div class=x>text " * 20_000, "<div>text " * 20_000 + "</span></div></p></li>" * 20_000, "<blockquote>" * 20_000 + "<li>x" * 20_000,
    "<script>" * 300_000, "<p>a<b \"c>" * 100_000, "&amp" * 1_000_000])
def test_time_grows_with_the_page(page):
    started = time.time()
    html.extract_page(f"<body>{page}")
    assert time.time() - started < 25  # linear: seconds on a busy machine


def pages_frame(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_vote_removes_what_the_host_repeats_and_keeps_what_a_page_has(spark):
    """Both directions: an unmarked sidebar, which the page itself would keep, goes
    because the host repeats it; text of one page alone stays."""
    side = "<div class=x1><p>{}</p></div>".format("Read our guide to better gardens, updated every week by the team. " * 3)
    rows = [(i, f"http://h.org/{i}", f"<div class=wrap><div class=story><p>{f'Story number {i} goes on. ' * 12}</p></div>{side}</div>") for i in range(8)]
    rows += [(8, "http://h.org/8", f"<div class=wrap><div class=story><p>{'Story number 8 goes on. ' * 12}</p></div>"
                                   f"<div class=x1><p>{'A postscript that no other page has. ' * 4}</p></div></div>")]
    rows += [(9, "http://other.org/9", rows[0][2])]
    assert "gardens" in html.extract_page(rows[0][2])
    pages = pages_frame(spark, rows)
    furniture = {r.host: r.furniture for r in html.host_furniture(pages).collect()}
    assert list(furniture) == ["h.org"] and len(furniture["h.org"]) == 1
    got = {r.page_id: r.main_text for r in html.extract(pages).collect()}
    for i in range(9):
        assert got[i].startswith(f"Story number {i}") and "gardens" not in got[i]
        assert ("postscript" in got[i]) == (i == 8)
    assert "gardens" in got[9]  # another host, one page: nothing says that it is furniture


def test_copies_of_an_article_are_not_furniture_of_it(spark):
    rows = [(i, f"http://copies.org/{i}", f"<body>{MENU}<div class=story>{BODY}</div>{FOOT}") for i in range(12)]
    assert {r.main_text for r in html.extract(pages_frame(spark, rows)).collect()} == {TEXT}
    rows += [(20 + i, f"http://copies.org/x{i}", f"<body>{MENU}<div class=story><p>{f'Another text {i} of the host. ' * 20}</p></div>") for i in range(20)]
    got = {r.page_id: r.main_text for r in html.extract(pages_frame(spark, rows)).collect()}
    assert all(got[i] == TEXT for i in range(12)) and all(f"Another text {i} " in got[20 + i] for i in range(20))


def test_generated_host_templates(spark):
    """Hosts with templates of their own and noise: the text is the article's, exactly."""
    rnd = random.Random(9)
    rows, want = [], {}
    for h in range(6):
        wrap, story = rnd.choice(["div class=page", "section id=main-content", "div"]), rnd.choice(
            ["article class=post-{n}", "div class='story c{n}'", "div id=entry-{n}", "main"])
        notice = f"<div class=zone{h}><p>{'Our shop has new offers for every season and reader. ' * 3}</p></div>"
        for n in range(10):
            i = 100 * h + n
            parts = [f"Host {h} page {n} paragraph {k} " + " ".join(rnd.choice(["river", "stone", "cloud", "market"]) for _ in range(30))
                     for k in range(rnd.randint(4, 8))]
            body = "".join(f"<p>{p.replace('river', '<b>river</b>')}\n" for p in parts)
            comments = f"<div class=comments><p>{'me too ' * rnd.randint(0, 60)}</p></div>" if n % 2 else ""
            page = (f"<html><head><title>t</title></head><body>{MENU}<{wrap}><{story.format(n=n)}>{body}</{story.split()[0]}>{comments}"
                    f"{notice if n % 5 else ''}</{wrap.split()[0]}>{FOOT}")
            rows.append((i, f"https://host{h}.net/{n}", page))
            want[i] = "\n".join(parts)
    got = {r.page_id: r.main_text for r in html.extract(pages_frame(spark, rows)).collect()}
    assert got == want


def test_clashing_and_extra_columns(spark):
    df = pages_frame(spark, [(1, "http://a.org", f"<p>{'words ' * 9}")]).selectExpr("*", "1 as host", "'x' as path", "2 as furniture", "3 as main_text", "4 as row")
    out = html.extract(df)
    assert set(out.columns) == set(df.columns)
    assert out.first().main_text.startswith("words") and out.first().host == 1
    assert html.extract(df.limit(0)).count() == 0
