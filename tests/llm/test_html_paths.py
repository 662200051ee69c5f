"""Pages on which op5_html_extraction has to decide by its path scores."""

import math
import time

import pytest

from billing_guard.llm.htmltext import main_text, path_scores, read_page, weigh_names

LONG = "A long paragraph, with many words, commas and more; it goes on and on. It has a second sentence, too."


def test_scores_select_on_pages_with_articles():
    teaser = "<article class=card><p>Short.</p></article>"
    page = f"<body><div><article><p>{LONG}</p><p>End</p></article></div><div><p>{LONG}</p></div><footer>f</footer></body>"
    assert main_text(page) == f"{LONG}\nEnd\n{LONG}"  # content beside the article
    two = f"<body><main><article><p>{LONG}</p></article><article><h2>Next</h2></article></main>{teaser}</body>"
    assert main_text(two).startswith(f"{LONG}\nNext")  # an article without a node above the threshold


def test_an_article_below_the_threshold_does_not_hide_the_content():
    page = f"<body><div class=story><p>{LONG}</p><p>{LONG}</p></div><article><h3>More</h3></article></body>"
    assert LONG in main_text(page)


@pytest.mark.parametrize("names", ["post tag-news", "content no-sidebar", "page-content sidebar-right",
                                   "entry has-header"])
@pytest.mark.parametrize("tag", ["article", "div"])
def test_a_furniture_name_around_the_article_does_not_lose_it(names, tag):
    page = (f"<body><nav><a href=/>Home</a></nav><div class='{names}'><{tag}><h1>Title</h1><p>{LONG}</p><p>End</p>"
            f"</{tag}></div><div class=ad>Buy, now!</div></body>")
    assert main_text(page) == f"Title\n{LONG}\nEnd"


def test_a_long_advert_beside_a_short_article_stays_out():
    assert main_text(f"<body><div class=ad>{LONG}</div><article><h1>T</h1><p>A b.</p></article></body>") == "T\nA b."


def test_a_lead_beside_the_body_stays():
    lead, body = LONG, "\n".join([LONG] * 6)
    page = (f"<body><div class=story><div class=lead><p>{lead}</p></div><div class=body>"
            + "".join(f"<p>{x}</p>" for x in body.split("\n")) + "</div></div></body>")
    assert main_text(page) == f"{lead}\n{body}"


@pytest.mark.parametrize("page, text", [
    ("<p><b>Hello</b> <i>world</i></p>", "Hello world"), ("<p><b>a</b>\n<i>b</i><u>c</u></p> <p>d</p>", "a bc\nd"),
    ("<article> <p> <b>x</b> </p> </article>", "x")])
def test_white_space_between_inline_elements_stays(page, text):
    assert main_text(page) == text


COMMENT = f"<p>{LONG} I said so before!</p>"


@pytest.mark.parametrize("page", [
    f"<body><div id=content><p>{LONG}</p><p>{LONG}</p><ol class=commentlist>{'<li>' + COMMENT * 4}</ol></div>",
    f"<body><article><p>{LONG}</p><p>{LONG}</p></article><div class='comments'>{COMMENT * 5}</div>",
    f"<body><article><p>{LONG}</p><p>{LONG}</p><section class=comments>{COMMENT * 5}</section></article>",
    f"<body><article><p>{LONG}</p><p>{LONG}</p></article><ol class=commentlist><li><article class=comment>{COMMENT * 5}"
    "</article></ol>"])
def test_comments_never_come_in_by_majority(page):
    assert main_text(page) == f"{LONG}\n{LONG}"


def test_a_name_of_content_needs_the_texts_support_inside_an_article():
    page = (f"<body><article><p>{LONG}</p><p class='legal'>{LONG}</p><div class='related-work'><p>{LONG}</p></div>"
            "<div class='tags'><a href=/x>one tag</a> <a href=/y>another tag</a></div><p class=notice>Short.</p></article>")
    assert main_text(page) == "\n".join([LONG] * 3)


def test_a_menu_name_around_the_heading_does_not_lose_the_article():
    assert main_text(f"<body class=x><div class='page menu-open'><h1>Title</h1><p>{LONG}</p></div>") == f"Title\n{LONG}"


@pytest.mark.parametrize("page", ["<div>" * 4_000 + f"<p>{LONG}</p>" * 4_000, "<div class=side>" * 4_000 + "<li>x" * 4_000,
                                  "<ul><li>" * 3_000 + f"{LONG}<td>" * 3_000, "<p>" * 20_000 + "x</div>" * 20_000])
def test_time_is_linear_in_deep_pages(page):
    start = time.perf_counter()
    main_text("<body>" + page)
    assert time.perf_counter() - start < 5  # about a fifth of a second; the square took minutes


def test_path_scores_against_their_formula():
    page = (f"<body><h1>T, a</h1><div class=a><p>{LONG}</p><p>b. c</p></div><div><a href=/>link, text</a> tail</div>"
            f"<article><p>{LONG}</p></article><div class=related><a href=/x>{LONG}</a></div>")
    elements, nodes = read_page(page)
    weigh_names(elements, nodes)

    def path(e):
        return () if e.parent is None else (*path(e.parent), e.tag, e.path)

    paths = [path(n.element) for n in nodes]
    assert len({p[-1] for p in paths}) == len(set(paths))
    ratio, marks = [], []
    for p in paths:
        same = [n for n, q in zip(nodes, paths) if q == p]
        ratio.append(max(0, sum(-len(n.text) if n.link else len(n.text) for n in same)) / len(same))
        marks.append(sum(sum(c in ".,;:!?" for c in n.text) for n in same if not n.link) / len(same))
    weights = [math.exp(-d * d / 2) for d in range(-3, 4)]

    def smooth(x, i):
        near = [x[min(max(i + d, 0), len(x) - 1)] for d in range(-3, 4)]
        return sum(w * v for w, v in zip(weights, near)) / sum(weights)

    fused = []
    for i, n in enumerate(nodes):
        f = smooth(ratio, i) * (1 + smooth(marks, i)) * (2 if n.element.article else 1)
        if n.element.dropped:
            f = 0.1 * min(f, ratio[i] * (1 + marks[i]))
        fused.append(f)
    mean = sum(fused) / len(fused)
    deviation = math.sqrt(sum((f - mean) ** 2 for f in fused) / len(fused))
    expected = [f >= 0.5 * (max(deviation, mean) if n.element.dropped else deviation) for f, n in zip(fused, nodes)]
    assert path_scores(nodes) == expected and any(expected) and not all(expected)
    assert any(n.element.dropped for n in nodes)
