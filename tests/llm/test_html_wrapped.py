"""Articles within elements that are named like something beside them, hidden parts, and deep pages."""

import random
import time

import pytest

from assay.llm.html_text import main_text
from tests.llm.test_html_density import _expected, _html, _tree

SENTENCES = [f"Sentence {i} of the article says that the {w} came home before it rained." for i, w in enumerate("cat dog fox hen owl bee ant cow emu elk".split() * 2)]
ARTICLE = " ".join(SENTENCES)


@pytest.mark.parametrize("opening", [
    '<form id="aspnetForm">', '<div class="post ad-free">', '<div class="article share-price">', '<div id="search-result-page">', '<div class="elementor-widget-container">',
    '<div class="text-center cookie-recipes">', '<form><div class="widget"><section class="banner">', '<div class="menu"><form action="x">',
])
def test_wrapped_articles_stay(opening):
    nav = '<nav><a href="/">Home</a></nav><div class="sidebar">Links</div>'
    assert main_text(f"<body>{nav}{opening}<p>{ARTICLE}</p></body>") == ARTICLE


@pytest.mark.parametrize("extra", [
    "<div hidden>Not to be seen here at all.</div>", "<div aria-hidden='true'>Not to be seen.</div>", "<p class=x hidden=''>Not seen</p>", '<div class="toc"><a href="#a">One</a> <a href="#b">Two</a></div>',
    '<div id="table-of-contents"><a href="#a">One</a></div>', '<section class="discussion"><p>Great read, thanks a lot!</p><p>I do not agree.</p></section>', '<div class="comment-list"><p>Nice.</p></div>',
    '<div class="cookie-notice">We use cookies.</div>', '<div class="share-buttons">Tweet</div>', '<div class="ad-container">Buy now</div>', '<form><label>Mail</label></form>', '<div class="google-ads">Buy</div>',
])
def test_parts_beside_go(extra):
    page = f"<body><div><p>{ARTICLE}</p>{extra}</div></body>"
    assert main_text(page) == ARTICLE
    assert main_text(f"<body>{extra}<div><p>{ARTICLE}</p></div></body>") == ARTICLE


def test_attributes_that_only_speak_of_hiding():
    for opening in ('<div title="a hidden gem">', '<div data-x=" hidden ">', '<div aria-hidden="false">', "<div class='hidden-gem'>", '<div data-hidden="1">'):
        assert main_text(f"{opening}<p>{ARTICLE}</p></div>") == ARTICLE


def test_long_comments_are_no_article():
    comments = "".join(f"<p>{s} I say so.</p>" for s in SENTENCES * 3)
    assert main_text(f'<body><div><p>{ARTICLE}</p></div><div class="comments">{comments}</div></body>') == ARTICLE
    assert main_text(f'<body><div class="comments">{comments}</div></body>') == ""


@pytest.mark.parametrize("opening", ["<b>", "<div>", "<div class=ad>", "<form>", "<div><b>", "<p><span>", "<ul><li>"])
def test_deep_pages_take_linear_time(opening):
    took = []
    for n in (12_500, 100_000):
        began = time.process_time()
        main_text(opening * n + ARTICLE)
        took.append(time.process_time() - began)
    assert took[1] < 20 * took[0] + 0.5


@pytest.mark.parametrize("seed", range(30))
def test_choice_with_parts_left_out(seed):
    """What isn't the article may stand anywhere among the blocks: the choice is that of the tree without it."""
    r = random.Random(seed)
    page = ("#page", [("body", [_tree(r) for _ in range(r.randrange(2, 5))])])
    beside = ["<nav><a>x y</a></nav>", '<div class="ad"><p>x<p>y</div>', "<aside>x</aside>", "<form>x<div>y</div></form>", "<script>if (a<b) x</script>", "<div hidden>x</div>"]
    parts = _html(page[1][0]).split("<div>")
    assert main_text("".join(x + (r.choice(beside) + "<div>" if i + 1 < len(parts) else "") for i, x in enumerate(parts))) == _expected(page)
