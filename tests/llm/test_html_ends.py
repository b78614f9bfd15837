"""Elements beside the article end as others do: by what follows and with their parent."""

import pytest

from assay.llm.html_text import main_text


@pytest.mark.parametrize(
    "page, text",
    [
        ('<p class="notice">X<p>Real</p><div>More</div>', "Real\nMore"),
        ("<ul><li class=share>a<li>Real</ul>Z", "Real\nZ"),
        ("<div><form>f</div><p>Real", "Real"),
        ("<div><aside><b>ad</div>Real", "Real"),
        ("<html><head><title>t</title><p>Real", "Real"),
        # What a skipped element holds doesn't end it.
        ("<div>a<table class=ad><tr><td>x</div>y</td></tr></table>Real</div>", "a\nReal"),
        ("<div>A<div class=ad><p>x<div>y</div></div>B</div>", "A\nB"),
        ("<p>a<button><div>z</div></button>b</p>", "ab"),
    ],
)
def test_skipped_elements_end(page, text):
    assert main_text(page) == text


def test_broken_markup_in_skipped_elements():
    for broken in ("<p><button><div>", "<div class=ad><td><b></div>", "<svg><li></span>"):
        main_text("<p>text" + broken * 20_000)
