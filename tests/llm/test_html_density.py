"""The choice of the main text, held against a plain version over trees."""

import math
import os
import random
import re
from collections import Counter

import pytest

from assay.llm.html_text import main_text

BLOCKS = {"body", "div", "section", "p", "h1", "article"}


def _tree(r, depth=0):
    """(tag, children): blocks of blocks, or of texts with inline elements."""
    if depth < 3 and r.random() < 0.7 - 0.15 * depth:
        return (r.choice(["div", "section", "article"]), [_tree(r, depth + 1) for _ in range(r.randrange(1, 5))])
    text = lambda most: " ".join("w" * r.randrange(1, 9) for _ in range(r.randrange(1, most)))
    parts = [text(r.choice([4, 60]))]
    for _ in range(r.randrange(3)):
        parts += [(r.choice(["a", "b", "a"]), [text(6)]), text(9)]
    return (r.choice(["p", "p", "h1" if r.random() < 0.1 else "p", "div"]), parts)


def _html(node):
    return node if isinstance(node, str) else f"<{node[0]}>{''.join(map(_html, node[1]))}</{node[0]}>"


def _below(node):
    for child in node[1]:
        if not isinstance(child, str):
            yield child
            yield from _below(child)


def _chars(node, linked=False):
    """Characters, and those in links, without spaces."""
    if isinstance(node, str):
        n = len(node.replace(" ", ""))
        return n, n * linked
    pairs = [_chars(c, linked or node[0] == "a") for c in node[1]]
    return sum(a for a, _ in pairs), sum(b for _, b in pairs)


def _density(node, page):
    """Characters for each tag, adjusted by links, as published for composite text density."""
    chars, links = _chars(node)
    if not chars:
        return 0.0
    tags, link_tags = max(len(list(_below(node))), 1), max(sum(t == "a" for t, _ in _below(node)), 1)
    all_chars, all_links = _chars(page)
    base = math.log(chars / max(chars - links, 1) * links + all_links / max(all_chars, 1) * chars + math.e)
    return chars / tags * math.log(max(chars / max(links, 1) * tags / link_tags, 1) + 1) / max(math.log(base + 1), 0.1)


def _sum(node, page):
    blocks = [c for c in node[1] if not isinstance(c, str) and c[0] in BLOCKS]
    return sum(_density(c, page) for c in blocks) if blocks else _density(node, page)


def _blocks(node):
    if isinstance(node, str):
        return node
    inner = "".join(map(_blocks, node[1]))
    return f"\n{inner}\n" if node[0] in BLOCKS else inner


def _expected(page):
    body = page[1][0]
    nodes = [body, *_below(body)]
    best = max((n for n in nodes if n[0] in BLOCKS), key=lambda n: _sum(n, page))
    # The first of equal sums in page order.
    best = next(n for n in nodes if n[0] in BLOCKS and _sum(n, page) == _sum(best, page))
    path = [n for n in nodes if n is best or any(c is best for c in _below(n))]
    least = min(_density(n, page) for n in path)
    chosen = []
    for n in nodes:
        if n is best or any(c is n for above in path if above is not best for c in above[1]) and not any(n is p for p in path):
            headed = n[0] == "h1" or any(t == "h1" for t, _ in _below(n))
            if n is best or _chars(n)[0] and (headed or max(_density(n, page), _sum(n, page) if n[0] in BLOCKS else _density(n, page)) >= least):
                chosen.append(n)
    return "\n".join(" ".join(x.split()) for n in chosen for x in _blocks(n).split("\n") if x.strip())


@pytest.mark.parametrize("seed", range(60))
def test_choice_is_the_plain_one(seed):
    r = random.Random(seed)
    page = ("#page", [("body", [_tree(r) for _ in range(r.randrange(1, 5))])])
    assert main_text(_html(page[1][0])) == _expected(page)


PAGES = "/root/testdata/sf0.01/pages.parquet"


@pytest.mark.skipif(not os.path.exists(PAGES), reason="no pages")
def test_names_of_elements_play_no_part():
    import pyarrow.parquet as pq

    recalls = []
    for page in pq.read_table(PAGES, columns=["html"])["html"].to_pylist():
        article = Counter(main_text("".join(re.findall(r"(?s)<article>.*?</article>", page))).split())
        found = Counter(main_text(re.sub(r"<(/?)(?:article|main)\b", r"<\1div", page)).split())
        recalls.append((sum((article & found).values()) + 1) / (sum(article.values()) + 1))
        assert sum((found - article).values()) == 0
    assert sum(recalls) / len(recalls) >= 0.99 and min(recalls) >= 0.9
