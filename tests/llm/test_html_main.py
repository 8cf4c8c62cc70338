import random
import time

import pytest

from renewlens.llm import html_text as H


def text(page):
    return H.main_text(H.page_blocks(page, None), frozenset())


@pytest.mark.parametrize("page, want", [
    ('<div class="main-menu"><p>Home</p></div><div class="content"><p>The article itself.</p></div>', "The article itself."),
    ('<div class="main-header"><p>Site</p></div><div class="content"><p>The article itself.</p></div><div class="main-footer"><p>Imprint</p></div>', "The article itself."),
    ('<div id="main-top"><p>Top</p></div><main><p>The article itself.</p></main>', "The article itself."),
    ('<div role="main"><p>The article itself.</p></div><div><p>Other text, longer than the article is.</p></div>', "The article itself."),
    ('<div class="wide main-content"><p>The article.</p></div><div><p>Other</p></div>', "The article."),
    ("<article><p>Energy is <math><mi>E</mi><mo>=</mo><mi>m</mi></math> here.</p></article>", "Energy is E=m here."),
    ("<article><p>A teaser.</p></article><p>The long text of the page goes on and on.</p><p>And on.</p>", "A teaser.\nThe long text of the page goes on and on.\nAnd on."),
    ("<article><p>The long text of the page goes on and on.</p></article><p>Around.</p>", "The long text of the page goes on and on."),
    ('<article><p class="recommended">First</p><blockquote class="social">Second</blockquote><fieldset>Third</fieldset><p class="ad">Buy</p></article>', "First\nSecond\nThird"),
    ('<article><p>First</p><div class="recommended"><p>Else</p></div><form><fieldset>Name</fieldset></form></article>', "First"),
])
def test_main_part(page, want):
    assert text(page) == want


def tree(rng, depth=0):
    tag = rng.choice(["div", "p", "ul"])
    return f"<{tag}>" + "".join(tree(rng, depth + 1) for _ in range(rng.randrange(4 - depth) if depth < 3 else 0)) + f"</{tag}>"


def test_alignment_by_rows_equals_the_table(monkeypatch):
    rng = random.Random(4)
    for _ in range(150):
        a, b = ("<section>" + "".join(tree(rng) for _ in range(rng.randrange(9))) + "</section>" for _ in range(2))
        got = []
        for most in (10**9, -1):
            monkeypatch.setattr(H, "BEST_PAIRS", most)
            x, y = H.parse(a).elements[0], H.parse(b).elements[0]
            weight = H._weight(x, y, {})
            pairs = H._matched(x.elements, y.elements, {})
            got.append((weight, pairs))
        assert got[0] == got[1]


def test_many_siblings_are_aligned_best():
    # in order, the first p of the page would take the skeleton's last one
    page = "<body>" + "<div></div>" * 300 + "<p>x</p>" * 300 + "</body>"
    skeleton = "<body>" + "<p>x</p>" * 10 + "<div></div>" * 300 + "<p>x</p>" * 290 + "</body>"
    a, b = H.parse(page).elements[0], H.parse(skeleton).elements[0]
    assert len(H._matched(a.elements, b.elements, {})) == 590
    big = H.parse("<body>" + "<p><b>x</b></p>" * 4000 + "</body>").elements[0], H.parse("<body>" + "<p><b>x</b></p>" * 3999 + "</body>").elements[0]
    start = time.time()
    assert H._weight(*big, {}) == 1 + 2 * 3999 and time.time() - start < 20
