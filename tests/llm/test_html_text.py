import random

from renewlens.llm import html_text as H


def text(page):
    return H.main_text(H.page_blocks(page, None), frozenset())


def test_article_without_what_surrounds_it():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><article>no</article>";</script></head>
    <body><header>Top</header><nav><ul><li><a href="/a>b">Menu</a></ul></nav><div class="cookie-notice">Cookies!</div>
    <article><header><h1>Head &amp; line</h1></header><p>One <b>bold</b>
       word.<p title="a>b">Two&nbsp;spaces<br>three &lt;tag&gt; &#233;</p><!-- <p>hidden</p> --><form><input value=x>Send</form>
    <aside>Side</aside><div class="ad x">Buy</div><section id="comments"><p>First!</p></section><p hidden>gone</p><ul><li>a<li>b</ul></article>
    <div id=sidebar>Bar</div><footer>&copy; x</footer>"""
    assert text(page) == "Head & line\nOne bold word.\nTwo spaces\nthree <tag> é\na\nb"


def test_pages_without_article_and_broken_pages():
    assert text("<body><nav>m</nav><div>Some <i>text</i></div>tail<footer>f</footer>") == "Some text\ntail"
    assert text(None) == text("") == text("<!-- open <p>x</p>") == text("<script>x") == ""
    assert text("a < b and <b>c") == "a < b and c"
    assert text('<p class="x>unclosed <p>second') == "unclosed\nsecond"
    assert text("<div>" * 3000 + "deep" + "</div>" * 3000) == "deep"
    assert text("plain") == "plain" and text("x</p></div>y") == "xy"


def plain_weight(a, b):
    if a.label != b.label:
        return 0
    x, y = a.elements, b.elements
    m = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i in range(len(x)):
        for j in range(len(y)):
            m[i + 1][j + 1] = max(m[i][j + 1], m[i + 1][j], m[i][j] + plain_weight(x[i], y[j]))
    return 1 + m[-1][-1]


def test_tree_matching_equals_the_plain_recursion():
    rng = random.Random(1)

    def tree(depth):
        tag = rng.choice(["div", "span", "b"])
        return f"<{tag}>" + "".join(tree(depth - 1) for _ in range(rng.randrange(0, 4) if depth else 0)) + f"</{tag}>"

    for _ in range(60):
        a, b = H.parse(tree(3)), H.parse(tree(3))
        assert H._weight(a, b, {}) == plain_weight(a, b)
        H.own_slots(b, 1)
        H.align(a, b)
        slots = {n.slot for n in walk(b)}
        assert sum(n.slot in slots for n in walk(a)) >= plain_weight(a, b)


def walk(n):
    yield n
    for c in n.elements:
        yield from walk(c)


def page(i, extra=""):
    return f"<html><body>{extra}<div><p>Subscribe to our letter</p></div><div><h1>Story {i}</h1><p>Body {i} of it.</p></div><div><p>All rights reserved</p></div></body></html>"


def test_constant_slots_are_template_and_varying_ones_content(spark):
    rows = [(i, f"http://News.example.com:80/{i}", page(i, "<div class=x><p>Breaking</p></div>" if i % 4 == 0 else ""), "c") for i in range(12)]
    rows += [(100 + i, f"http://two.example.com/{i}", page(i), "c") for i in range(2)]
    rows += [(200, None, page(200), "c"), (201, "http://News.example.com/z", None, "c"), (202, "http://News.example.com/y", "", "c"), (203, "nohost", "<p>x", "c"), (None, "http://News.example.com/0", page(1), "c"), (3, rows[3][1], rows[3][2], "c")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, skeleton string").repartition(4)
    got = {}
    for r in H.extract(df).collect():
        got.setdefault(r.page_id, []).append(r.text)
        assert r.n_chars == len(r.text)
    for i in range(12):
        assert got[i][0] == ("Breaking\n" if i % 4 == 0 else "") + f"Story {i}\nBody {i} of it."
    assert got[100] == ["Subscribe to our letter\nStory 0\nBody 0 of it.\nAll rights reserved"]
    assert got[200][0].startswith("Subscribe") and got[201] == [""] and got[202] == [""] and got[203] == ["x"] and got[None] == ["Story 1\nBody 1 of it."] and len(got[3]) == 2
    assert H.extract(df.limit(0)).collect() == []
