import pytest

from renewlens.llm import html_text as H


def text(page):
    return H.main_text(H.page_blocks(page, None), frozenset())


@pytest.mark.parametrize("page", [
    '<body><article><p style="overflow:hidden">Text</p></article></body>',
    '<body><article><p title="The hidden valley" data-title="display: none">Text</p></article></body>',
    '<body class="post has-sidebar"><article><p>Text</p></article></body>',
    '<html class="no-sidebar comment-open"><body id="sidebar"><p>Text</p></body></html>',
    '<body><article class="comment-open"><p>Text</p></article></body>',
    '<body><div class="content-with-sidebar"><p>Text</p></div></body>',
    '<body><article><h1 class="entry-header">Text</h1></article></body>',
    '<body><div class="widget"><main><p>Text</p></main></div><div class="widget">Other</div></body>',
])
def test_loose_names_keep_the_article(page):
    assert text(page) == "Text"


@pytest.mark.parametrize("attributes", [
    "hidden", 'hidden=""', 'aria-hidden="true"', 'style="color:red; display : none"', 'style="display:none!important"', "class=ad", 'class="x sidebar"',
    'id="site-footer"', 'class="cookie-notice"', 'class="post-comments"', 'role="complementary"', 'class="ad_box-2"',
])
def test_what_surrounds_the_article_still_goes(attributes):
    assert text(f"<body><article><p>Text</p><div {attributes}>Gone</div></article></body>") == "Text"


def test_teasers_in_dropped_boxes_go_where_the_page_has_its_own_article():
    assert text('<body><article><p>Text</p></article><div class="related"><article><p>Teaser</p></article></div></body>') == "Text"
