"""Class names that describe a page are no marks of parts that go."""

import pytest

from tillspark.llm import wrappers

FORMS = [
    ("<article class='post no-sidebar'>%s</article>", True),
    ("<main class='has-sidebar'>%s</main>", True),
    ("<article class='post comments-open'>%s</article>", True),
    ("<article class='notice'>%s</article>", True),
    ("<div class='content with-sidebar'><article>%s</article></div>", True),
    ("<div class='content comments-closed'>%s</div>", True),
    *((f"<div class='{name}'>%s</div>", True) for name in (
        "entry-header", "post-side", "promo-story", "alert-news", "search-result-body", "article-share-count",
    )),
    *((f"<div class='{name}'>%s</div>", False) for name in (
        "site-footer", "cookie-banner", "comment_list", "main-nav", "ad-slot", "Social-Share",
    )),
    ("<div class='sidebar'>%s</div>", False),
    ("<div class='widget-area'>%s</div>", False),
    ("<main><p>Body</p><article class='comment'>%s</article></main>", False),
    ("<main><article class='post sidebar'>%s</article></main>", True),
]


@pytest.mark.parametrize("form, stays", FORMS)
def test_names_of_parts(form, stays):
    page = "<body><nav>Menu</nav>" + form % "<p>The text itself</p>" + "</body>"
    verdicts = wrappers.judged(wrappers.folded(wrappers.parsed(page)))
    found = wrappers.extracted(page, verdicts)
    assert ("The text itself" in found) is stays
    assert "Menu" not in found


def wrapper_of(pages):
    whole = wrappers.folded(wrappers.parsed(pages[0]))
    for page in pages[1:]:
        wrappers._merged(whole, wrappers.folded(wrappers.parsed(page)))
    return whole


TEMPLATE = (
    "<body><div class='x1'><p>Read us daily</p></div>%s<div class='x2'>All rights <b>kept</b> 2020</div>%s</body>"
)


@pytest.mark.parametrize("form", ["<div class='body'><h1>%s</h1><p>%s</p></div>", "<article><h1>%s</h1><p>%s</p><div class='by'>By our desk</div></article>"])
def test_text_that_all_pages_share_goes_whatever_its_name(form):
    pages = [TEMPLATE % (form % (f"Title {k}", f"Story number {k} <a href='#'>more</a> of it"), "") for k in range(50)]
    pages[7] = TEMPLATE % (form % ("Title 7", "Story seven"), "<div class='extra'>Only here</div>")
    verdicts = wrappers.judged(wrapper_of(pages))
    found = [wrappers.extracted(page, verdicts) for page in pages]
    assert found[3] == "Title 3 Story number 3 more of it"
    only = "" if "article" in form else " Only here"
    assert found[7] == f"Title 7 Story seven{only}"
    assert wrapper_of(pages[::-1])[3] == 50


def test_pages_that_are_all_alike_keep_their_text():
    page = "<body><div class='body'><p>Same on all pages</p></div></body>"
    verdicts = wrappers.judged(wrapper_of([page] * 20))
    assert wrappers.extracted(page, verdicts) == "Same on all pages"


def test_names_of_their_own_on_every_page_do_not_grow_the_wrapper():
    words = [a + b + c for a in "bcdefghijk" for b in "abcdefghij" for c in "klmnopqrst"]
    pages = [f"<body><div class='menu'>m</div><div id='{w}' class='post-{w}'><p>About {w}</p></div></body>" for w in words]
    whole = wrapper_of(pages)
    assert len(whole[6][0][6]) <= wrappers.MOST_PARTS + 1
    verdicts = wrappers.judged(whole)
    assert all(wrappers.extracted(p, verdicts) == f"About {w}" for p, w in zip(pages, words))
