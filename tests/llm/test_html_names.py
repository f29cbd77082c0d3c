import pytest

from scorewright.llm.html_text import main_text

TEXT = "<p>First paragraph of the article, with some words.</p><p>Second paragraph of it.</p>"
PLAIN = "First paragraph of the article, with some words. Second paragraph of it."


@pytest.mark.parametrize("page, text", [
    (f'<div class="content overflow-hidden">{TEXT}</div>', PLAIN),
    (f'<div style="overflow:hidden">{TEXT}</div>', PLAIN),
    (f'<div data-hidden="no" title="hidden costs">{TEXT}</div>', PLAIN),
    ('<article><p>About <a href="/blog/hidden-costs">hidden costs</a> here.</p></article>', "About hidden costs here."),
    (f'<div class="post has-sidebar">{TEXT}</div>', PLAIN),
    (f'<article>{TEXT}<section id="related-work"><p>Others did so too.</p></section></article>', PLAIN + " Others did so too."),
    (f'<article><h2 id="social-history">Past</h2>{TEXT}<h2 id="navigation">Way</h2></article>', f"Past {PLAIN} Way"),
    (f'<article><span class="ad">Notes</span>{TEXT}</article>', f"Notes {PLAIN}"),
    (f'<body><div class="notice">{TEXT}</div></body>', PLAIN),
    (f'<body><div class="sidebar">{TEXT}</div><article><p>The article.</p></article></body>', "The article."),
    (f'<article>{TEXT}<div hidden>x y</div><div aria-hidden="true">x</div><p style="color:red; display: none">y</p></article>', PLAIN),
    (f'<article>{TEXT}<div class="related-posts">x</div><ul id="comment_list"><li>y</ul><div class="a share-buttons">z</div></article>', PLAIN),
    (f'<article>{TEXT}<p hidden="until-found">Found.</p></article>', PLAIN + " Found."),
])
def test_names(page, text):
    assert main_text(page) == text
