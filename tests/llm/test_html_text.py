import pytest

from scorewright.llm.html_text import extract_main_text, main_text

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><p>no";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/a">Home</a></li><li><a href="/b">About</a></li></ul></nav>
<!-- ad --><div class="ad">Buy now</div>%s<aside><p>Related story</p></aside><footer>&copy; Site</footer></body></html>"""
BODY = "<h1>The  title</h1><p>First <b>bold</b> para&shy;graph, quite long &amp; dense.<br>Next line.</p><p>Second paragraph &lt;ok&gt; with more words in it.</p>"
TEXT = "The title First bold para­graph, quite long & dense. Next line. Second paragraph <ok> with more words in it."


@pytest.mark.parametrize("page, text", [
    (PAGE % f"<article>{BODY}</article>", TEXT),
    (PAGE % f"<main>{BODY}</main>", TEXT),
    (PAGE % f'<div id="content">{BODY}</div>', TEXT),
    (PAGE % f'<article>{BODY}<div class="comments"><p>A reader says a lot of things here, on and on.</p></div><form><p>Send</p></form></article>', TEXT),
    (PAGE % f'<div class="wrap"><div class="sidebar"><p>side text</p></div><div>{BODY}</div><div class="cookie-notice">We use cookies</div></div>', TEXT),
    ("", ""),
    ("   ", ""),
    ("no markup at all, &eacute;", "no markup at all, é"),
    ("<p>a < b and c > d</p>", "a < b and c > d"),
    ("<article><p>open <b>never closed<p>next</article>", "open never closed next"),
    ("<article><p>cut in a ta</p><p cla", "cut in a ta"),
    ("<article><p>text<!-- never closed <p>gone", "text"),
    ("<article><p>x<script>if (a<b) {</script>y</p></article>", "xy"),
    ("<table><tr><td>a<td>b<tr><td>c</table>", "a b c"),
    ("<article><p>one &#65;&#x42; &am &amp two</p></article>", "one AB &am & two"),
])
def test_pages(page, text):
    assert main_text(page) == text


def test_links_do_not_win():
    links = "".join(f'<li><a href="/{i}">A headline about something number {i}</a></li>' for i in range(40))
    prose = "".join(f"<p>Paragraph {i} holds a sentence that goes on for quite a while without any link.</p>" for i in range(5))
    got = main_text(f"<body><div><ul>{links}</ul></div><div>{prose}</div></body>")
    assert got.startswith("Paragraph 0") and "headline" not in got


def test_long_page_is_whole():
    body = "".join(f"<p>word{i} and some more text</p>" for i in range(30_000))
    assert len(main_text(f"<article>{body}</article>").split()) == 150_000


def test_operator(spark):
    rows = [(1, "u", PAGE % f"<article>{BODY}</article>", "x"), (2, None, None, None), (3, "v", "", "y"), (3, "v", "", "y")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = extract_main_text(df)
    assert got.columns == ["page_id", "url", "text"]
    assert sorted((r.page_id, r.text) for r in got.collect()) == [(1, TEXT), (2, ""), (3, ""), (3, "")]
    assert extract_main_text(df.limit(0)).collect() == []
