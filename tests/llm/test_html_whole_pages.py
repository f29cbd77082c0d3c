import time

import pytest

from scorewright.llm.html_text import main_text

TEXT = "A paragraph of the article with words enough to count as text, and then some more of them. " * 6
MENU = "<ul>" + "".join(f"<li><a href=/{k}>entry {k}</a></li>" for k in range(8)) + "</ul>"


@pytest.mark.parametrize("page", [
    f"<body><form id=aspnetForm><div><p>{TEXT}</p><input type=hidden value=x><button>Go</button></div></form></body>",
    f"<body><form><div><p>{TEXT}</p></div></body>",
    f"<body><nav>{MENU}<div><p>{TEXT}</p></div></body>",
    f"<body><fieldset><p>{TEXT}</p></fieldset></body>",
    f"<body><aside><footer><p>{TEXT}</p></body>",
])
def test_wrapped_and_unclosed(page):
    assert TEXT.strip() in main_text(page)
    assert "Go" not in main_text(page)


def test_small_forms_go():
    page = f"<body><div><p>{TEXT}</p></div><form><label>Name</label><select><option>one</select><p>Send us a note</p></form></body>"
    assert main_text(page) == TEXT.strip()


def test_many_unclosed_and_deep_pages_are_read_in_time():
    start = time.time()
    assert TEXT.strip() in main_text("<div>" * 20_000 + f"<p>{TEXT}</p>")
    assert TEXT.strip() in main_text("<nav><aside><menu>" * 2000 + f"<p>{TEXT}</p>")
    assert time.time() - start < 6
