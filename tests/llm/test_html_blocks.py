from scorewright.llm.html_text import main_text

PARAS = [" ".join(f"word{i}x{k}" for k in range(40)) for i in range(10)]
PROSE = "".join(f"<p>{p}</p>" for p in PARAS)
PLAIN = " ".join(PARAS)
LINKS = "".join(f'<li><a href="/{i}">A headline about something number {i}</a></li>' for i in range(8))


def test_title_lead_and_close_beside_the_best_block():
    assert main_text(f"<body><h1>Title</h1><p>Lead</p><div>{PROSE}</div><p>Close</p></body>") == f"Title Lead {PLAIN} Close"


def test_every_chapter_stays():
    short = f"<div class=chapter><div class=text><h2>Two</h2><p>{PARAS[0]}</p><p>End.</p></div></div>"
    got = main_text(f"<body><div class=chapter><div class=text>{PROSE}</div></div>{short}</body>")
    assert got == f"{PLAIN} Two {PARAS[0]} End."


def test_every_article_stays():
    got = main_text(f"<body><div><ul>{LINKS}</ul></div><article>{PROSE}</article><article><p>Short one.</p></article></body>")
    assert got == f"{PLAIN} Short one."
    many = "".join(f"<article><h2>T{i}</h2><p>{p}</p></article>" for i, p in enumerate(PARAS))
    assert main_text(f"<body><ul>{LINKS}</ul>{many}</body>") == " ".join(f"T{i} {p}" for i, p in enumerate(PARAS))


def test_link_lists_go():
    got = main_text(f"<body><div><ul>{LINKS}</ul></div><h1>Title</h1><div>{PROSE}</div><div><b>More</b><ul>{LINKS}</ul></div><p>Close</p></body>")
    assert got == f"Title {PLAIN} Close"
