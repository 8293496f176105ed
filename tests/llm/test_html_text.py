from __future__ import annotations

import pytest

from forktide.llm.html_text import extract, main_text
from tests.llm.conftest import prose

CASES = [
    (None, ""),
    ("", ""),
    ("plain words", "plain words"),
    ("<p>a&amp;b &lt;c&gt;&nbsp; d\n e</p>", "a&b <c> d e"),
    ("<p>one<p>two < three", "one\n\ntwo < three"),
    ("<article><h1>T</h1><p>x<br>y</p></article><footer>f</footer>", "T\n\nx y"),
    ("<nav><ul><li><a href=a>A</a></ul></nav><article><p>x</article><aside>s</aside>", "x"),
    ("<article><p>x</p><div class='ad'>buy</div><section id='comments'><p>c</p></section></article>", "x"),
    ("<div class='page-with-sidebar'><article><p>x</p></article></div>", "x"),
    ("<div class='sidebar'><p>side</p></div><div><p>main text here</p></div>", "main text here"),
    ("<script>var t='</p>';</script><style>p{}</style><!-- c --><p>x</p><form>name</form>", "x"),
    ("<ul><li>a<li>b</ul>", "a\n\nb"),
    ("<p>x <b>bold</b>er</p><p hidden>h</p><p style='display:none'>n</p>", "x bolder"),
    ("<article><p>a <script>unclosed", "a"),
]


@pytest.mark.parametrize("html,text", CASES)
def test_cases(html, text):
    assert main_text(html) == text


def test_deep_and_long_pages_are_read():
    assert main_text("<div>" * 20_000 + "x") == "x"
    assert main_text("<article>" + "<p>word</p>" * 20_000 + "</article>").count("word") == 20_000


def test_short_sections_between_adverts_beside_one_long_paragraph():
    advert = "<div class=ad><p>buy</p><p>now</p><p>here</p></div>"
    short = [f"Section {i} has a few words." for i in range(6)]
    long = "word " * 600
    for page in (
        f"<body><div><p>{long}</p>{advert}{advert.join(f'<p>{s}</p>' for s in short)}</div></body>",
        f"<body><section><p>{long}</p></section>{advert}{advert.join(f'<section><p>{s}</p></section>' for s in short)}</body>",
    ):
        assert main_text(page) == "\n\n".join([long.strip(), *short])
    # Not one container: long enough by itself, or not.
    other = "x" * 90
    page = f"<div><p>{long}</p></div>{advert}<div><p>{other}</p></div>{advert}<div><p>tiny</p></div>"
    assert main_text(page) == f"{long.strip()}\n\n{other}"


LINKS = "<div>" + "".join(f"<p><a href=x>Other story {i}</a></p>" for i in range(5)) + "</div>"


def test_link_lists_in_articles_go_and_their_prose_stays():
    first, second = "First words of the story. " * 6, "Second, with <a href=x>one link</a> in it. " * 6
    page = f"<article><h1><a href=x>Title</a></h1><p>{first}</p><p>{second}</p>{LINKS}<p>Last line.</p>{LINKS}</article>"
    prose = second.replace("<a href=x>", "").replace("</a>", "")
    assert main_text(page) == "\n\n".join(["Title", first.strip(), prose.strip(), "Last line."])
    assert main_text(LINKS).count("Other story") == main_text(f"<main>{LINKS}</main>").count("Other story") == 5


def test_a_body_beside_teaser_articles_is_kept():
    body = "A long paragraph of the body of the page. " * 20
    cards = "".join(f"<article><h3><a href=x>Teaser {i}</a></h3></article><article><p>Read it.</p></article>" for i in range(4))
    assert body.strip() in main_text(f"<div><p>{body}</p><p>{body}</p></div><div>{cards}</div>")
    assert main_text(f"<main><p>{body}</p></main><div><p>{body[:200]}</p></div>") == body.strip()


def test_extract_keeps_rows_and_clashing_columns(spark):
    rows = [(1, "u", "<p>x</p>", "old"), (1, "u", "<p>x</p>", "old"), (None, None, None, None)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    got = sorted(map(tuple, extract(pages, keep=("url",)).collect()), key=str)
    assert got == sorted([(1, "u", "x", 1), (1, "u", "x", 1), (None, None, "", 0)], key=str)
    assert extract(pages.limit(0)).count() == 0


PROSE = [prose(40 + i, 60) for i in range(5)]
BODY = "".join(f"<p>{p}</p>" for p in PROSE)
WANTED = "\n\n".join(PROSE)


@pytest.mark.parametrize(
    "frame",
    ["<form action='/'>{}</form>", "<div class='content has-sidebar'>{}</div>", "<div class='no-header'>{}</div>",
     "<div class='site-search-enabled'><div role='search'>{}</div></div>", "<fieldset><div id='page-nav-layout'>{}</div></fieldset>"],
)
def test_frames_of_a_page_are_no_parts_beside_it(frame):
    inner = f"<nav><a href=a>Home</a></nav>{BODY}<div class=comments><p>{prose(9, 30)}</p></div><footer>Imprint</footer>"
    assert main_text("<html><body>" + frame.format(inner) + "</body></html>") == WANTED
    hidden = frame.format(f"<div hidden>{BODY}</div>")
    assert main_text(hidden) == ""


def test_reader_comments_are_no_frame():
    page = f"<body><p>{PROSE[0][:40]}</p><div class=comments>{BODY * 5}</div></body>"
    assert PROSE[1] not in main_text(page)


def test_deep_inline_elements_and_unmatched_tags_take_linear_time():
    import time

    begun = time.perf_counter()
    assert main_text("<b>" * 5_000 + f"<p>{PROSE[0]}</p>") == PROSE[0]
    assert main_text("<b>" * 20_000 + "</i>" * 20_000 + f"<p>{PROSE[0]}</p>") == PROSE[0]
    assert main_text("<svg>" * 20_000 + f"<p>{PROSE[0]}</p>") == PROSE[0]
    assert time.perf_counter() - begun < 5
