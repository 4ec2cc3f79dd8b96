"""Pages of op5 whose layout has names of parts that are left out, of several regions, or broken."""

import time

import pytest

from shelfmark.llm import pages

TEXT = ["One long paragraph of the article, with many words in it. " * 4, "And another of them, as long. " * 6]
BODY = "".join(f"<p>{t}</p>" for t in TEXT)
SIDE = "<div class='sidebar'><p>Latest posts and other things</p></div>"
COMMENTS = "<div id=comments><article><p>" + "I do not agree at all with any of this. " * 30 + "</p></article></div>"


@pytest.mark.parametrize(
    "page",
    [
        f"<body><div class='content-sidebar-wrap'><main>{BODY}</main>{SIDE}</div></body>",
        f"<body><div class='content-sidebar-wrap'><article>{BODY}</article>{SIDE}</div></body>",
        f"<body><div class='sidebar-layout'><div>{BODY}</div>{SIDE}</div></body>",
        f"<body><main><div class='elementor-widget elementor-widget-text-editor'>{BODY}</div></main></body>",
        "<body><main>"
        + "".join(f"<div class='elementor-widget elementor-widget-text-editor'><p>{t}</p></div>" for t in TEXT)
        + f"</main>{SIDE}</body>",
        f"<body><form action=x><main>{BODY}</main>{SIDE}<input name=y></form></body>",
        f"<body><form action=x><div>{BODY}</div></form></body>",
        f"<body><article>{BODY}{COMMENTS}</article></body>",
        f"<body><main>{BODY}<form><p>Your mail</p></form>{SIDE}</main>{COMMENTS}</body>",
    ],
)
def test_wrappers_keep_the_article(page):
    assert pages.main_text(page) == "\n".join(t.strip() for t in TEXT)


LINES = [t.strip() for t in TEXT]


@pytest.mark.parametrize(
    "page, expected",
    [
        (f"<body><main><h1>Title</h1><p>A lead.</p><article>{BODY}</article></main></body>", ["Title", "A lead.", *LINES]),
        ("<body><main>" + "".join(f"<article><p>{t}</p></article>" for t in TEXT) + f"</main>{SIDE}</body>", LINES),
        (
            f"<body><div><p>{TEXT[0]}</p><p><a href=x>The whole report</a></p><p>{TEXT[1]}</p></div></body>",
            [LINES[0], "The whole report", LINES[1]],
        ),
        (f"<body><main><article>{BODY}</article><article><a href=x>More</a></article></main></body>", LINES),
        (f"<body><article>{BODY}</article><article><p>Short teaser</p></article></body>", LINES),
    ],
)
def test_regions_of_one_article(page, expected):
    assert pages.main_text(page) == "\n".join(expected)


@pytest.mark.parametrize("broken", ["<a " * 20_000, "<b>" * 20_000 + "</i>" * 20_000, "<div>" * 5_000 + "</p>" * 20_000])
def test_broken_tags_cost_their_number(broken):
    begin = time.process_time()
    assert pages.main_text(f"<article>{BODY}</article>{broken}").startswith("\n".join(LINES))
    assert time.process_time() - begin < 3
