"""Text that belongs to an article stays, reader comments go, and drawings cost their length."""

import time

import pytest

from stenoflow.llm import html_text as H

LINE = "Some words of the article that go on for a while, and on. " * 4
P = f"<p>{LINE}</p>"
TEXT = LINE.strip()


def page(body):
    return f"<html><body><nav><a href=1>a</a><a href=2>b</a></nav>{body}</body></html>"


@pytest.mark.parametrize("last", [
    "(c) the third condition of the contract holds in all cases.", "Copyright 1998 was the year when the law was changed for good.",
    "© is the sign that stands for it.",
])
def test_paragraphs_that_begin_like_rights_stay(last):
    for tag in ("article", "div"):
        assert H.extract(page(f"<{tag}>{P}{P}<p>{last}</p></{tag}>")).split("\n")[-1] == last
    assert H.extract(page(f"<article>{P}<ol><li>(a) one</li><li>(c) 2020 Example Media</li></ol></article>")).endswith("(c) 2020 Example Media")


@pytest.mark.parametrize("last", ["© 2020 Example Media of Bern. All rights reserved.", "Copyright (c) 1999-2004 by Example", "(c) Example Ltd. 2001"])
def test_lines_of_rights_go(last):
    assert H.extract(page(f"<div>{P}{P}<p>{last}</p></div>")) == f"{TEXT}\n{TEXT}"


def test_comments_in_articles_go():
    said = "<p>Great post, thank you for this, I have read it twice over and over.</p>"
    for mark in ("class='comment'", "class='comment user' id=comment-12", "id='comments'"):
        assert H.extract(page(f"<div>{P}{P}</div><section><article {mark}>{said}</article></section>")) == f"{TEXT}\n{TEXT}"
        assert H.extract(page(f"<article>{P}{P}<article {mark}>{said}</article></article>")) == f"{TEXT}\n{TEXT}"
    # a page's own article may be called a comment, and others may have comments
    assert H.extract(page(f"<article class=comment>{P}{P}</article>")) == f"{TEXT}\n{TEXT}"
    assert H.extract(page(f"<p>Lead.</p><article class=has-comments>{P}{P}</article>")).endswith(f"{TEXT}\n{TEXT}")


def test_lists_of_references_stay_in_articles():
    refs = "".join(f"<li><a href={i}>Reference number {i}</a></li>" for i in range(3))
    want = "\n".join([TEXT, *[f"Reference number {i}" for i in range(3)], TEXT])
    assert H.extract(page(f"<article>{P}<ul>{refs}</ul>{P}</article>")) == want


def test_drawings_cost_their_length():
    begun = time.monotonic()
    for inside in ("<g><path/>" * 30_000 + "</svg>", "<g>" * 30_000, "<g><title>x</title>" * 10_000 + "</svg>"):
        assert H.extract(page(f"{P}{P}<svg>{inside}{P}")).startswith(f"{TEXT}\n{TEXT}")
    assert time.monotonic() - begun < 10
