"""The main text of pages: signs and marks, an independent slow version on random pages, and time in proportion to the page."""

from __future__ import annotations

import random
import time

import pytest

from rollcall.llm import html_text
from rollcall.llm.html_text import main_text

BODY = "<p>" + " ".join(["word"] * 40) + "</p>"
TEXT = " ".join(["word"] * 40)


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (f"<body><form action=x><ul><li><a href=1>a</a></ul>{BODY * 3}</form></body>", " ".join([TEXT] * 3)),
        (f"<body><form action=x><article>{BODY * 3}</article><footer>foot</footer></form></body>", " ".join([TEXT] * 3)),
        (f"<form>{BODY}<input> Your name</form><article>{BODY * 3}</article>", " ".join([TEXT] * 3)),
        (f"<article class='post with-sidebar'>{BODY * 3}</article><div class='sidebar'>{BODY}</div>", " ".join([TEXT] * 3)),
        (f"<div id=site-search><article class=widget><h1>H</h1>{BODY}</article></div>", "H " + TEXT),
        (f"<article>{BODY}<div class='article comments-list'>{BODY * 3}</div></article>", TEXT),
        (f"<article>{BODY}</article><article class=comment>{BODY * 3}</article>", TEXT),
        (f"<article><p title='hidden gems of Rome'>one</p>{BODY}</article>", "one " + TEXT),
        (f"<article><p data-hidden='false' data-grid='form'>two</p>{BODY}</article>", "two " + TEXT),
        (f"<article><p>see <a href='/x?id=ad' rel=nofollow>four</a></p>{BODY}</article>", "see four " + TEXT),
        (f"<article><p class='first form-of-art'>five</p>{BODY}</article>", "five " + TEXT),
        (f"<article><p hidden>six</p><p hidden=false>no</p><p class='x' class='ad'>seven</p>{BODY}</article>", "no seven " + TEXT),
        (f"<article>{BODY}<div class='ad'>no</div><div class='cookie-banner'>no</div><div class=site-footer>no</div></article>", TEXT),
        (f"<article>{BODY}<p style='color:red; DISPLAY : none'>no</p><div role=Navigation>no</div></article>", TEXT),
        # links in a row leave the text, a link among sentences stays
        (f"<article>{BODY}<ul><li><a href=1>First story</a><li><a href=2>Second story</a><li><a href=3>Third</a></ul>{BODY}</article>", f"{TEXT} {TEXT}"),
        (f"<article>{BODY}<p><a href=1>A whole sentence that is a link.</a></p>{BODY}</article>", f"{TEXT} A whole sentence that is a link. {TEXT}"),
        # comments without a mark beside an article
        (f"<article>{BODY * 3}</article><div><p>Bob I totally disagree with this piece, it is wrong in every way I can think of.</p><p>Ann me too.</p></div>", " ".join([TEXT] * 3)),
        (f"<div>{BODY * 2}</div><h3>3 replies</h3><div>{BODY}</div>", f"{TEXT} {TEXT}"),
        (f"<div>{BODY * 2}</div><h3>The replies of the ministers</h3><div>{BODY}</div>", f"{TEXT} {TEXT} The replies of the ministers {TEXT}"),
        # an article of a few words beside the real text
        (f"<article><p>Teaser</p></article><div>{BODY * 3}</div>", "Teaser " + " ".join([TEXT] * 3)),
        ("<p>short</p>", "short"),
        ("<article><p>Hi.</p></article>", "Hi."),
        ("", ""),
    ],
)
def test_pages(page, text):
    assert main_text(page) == text


# ---- an independent version: a tree, walked for each question


NAMES = ["div", "section", "form", "article", "nav", "header", "blockquote", "aside", "main"]
CLASSES = ["", "", "", "sidebar", "post", "post-comments", "site-footer", "with-sidebar", "ad", "search form", "left", "share-of-voice"]


def random_tree(rng, depth=0):
    """(name, class, children); children are trees or texts (text, whether all of it is a link)."""
    kids = []
    for _ in range(rng.randrange(1, 5)):
        if depth < 4 and rng.random() < 0.5:
            kids.append(random_tree(rng, depth + 1))
        else:
            kids.append((" ".join(["w" * rng.randrange(1, 9)] * rng.choice([1, 1, 4, 10, 20])), rng.random() < 0.3))
    return rng.choice(NAMES) if depth else "body", rng.choice(CLASSES) if depth else "", kids


def markup(tree):
    name, classes, kids = tree
    inner = "".join(markup(k) if len(k) == 3 else f"<p><a href=x>{k[0]}</a></p>" if k[1] else f"<p>{k[0]}</p>" for k in kids)
    return f'<{name} class="{classes}">{inner}</{name}>'


def texts_in(tree):
    return sum(len(k[0]) if len(k) == 2 else texts_in(k) for k in tree[2])


def holds_mark(tree):
    return any(len(k) == 3 and (k[0] in ("article", "main") or holds_mark(k)) for k in tree[2])


SAYS = {"sidebar": 2, "site-footer": 2, "ad": 2, "search form": 1, "post-comments": 3}


def slow_text(page):
    lines = []  # text, size, home

    def walk(tree, home, gone):
        name, classes, kids = tree
        said = 3 if name in ("nav", "aside") else max(SAYS.get(classes, 0), 1 if name == "form" else 2 if name == "header" and home is None else 0)
        if name not in ("body", "main"):
            gone = gone or said == 3 or said > 0 and not holds_mark(tree) and (said == 2 or 2 * texts_in(tree) <= texts_in(page))
        if home is None and not gone and name in ("article", "main"):
            home = id(tree)
        for kid in kids:
            if len(kid) == 3:
                walk(kid, home, gone)
            else:
                lines.append(("", 0, None) if gone else (kid[0], 0 if kid[1] else len(kid[0]), home))

    walk(page, None, False)
    marked = [size for _, size, home in lines if home and size]
    dense = max(html_text.SURGE, 3 * sum(marked) // len(marked)) if marked else html_text.SURGE

    def window(i):
        total = 0
        for j in range(i, min(i + 3, len(lines))):
            if lines[j][2] != lines[i][2]:
                break
            total += lines[j][1]
        return total

    kept = []
    for i, (text, size, home) in enumerate(lines):
        # inside, if some line before it in the run surges and no window dives since then
        start = i
        while True:
            linked = lambda j: bool(lines[j][0]) and not lines[j][1]
            below = start + 1 < len(lines) and lines[start + 1][2] == home and lines[start + 1][1] > 0
            above = start > 0 and lines[start - 1][2] == home and linked(start - 1)
            opens = lines[start][1] > 0 or home and linked(start) and below and not above
            if opens and window(start) > (0 if home else dense):
                if all(window(j) > 0 for j in range(start, i + 1)):
                    kept.append(text)
                    break
            if not start or lines[start - 1][2] != home:
                break
            start -= 1
    kept = [text for text in kept if text]
    return " ".join(kept or [text for text, size, _ in lines if text and size])


@pytest.mark.parametrize("seed", range(400))
def test_random_pages_equal_a_slow_version(seed):
    page = random_tree(random.Random(seed))
    assert main_text(markup(page)) == slow_text(page)


# ---- time


@pytest.mark.parametrize(
    "page",
    [
        lambda n: "<i><div>" + "<b>" * n + "</i>" * n, lambda n: "<b>" * n + "</p>" * n, lambda n: "<ul><li>" * n + "</li>" * n,
        lambda n: "<div>" * n + "<h1>x" * n, lambda n: "<p>" + "<b>" * n + "<li>" * n, lambda n: "<table><tr><td>" * n + "</td>" * n,
        lambda n: "<b '>" * n, lambda n: "<p " + "x=\"' " * n + ">", lambda n: "<p " + '"x ' * n + ">", lambda n: "<a href=\"" * n,
    ],
)
def test_time_grows_with_the_page(page):
    def seconds(n):
        best = []
        for _ in range(3):
            started = time.process_time()
            main_text(page(n))
            best.append(time.process_time() - started)
        return min(best)

    assert seconds(40_000) < 3.5 * seconds(20_000) + 0.05
