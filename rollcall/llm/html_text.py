"""The main text of web pages by line-block distribution.

A page is cut into lines at tags that break text; markup, scripts, styles and comments leave nothing. Elements that say
they are no article (menus, headers, footers, sidebars, notices, adverts, forms, reader comments, hidden parts) leave
empty lines. Over the lines slides a window of three; its sum counts text outside links. Text surges where the sum
rises over a threshold, and dives where a whole window holds no text but links. What lies between is kept, line by line,
short lines included. So links in a row leave the text anywhere, a link among sentences or above one stays. Where a page marks articles
or a main part, a window ends at the mark's edge. Inside it the threshold is 0, as every line there is likely text;
outside of it, text must be as dense as the marked text is on average: what stands beside an article is mostly not part of
it. A heading that announces comments ends the unmarked text.

Signs weigh less than text. A class, id or role counts as a sign only if all its words are signs or words of layout, so
that `with-sidebar` is none. Elements with a sign, and forms, are kept where they hold a marked part or a main heading;
forms, widgets and the like also where they hold more than half of the page's text. Only comments, hidden parts and
elements like menus go whatever they hold.

Pages may be cut off anywhere: what is not closed ends with the page, except that an unclosed menu or the like takes
only its own line. Every element is asked, paragraphs, list items, table cells and inline ones as well; where HTML lets
end tags of those be missing, they end as in HTML. Time grows in proportion to the page, however its tags are nested.
Null pages have an empty text. Nothing else is dropped, and no text is capped.
"""

from __future__ import annotations

import html
import itertools
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.llm.shared import replaced, single, without

WINDOW, SURGE = 3, 80

#: Fixed values of HTML: elements whose content is no markup, elements without content, elements that don't break text.
RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "xmp", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label",
    "mark", "q", "ruby", "rt", "rp", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
}
#: Elements whose end tag may be missing: those that an opening one ends, and those it doesn't look beyond.
SCOPE = {"table", "td", "th", "caption", "button", "object", "template"}
LISTED = SCOPE | {"section", "article", "main", "aside", "nav", "header", "footer", "form", "fieldset", "figure", "blockquote", "details", "body", "html"}
ENDS = {
    "li": ({"li"}, LISTED | {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, LISTED | {"dl"}), "dd": ({"dt", "dd"}, LISTED | {"dl"}),
    "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}), "tr": ({"tr", "td", "th"}, {"table"}),
    **dict.fromkeys(("tbody", "thead", "tfoot"), ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"})),
    "option": ({"option"}, {"select", "datalist", "optgroup"}), "optgroup": ({"option", "optgroup"}, {"select"}),
}
OPTIONAL = {"p", *ENDS}
#: Elements that end a paragraph.
ENDS_P = {
    "address", "article", "aside", "blockquote", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer",
    "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "li", "main", "menu", "nav", "ol", "p", "pre", "search", "section", "summary", "table", "ul",
}
#: Elements that aren't part of an article, and words of a class, id or role that say so.
OUTSIDE = {"nav", "footer", "aside", "form", "button", "select", "dialog", "menu", "svg", "canvas", "object", "audio", "video", "head", "fieldset", "datalist"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog", "menu", "menubar", "toolbar", "form"}
SIGNS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promotion", "banner", "menu", "nav",
    "navbar", "navigation", "breadcrumb", "breadcrumbs", "sidebar", "footer", "masthead", "topbar", "cookie", "cookies", "consent", "gdpr",
    "notice", "notices", "alert", "popup", "modal", "overlay", "newsletter", "subscribe", "subscription", "signup", "login", "share",
    "sharing", "social", "related", "recommended", "comment", "comments", "commentlist", "disqus", "respond", "reply", "replies",
    "pagination", "pager", "toolbar", "widget", "widgets", "skip", "search", "form", "toc", "copyright", "disclaimer",
}
#: Signs of what readers wrote, and words of layout that may stand beside a sign.
READERS = {"comment", "comments", "commentlist", "disqus", "respond", "reply", "replies"}
LAYOUT = {
    "area", "article", "bar", "block", "body", "bottom", "box", "col", "column", "container", "content", "entry", "global", "group", "header", "holder", "inner",
    "item", "items", "left", "link", "links", "list", "main", "outer", "page", "panel", "post", "posts", "primary", "right", "secondary", "section", "site",
    "place", "placeholder", "slot", "small", "space", "thread", "top", "unit", "wrap", "wrapper", "zone",
}
#: Elements and signs that may well stand around the text, and words of a heading above comments.
AROUND = {"form", "fieldset"}
AROUND_SIGNS = {"banner", "form", "masthead", "modal", "overlay", "search", "toolbar", "topbar", "widget", "widgets", "dialog"}
ABOVE_COMMENTS = {"comment", "comments", "reply", "replies", "response", "responses", "kommentar", "kommentare", "commentaire", "commentaires", "comentario", "comentarios"}
BESIDE_THOSE = {"a", "add", "all", "leave", "on", "post", "the", "your"}

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)[^>]*(?:>|\Z)|</?\Z", re.S)
ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?|["'][^"']*["']?""")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


#: What an element says of itself: nothing; that it is no article unless it holds most of the text, or a mark; unless it
#: holds a mark; or that it is none at all.
PLAIN, OUTER, OTHER, GONE = range(4)


@dataclass
class Element:
    name: str
    token: int  # where it opens
    parent: int
    says: int
    close: int = -1  # where it closes, -1 if it doesn't
    keeps: bool = False  # holds an article's beginning
    text: int = 0  # characters inside


def sign(value: str) -> int:
    """What a class or id says, word by word."""
    found = PLAIN
    for compound in value.split():
        words = [w.lower() for w in WORD.findall(compound)]
        if any(w in SIGNS for w in words) and all(w in SIGNS or w in LAYOUT for w in words):
            signs = {w for w in words if w in SIGNS}
            found = max(found, GONE if signs & READERS else OUTER if signs <= AROUND_SIGNS else OTHER)
    return found


def says(name: str, attributes: str) -> int:
    if name in OUTSIDE - AROUND:
        return GONE
    found = OUTER if name in AROUND else PLAIN
    seen = set()
    for m in ATTRIBUTE.finditer(attributes):
        key, value = (m[1] or "").lower(), m[2] or m[3] or m[4] or ""
        if key in seen:
            continue
        seen.add(key)
        if key == "hidden" and value.lower() != "false" or key == "aria-hidden" and value.lower() == "true":
            return GONE
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return GONE
        if key == "role" and value.lower() in ROLES:
            found = max(found, OUTER if value.lower() in AROUND_SIGNS else OTHER)
        if key in ("class", "id"):
            found = max(found, sign(value))
    return found


def tokens(page: str) -> list[tuple[str, str, str]]:
    """(kind, name, rest): text, open, close; raw content, comments and declarations leave nothing."""
    found, at = [], 0
    while m := TAG.search(page, at):
        if m.start() > at:
            found.append(("text", "", page[at : m.start()]))
        at = m.end()
        if name := (m[2] or m[5] or "").lower():
            if m[1] or m[4]:
                found.append(("close", name, ""))
            else:
                found.append(("open", name, m[3] or ""))
                if name in RAW:
                    end = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(page, at)
                    at = end.end() if end else len(page)
                    found.append(("close", name, ""))
    if at < len(page):
        found.append(("text", "", page[at:]))
    return found


def elements(parts: list[tuple[str, str, str]]) -> tuple[list[Element], list[int]]:
    """The elements, and for each token the innermost one around it. End tags that HTML lets be missing are filled in."""
    made, around = [Element("", -1, -1, PLAIN, len(parts))], []
    stack = [0]
    places: dict[str, list[int]] = {}  # where in the stack the open elements of a name are
    solid = [0]  # and those that are not inline

    def close(place: int, name: str, at: int) -> None:
        """Close all from a place of the stack on: by its end tag, or where that may be missing."""
        for e in stack[place:]:
            places[made[e].name].pop()
            if made[e].name == name or made[e].name in OPTIONAL:
                made[e].close = at
        del stack[place:]
        while solid[-1] >= place:
            solid.pop()

    def lowest(names: set[str], bounds: set[str]) -> int:
        """The place of the outermost open one of these that no bound hides, 0 if none."""
        if not any(places.get(name) for name in names):
            return 0
        bound = max((places[name][-1] for name in bounds if name not in names and places.get(name)), default=0)
        found = [held[i] for name in names if (held := places.get(name)) and (i := bisect_right(held, bound)) < len(held)]
        return min(found, default=0)

    for at, (kind, name, rest) in enumerate(parts):
        if kind == "open":
            if name in ENDS_P and (place := lowest({"p"}, SCOPE | (ENDS_P - {"p"}))):
                close(place, "p", at)
            if name in ENDS and (place := lowest(*ENDS[name])):
                close(place, name, at)
            if name not in VOID and not rest.endswith("/"):
                made.append(Element(name, at, stack[-1], says(name, rest)))
                stack.append(len(made) - 1)
                places.setdefault(name, []).append(len(stack) - 1)
                if name not in INLINE:
                    solid.append(len(stack) - 1)
            if name in ("article", "main", "h1"):
                e = made[stack[-1]].parent if name not in VOID and not rest.endswith("/") else stack[-1]
                while e > 0 and not made[e].keeps:
                    made[e].keeps = True
                    e = made[e].parent
        elif kind == "close" and places.get(name):
            if name in INLINE:  # an inline end tag ends nothing around its block
                place = places[name][-1] if places[name][-1] > solid[-1] else 0
            elif name == "p":
                place = lowest({"p"}, SCOPE | (ENDS_P - {"p"}))
            elif name in ENDS:
                place = lowest({name}, ENDS[name][1] - {"tr"} if name in ("td", "th") else ENDS[name][1])
            else:
                place = places[name][-1]
            if place and made[stack[place]].name == name:
                close(place, name, at)
        around.append(stack[-1])
    return made, around


def blocks(page: str) -> list[tuple[str, int, int]]:
    """The page's lines: text, characters of it outside links, and the article or main part around them, 0 if none."""
    parts = tokens(page)
    made, around = elements(parts)
    for at, (kind, _, rest) in enumerate(parts):
        if kind == "text" and made[around[at]].name not in RAW:
            made[around[at]].text += len(rest.strip())
    for e in reversed(made[1:]):
        made[e.parent].text += e.text
    dropped = [False] * len(made)
    home = [0] * len(made)  # the outermost article or main part around an element
    for i, e in enumerate(made[1:], 1):
        said = max(e.says, OTHER) if e.name == "header" and not home[e.parent] else e.says
        holds = e.keeps or said == OUTER and 2 * e.text > made[0].text
        gone = e.close >= 0 and e.name not in ("html", "body", "main") and (said == GONE or said != PLAIN and not holds)
        dropped[i] = dropped[e.parent] or gone or e.name in RAW
        home[i] = home[e.parent] or (i if e.name in ("article", "main") and not dropped[i] else 0)
    lines: list[list] = [["", 0, 0, False]]  # text, length outside links, home, whether something was taken out
    link, blocked = 0, -1

    def opens(at: int, e: Element) -> bool:
        return e.token == at and e.close < 0 and (e.says != PLAIN or e.name == "header") and not e.keeps

    for at, (kind, name, rest) in enumerate(parts):
        e = around[at]
        if kind == "text":
            if dropped[e] or blocked == len(lines):
                lines[-1][3] = True
                continue
            line = lines[-1]
            line[0] += rest
            line[1] += 0 if link else len(rest.strip())
            line[2] = line[2] or home[e]
        elif name in INLINE:
            if name == "a" and not (kind == "open" and rest.endswith("/")):
                link = 1 if kind == "open" else 0
            if kind == "open" and opens(at, made[e]):
                blocked = len(lines)
        else:
            link = 0
            lines.append(["", 0, 0, False])
            if kind == "open" and name not in VOID and name not in ("html", "body", "main", "article") and opens(at, made[e]):
                blocked = len(lines)  # not closed: its own line goes
    # lines of nothing but markup say nothing; lines that were taken out stay, empty
    return [(line, length, of) for text, length, of, gone in lines if (line := " ".join(html.unescape(text).split())) or gone]


def announces_comments(line: str) -> bool:
    words = re.findall(r"[^\W\d_]+", line.lower())
    return 0 < len(words) <= 4 and any(w in ABOVE_COMMENTS for w in words) and all(w in ABOVE_COMMENTS | BESIDE_THOSE for w in words)


def between(lines: list[tuple[str, int, int]]) -> list[str]:
    """The lines between each surge and the dive after it."""
    sizes = [length if text else 0 for text, length, _ in lines]
    marked = [size for size, (_, _, of) in zip(sizes, lines, strict=True) if of and size]
    dense = max(SURGE, WINDOW * sum(marked) // len(marked)) if marked else SURGE
    kept, first, ended = [], 0, False
    for of, part in itertools.groupby(of for _, _, of in lines):
        end = first + len(list(part))
        inside = False
        for i in range(first, end):
            ended = ended or not of and announces_comments(lines[i][0])
            sum_ = sum(sizes[i : min(i + WINDOW, end)])
            headline = of and lines[i][0] and sizes[i + 1 : min(i + 2, end)] > [0] and not (i > first and lines[i - 1][0] and not sizes[i - 1])
            inside = sum_ > 0 if inside else (sizes[i] > 0 or headline) and sum_ > (0 if of else dense)
            if inside and (of or not ended):
                kept.append(lines[i][0])
        first = end
    return [text for text in kept if text]


def main_text(page: str | None) -> str:
    if not page:
        return ""
    lines = blocks(page)
    kept = between(lines)
    if not kept:  # a page of a few words never surges
        kept = [text for text, length, _ in lines if text and length]
    return " ".join(kept)


def extract(pages: DataFrame, source: str = "html", text: str = "text") -> DataFrame:
    """Adds the main text of every whole page; a given column of that name is replaced, all others stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in single(batches, 500):
            yield replaced(batch, {text: pa.array([main_text(page) for page in batch.column(source).to_pylist()], pa.string())})

    return pages.mapInArrow(run, T.StructType([*without(pages, text).schema.fields, T.StructField(text, T.StringType())]))


def texts(pages: DataFrame) -> DataFrame:
    found = extract(pages.select("page_id", "url", "html")).drop("html")
    return found.withColumn("n_chars", F.length("text").cast("long"))
