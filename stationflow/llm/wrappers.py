"""Main text of web pages by wrappers: union-free regular expressions per host.

A page is read as a stream of tags and texts and kept as a tree of elements. A
wrapper has the same shape, and its elements may be optional or repeated; a text
is either the one that all pages show or a slot, and an element remembers whether
its whole content is the same on all pages that have it. Pages of one host are
aligned with the host's wrapper one after the other, element by element along
the longest common sequence of their children:

* texts that differ become a slot;
* elements that only one side has become optional;
* neighbours of the same form, alone or in groups of two or three, become one
  repeated group.

There are no alternatives, so the expression stays union-free. A host's pages
are dealt by their content and aligned in its order, in parts so that no task
gets all of a busy host; the parts' wrappers are aligned in the order of the
parts. So the wrapper does not depend on how the pages arrive.

The wrapper's slots say where the host's articles are: in ``article`` or ``main``
elements if those hold half of the slots' text, else in the element that holds
most of it, outside links and boilerplate. What all pages show weighs nothing,
however long, and blocks inside the article that all of them show are left out
(headings stay). A host of fewer than ``SHOWN`` pages shows too little of its
template, and one of equal pages has no slots: there all text counts. A fixed
element among varying neighbours of the same form is part of their repetition,
so it counts as varying. Applied to a page, the text of that element
is taken without the parts that are menus, headers, footers, sidebars, notices,
adverts, forms, scripts, styles or comments by their tag, role, class or id. The
wrapper overrules roles, classes and ids that would drop its article or most of
its text. On a page of which the host's place holds less than half, the page's
own place is read as well; a page on which both are empty is read with a wrapper
of its own, and if it is still empty, with the tags' names only.

Defined results: a null or empty page has the empty text. Unclosed and stray
tags are tolerated; elements more than ``MAX_DEPTH`` deep are laid beside each
other, as browsers do at 512; what a script, style, title or textarea holds is no text.
Pages without a URL form the host ''. Equal rows give equal results; other
columns are never read.
"""

from __future__ import annotations

import functools
import hashlib
import html
import itertools
import json
import re
import sys
from collections.abc import Container, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationflow.llm.support import settled

# What HTML's elements are, and the words that mark boilerplate in roles, classes and ids.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong"
    " sub sup time tt u var wbr img".split())
DROPPED = set("head nav header footer aside form button select menu dialog object applet canvas svg audio video template".split())
CLOSED_BY = {  # an element that ends where one of these begins, unless a closer element stands between
    "p": set("address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()),
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"},
    "head": {"body"},
}
BARRIER = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "option": {"select"}, "p": {"td", "th", "li", "div", "article", "section"}, "head": set()}
MARKS = set(
    "nav navbar navigation menu header masthead footer sidebar aside ad ads advert adverts advertisement advertising sponsor"
    " sponsored promo promotion banner cookie cookies consent notice notices gdpr popup modal newsletter subscribe"
    " subscription signup share sharing social related recommended comment comments respond replies disqus breadcrumb"
    " breadcrumbs pagination pager widget toolbar login search contentinfo complementary dialog alert".split())
STATES = {"has", "with", "without", "no"}  # a token with one says what a container has beside the text
TALK = ("comment", "respond", "replies", "disqus", "related", "recommended")  # never the main text for its length alone
OWN = {"article", "post", "entry", "story", "content", "body"}  # with "header" beside them, a mark is the article's own

_ATTRIBUTES = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+"""
TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(script|style|title|textarea|noscript|iframe|xmp|noembed|noframes)\b(?:{_ATTRIBUTES}|[^>]*)>.*?(?:</\1\s*>|\Z)"
    rf"|<(/?)([a-z][^\s/>]*)({_ATTRIBUTES}|[^>]*)>|</[a-z][^<>]*\Z", re.S | re.I)
_NAMED = re.compile(r"""(?<![\w-])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_LETTERS = re.compile(r"[a-z]+")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
SMALL = 10_000
MAX_DEPTH = 1000
SHOWN = 5
PAGES_A_PART = 2000
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
MARKED, BY_TAG, PARTLY = 1, 2, -1  # boilerplate by a word, by the tag's name; by a word on some pages only, so not dropped
_known: dict[tuple[str, str], tuple[str, int]] = {}


def element(name: str, attributes: str) -> tuple[str, int]:
    """(key, boilerplate: 0, MARKED or BY_TAG) of a tag; the key is its name with the letters of its id or first class."""
    if (name, attributes) in _known:
        return _known[name, attributes]
    key, drop = name, BY_TAG if name in DROPPED else 0
    found = {a.lower(): b or c or d for a, b, c, d in _NAMED.findall(attributes)} if attributes else {}
    for kind, value in found.items():
        for token in value.split():
            words = {w.lower() for w in _WORDS.findall(token)}
            if words & MARKS and not words & STATES and not ("header" in words and words & OWN):
                drop = drop or MARKED
    if found.get("id"):
        key += "#" + "".join(_LETTERS.findall(found["id"].lower()))
    elif found.get("class", "").split():
        key += "." + "".join(_LETTERS.findall(found["class"].split()[0].lower()))
    if name in ("html", "body"):
        key, drop = name, 0
    if len(_known) > 50_000:
        _known.clear()
    _known[name, attributes] = key, drop
    return key, drop


def parse(page: str, kept: Container[str] = (), words: bool = True) -> list:
    """The page as [key, boilerplate, children, name]; children are elements and undecoded texts.

    Elements of the ``kept`` keys, and without ``words`` all, are boilerplate by the tag's name only.
    """
    root = ["#page", 0, [], ""]
    stack, at = [root], 0
    for m in TOKEN.finditer(page):
        begin = m.start()
        if begin > at:
            stack[-1][2].append(page[at:begin])
        at = m.end()
        name = m.group(3)
        if not name:
            continue
        name = name.lower()
        if m.group(2):
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][3] == name:
                    del stack[depth:]
                    break
            else:
                if name == "br" or name == "p":
                    stack[-1][2].append([name, False, [], name])
            continue
        for depth in range(len(stack) - 1, 0, -1):
            open_ = stack[depth][3]
            if name in CLOSED_BY.get(open_, ()):
                del stack[depth:]
                break
            if any(open_ in BARRIER[k] for k in BARRIER if name in CLOSED_BY[k]):
                break
        attributes = m.group(4)
        key, drop = element(name, attributes if "=" in attributes else "")
        if drop == MARKED and (not words or key in kept):
            drop = 0
        node = [key, drop, [], name]
        stack[-1][2].append(node)
        # deeper elements are laid beside each other; boilerplate keeps its text to itself at any depth
        if name not in VOID and not attributes.endswith("/") and (len(stack) < MAX_DEPTH or drop and len(stack) == MAX_DEPTH):
            stack.append(node)
    if at < len(page):
        stack[-1][2].append(page[at:])
    return root


# A wrapper element: [key, boilerplate, optional, repeated, pages, characters outside links, characters, children, digest
# of its content or None if pages differ]; its children are elements and texts. A text is {"t": what all pages show, or
# None for a slot, "n": its characters outside links}. A group of elements that repeat together has the key "()".
KEY, DROP, OPTIONAL, REPEATED, PAGES, PROSE, CHARS, CHILDREN, FIXED = range(9)


def _form(x) -> str:
    return x[KEY] if isinstance(x, list) else "#"


def _digest(parts: list[str]) -> str:
    return hashlib.blake2b("\x00".join(parts).encode("utf-8", "replace"), digest_size=8).hexdigest()


def _content(x) -> str | None:
    return x[FIXED] if isinstance(x, list) else x["t"]


def _both(items: list) -> str | None:
    """The digest of several contents of one page in a row; None if one of them differs between pages."""
    parts = [_content(x) for x in items]
    return None if None in parts else _digest(parts)


def signed(node: list) -> str:
    """Adds to every element of a page the digest of its content, without spaces around texts; gives the element's."""
    parts = [node[0]]
    for c in node[2]:
        if isinstance(c, list):
            parts.append(signed(c))
        elif c.strip():
            parts.append(_text(c))
    node.append(_digest(parts))
    return node[4]


def _text(raw: str) -> str:
    line = " ".join(raw.split())
    return line if len(line) <= 40 else "~" + hashlib.blake2b(line.encode("utf-8", "replace"), digest_size=8).hexdigest()


def wrapper_of(node: list, in_link: bool = False) -> list:
    """The wrapper of one page's element."""
    if len(node) < 5:
        signed(node)
    children, prose, chars = [], 0, 0
    in_link = in_link or node[3] == "a"
    for c in node[2]:
        if isinstance(c, str):
            if c.strip():
                n = 0 if in_link else len(c)
                children.append({"t": _text(c), "n": n})
                chars += len(c)
                prose += n
        else:
            w = wrapper_of(c, in_link)
            children.append(w)
            chars += w[CHARS]
            prose += 0 if _dropped(w) else w[PROSE]
    return [node[0], node[1], False, False, 1, prose, chars, folded(children), node[4]]


def _dropped(w: list) -> bool:
    return w[DROP] > 0


def merged(a, b, beside: bool = False):
    """One wrapper of two of the same form, from different pages or, with ``beside``, from one place of the same pages."""
    if not isinstance(a, list):
        return {"t": a["t"] if a["t"] == b["t"] else None, "n": a["n"] + b["n"]}
    drop = a[DROP] if a[DROP] == b[DROP] else PARTLY
    fixed = _both([a, b]) if beside else a[FIXED] if a[FIXED] == b[FIXED] else None
    return [
        a[KEY], drop, a[OPTIONAL] or b[OPTIONAL], a[REPEATED] or b[REPEATED], a[PAGES] + b[PAGES],
        a[PROSE] + b[PROSE], a[CHARS] + b[CHARS], aligned(a[CHILDREN], b[CHILDREN], beside), fixed]


def folded(items: list) -> list:
    """Neighbours of the same form as one repeated element, groups of two and three likewise."""
    out: list = []
    for x in items:
        out.append(x)
        while True:
            if len(out) > 1 and _form(out[-1]) == _form(out[-2]):
                last = out.pop()
                out[-1] = merged(out[-1], last, True)
                if isinstance(out[-1], list):
                    out[-1][REPEATED] = True
                    out[-1][PAGES] = max(out[-1][PAGES] - last[PAGES], last[PAGES])
                continue
            for size in (2, 3):
                tail = out[-size:]
                group = out[-size - 1] if len(out) > size else None
                if isinstance(group, list) and group[KEY] == "()" and list(map(_form, group[CHILDREN])) == list(map(_form, tail)):
                    del out[-size:]
                    group[FIXED] = _both([group, *tail])
                    group[CHILDREN] = [merged(p, q, True) for p, q in zip(group[CHILDREN], tail)]
                elif len(out) >= 2 * size and list(map(_form, out[-2 * size:-size])) == list(map(_form, tail)) and any(isinstance(t, list) for t in tail):
                    both, pages = [merged(p, q, True) for p, q in zip(out[-2 * size:-size], tail)], max(t[PAGES] for t in tail if isinstance(t, list))
                    fixed = _both(out[-2 * size:])
                    del out[-2 * size:]
                    out.append(["()", 0, False, True, pages, 0, 0, both, fixed])
                else:
                    continue
                weight = [c for c in out[-1][CHILDREN] if isinstance(c, list)]
                out[-1][PROSE] = sum(0 if _dropped(c) else c[PROSE] for c in weight)
                out[-1][CHARS] = sum(c[CHARS] for c in weight)
                break
            else:
                break
    return out


def _alone(x):
    return [*x[:OPTIONAL], True, *x[REPEATED:]] if isinstance(x, list) else {"t": None, "n": x["n"]}


def _lengths(xs: list[str], ys: list[str]) -> np.ndarray:
    """By number of ``ys`` taken from the front, the length of its longest common sequence with ``xs``: all of ``ys`` in one number's bits."""
    places: dict[str, int] = {}
    for j, y in enumerate(ys):
        places[y] = places.get(y, 0) | 1 << j
    full = (1 << len(ys)) - 1
    row = full
    for x in xs:
        hit = row & places.get(x, 0)
        row = (row + hit | row - hit) & full
    bits = np.unpackbits(np.frombuffer(row.to_bytes(-(-len(ys) // 8) or 1, "little"), np.uint8), bitorder="little")[:len(ys)]
    return np.concatenate([[0], np.cumsum(1 - bits.astype(np.int64))])


def common(xs: list[str], ys: list[str]) -> list[tuple[int, int]]:
    """Places of a longest common sequence. Long lists are halved where the halves' sequences add up to the longest: memory stays linear."""
    n, m = len(xs), len(ys)
    if n * m <= SMALL or n < 2:
        best = [[0] * (m + 1) for _ in range(n + 1)]
        for i in range(n - 1, -1, -1):
            row, below = best[i], best[i + 1]
            for j in range(m - 1, -1, -1):
                row[j] = below[j + 1] + 1 if xs[i] == ys[j] else max(below[j], row[j + 1])
        pairs, i, j = [], 0, 0
        while i < n and j < m:
            if xs[i] == ys[j]:
                pairs.append((i, j))
                i, j = i + 1, j + 1
            elif best[i + 1][j] >= best[i][j + 1]:
                i += 1
            else:
                j += 1
        return pairs
    half = n // 2
    at = int((_lengths(xs[:half], ys) + _lengths(xs[:half - 1:-1] if half else xs[::-1], ys[::-1])[::-1]).argmax())
    return common(xs[:half], ys[:at]) + [(i + half, j + at) for i, j in common(xs[half:], ys[at:])]


def aligned(xs: list, ys: list, beside: bool = False) -> list:
    """Children of two elements in one order; what only one has is optional."""
    fx, fy = list(map(_form, xs)), list(map(_form, ys))
    if fx == fy:
        return [merged(x, y, beside) for x, y in zip(xs, ys)]
    out, i, j = [], 0, 0
    for p, q in [*common(fx, fy), (len(fx), len(fy))]:
        out += [_alone(x) for x in xs[i:p]] + [_alone(y) for y in ys[j:q]]
        if p < len(fx):
            out.append(merged(xs[p], ys[q], beside))
        i, j = p + 1, q + 1
    return folded(out)


def slotted(w: list) -> list:
    """The wrapper with PROSE for the text of slots only: texts and elements that more than one page shows alike weigh nothing."""
    alone = w[PAGES] == 1
    children = [slotted(c) if isinstance(c, list) else c for c in w[CHILDREN]]
    prose = sum((0 if _dropped(c) else c[PROSE]) if isinstance(c, list) else c["n"] * (alone or c["t"] is None) for c in children)
    return [*w[:PROSE], 0 if w[FIXED] is not None and not alone else prose, w[CHARS], children, w[FIXED]]


def shown(w: list) -> list[str]:
    """Blocks, as key and digest, that every page of the wrapper shows; the outermost ones."""
    found: list[str] = []

    def look(node: list) -> None:
        for c in node[CHILDREN]:
            if isinstance(c, list) and not _dropped(c):
                if c[FIXED] is not None and c[PAGES] == w[PAGES] and not (c[OPTIONAL] or c[REPEATED]) and c[CHARS]:
                    if _name(c[KEY]) not in INLINE | HEADINGS:
                        found.append(f"{c[KEY]}:{c[FIXED]}")
                else:
                    look(c)

    if w[PAGES] >= SHOWN:
        look(w)
    return found


def expression(w) -> str:
    """The wrapper as a regular expression over tags; ``#`` is a text slot."""
    if not isinstance(w, list):
        return "#" if w["t"] is None else json.dumps(w["t"], ensure_ascii=False)
    inner = " ".join(map(expression, w[CHILDREN]))
    name = w[KEY].split(".")[0].split("#")[0]
    body = inner if w[KEY] in ("()", "#page") else f"<{w[KEY]}>" if name in VOID else f"<{w[KEY]}> {inner} </{name}>"
    sign = "*" if w[OPTIONAL] and w[REPEATED] else "+" if w[REPEATED] else "?" if w[OPTIONAL] else ""
    return f"({body}){sign}" if sign else body


def _elements(w: list, path: tuple[str, ...] = (), often: bool = False) -> Iterator[tuple[list, tuple[str, ...], bool]]:
    """Elements outside boilerplate, with their paths and whether they repeat; groups add nothing to a path."""
    for c in w[CHILDREN]:
        if isinstance(c, list) and not _dropped(c):
            own, more = path if c[KEY] == "()" else (*path, c[KEY]), often or c[REPEATED]
            if c[KEY] != "()":
                yield c, own, more
            yield from _elements(c, own, more)


def _name(key: str) -> str:
    return key.split(".")[0].split("#")[0]


def _marked(w: list, above: tuple[str, ...] = (), partly: bool = True, often: bool = False) -> Iterator[tuple[list, tuple[str, ...], bool, bool]]:
    """Elements with a mark or inside such: the marked keys down to them, whether those are marked on some pages only, and whether they repeat."""
    for c in w[CHILDREN]:
        if isinstance(c, list) and c[DROP] != BY_TAG:
            keys = (*above, c[KEY]) if c[DROP] else above
            some, more = partly and c[DROP] != MARKED, often or c[REPEATED]
            if keys:
                yield c, keys, some, more
            yield from _marked(c, keys, some, more)


def _whole(w: list) -> int:
    """Characters outside links and boilerplate by tag."""
    return w[PROSE] + sum(_whole(c) for c in w[CHILDREN] if isinstance(c, list) and c[DROP] == MARKED) + sum(
        _whole(c) - c[PROSE] for c in w[CHILDREN] if isinstance(c, list) and not _dropped(c))


def _talk(keys: tuple[str, ...]) -> bool:
    return any(t in k for k in keys for t in TALK)


def kept_of(w: list) -> list[str]:
    """Keys whose marks the wrapper overrules: what leads to its article, or else holds most of its text, is no boilerplate."""
    named = ("article", "main")
    open_ = sum(c[PROSE] for c, path, _ in _elements(w) if _name(c[KEY]) in named and not any(_name(k) in named for k in path[:-1]))
    inside = [
        (_whole(c), keys, partly) for c, keys, partly, often in _marked(w) if _name(c[KEY]) in named and not (often and open_)]
    inside = [x for x in inside if not _talk(x[1])] or ([] if open_ else inside)
    most = max((n for n, _, _ in inside), default=0)
    found = {k for n, keys, partly in inside if n and 2 * n >= most and n * (1 + partly) > open_ for k in keys}
    if not found and not open_:
        found = {k for c, keys, _, _ in _marked(w) if 2 * _whole(c) > _whole(w) and not _talk(keys) for k in keys}
    return sorted(found)


def opened(w: list, kept: Container[str]) -> list:
    """The wrapper with the elements of those keys outside boilerplate."""
    children = [opened(c, kept) if isinstance(c, list) else c for c in w[CHILDREN]]
    prose = sum(0 if _dropped(c) else c[PROSE] for c in children if isinstance(c, list))
    before = sum(0 if _dropped(c) else c[PROSE] for c in w[CHILDREN] if isinstance(c, list))
    drop = 0 if w[DROP] == MARKED and w[KEY] in kept else w[DROP]
    return [w[KEY], drop, *w[OPTIONAL:PROSE], max(w[PROSE] + prose - before, prose), w[CHARS], children, w[FIXED]]


def reading_of(w: list) -> tuple[str, list[str]]:
    """Where a wrapper has its articles, and the keys whose marks it overrules; by its slots, if it has pages enough and any text in them."""
    if w[PAGES] >= SHOWN:
        own = slotted(w)
        w = own if _whole(own) else w
    kept = kept_of(w)
    return place_of(opened(w, kept) if kept else w), kept


def place_of(w: list) -> str:
    """Where a wrapper has its articles: keys, or a path with slashes.

    Articles count where they hold half of the text outside boilerplate: the
    largest key with all that do not repeat, or, if that is too little, all
    keys. A smaller key that repeats beside a larger one is a list of teasers.
    """
    for name in ("article", "main"):
        keys = {}
        for c, path, often in _elements(w):
            if _name(c[KEY]) == name and c[PROSE] and not any(_name(k) == name for k in path[:-1]):
                n, once = keys.get(c[KEY], (0, False))
                keys[c[KEY]] = (n + c[PROSE], once or not often)
        if keys:
            top = max(sorted(keys), key=lambda k: keys[k][0])
            for chosen in (sorted(k for k in keys if k == top or keys[k][1]), sorted(keys)):
                if 2 * sum(keys[k][0] for k in chosen) >= w[PROSE]:
                    return " ".join(chosen)
    node, path = w, ()
    while True:
        inner = [c for c in node[CHILDREN] if isinstance(c, list) and not c[DROP]]
        top = max(inner, key=lambda c: c[PROSE], default=None)
        # paragraphs are no place of their own: only what holds most of the text and elements of its own
        if top is None or top[PROSE] < 0.6 * node[PROSE] or top[REPEATED] or not any(
                isinstance(c, list) and c[KEY].split(".")[0].split("#")[0] not in INLINE for c in top[CHILDREN]):
            break
        node, path = top, path if top[KEY] == "()" else (*path, top[KEY])
    if path and re.search("[.#]", path[-1]):
        return path[-1]
    return "/".join(path) or "html"


def _collect(node: list, out: list[str]) -> None:
    for c in node[2]:
        if isinstance(c, str):
            out.append(html.unescape(c))
        elif not c[1]:
            block = c[3] not in INLINE
            if block:
                out.append(" ")
            _collect(c, out)
            if block:
                out.append(" ")


def _held(w: list, places: list[str], path: str = "") -> int:
    """Characters outside links and boilerplate in the outermost elements at the places."""
    held = 0
    for c in w[CHILDREN]:
        if isinstance(c, list) and not _dropped(c):
            own = path if c[KEY] == "()" else f"{path}/{c[KEY]}" if path else c[KEY]
            held += c[PROSE] if c[KEY] in places or own in places else _held(c, places, own)
    return held


def _place_on(w: list, place: str) -> str:
    """The host's place for a page, with the page's own where the host's holds less than half of its text."""
    if 2 * _held(w, place.split()) < w[PROSE]:
        return f"{place} {place_of(w)}"
    if re.search("[.#]", place) or _name(place) in ("article", "main"):
        return place
    own = place_of(w)  # the host has no place of a name; the page may have an article
    return own if _name(own) in ("article", "main") else place


def _at(node: list, places: list[str], path: str, out: list[str]) -> None:
    """Texts of the outermost elements at the places."""
    for c in node[2]:
        if isinstance(c, str) or c[1]:
            continue
        own = f"{path}/{c[0]}" if path else c[0]
        if c[0] in places or own in places:
            out.append(" ")
            _collect(c, out)
            out.append(" ")
        else:
            _at(c, places, own, out)


def hidden(node: list, same: Container[str]) -> list:
    """The signed page with the blocks ``same`` as boilerplate."""
    for c in node[2]:
        if isinstance(c, list):
            if f"{c[0]}:{c[4]}" in same:
                c[1] = BY_TAG
            else:
                hidden(c, same)
    return node


def text_at(tree: list, place: str) -> str:
    out: list[str] = []
    _at(tree, place.split(), "", out)
    return " ".join("".join(out).split())


def main_text(page: str, place: str | None, kept: Container[str] = (), same: Container[str] = ()) -> str:
    found = ""
    for blocks in ([same] if same else []) + [()] if place else []:
        tree = parse(page, kept)
        if blocks:
            signed(tree)
            hidden(tree, blocks)
        found = found or text_at(tree, _place_on(wrapper_of(tree), place))
    for words in (True, False):  # in the end boilerplate is known by the tags' names only
        if not found:
            place, kept = reading_of(wrapper_of(parse(page, words=words)))
            tree = parse(page, kept, words)
            found = text_at(tree, place)
        if not found:
            out: list[str] = []
            _collect(tree, out)
            found = " ".join("".join(out).split())
    return found


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def _deep() -> None:
    sys.setrecursionlimit(max(sys.getrecursionlimit(), 20 * MAX_DEPTH))


def _infer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The wrapper of each host and part; a partition's pages stand in the order of both."""
    _deep()
    pages = ((host, part, wrapper_of(parse(page or ""))) for batch in batches for host, part, page in zip(
        *(batch.column(c).to_pylist() for c in ("host", "part", "html"))))
    yield from _in_order(pages)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same for partial wrappers, whose parts are dealt into fewer."""
    _deep()
    parts = ((host, part, json.loads(text)) for batch in batches for host, part, text in zip(
        *(batch.column(c).to_pylist() for c in ("host", "into", "wrapper"))))
    yield from _in_order(parts)


def _in_order(items: Iterator[tuple[str, int, list]]) -> Iterator[pa.RecordBatch]:
    for (host, part), group in itertools.groupby(items, key=lambda x: x[:2]):
        w = functools.reduce(merged, (x[2] for x in group))
        yield pa.RecordBatch.from_arrays(
            [pa.array([host], pa.string()), pa.array([part], pa.int64()), pa.array([json.dumps(w)], pa.string())], names=["host", "part", "wrapper"])


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each host's wrapper says."""
    _deep()
    for batch in batches:
        for host, text in zip(batch.column("host").to_pylist(), batch.column("wrapper").to_pylist()):
            w = json.loads(text)
            place, kept = reading_of(w)
            lists = [pa.array([x], pa.list_(pa.string())) for x in (kept, shown(w))]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array([x], pa.string()) for x in (host, text, place, expression(w))), *lists], names=["host", "wrapper", "place", "expression", "kept", "same"])


PARTIAL = "host string, part long, wrapper string"
SCHEMA = "host string, wrapper string, place string, expression string, kept array<string>, same array<string>"
SALT = 16


def infer(pages: DataFrame, url_name: str = "url", html_name: str = "html") -> DataFrame:
    """(host, wrapper, place, expression, kept, same): one row per host, from all its pages."""
    content = F.xxhash64(F.coalesce(F.col(html_name), F.lit("")))
    parts = -(-pages.count() // PAGES_A_PART) or 1
    dealt = pages.select(
        host_of(F.col(url_name)).alias("host"), F.pmod(content, F.lit(parts)).cast("long").alias("part"), content.alias("content"), F.col(html_name).alias("html"))
    some = dealt.repartition("host", "part").sortWithinPartitions("host", "part", "content", "html").mapInArrow(_infer, PARTIAL)
    while parts > 1:
        parts = -(-parts // SALT)
        into = some.withColumn("into", F.expr(f"part div {SALT}")).repartition("host", "into")
        some = into.sortWithinPartitions("host", "into", "part").mapInArrow(_merge, PARTIAL)
    return some.mapInArrow(_read, SCHEMA)


@F.arrow_udf(T.StringType())
def _extract(pages: pa.Array, places: pa.Array, kept: pa.Array, same: pa.Array) -> pa.Array:
    _deep()
    columns = (c.to_pylist() for c in (pages, places, kept, same))
    return pa.array([main_text(p or "", q, k or (), set(s or ())) for p, q, k, s in zip(*columns)], pa.string())


def extract(pages: DataFrame, url_name: str = "url", html_name: str = "html") -> DataFrame:
    """``pages`` as struct column _page with _text, the main text by the wrapper of the page's host."""
    wrappers = settled(infer(pages, url_name, html_name), "wrappers")
    packed = pages.select(
        F.struct(*(F.col(f"`{c}`") for c in pages.columns)).alias("_page"), host_of(F.col(url_name)).alias("_host"), F.col(html_name).alias("_html"))
    names = {"host": "_host", "place": "_place", "kept": "_kept", "same": "_same"}
    placed = packed.join(wrappers.select(*(F.col(a).alias(b) for a, b in names.items())), "_host", "left")
    return placed.select("_page", _extract(F.col("_html"), F.col("_place"), F.col("_kept"), F.col("_same")).alias("_text"))
