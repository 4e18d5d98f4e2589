"""Main text of web pages by line-block distribution.

Markup is stripped to lines: a block element's text is one line, inline tags
leave no trace, white space inside a line becomes one space. Elements that
can't be article text (scripts, styles, forms, navigation, headers and footers
of the site, asides, adverts, notices, reader comments, hidden parts) give no
line. An element that may be a wrapper of the article (a form, one named
``has-sidebar``) is read after all when it holds more text than what is left of
the page and no marked article stands outside it.

Every remaining line has a weight, its text length less twice that of its
links; where the page marks its article, a line inside that is not just a link
weighs ``MARK`` more. A mark around less text than stands outside counts for
nothing. Weights are summed over sliding windows of ``BLOCK`` lines. The text
starts where the sums surge, to ``SURGE`` or, on a page of short lines, to half
of its largest sum, and ends where they dive to ``DIVE`` (a third of the surge)
or the marked part begins or ends; weightless lines at both ends of the stretch
are cut off, and stretches at most ``BLOCK`` lines apart are one. A page that
marks its article keeps every stretch of it and those outside of at least
``OUTSIDE`` of its heaviest; any other the heaviest stretch and those of at
least ``SHARE`` of its weight.

A page is read in one pass; ends of elements are matched by one stack per name.
"""

from __future__ import annotations

import heapq
import html as entities
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventweave.llm.tables import map_texts

BLOCK = 3
SURGE = 60
DIVE = 20
MARK = 15           # less than SURGE / BLOCK, so that the sums decide inside the marked part too
SHARE = 0.2
OUTSIDE = 0.5

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>", re.S)
_RAW = {"script", "style", "noscript", "template", "textarea", "title", "svg", "math", "iframe", "object",
        "canvas", "audio", "video", "select", "button", "head"}
_RAW_END = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in _RAW}
_GONE = {"nav", "footer", "aside", "form", "menu", "dialog", "header", "search"}
_INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font",
           "i", "img", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span",
           "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_HEADING = {"h1", "h2", "h3"}
_ATTR = re.compile(r"([a-zA-Z-]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_PART = re.compile(r"[a-z]+|[0-9]+")
# Words in class, id and role that mark something other than the article.
_MARKS = set("""ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner
cookie cookies consent gdpr notice notices alert sidebar aside widget widgets menu menus nav navbar navigation
breadcrumb breadcrumbs masthead footer comment comments commentlist disqus reply replies
response responses respond discussion share sharing social
related recommended recommendations newsletter subscribe subscription signup login popup modal overlay lightbox
pagination pager toolbar search complementary contentinfo topbar bottombar outbrain taboola""".split())
_OWN = {"article", "entry", "post", "story", "content", "main"}
_REPLIES = {"comment", "comments", "reply", "replies", "response", "responses", "respond", "ad", "ads", "advert", "sponsored", "related", "promo"}


_NEVER = {"nav", "footer", "menu", "dialog", "search", "aside"}


def _may_hold_text(tag: str, attrs: str) -> bool:
    """Whether an unwanted element could be a wrapper of the article, by its marks."""
    if tag in _NEVER:
        return False
    for m in _ATTR.finditer(attrs):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return False
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return False
        if name in ("class", "id", "role"):
            if set(_PART.findall(value)) & (_REPLIES | {"commentlist", "disqus", "discussion"}):
                return False
            # a name that starts with such a word is the thing itself, not a wrapper with one
            if any((parts := _PART.findall(word)) and parts[0] in _MARKS for word in value.split()):
                return False
    return True


def _unwanted(tag: str, attrs: str, depth_article: int) -> bool:
    if tag in _GONE:
        return tag != "header" or not depth_article
    if not attrs or tag in ("html", "body", "main"):
        return False
    words: set[str] = set()
    for m in _ATTR.finditer(attrs):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
        if name in ("class", "id", "role"):
            words.update(_PART.findall(value))
            if name != "class" and value in ("header", "banner") or "site-header" in value or "page-header" in value:
                return not depth_article
    if tag == "article":
        return bool(words & _REPLIES)
    return bool(words & _MARKS) and not (words & _OWN and not words & _REPLIES)


def _is_article(tag: str, attrs: str) -> bool:
    return tag in ("article", "main") or bool(attrs) and bool(
        re.search(r"role\s*=\s*[\"']?main|itemprop\s*=\s*[\"']?articleBody", attrs))


Line = tuple[str, int, bool, bool]


def _own(line: Line) -> int:
    return max(0, len(line[0]) - 2 * line[1])


def _ends(tags: list[re.Match]) -> list[int]:
    """The tag number of the end of each open tag; -1 without one."""
    out = [-1] * len(tags)
    open_: dict[str, list[int]] = {}
    for k, m in enumerate(tags):
        if not m[2]:
            continue
        name = m[2].lower()
        if not m[1]:
            if name not in _VOID and not m[3].endswith("/"):
                open_.setdefault(name, []).append(k)
        elif open_.get(name):
            out[open_[name].pop()] = k
    return out


def lines_of(page: str) -> list[Line]:
    """(text, characters of links, in the article, heading) of each line with text, in page order.

    Lines of unwanted elements are left out, but for elements that may be
    wrappers of the article and hold more text than the rest of the page.
    """
    lines, owner, parent, may, marked = _lines(page)
    own = [0] * (len(parent) + 1)               # the last one: what stands in no unwanted element
    holds_article = [False] * (len(parent) + 1)
    for line, e in zip(lines, owner):
        own[e] += _own(line)
        holds_article[e] |= line[2]
    children: dict[int, list[int]] = {}
    for e, p in enumerate(parent):
        children.setdefault(p, []).append(e)
    spared, kept = {-1}, own[-1]
    article_outside = holds_article[-1]
    heap = [(-own[e], e) for e in children.get(-1, ())]
    heapq.heapify(heap)
    while heap and -heap[0][0] > kept:
        _, e = heapq.heappop(heap)
        if (may[e] and not article_outside) or marked[e]:
            spared.add(e)
            kept += own[e]
            article_outside |= holds_article[e]
            for c in children.get(e, ()):
                heapq.heappush(heap, (-own[c], c))
    return [line for line, e in zip(lines, owner) if e in spared]


def _lines(page: str):
    """All lines, the unwanted element of each (-1: none), and of those elements the one around it, whether it may
    be a wrapper, and whether the page's article is marked as such in it."""
    tags = list(_TAG.finditer(page))
    ends = _ends(tags)
    out: list[Line] = []
    owner: list[int] = []
    parent: list[int] = []
    may: list[bool] = []
    marked: list[bool] = []
    inside: list[tuple[int, int, int]] = []     # open unwanted elements: number, tag number of the end, article depth
    words: list[str] = []
    linked, in_link, heading = 0, False, False
    article: list[str] = []         # open tags of the name that opened the article
    at, k = 0, 0

    def add(piece: str) -> None:
        nonlocal linked
        if piece:
            words.append(piece)
            if in_link:
                linked += len(piece)

    def close() -> None:
        nonlocal linked
        text = " ".join(entities.unescape("".join(words)).split())
        if text:
            out.append((text, min(linked, len(text)), bool(article), heading))
            owner.append(inside[-1][0] if inside else -1)
        words.clear()
        linked = 0

    while k < len(tags):
        m = tags[k]
        if m.start() < at:
            k += 1
            continue
        add(page[at:m.start()])
        at = m.end()
        if not m[2]:
            k += 1
            continue
        tag, attrs = m[2].lower(), m[3]
        if not m[1] and tag in _RAW:
            end = _RAW_END[tag].search(page, at)
            if end or tag in ("script", "style"):
                at = end.end() if end else len(page)
            close() if tag not in ("button", "svg", "math") else None
        elif not m[1] and tag not in _VOID and ends[k] >= 0 and _unwanted(tag, attrs, len(article)):
            if tag not in _INLINE:
                close()
            inside.append((len(parent), ends[k], len(article)))
            parent.append(inside[-2][0] if len(inside) > 1 else -1)
            may.append(_may_hold_text(tag, attrs))
            marked.append(False)
        elif m[1] and inside and any(e == k for _, e, _ in inside[-1:]):
            close()
            del article[inside.pop()[2]:]
        elif tag in _INLINE:
            if tag == "a":
                in_link = not m[1]
        else:
            close()
            heading = tag in _HEADING and not m[1]
            if m[1]:
                if article and tag == article[-1]:
                    article.pop()
            elif not attrs.endswith("/") and (article and tag == article[-1] or _is_article(tag, attrs)):
                if inside and not article and may[inside[-1][0]]:
                    marked[inside[-1][0]] = True
                article.append(tag)
        k += 1
    add(page[at:])
    close()
    return out, owner, parent, may, marked


def main_text(page: str | None) -> str:
    """The main text of one page; empty for a null page or one without any."""
    if not page:
        return ""
    lines = lines_of(page)
    if not lines:
        return ""
    marked = 2 * sum(_own(x) for x in lines if x[2]) >= sum(map(_own, lines)) and any(x[2] for x in lines)
    weights = []
    for line in lines:
        text, linked, inside, heading = line
        own = _own(line)
        if marked and inside and (heading or len(text) > linked):
            own += MARK
        elif heading:
            own = max(own, DIVE + 1)
        weights.append(own)
    part = [marked and inside for _, _, inside, _ in lines]
    sums = [sum(w for w, p in zip(weights[i:i + BLOCK], part[i:i + BLOCK]) if p == part[i]) for i in range(len(weights))]
    surge = min(SURGE, max(sums) / 2)
    dive = DIVE * surge / SURGE
    stretches, i = [], 0
    while i < len(sums):
        if sums[i] < surge or not sums[i]:
            i += 1
            continue
        j = i
        while j < len(sums) and sums[j] > dive and part[j] == part[i]:
            j += 1
        a, b = i, j
        while a < b and not weights[a]:
            a += 1
        while b > a and not weights[b - 1]:
            b -= 1
        if a < b:
            if stretches and a - stretches[-1][1] <= BLOCK and part[stretches[-1][0]] == part[a]:
                a = stretches.pop()[0]                          # a short dip is part of the text
            stretches.append((a, b))
        i = max(j, i + 1)
    if not stretches:
        return ""
    total = [0]
    for w in weights:
        total.append(total[-1] + w)
    weight = {a: total[b] - total[a] for a, b in stretches}
    inside = [weight[a] for a, _ in stretches if part[a]]
    least = OUTSIDE * max(inside) if inside else SHARE * max(weight.values())
    return " ".join(lines[k][0] for a, b in stretches if weight[a] >= least or part[a] for k in range(a, b))


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """(key, url, text, n_chars) of every row; the page is read whole.

    A null, empty or textless page gives an empty text; a null url stays
    null. Repeated rows repeat; an empty table gives an empty result; other
    columns are not read.
    """
    both = pages.select(F.struct(F.col(key).cast("long").alias("k"), F.col(url).cast("string").alias("u")).alias("row"),
                        F.col(page).alias("page"))

    def run(rows, texts):
        found = [main_text(t) for t in texts]
        return [[r["k"] for r in rows], [r["u"] for r in rows], found, [len(t) for t in found]]

    return map_texts(both, "row", "page", run, f"{key} long, {url} string, text string, n_chars long")
