"""Main text of web pages by line-block distribution.

Markup is stripped to lines, one per block. The lengths of the lines, summed over a sliding window, surge where the main
text starts and dive where it ends. Menus, adverts, forms and the like count as lines of no length, so that the sums dive
at them. The run of lines between surge and dive that holds most text is the core; the smallest sectioning element around
it sets where the article starts and ends, so that short first and last paragraphs stay.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from busframe.llm.common import bound_batches, lean, need

#: Lines in a window, and the sum that starts a surge (or a fifth of the largest sum, if that is less).
WINDOW, SURGE = 3, 80

_OPEN = re.compile(r"<!--|<[!?]|<(/?)([a-zA-Z][^\s/>]*+)")
_QUOTED = re.compile(r"""((?:[^>"']|"[^"]*+"|'[^']*+')*+)>""")
_MARK = re.compile(r"""[>"']""")
_ATTR = re.compile(r"""\b(class|id|role|hidden|style|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
#: Elements whose content is no markup; elements that never hold main text; elements that end a line; sectioning elements.
_RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "xmp", "noembed", "noframes", "object", "canvas", "audio", "video"}
_DROP = {"head", "nav", "footer", "aside", "form", "button", "select", "menu", "dialog", "fieldset", "label", "datalist", "map"}
_HOLD = {"article", "main", "section", "div", "td", "body", "center"}
_BLOCK = _DROP | _HOLD | {"html", "header", "address", "blockquote", "caption", "dd", "details", "dir", "dl", "dt", "figcaption", "figure", "h1", "h2", "h3", "h4", "h5", "h6", "hgroup", "hr", "legend", "li", "ol", "optgroup", "option", "p", "pre", "summary", "table", "tbody", "tfoot", "th", "thead", "tr", "ul"}
_VOID = {"hr", "br", "img", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr", "param"}
#: An element of the first kind also ends when one of the second kind opens.
_ENDED_BY = {"p": _BLOCK, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot"}, "td": {"td", "th", "tr", "tbody"}, "th": {"td", "th", "tr", "tbody"}, "option": {"option", "optgroup"}, "head": {"body"}}
_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "alertdialog", "dialog", "menu", "menubar", "toolbar"}
_BEFORE = r"(?:(?:site|page|main|top|left|right|bottom|global|user|reader|post|entry|article|blog|cookie|inline|google|text|sticky|mobile|js|the|primary|secondary)[-_]?)*"
_NAMES = r"ads?|advert(?:s|isements?|ising|orial)?|adsense|banners?|sponsor(?:s|ed)?|promo(?:s|tions?|ted)?|side[-_]?bars?|comments?|comment[-_]?list|discussion|disqus|replies|responses|respond|cookies?|consent|gdpr|notices?|notifications?|alerts?|pop[-_]?ups?|modals?|overlay|newsletter|subscri(?:be|ption)|sign[-_]?up|log[-_]?in|menus?|nav|navbar|navigation|breadcrumbs?|toolbar|shar(?:e|ing)|social|related|recommend(?:ed|ations?)|widgets?|paginat(?:ion|or)|pager|skip[-_]?links?|footers?|masthead|topbar|copyright|disclaimer|outbrain|taboola|dianomi|paywall|author[-_]?(?:bio|card)|tag[-_]?cloud|talkbacks?|guestbook|privacy|you[-_]?may[-_]?(?:also[-_]?)?like|more[-_]?stories|popular[-_]?posts?|trending|mpu|leaderboard|share[-_]?this"
_AFTER = r"(?:[-_]?(?:bar|box|block|list|section|area|container|wrapper|wrap|inner|menu|links?|widget|form|banner|notice|thread|content|unit|slot|item|text|message|posts?|buttons?|top|bottom|left|right|body|feed|prompt|bar|now|\d+))*"
#: Words of a compound class that make it boilerplate wherever they stand; words at its start that make it say something about the layout.
_PARTS = {"ad", "ads", "adv", "advert", "adverts", "advertisement", "advertisements", "advertising", "adsense", "adslot", "dfp", "sponsored", "promo", "cookie", "cookies", "gdpr", "consent", "popup", "modal", "newsletter", "comments", "disqus", "breadcrumb", "breadcrumbs", "navbar", "sidebar"}
_LAYOUT = {"has", "with", "no", "without", "hide", "hides", "show", "is", "not", "page", "layout", "above", "below", "beside"}
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_PAGE_PARTS = re.compile(r"<(?:article|main|nav|header|footer|h1)\b", re.I)
_BOILERPLATE = re.compile(rf"{_BEFORE}(?:{_NAMES}){_AFTER}|(?:(?:site|page|main|top|global)[-_]?)?header(?:[-_]?(?:bar|wrap|wrapper|inner|top))*", re.I)


#: Words that say nothing of what a box holds, beside _PARTS.
_PLAIN = {"in", "article", "inline", "box", "block", "list", "section", "area", "container", "wrapper", "wrap", "inner", "outer", "banner", "bar", "policy", "notice", "unit", "slot", "item", "text", "content", "widget", "form", "link", "links", "top", "bottom", "left", "right", "main", "site", "page", "body", "post", "entry", "module", "panel", "group", "row", "col", "column", "small", "large", "mobile", "desktop", "google", "native", "header", "footer", "holder", "zone", "space", "message", "popup", "modal", "overlay", "user", "reader", "the", "js", "js", "ui", "c", "l", "u", "o"}
#: Whether an element is boilerplate: it isn't, its content decides, it is.
NO, MAYBE, YES = 0, 1, 2


def _compound(name: str) -> int:
    """What a class such as in-article-ad (YES) or cookies-recipe (MAYBE: another word says what the box holds) tells by one of its words."""
    words = [w.lower() for w in _WORDS.findall(name)]
    if not words or words[0] in _LAYOUT or _PARTS.isdisjoint(words):
        return NO
    return YES if all(w in _PARTS or w in _PLAIN for w in words) else MAYBE


def _dropped(name: str, attrs: str, in_article: bool) -> int:
    if name in _DROP or name == "header" and not in_article:
        return YES
    if not attrs or name in ("html", "body", "article", "main"):
        return NO
    found = NO
    for key, a, b, c in _ATTR.findall(attrs):
        key, value = key.lower(), a or b or c
        if key in ("class", "id"):
            for x in value.split():
                found = max(found, YES if len(x) < 100 and _BOILERPLATE.fullmatch(x) else _compound(x))
        elif key == "role" and value.lower() in _ROLES or key == "hidden" or key == "aria-hidden" and value.lower() == "true" or key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return YES
    return found


class _Ends:
    """Where tags and elements without markup end, each page read once for each kind however many there are."""

    def __init__(self, page: str):
        self.page, self.last, self.found = page, page.rfind(">"), {}
        self.hard: tuple[list[int], list[int]] | None = None

    def places(self, pattern: str) -> list[int]:
        if pattern not in self.found:
            self.found[pattern] = [m.start() for m in re.finditer(pattern, self.page, re.I)]
        return self.found[pattern]

    def first(self, pattern: str, at: int) -> int | None:
        places = self.places(pattern)
        i = bisect_left(places, at)
        return places[i] if i < len(places) else None

    def tag(self, at: int) -> int:
        """The > that ends a tag whose name ends at `at`: one outside quotes, else the next one. There is one after `at`."""
        if self.hard is None:
            if m := _QUOTED.match(self.page, at):
                return m.end() - 1
            marks, ends = [m.start() for m in _MARK.finditer(self.page, at)], []
            follows, end = {'"': -1, "'": -1}, []  # from the right: the next mark of a kind, where a tag ends that is outside quotes at a mark
            for i in range(len(marks) - 1, -1, -1):
                c = self.page[marks[i]]
                if c == ">":
                    end.append(marks[i])
                else:
                    j = follows[c]
                    end.append(end[len(marks) - 2 - j] if 0 <= j < len(marks) - 1 else -1)
                    follows[c] = i
            ends = end[::-1]
            self.hard = marks, ends
        marks, ends = self.hard
        i = bisect_left(marks, at)
        return ends[i] if i < len(marks) and ends[i] >= 0 else self.page.find(">", at)


def lines(page: str) -> tuple[list[tuple[str, int, int, int]], list[tuple[int, int, int]]]:
    """A page's lines in order and its sectioning elements.

    A line: text, code points of it in links, number of the innermost element around it (0: none), and NO, MAYBE or YES, with
    MAYBE and YES by the boxes around it. Elements in order of their start: number of the one around it, kind (1: article, 2: main, 3:
    body, else 0), and of the innermost box around it that may be boilerplate. Time and memory grow with the page alone.
    """
    out: list[tuple[str, int, int, int]] = []
    elements: list[tuple[int, int, int]] = [(0, 0, NO)]
    # Of an open element: name, number of the innermost recorded element, place of the innermost sectioning one on the stack, boilerplate, whether in an article.
    stack: list[tuple[str, int, int, int, bool]] = [("", 0, -1, NO, False)]
    opened: dict[str, list[int]] = {}
    buf: list[str] = []
    linked, in_link = 0, False
    ends = _Ends(page)

    def flush() -> None:
        nonlocal linked
        if buf:
            if text := " ".join(html.unescape("".join(buf)).split()):
                out.append((text, linked, stack[-1][1], stack[-1][3]))
            buf.clear()
        linked = 0

    def pop(to: int) -> None:
        for name, *_ in stack[to:]:
            opened[name].pop()
        del stack[to:]

    def said(text: str) -> None:
        nonlocal linked
        if text:
            buf.append(text)
            linked += in_link and len(" ".join(html.unescape(text).split()))

    at, n = 0, len(page)
    while at < n:
        m = _OPEN.search(page, at)
        if not m:
            said(page[at:])
            break
        begin = m.start()
        if page.startswith("<!--", begin):
            said(page[at:begin])
            close = page.find("-->", begin + 4)
            at = close + 3 if close >= 0 else n
            continue
        if begin > ends.last:  # nothing that follows ends, comments apart
            comment = page.find("<!--", begin)
            said(page[at : comment if comment >= 0 else n])
            break
        said(page[at:begin])
        name = (m[2] or "").lower()
        if not name:
            at = page.find(">", begin) + 1
            continue
        stop = ends.tag(m.end())
        closing, attrs, at = m[1], page[m.end() : stop], stop + 1
        if name in _RAW:
            if not closing and not attrs.endswith("/"):
                close = ends.first(rf"</{re.escape(name)}[\s/>]", at)
                if close is not None:
                    at = page.find(">", close) + 1 or n
                elif name in ("script", "style", "title", "textarea"):
                    at = n
        elif name == "br":
            buf.append(" ")
        elif name == "a":
            in_link = not closing
        elif name in _BLOCK:
            flush()
            in_link = False
            if closing:
                if own := opened.get(name):
                    # A stray end tag doesn't close the section around it.
                    if name in _HOLD | _DROP | {"header", "html", "table", "ul", "ol", "dl"} or stack[-1][2] <= own[-1]:
                        pop(own[-1])
            else:
                while name in _ENDED_BY.get(stack[-1][0], ()):
                    pop(len(stack) - 1)
                if name not in _VOID:
                    _, number, section, around, inside = stack[-1]
                    drop = _dropped(name, attrs, inside)
                    if name == "form":  # a form around a page's parts is the page's, not a form to fill in
                        close, part = ends.first(r"</form\b", at), ends.first(r"<(?:article|main|nav|header|footer|h1)\b", at)
                        drop = NO if part is not None and (close is None or part < close) else drop
                    if name in _HOLD or drop == MAYBE:
                        elements.append((number, {"article": 1, "main": 2, "body": 3}.get(name, 0 if name in _HOLD else 4), drop))
                        number = len(elements) - 1
                    opened.setdefault(name, []).append(len(stack))
                    stack.append((name, number, len(stack) if name in _HOLD else section, max(around, drop), inside or name in ("article", "main")))
    flush()
    return out, elements


def main_text(page: str) -> str:
    """The article of one page as one line of text; empty if it has none."""
    found, elements = lines(page)
    if not found:
        return ""
    # Boxes whose names leave it open: one whose own lines surge as an article's do, in few links, is kept.
    last = list(range(len(elements)))
    own: list[list[int]] = [[0, 0] for _ in elements]
    for t, linked, k, d in found:
        if d < YES:
            own[k][0] += len(t)
            own[k][1] += linked
    for k in range(len(elements) - 1, 0, -1):
        up = elements[k][0]
        last[up] = max(last[up], last[k])
        own[up][0] += own[k][0]
        own[up][1] += own[k][1]
    gone = [False] * len(elements)
    for k in range(1, len(elements)):
        gone[k] = gone[elements[k][0]] or elements[k][2] == MAYBE and (own[k][0] < SURGE or 2 * own[k][1] > own[k][0])
    off = [d == YES or gone[k] for _, _, k, d in found]
    lengths = [0 if o or 2 * linked > len(t) else len(t) for (t, linked, _, _), o in zip(found, off, strict=True)]
    sums = [sum(lengths[i : i + WINDOW]) for i in range(len(lengths))]
    least = min(SURGE, max(sums) / 5)
    if not max(sums):
        return ""
    best, run = (0, 0, 0), None
    for i, s in enumerate([*sums, -1]):
        if s >= least and s > 0:
            run = i if run is None else run
        elif run is not None:
            stop = min(i + WINDOW - 1, len(lengths))
            while stop > i and not lengths[stop - 1]:
                stop -= 1
            best, run = max(best, (sum(lengths[run:stop]), run, stop), key=lambda x: x[0]), None
    total, first, end = best
    inside, depth = [0] * len(elements), [0] * len(elements)
    for i in range(first, end):
        inside[found[i][2]] += lengths[i]
    for k in range(1, len(elements)):
        depth[k] = depth[elements[k][0]] + 1
    for k in range(len(elements) - 1, 0, -1):
        inside[elements[k][0]] += inside[k]
    sections = [k for k in range(1, len(elements)) if inside[k] and elements[k][1] < 4]
    deepest = lambda share: max((k for k in sections if inside[k] >= share * total), key=lambda k: depth[k], default=None)
    chosen = deepest(1)
    if chosen is None or elements[chosen][1] == 3:  # text beside the article reached the core
        chosen = deepest(0.9)
    marked = [k for k in sections if inside[k] >= 0.5 * total and elements[k][1] in (1, 2)]
    if marked:  # an article, or else the main element, is the whole of the text
        chosen = min((k for k in marked if elements[k][1] == 1), key=lambda k: depth[k], default=max(marked, key=lambda k: depth[k]))
    whole = chosen is not None and elements[chosen][1] in (1, 2)
    return " ".join(t for (t, linked, k, _), o in zip(found, off, strict=True) if not o and (chosen is None or chosen <= k <= last[chosen]) and (whole or 2 * linked <= len(t)))


def extract(pages: DataFrame, *, keep: list[str], html_col: str = "html") -> DataFrame:
    """Main text of every page: the columns `keep`, then text (empty if a page has none) and n_chars (its code points).

    A null page is empty. Whole pages are read, however long. Repeated rows give repeated rows, an empty table none.
    Columns of `keep` named text or n_chars are replaced. No shuffle; a task holds one batch of rows.
    """
    need(pages, html_col, *keep)
    bound_batches(pages.sparkSession)
    keep = [c for c in keep if c not in ("text", "n_chars")]
    schema = pages.select(*keep).schema.add("text", "string").add("n_chars", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 1000):
                part = b.slice(i, 1000)
                texts = [main_text(x) if x else "" for x in part.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns[1:], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=[f.name for f in schema.fields])

    return pages.select(pages[html_col].alias("__html"), *[pages[c] for c in keep]).mapInArrow(lean(run), schema)
