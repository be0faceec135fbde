"""Main text of web pages by the maximum-scoring run of tokens.

A page is read as a sequence of words and tags.  Words score positive, tags
negative; the run with the largest sum (one linear scan) is the article.  The
weights come from labelled pages: pages whose article is marked up as such
(``article`` or ``main``) say for every tag, and for words by the element
around them, how often they stand inside the content.  Elements that are
never content (menus, forms, adverts, comments, ...) score nothing for their
words and are left out of the text when they stand inside the run.
"""

from __future__ import annotations

import html
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pages among which the weights are fitted, about (by a hash of id and url).
FIT_PAGES = 4000

# Element names of the HTML standard by their role here.
RAW = {"script", "style", "xmp", "iframe", "noembed", "noframes", "textarea", "title"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt",
    "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup", "hr", "html",
    "legend", "li", "main", "menu", "nav", "ol", "option", "p", "pre", "section", "select", "summary", "table", "tbody", "td", "tfoot",
    "th", "thead", "tr", "ul",
}
NEVER = {
    "annotation", "annotation-xml", "applet", "aside", "audio", "button", "canvas", "datalist", "dialog", "embed", "fieldset", "footer", "form", "head", "iframe", "input",
    "label", "menu", "nav", "noembed", "noframes", "noscript", "object", "option", "script", "select", "style", "svg", "template",
    "textarea", "title", "video", "xmp",
}
CONTENT = {"article", "main"}
SECTION = CONTENT | {"aside", "body", "footer", "header", "nav", "form"}
#: Words of class, id and role attributes that name what is not the article.
NEVER_NAMED = {
    "ad", "ads", "adbox", "adslot", "advert", "adverts", "advertisement", "advertisements", "advertising", "alert", "aside", "banner",
    "breadcrumb", "breadcrumbs", "comment", "commentlist", "comments", "complementary", "consent", "contentinfo", "cookie", "cookies", "copyright",
    "dialog", "disclaimer", "discussion", "disqus", "footer", "footnav", "form", "gdpr", "login", "masthead", "menu", "menubar", "modal", "nav",
    "navbar", "navigation", "newsletter", "notice", "notices", "notification", "overlay", "pager", "pagination", "popup", "promo", "promoted",
    "promotion", "recommended", "related", "replies", "reply", "respond", "responses", "search", "share", "sharing", "sidebar", "sidenav",
    "signup", "social", "sponsor", "sponsored", "sponsors", "subscribe", "subscription", "toolbar", "widget", "widgets",
}
TOP_NAMED = {"header", "topbar"}
#: Elements that pages use for anything; what labelled pages use them for says little about others.
GENERIC = {"div", "section", "span", "center", "table", "tbody", "tr", "td"}
HEADINGS = {"h1", "h2", "h3"}
#: Words that the mark of an article is worth: text outside of it does not make up for leaving it.
MARKED = 1e6
#: Words that a telling class or role inside of an article takes from its element; what is left with none is left out.
NAME_COST = 30.0

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:=\s*+(?:"[^"]*+"(?=[\s/>])|'[^']*+'(?=[\s/>])|"[^"<>]*+"|'[^'<>]*+')|[^<>])*+)>""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'<>]+)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_NAMES = re.compile(r"[a-z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Item:
    """A tag (``name``) or a stretch of text (``name`` is None); ``within``: inside of a marked article."""

    __slots__ = ("name", "close", "text", "never", "around", "within")

    def __init__(self, name, close, text, never, around, within):
        self.name, self.close, self.text, self.never, self.around, self.within = name, close, text, never, around, within


def _never(name: str, within: bool) -> bool:
    return name in NEVER and not (within and name == "label")


def _named(attributes: str, within: bool) -> tuple[set[str], bool]:
    """Names that the attributes give, and whether the element is hidden; in an article classes and roles as wholes, and no id (headings have slugs)."""
    names, hidden = set(), False
    for key, value in _ATTRIBUTE.findall(attributes):
        key = key.lower()
        value = value.strip("\"'")
        if within and key in ("class", "role"):
            for token in value.split():
                # "ad-banner", "adBox" as wholes: all of it tells, other than in "related-work"
                words = [w.lower() for w in re.split(r"[^A-Za-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", token)) if w]
                names.update(words if NEVER_NAMED.issuperset(words) else ["".join(words)])
        elif not within and key in ("class", "id", "role"):
            # "commentList", "side-bar_ad2" -> words
            for part in re.split(r"[^A-Za-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", value)):
                names.add(part.lower())
            names.add("".join(_NAMES.findall(value.lower())))
        elif key == "hidden" or key == "aria-hidden" and value.lower() == "true" or key == "style" and _HIDDEN.search(value):
            hidden = True
    return names, hidden


def parse(page: str) -> list[Item]:
    """Tags and texts of a page in order, each with the innermost open element and whether it is never content."""
    items: list[Item] = []
    stack: list[tuple[str, bool, int]] = []  # open elements: name, never content, index of their tag
    marks: dict[int, int] = {}  # never-content elements that go by their names only: tag index -> end index
    judged: dict[int, int] = {}  # elements with telling names inside of an article: tag index -> end index
    at = 0
    marked = 0  # open elements that mark an article
    opened: dict[str, int] = {}  # open elements by name

    def state():
        return stack[-1][1] if stack else False

    def around():
        return stack[-1][0] if stack else ""

    def within():
        return marked > 0

    def ends(entries):
        nonlocal marked
        for name, _, k in entries:
            opened[name] -= 1
            marked -= name in CONTENT
            if k in judged:
                judged[k] = len(items)

    def text(s):
        if s:
            items.append(Item(None, False, s, state(), around(), within()))

    pos = 0
    find = _TOKEN.search
    while m := find(page, pos):
        text(page[at:m.start()])
        at = pos = m.end()
        name = m[2]
        if name is None:
            continue
        name = name.lower()
        if m[1]:
            depth = next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name) if opened.get(name) else None
            inside = stack[depth][1] if depth is not None else state()
            if depth is not None:
                for _, _, k in stack[depth:]:
                    if k in marks:
                        marks[k] = len(items)
                gone = stack[depth:]
                del stack[depth:]
                ends(gone)
            items.append(Item(name, True, "", inside, around(), within()))
            continue
        # an element that its parent's next child closes
        if name == "p" or name in BLOCK:
            while stack and stack[-1][0] == "p":
                ends([stack.pop()])
        if name in ("li", "tr", "td", "th", "dt", "dd", "option") and stack and stack[-1][0] == name:
            ends([stack.pop()])
        in_content = within()
        never = state() or _never(name, in_content)
        attributes = m[3]
        if not never and attributes:
            names, hidden = _named(attributes, in_content)
            named = name not in ("body", "html") and not NEVER_NAMED.isdisjoint(names)
            never = hidden or not in_content and name not in CONTENT and (named or name not in ("body", "html") and not TOP_NAMED.isdisjoint(names))
            if never and not hidden and name not in VOID:
                marks[len(items)] = -1
            elif not never and named and in_content and name not in VOID and not attributes.rstrip().endswith("/"):
                judged[len(items)] = -1
        if name == "header" and not never:
            never = not within()
            if never:
                marks[len(items)] = -1
        items.append(Item(name, False, "", never, around(), within()))
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(page, pos)
            at = pos = end.end() if end else len(page)
        elif name not in VOID and not attributes.rstrip().endswith("/"):
            stack.append((name, never, len(items) - 1))
            opened[name] = opened.get(name, 0) + 1
            marked += name in CONTENT
    text(page[at:])
    for k, end in marks.items():
        end = len(items) if end < 0 else end
        # a wrapper with a telling name around the article itself is not what its name says
        if any(i.name in CONTENT and not i.close or i.name == "h1" and items[k].name != "header" for i in items[k + 1:end]):
            _restore(items, k, end)
    if judged:
        _judge(items, {k: len(items) if end < 0 else end for k, end in judged.items()})
    return items


def _judge(items: list[Item], named: dict[int, int]) -> None:
    """Leaves out the named elements whose words don't outweigh their names, unless they hold an article or its title."""
    words, names, titles = [0.0], [0], [0]
    for i, x in enumerate(items):
        words.append(words[-1] + (len(x.text.split()) * (0.25 if x.around == "a" else 1.0) if x.name is None and not x.never else 0.0))
        names.append(names[-1] + (i in named))
        titles.append(titles[-1] + (x.name in CONTENT and not x.close or x.name == "h1"))
    out = 0
    for k, end in sorted(named.items()):
        if k < out or titles[end] > titles[k + 1] or words[end] - words[k] > NAME_COST * (names[end] - names[k]):
            continue
        out = end + (end < len(items) and items[end].close and items[end].name == items[k].name)
        for x in items[k:out]:
            x.never = True


def _restore(items: list[Item], start: int, end: int) -> None:
    """Takes the mark of the element ``start`` from what it holds, but not from elements that are never content by themselves."""
    items[start].never = False
    inner: list[str] = []
    for i in items[start + 1:end]:
        if i.name is None:
            i.never = bool(inner)
        elif not i.close:
            i.never = bool(inner) or _never(i.name, i.within)
            if i.never and i.name not in VOID and i.name not in RAW:
                inner.append(i.name)
        else:
            i.never = bool(inner)
            if inner and inner[-1] == i.name:
                inner.pop()


def observations(page: str) -> dict[tuple[str, bool], int] | None:
    """Feature counts inside and outside of the marked article; None for a page that is not labelled.

    Features: ``<name`` for tags and ``around name`` for words by the element around them.
    """
    items = parse(page)
    opened = [i for i, x in enumerate(items) if x.name in CONTENT and not x.close]
    closed = [i for i, x in enumerate(items) if x.name in CONTENT and x.close]
    if not opened or not closed or closed[-1] < opened[0]:
        return None
    lo, hi = opened[0], closed[-1]
    out: dict[tuple[str, bool], int] = {}
    for i, x in enumerate(items):
        inside = lo < i < hi and not x.never
        if x.never and x.name not in SECTION:  # left out by themselves: they say nothing about tags elsewhere
            continue
        if x.name is not None:
            key = ("<" + x.name, inside)
            out[key] = out.get(key, 0) + 1
        else:
            n = len(x.text.split())
            if n:
                out[(x.around, inside)] = out.get((x.around, inside), 0) + n
    return out


def weights(counts: dict[tuple[str, bool], int]) -> dict[str, float]:
    """Feature weights: word weights in (0, 1], tag weights below 0 (larger cost for what stands outside of articles)."""
    out = {}
    for f in {k[0] for k in counts}:
        inside, outside = counts.get((f, True), 0) + 1.0, counts.get((f, False), 0) + 1.0
        if f.startswith("<"):
            cost = 0.25 + max(0.0, math.log(outside / inside))
            out[f] = -(10 * cost if f[1:] in SECTION else min(0.5 if f[1:] in GENERIC else 2.0, cost))
        else:
            out[f] = min(1.0, max(0.25, 0.5 + math.log10(inside / outside) / 4))
    return out


def _default(name: str) -> float:
    return -20.0 if name in SECTION else -1.0 if name == "a" else -0.25


def scores(items: list[Item], weight: dict[str, float]) -> list[tuple[int, float]]:
    """(item, score) in page order: words above 0, tags below; a marked article is worth more than all words, and leaving or entering it costs that."""
    out: list[tuple[int, float]] = []
    for i, x in enumerate(items):
        if x.name is None:
            if not x.never and (n := len(x.text.split())):
                out.append((i, n * weight.get(x.around, 0.25 if x.around == "a" else 1.0)))
            continue
        w = weight.get("<" + x.name, _default(x.name))
        if x.within and x.name not in CONTENT:  # menus, notes and the like that an article holds don't end it
            w = max(w, -0.25)
        if x.name in CONTENT and not x.never and not x.within:
            out += [(i, w - MARKED)] if x.close else [(i, -MARKED), (i, MARKED)]
            continue
        out.append((i, w / 10 if x.never and x.name not in SECTION else w))
        if x.never and not x.close and not x.within and not (i and items[i - 1].never):
            # a menu, form or note stands rather between than within articles; an advert stands anywhere
            out.append((i, -3.0 if x.name in NEVER or x.name in SECTION else -0.5))
    return out


def best_run(items: list[Item], scored: list[tuple[int, float]]) -> tuple[float, tuple[int, int] | None]:
    """Sum, first and last item of the run of the largest sum that ends with a word, by one scan."""
    best, run, total, start = 0.0, None, 0.0, 0
    for i, score in scored:
        if score > 0 and total <= 0:
            total, start = 0.0, i
        total += score
        if score > 0 and total > best and items[i].name is None:
            best, run = total, (start, i)
    return best, run


def main_text(page: str | None, weight: dict[str, float]) -> str:
    """The article's blocks, joined by one newline; empty if there is none."""
    items = parse(page or "")
    _, best_at = best_run(items, scores(items, weight))
    if best_at is None:
        return ""
    lo, hi = best_at
    # whole blocks: the run's first and last block may hold inline tags that cost more than a word gains
    while lo > 0 and not (items[lo - 1].name in BLOCK):
        lo -= 1
    while hi + 1 < len(items) and not (items[hi + 1].name in BLOCK):
        hi += 1
    # a heading right before the run leads into it
    i = lo - 1
    while i >= 0 and items[i].name not in SECTION and not items[i].never and not (items[i].name is None and items[i].around not in HEADINGS and items[i].text.strip()):
        if items[i].name in HEADINGS and not items[i].close:
            lo = i
        i -= 1
    blocks, own = [], []

    def end():
        line = " ".join(html.unescape("".join(own)).split()) if own else ""
        if line:
            blocks.append(line)
        own.clear()

    for x in items[lo:hi + 1]:
        if x.name is None:
            if not x.never:
                own.append(x.text)
        elif x.name == "br" or x.never and x.name not in BLOCK:
            own.append(" ")
        elif x.name in BLOCK:
            end()
    end()
    return "\n".join(blocks)


def _observe(batches):
    for b in batches:
        total: dict[tuple[str, bool], int] = {}
        for page in b.column(0):
            for k, n in (observations(page.as_py()) or {}).items():
                total[k] = total.get(k, 0) + n
        yield pa.record_batch({"feature": pa.array([k[0] for k in total], pa.string()), "inside": pa.array([k[1] for k in total], pa.bool_()),
                               "n": pa.array(list(total.values()), pa.int64())})


def fit_weights(pages: DataFrame, fit_pages: int = FIT_PAGES) -> dict[str, float]:
    """Weights from the labelled ones among about ``fit_pages`` pages, chosen by a hash; features are element names, few whatever the input.

    The pages are counted where they lie: only counts are moved.
    """
    share = min(1.0, fit_pages / max(1, pages.count()))
    chosen = F.pmod(F.xxhash64(F.col("page_id").cast("string"), F.col("url").cast("string")), F.lit(1 << 30)) < int(share * (1 << 30))
    labelled = pages.filter(chosen).select(F.col("html").cast("string").alias("html")).filter(F.lower("html").rlike("<(article|main)[\\s>]"))
    rows = (labelled.mapInArrow(_observe, "feature string, inside boolean, n long")
            .filter(F.col("feature").rlike("^<?[a-z][a-z0-9]{0,15}$|^$")).groupBy("feature", "inside").agg(F.sum("n").alias("n"))
            .orderBy(F.desc("n"), "feature").limit(1000).collect())
    return weights({(r["feature"], r["inside"]): r["n"] for r in rows})


def _extract(weight: dict[str, float]):
    def run(batches):
        for b in batches:
            texts = [main_text(h.as_py(), weight) for h in b.column(2)]
            yield pa.record_batch({"page_id": b.column(0), "url": b.column(1), "text": pa.array(texts, pa.string()),
                                   "n_chars": pa.array([len(t) for t in texts], pa.int64())})
    return run


def extract_pages(pages: DataFrame, weight: dict[str, float] | None = None) -> DataFrame:
    """``(page_id, url, text, n_chars)``, one row per row of ``pages``.

    Null or empty html, and pages without an article, give an empty text.
    Nulls in ``page_id`` and ``url`` are passed on; repeated rows are kept.
    ``weight`` defaults to weights fitted on ``pages`` themselves; with no
    labelled page there, fixed weights by the elements' role are used.
    """
    weight = fit_weights(pages) if weight is None else weight
    plain = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return plain.mapInArrow(_extract(weight), "page_id long, url string, text string, n_chars long")
