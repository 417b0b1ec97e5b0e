"""Main text of HTML pages by tag-path ratios.

A page is read into blocks of text, each with its root-to-leaf tag path.  Per
path the text length, the punctuation and the link text are summed up.  A
path's length and punctuation (plus one, the smoothing) against the number of
its nodes give two ratios; they are smoothed with those of the paths beside
it in page order, fused as a product and weighted by the text outside of
links.  Paths whose fused value is above the threshold ``least_share`` of
their page mark the content; the deepest container that holds all of them is
the article (the whole page where no path passes), and its paths are kept
whole unless they lead through boilerplate (navigation, forms, scripts,
adverts, comments and the like, by element or by a word of class, id or
role).  Of a container that is no ``article`` or ``main``, paths below the threshold
whose text is mostly links (menus without a name) are left out, and headings
right before its first block belong to it.  Where that container lies in an ``article`` or
``main`` element it is widened to the element; such an element that the values
do not choose (a teaser, a card) decides nothing.

Edge cases: null and empty pages, pages of boilerplate only and pages cut off
before their article give an empty text; an unclosed tag at the end of a page
is dropped; unknown references stay as they are; repeated pages give equal
texts; paths of equal value are marked alike; very long pages, and tags or
quotes that never close, take time and memory in proportion to the page; an
empty table gives an empty result; further columns, whatever their names, are
not read.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from functools import reduce
from math import log1p

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values of HTML: elements by their role in a page
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "math", "object", "xmp", "noframes", "select")
BLOCK = set("address article aside blockquote body canvas caption center dd details dialog dir div dl dt fieldset figcaption "
            "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre "
            "section summary table tbody td tfoot th thead tr ul".split())
BOILERPLATE = set("nav aside footer form button select label input menu dialog head title".split())
#: Words of class, id or role that name parts which are not the article.
BOILERPLATE_WORDS = set("ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie "
                        "cookies disclaimer discussion disqus footer gdpr header masthead menu menubar modal nav navbar navigation "
                        "newsletter notice notices notification pager pagination popup promo promoted promotion reader-comments related "
                        "replies reply respond share sharing sidebar sitemap skip social sponsor sponsored subscribe subscription "
                        "thread toolbar widget".split())
#: Words beside them in a compound name.  Inside of an article a compound with
#: any other word (``related-work``) names its subject, not its role.
STRUCTURE_WORDS = set("area articles bar block body bottom box button buttons col column container content form group header heading "
                      "icon icons inline inner item items left link links list main module news outer page panel post posts right row "
                      "section site stories story text title top tools up wrap wrapper".split())
CLOSED_BY = {"p": BLOCK, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot"}, "td": {"td", "th", "tr"},
             "th": {"td", "th", "tr"}, "option": {"option", "optgroup"}}
PUNCTUATION = re.compile(r"[.,;:!?…。，！？]")

# A quoted value ends at its quote, unless a tag seems to begin before it and
# no quote follows soon: so an unclosed quote costs no more than a short look.
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*(?:>|\Z)|<\?[^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)"
                    r"((?:[^>\"']++|\"[^\"<]*+\"|'[^'<]*+'|\"[^\"]{0,2000}+\"|'[^']{0,2000}+')*+)>", re.S)
_OPEN_END = re.compile(r"<(?:/?[a-zA-Z][^<>]*|/)?\Z")
_NAME = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_SEMANTIC = re.compile(r"(article|main)(\.|\Z)")
_BOX = re.compile(r"(div|section|body|td)(\.|\Z)")
_HEADING = re.compile(r"h[1-6](\.|\Z)")
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|\Z)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)


_INSIDE_WORDS = BOILERPLATE_WORDS - {"header"}


def _is_boilerplate(tag: str, attributes: str, inside_article: bool) -> bool:
    if tag in BOILERPLATE or tag == "header" and not inside_article:
        return True
    if not attributes or tag in ("html", "body", "article", "main"):
        return False
    if _HIDDEN.search(attributes):
        return True
    words = " ".join(m[2] or m[3] or m[4] or "" for m in _NAME.finditer(attributes))
    bad = _INSIDE_WORDS if inside_article else BOILERPLATE_WORDS

    def names_boilerplate(name: str) -> bool:
        steps = re.split(r"[-_]+", name)
        return not bad.isdisjoint(steps) and (not inside_article or all(
            w in bad or w in STRUCTURE_WORDS or len(w) < 3 or w.isdigit() for w in steps))

    return any(w in bad or names_boilerplate(w) for w in words.lower().split() if not w.startswith(("with-", "has-", "no-")))


#: Open elements that a start tag may close, counted from the innermost.
NESTED = 100


class Paths:
    """The tag paths of a page as a tree, so that a path is a number and
    deeply nested elements store one step each.  Path 0 is the page."""

    def __init__(self) -> None:
        self.parent, self.step, self.depth = [0], [""], [0]
        self.known: dict[tuple[int, str], int] = {}

    def below(self, path: int, step: str) -> int:
        found = self.known.setdefault((path, step), len(self.step))
        if found == len(self.step):
            self.parent.append(path)
            self.step.append(step)
            self.depth.append(self.depth[path] + 1)
        return found

    def shared(self, a: int, b: int) -> int:
        """The deepest path that both lie on or below."""
        while a != b:
            if self.depth[a] < self.depth[b]:
                a, b = b, a
            a = self.parent[a]
        return a


def blocks(page: str) -> tuple[list[tuple[int, str, int, bool]], Paths]:
    """(path, text, characters inside of links, boilerplate) of each block of
    text in page order; a path is made of element names and class attributes.
    Time and memory grow with the page, however its tags nest or stay open."""
    out: list[tuple[int, str, int, bool]] = []
    paths = Paths()
    stack: list[tuple[str, int, bool]] = []  # element, path down to it, boilerplate
    boxes: list[int] = []  # places in the stack of elements that hold blocks
    opened: dict[str, int] = defaultdict(int)  # elements in the stack
    parts: list[str] = []
    links, at, raw = 0, 0, None

    def flush() -> None:
        nonlocal links
        text = " ".join("".join(parts).split())
        if text:
            path, bad = stack[boxes[-1]][1:] if boxes else (0, False)
            out.append((path, text, links, bad))
        parts.clear()
        links = 0

    def add(text: str) -> None:
        nonlocal links
        if text and not (stack and stack[-1][2]):
            text = html.unescape(text)
            parts.append(text)
            if opened["a"]:
                links += len(text)

    def close_to(size: int) -> None:
        while len(stack) > size:
            opened[stack.pop()[0]] -= 1
        while boxes and boxes[-1] >= size:
            boxes.pop()

    while at < len(page):
        if raw:  # up to the end tag of an element whose content is not markup
            end = re.compile(rf"</{raw}\b[^>]*>", re.I).search(page, at)
            at, raw = (end.end() if end else len(page)), None
            continue
        token = _TOKEN.search(page, at)
        add(page[at:token.start()] if token else _OPEN_END.sub("", page[at:]))
        if not token:
            break
        at = token.end()
        tag = (token[2] or "").lower()
        if not tag:
            continue
        if token[1]:
            if opened[tag]:
                if tag in BLOCK:
                    flush()
                size = len(stack) - 1
                while stack[size][0] != tag:
                    size -= 1
                close_to(size)
            continue
        if tag in RAW:
            if not token[3].endswith("/"):
                raw = tag
            continue
        if tag in BLOCK:
            flush()
            for k in boxes[:-NESTED:-1]:
                if tag in CLOSED_BY.get(stack[k][0], ()):
                    close_to(k)
                    break
                if stack[k][0] not in CLOSED_BY:
                    break
        if tag == "br":
            parts.append(" ")
        if tag in VOID or token[3].endswith("/"):
            continue
        inside = bool(opened["article"] or opened["main"])
        bad = bool(stack and stack[-1][2]) or _is_boilerplate(tag, token[3], inside)
        names = [m[2] or m[3] or m[4] or "" for m in _NAME.finditer(token[3]) if m[1].lower() == "class"]
        step = tag + "".join("." + n for n in " ".join(names).split()[:3])
        if tag in BLOCK:
            boxes.append(len(stack))
        opened[tag] += 1
        stack.append((tag, paths.below(stack[-1][1] if stack else 0, step), bad))
    flush()
    return out, paths


def path_values(found: list[tuple[int, str, int, bool]]) -> dict[int, float]:
    """Fused, smoothed ratio of every path, in order of first appearance."""
    nodes, length, marks, linked = (defaultdict(int) for _ in range(4))
    for path, text, links, _ in found:
        nodes[path] += 1
        length[path] += len(text)
        marks[path] += len(PUNCTUATION.findall(text))
        linked[path] += min(links, len(text))
    paths = list(nodes)
    ratios = [(length[p] / nodes[p], (marks[p] + 1) / nodes[p]) for p in paths]
    out = {}
    for k, p in enumerate(paths):
        near = ratios[max(0, k - 1):k + 2]
        by_text = (ratios[k][0] + sum(r[0] for r in near) / len(near)) / 2
        by_marks = (ratios[k][1] + sum(r[1] for r in near) / len(near)) / 2
        out[p] = log1p(by_text * by_marks) * (length[p] - linked[p])
    return out


def main_text(page: str, least_share: float = 0.05) -> str:
    """The main text of one page, blocks joined by line ends."""
    found, paths = blocks(page)
    found = [b for b in found if not b[3]]
    if not found:
        return ""
    values = path_values(found)
    total = sum(values.values())
    marked = [path for path, value in values.items() if value >= least_share * total]
    root = reduce(paths.shared, marked) if marked else 0
    # the leaf element of a single path is a paragraph, not the container; of
    # several, where it holds text itself, a container only if it is a box
    if root in values and paths.depth[root] > 1 and (len(marked) == 1 or not _BOX.match(paths.step[root])):
        root = paths.parent[root]
    # what the values chose inside of an article or main element is that whole element
    above, path = root, root
    while path:
        if _SEMANTIC.match(paths.step[path]):
            above = path
        path = paths.parent[path]
    inside = {above: True, 0: above == 0}

    def lies_inside(path: int) -> bool:
        way = []
        while path not in inside:
            way.append(path)
            path = paths.parent[path]
        for p in way:
            inside[p] = inside[path]
        return inside[path]

    chosen = [lies_inside(path) for path, _, _, _ in found]
    if marked and not _SEMANTIC.match(paths.step[above]):
        length, linked = defaultdict(int), defaultdict(int)
        for path, text, links, _ in found:
            length[path] += len(text)
            linked[path] += min(links, len(text))
        menus = {p for p in values if p not in marked and 2 * linked[p] > length[p]}
        chosen = [c and path not in menus for c, (path, _, _, _) in zip(chosen, found)]
        first = chosen.index(True) if any(chosen) else 0
        while first and _HEADING.match(paths.step[found[first - 1][0]]) and found[first - 1][0] not in menus:
            first -= 1
            chosen[first] = True
    return "\n".join(text for c, (_, text, _, _) in zip(chosen, found) if c)


def extract(page: Column) -> Column:
    @F.arrow_udf("string")
    def run(pages: pa.Array) -> pa.Array:
        return pa.array([main_text(p.as_py() or "") for p in pages], pa.string())

    return run(page)


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every page."""
    return (pages.select("page_id", "url", extract(F.col("html")).alias("text"))
            .withColumn("n_chars", F.length("text").cast("long")))
