"""Main text of HTML pages by tag-path ratios.

A page is read once into pieces of text, each with its path of elements from the root. Paths form a
tree. Text length, pieces and punctuation are summed up for every path and, carried upwards once, for
the region below it. A path's length and punctuation per piece are smoothed with those of the regions
around it, down from the body or the article, and fused; what elements' tags, class and id say only
weighs a path. Paths whose fused ratio reaches a threshold that follows from the spread of the page's
own ratios hold the content. All steps are linear in the length of the page.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

#: Part of a path's own ratio after smoothing; the rest is that of the region around it.
OWN = 0.3
#: Weights: of an element that is no running text by its kind, and of one by its class or id.
KIND, NAME = 0.02, 0.05
#: Weight of text beside a main element, beside the articles that hold at least ``ARTICLES`` of the text, and in articles that hold less (cards).
BESIDE_MAIN, BESIDE_ARTICLE, CARD, ARTICLES = 0.05, 0.15, 0.5, 0.4
#: The threshold: part of the standard deviation of the ratios, part of the best one, and a least value.
SPREAD, SHARE, FLOOR = 0.5, 0.15, 0.05
#: Punctuation that running text has, ASCII and wide.
STOPS = re.compile("[.,;:!?¡¿…。，、；：！？]")

# Fixed values of the HTML standard: elements by their kind.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noframes template".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section summary table tbody td "
    "tfoot th thead tr ul".split())
CLOSES_P = BLOCK - frozenset("td th tr tbody thead tfoot caption body html head option legend summary".split())
#: Elements that a new one of the given kind ends, if they are open in the same container.
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "tbody": {"tbody", "thead", "tr", "td", "th"}, "tfoot": {"tbody", "thead", "tr", "td", "th"},
}
SCOPE = frozenset("table ul ol dl div article section main body html aside nav header footer form td th blockquote figure".split())
#: By their kind no running text.
OTHER = frozenset("nav aside footer form button select noscript dialog menu object head label fieldset search".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
#: Words of class and id that are usual for regions that are not the article.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion promoted banner cookie cookies consent gdpr notice notices "
    "nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar side rail widget widgets comment comments commentlist reply replies respond disqus "
    "discussion footer foot copyright header masthead topbar toolbar related recommended share sharing social subscribe newsletter signup login popup "
    "modal overlay alert pagination pager skip hidden".split())

# A tag ends at the first > outside of a quoted value; quotes elsewhere are characters of a name.
ATTRIBUTES = r"(?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z)|[^\s>\"'][^\s>]*+)?+)?+)*+"
TOKEN = re.compile(rf"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)({ATTRIBUTES})(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s/>][^\s/>=]*)(?:\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s>]+))?)?")
WORD = re.compile(r"[a-z]+")
SPACE = re.compile(r"\s+")


def weights(tag: str, attributes: str, inside: bool) -> tuple[float, float, str]:
    """Weights of an element by its kind and by its names, and the names, numbers left out."""
    kind = KIND if tag in OTHER or tag == "header" and not inside else 1.0
    if not attributes or tag in ("html", "body", "article", "main"):
        return kind, 1.0, ""
    found = {k.lower(): a or b or c for k, a, b, c in ATTRIBUTE.findall(attributes)}
    if found.get("role", "").lower() in ROLES or "hidden" in found or found.get("aria-hidden", "").lower() == "true":
        kind = KIND
    if re.search(r"display\s*:\s*none", found.get("style", "")):
        kind = KIND
    names = WORD.findall((found.get("class", "") + " " + found.get("id", "")).lower())
    return kind, 1.0 if MARKS.isdisjoint(names) else NAME, " ".join(names)


class Paths:
    """The tree of a page's paths, as lists by path number; a parent has a smaller number than its children."""

    def __init__(self):
        self.number: dict[tuple, int] = {}
        self.parent, self.kind, self.name, self.article, self.main, self.top = [], [], [], [], [], []
        self.child(-1, "", 1.0, 1.0)

    def child(self, parent: int, tag: str, kind: float, name: float, names: str = "", main: bool = False) -> int:
        key = (parent, tag, names, kind, main)
        found = self.number.get(key)
        if found is None:
            found = self.number[key] = len(self.parent)
            known = parent >= 0
            self.parent.append(parent)
            self.kind.append(max(self.kind[parent] * kind, 1e-6) if known else 1.0)
            self.name.append(max(self.name[parent] * name, 1e-6) if known else 1.0)
            self.main.append(main or known and self.main[parent])
            self.article.append(tag == "article" or known and self.article[parent])
            # regions count from below the body, or from the article or main element
            self.top.append(tag in ("", "html", "body", "article", "main") or main)
        return found


def pieces(page: str, paths: Paths) -> Iterator[tuple[int, int, str]]:
    """Path, number of the block, and text of every piece, in the page's order."""
    stack: list[tuple[str, int]] = [("", 0)]
    open_tags: dict[str, int] = {}
    at, n, block = 0, len(page), 0

    def close(i: int) -> bool:
        edge = False
        for tag, _ in stack[i:]:
            open_tags[tag] -= 1
            edge = edge or tag in BLOCK
        del stack[i:]
        return edge

    while at < n:
        mark = page.find("<", at)
        if mark < 0:
            mark = n
        if mark > at:
            yield stack[-1][1], block, page[at:mark]
        if mark == n:
            return
        m = TOKEN.match(page, mark)
        if not m:
            yield stack[-1][1], block, "<"
            at = mark + 1
            continue
        at = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if m[1]:
            if open_tags.get(tag):
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] == tag:
                        block += close(i)
                        break
                    if stack[i][0] in ("table", "article", "body") and tag not in BLOCK:
                        break
            continue
        if tag == "br":
            yield stack[-1][1], block, " "
            continue
        block += tag in BLOCK
        if tag in VOID:
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
            at = end.end() if end else n
            continue
        if tag in CLOSES_P and open_tags.get("p"):
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == "p":
                    close(i)
                    break
                if stack[i][0] in SCOPE:
                    break
        ended = ENDS.get(tag, ())
        if any(open_tags.get(t) for t in ended):
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] in ended:
                    close(i)
                    if tag not in ("tr", "tbody", "tfoot"):
                        break
                elif stack[i][0] in SCOPE:
                    break
        top, attributes = stack[-1][1], m[3]
        kind, name, names = weights(tag, attributes, paths.article[top] or paths.main[top])
        # inline elements are paths of their own only if they are weighed
        path = top
        if tag in BLOCK or kind < 1 or name < 1:
            path = paths.child(top, tag, kind, name, names, tag == "main" or 'role="main"' in attributes)
        if not attributes.rstrip().endswith("/"):
            stack.append((tag, path))
            open_tags[tag] = open_tags.get(tag, 0) + 1


def page_pieces(page: str) -> tuple[Paths, list[list]]:
    """The paths of a page, and its pieces with neighbours of one path and block joined."""
    paths, found = Paths(), []
    for path, block, text in pieces(page, paths):
        if found and found[-1][0] == path and found[-1][1] == block:
            found[-1][2].append(text)
        else:
            found.append([path, block, [text]])
    for piece in found:
        piece[2] = html.unescape("".join(piece[2]))
    return paths, found


def smoothed(paths: Paths, own: list[list[float]]) -> tuple[list[float], list[float]]:
    """Length and punctuation per piece of every path, smoothed with the regions around it."""
    size = len(paths.parent)
    region = [list(x) for x in own]
    for i in range(size - 1, 0, -1):  # upwards: children come behind their parents
        above = region[paths.parent[i]]
        for k in range(3):
            above[k] += region[i][k]
    out = [], []
    around: list[tuple[float, float] | None] = [None] * size
    for i in range(size):  # downwards from the regions that nothing is around
        wider = None if paths.top[i] or i == 0 else around[paths.parent[i]]
        length, n, stops = region[i]
        mine = (length / n, stops / n) if n else (0.0, 0.0)
        here = mine if wider is None else tuple(OWN * a + (1 - OWN) * b for a, b in zip(mine, wider))
        # the page as a whole is no region that says anything
        around[i] = None if paths.top[i] and not (paths.article[i] or paths.main[i]) else here
        length, n, stops = own[i]
        mine = (length / n, stops / n) if n else (0.0, 0.0)
        wider = around[i]
        for k in range(2):
            out[k].append(mine[k] if wider is None else OWN * mine[k] + (1 - OWN) * wider[k])
    return out


def place_weights(paths: Paths, used: list[int], text: dict[int, float]) -> dict[int, float]:
    """What being inside or beside a main element or articles weighs, by path."""
    total = sum(text.values()) or 1.0
    if any(paths.main[p] and text[p] for p in used):
        return {p: 1.0 if paths.main[p] else BESIDE_MAIN for p in used}
    share = sum(text[p] for p in used if paths.article[p]) / total
    if share >= ARTICLES:
        return {p: 1.0 if paths.article[p] else BESIDE_ARTICLE for p in used}
    return {p: CARD if paths.article[p] else 1.0 for p in used}


def ratios(paths: Paths, found: list[list]) -> dict[int, float]:
    """The fused ratio of every path that has text."""
    own = [[0.0, 0.0, 0.0] for _ in paths.parent]
    for path, _, text in found:
        words = SPACE.sub(" ", text).strip()
        if words:
            w = paths.kind[path] * paths.name[path]
            own[path][0] += w * len(words)
            own[path][1] += w
            own[path][2] += w * len(STOPS.findall(words))
    used = [p for p, x in enumerate(own) if x[1]]
    if not used:
        return {}
    place = place_weights(paths, used, {p: own[p][0] for p in used})
    lengths, stops = smoothed(paths, own)
    # class and id only tell parts of a page from each other: what all of it is in weighs nothing
    plain = [p for p in used if paths.kind[p] == 1.0] or used
    most = max(paths.name[p] for p in plain)
    usual = sum(own[p][0] * place[p] for p in used) / sum(own[p][1] * place[p] for p in used)
    fused = {}
    for p in used:
        weight = paths.kind[p] * min(paths.name[p] / most, 1.0) * place[p]
        fused[p] = weight * 2 * lengths[p] / (lengths[p] + usual) * (0.5 + 0.5 * stops[p] / (stops[p] + 0.5))
    return fused


def threshold(values: list[float]) -> float:
    """Follows from the spread of the ratios of the page's pieces."""
    if not values:
        return FLOOR
    mean = sum(values) / len(values)
    spread = (sum((v - mean) ** 2 for v in values) / len(values)) ** 0.5
    return max(FLOOR, SPREAD * spread, SHARE * max(values))


def main_text(page: str) -> str:
    """The content blocks of a page, one a line."""
    paths, found = page_pieces(page)
    fused = ratios(paths, found)
    least = threshold([fused[path] for path, _, text in found if text.strip() and path in fused])
    lines: list[list] = []
    for path, block, text in found:
        if fused.get(path, 0.0) >= least:
            if lines and lines[-1][0] == block:
                lines[-1][1] += text
            else:
                lines.append([block, text])
    texts = (SPACE.sub(" ", text).strip() for _, text in lines)
    return "\n".join(t for t in texts if t)


def extracted(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``pages``.

    A null or empty page, and one without content, has the empty text. Unclosed and wrongly nested
    elements are closed as browsers do for the common cases; a tag that never ends reaches to the
    end of the page. Rows without page_id or url keep their null. Repeated rows each give a row.
    """
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def run(batches):
        for batch in batches:
            texts = [main_text(p.as_py() or "") for p in batch.column("html")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id").cast(pa.int64()), batch.column("url").cast(pa.string()), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], schema=schema)

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")
