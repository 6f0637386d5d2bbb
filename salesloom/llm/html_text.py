"""Main text of web pages by tag-path ratios.

Every block of text has a tag path, from the root to the element it stands in.
The blocks of one path share a fate: per path the text length and punctuation
per block are summed up, links count against it, and both ratios are fused to
one score. Scores are smoothed over paths that are near each other in the tree,
so that a heading or a short list of the article is carried by its paragraphs.
Paths above a share of the page's mean score, weighted by text, are content.

Names of elements are a feature of that score. A path through an element whose
name, class or role tells of something else than an article (menus, forms,
adverts, reader comments) is not carried by its neighbours and keeps a fiftieth of
its score. A name does not count on an element that holds nearly all of the
page's text outside of links, such as a form around the whole page or a menu that
was never closed; only reader comments keep it, which can be longer than what
they comment on. What is hidden scores nothing.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


THRESHOLD = 0.3  # of the mean score
SPREAD = 1.0  # steps in the tree over which scores are smoothed
BORDER = 3  # steps that the edge of an article counts more
INSIDE = 0.5  # what a step within one article counts
NAMED = 0.02  # what remains of the score of a path through an element that is named as no article
WHOLE_SHARE, WHOLE_CHARS = 0.8, 250  # share and length of the text that an element holds whatever its name
#: Steps in one article beyond which a weight is exactly 0.0 in doubles, as exp(-39 ** 2 / 2) is.
FARTHEST = math.ceil(39 * SPREAD / INSIDE)

# Elements and marks of the HTML standard and common names of page parts.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript template iframe noembed noframes svg select annotation".split())
CODE = set("script style".split())
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp"
    " small span strike strong sub sup time tt u var wbr"
    " math semantics mrow mi mn mo mtext ms mspace mfrac msqrt mroot msub msup msubsup munder mover munderover"
    " mtable mtr mtd mfenced mpadded mstyle menclose mmultiscripts mprescripts none".split()
)
NOT_TEXT = set("nav footer aside header form button menu dialog fieldset head".split())
ARTICLE = set("article main".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
NEVER_MARKED = {"html", "body", *ARTICLE}
MARKS = set(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent"
    " cookie cookies copyright disclaimer disqus footer gdpr header login masthead menu modal nav navbar"
    " navigation newsletter notice notices notification pager pagination popup promo promoted promotion related"
    " replies reply respond search share sharing sidebar signup social sponsor sponsored subscribe subscription"
    " tags toolbar topbar widget widgets".split()
)
ROLES = set("navigation banner contentinfo complementary search form menu menubar dialog alert toolbar".split())
#: An open element that the start of another one ends.
ENDED_BY = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "option": {"option"},
}
PUNCTUATION = re.compile(r"[.,;:!?…。、，！？；：¿¡]")

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(/?)([A-Za-z][A-Za-z0-9:-]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)(?:>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)",
    re.DOTALL,
)
#: One attribute: its name and then its value, so that no value is taken for a name.
ATTRIBUTE = re.compile(r"([^\s\"'>/=]++)(?:\s*+=\s*+(\"[^\"]*+\"|'[^']*+'|[^\s>]++))?+|[\"'/=]")
SVG_TEXT = re.compile(r"<text\b[^>]*+>(.*?)</text\b", re.I | re.DOTALL)
HIDDEN = re.compile(r"display\s*+:\s*+none|visibility\s*+:\s*+hidden", re.I)
NAME_PARTS = re.compile(r"[A-Za-z]+")
COMMENTS = set("comment comments disqus replies reply respond".split())
OWN = set("article entry post story content".split())  # what these start is a part of an article
#: What may stand in a head; anything else ends it.
IN_HEAD = set("base link meta script style title noscript template head html".split())
#: What main, of which a page has one, cannot lie in.
NOT_AROUND_MAIN = set("nav aside header footer head".split())
LAYOUT = set("no not non with without has have".split())  # what these start tells of an element's neighbours


def mark(token: str) -> str:
    """What one class or id says its element is, as a whole or by its last part; empty if no mark."""
    parts = [p.lower() for p in NAME_PARTS.findall(token)]
    if not parts or parts[-1] not in MARKS or parts[0] in LAYOUT:
        return ""
    return "" if parts[-1] == "header" and parts[0] in OWN else parts[-1]


class Paths:
    """The tag paths of a page, as a tree; a path is the number of its last element."""

    def __init__(self):
        self.parent, self.depth = [-1], [0]
        self.hidden, self.mark = [False], [""]  # mark: what the element itself is named as
        self.title_of = [0]  # of a heading in an article's own header: that header
        self.article = [0]  # the path of the article around it, or 0
        self.children: dict[tuple[int, str], int] = {}

    def child(self, path: int, tag: str, attributes: str) -> int:
        names, mark_ = [], ""
        hidden, inside = self.hidden[path], self.article[path]
        if attributes:
            for key, value in ATTRIBUTE.findall(attributes):
                key, value = key.lower(), value.strip("\"'")
                if key in ("class", "id"):
                    names += [p.lower() for p in NAME_PARTS.findall(value)]
                    if tag not in NEVER_MARKED:
                        marks = [m for m in map(mark, value.split()) if m]
                        mark_ = next((m for m in marks if m in COMMENTS), mark_ or (marks or [""])[0])
                elif key == "role" and value.lower() in ROLES:
                    mark_ = mark_ or value.lower()
                elif key == "style":
                    hidden |= bool(HIDDEN.search(value))
                elif key == "hidden" or key == "aria-hidden":
                    hidden |= key == "hidden" or value.lower() == "true"
        if tag in NOT_TEXT:
            mark_ = mark_ or tag
        step = (path, " ".join([tag, *names, "-" if hidden else "", mark_]))
        found = self.children.get(step)
        if found is None:
            found = self.children[step] = len(self.parent)
            self.parent.append(path)
            self.depth.append(self.depth[path] + 1)
            self.hidden.append(hidden)
            self.mark.append(mark_)
            self.title_of.append(self._header_around(path) if tag in HEADINGS and inside else 0)
            self.article.append(found if tag in ARTICLE else inside)
        return found

    def _header_around(self, path: int) -> int:
        """The header that is the innermost element with a mark around a path, 0 if it is none."""
        while path and not self.mark[path]:
            path = self.parent[path]
        return path if self.mark[path] == "header" and self.article[path] else 0

    def named(self, weights: dict[int, float]) -> list[bool]:
        """Whether each path goes through an element that its name sets apart; ``weights`` are of their text."""
        below = [0.0] * len(self.parent)
        for path, weight in weights.items():
            below[path] = weight
        for path in range(len(below) - 1, 0, -1):  # a child comes after its parent
            below[self.parent[path]] += below[path]
        least = max(WHOLE_SHARE * below[0], WHOLE_CHARS)
        out = [False]
        for path in range(1, len(below)):
            own = self.mark[path] and (self.mark[path] in COMMENTS or below[path] < least)
            # a heading in the header of an article is its title
            around = self.parent[self.title_of[path]] if self.title_of[path] else self.parent[path]
            out.append(bool(own) or out[around])
        return out

    def distance(self, a: int, b: int) -> float:
        """Steps between two paths; leaving or entering an article counts more, staying in it less."""
        same = self.article[a] == self.article[b]
        steps = 0 if same else BORDER
        step = INSIDE if same and self.article[a] else 1
        while a != b:
            if self.depth[a] < self.depth[b]:
                a, b = b, a
            a = self.parent[a]
            steps += step
        return steps


def leave(open_: list[tuple[str, int]], names: set[str]) -> None:
    """Close the outermost open element of these names, and all in it."""
    for i, (name, _) in enumerate(open_):
        if name in names:
            del open_[i:]
            return


def blocks(html: str) -> tuple[Paths, list[tuple[int, str, int]]]:
    """The blocks of a page in order: path, text with references decoded, characters in links."""
    paths = Paths()
    open_: list[tuple[str, int]] = []  # block elements and the path of each
    links = 0  # open a elements
    found: list[tuple[int, str, int]] = []
    pieces: list[str] = []
    linked = 0

    def here() -> int:
        return open_[-1][1] if open_ else 0

    def flush():
        nonlocal linked
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                found.append((here(), text, min(linked, len(text))))
            pieces.clear()
        linked = 0

    at, end = 0, len(html)
    while at < end:
        tag = TAG.search(html, at)
        stop = tag.start() if tag else end
        if stop > at:
            text = unescape(html[at:stop])
            pieces.append(text)
            if links:
                linked += len(text.strip())
        if not tag:
            break
        at = tag.end()
        name = (tag[2] or "").lower()
        if not name:
            continue
        closing, attributes = tag[1] == "/", tag[3]
        raw = name in RAW and not closing and not attributes.endswith("/")
        close = re.compile(rf"</{name}\b[^>]*+(?:>|\Z)", re.I).search(html, at) if raw else None
        # without its end, code takes the rest of the page, and any other raw element is passed over
        if raw and (close or name in CODE):
            at = close.end() if close else end
            if name == "svg":
                for label in SVG_TEXT.findall(html, tag.end(), at):
                    pieces.append(f" {unescape(re.sub('<[^>]*+>', '', label))} ")
            elif name != "title":
                pieces.append(" ")
            continue
        if name == "xmp" and not closing:
            flush()  # shown as it is, tags and references too
            close = re.compile(r"</xmp\b", re.I).search(html, at)
            pieces.append(html[at : close.start() if close else end])
            at = close.start() if close else end
            flush()
            continue
        if name == "a":
            links = max(0, links + (-1 if closing else 1))
            continue
        if name in INLINE or raw:
            if name in ("br", "wbr", "img"):
                pieces.append(" " if name != "wbr" else "")
            continue
        flush()
        links = 0
        if not closing and open_ and any(tag_ == "head" for tag_, _ in open_) and name not in IN_HEAD:
            leave(open_, {"head"})
        if not closing and name == "main":
            leave(open_, NOT_AROUND_MAIN)
        if name in VOID:
            continue
        if closing:
            for i in range(len(open_) - 1, -1, -1):
                if open_[i][0] == name:
                    del open_[i:]
                    break
        else:
            if open_ and open_[-1][0] == "p":
                open_.pop()
            if open_ and open_[-1][0] in ENDED_BY.get(name, ()):
                open_.pop()
            if not attributes.endswith("/"):
                open_.append((name, paths.child(here(), name, attributes)))
    flush()
    return paths, found


def smoothed(paths: Paths, chars: dict[int, int], scores: dict[int, float]) -> dict[int, float]:
    """The mean of all scores for every path, weighted by text and by nearness in the tree.

    Text and score times text are summed up per ancestor and depth below it. The
    paths that part from one at an ancestor are those below the ancestor without
    those below its child on the way, so that no pairs of paths are compared.
    """
    everyone: dict[int, dict[int, list]] = {}
    fellows: dict[int, dict[int, list]] = {}  # only paths with the article of the ancestor
    for path, n in chars.items():
        above, depth = path, 0
        while above >= 0 and depth <= FARTHEST:
            for sums in (everyone, fellows) if paths.article[above] == paths.article[path] else (everyone,):
                entry = sums.setdefault(above, {}).setdefault(depth, [0, 0.0])
                entry[0] += n
                entry[1] += n * scores[path]
            above, depth = paths.parent[above], depth + 1

    def weight(steps: float) -> float:
        return math.exp(-((steps / SPREAD) ** 2) / 2)

    inside, outside, border = (
        [weight(more + step * k) for k in range(2 * FARTHEST + 1)] for more, step in ((0, INSIDE), (0, 1), (BORDER, 1))
    )
    out = {}
    for path in chars:
        # what is counted here: fellows by their own weight, others by the weight across the border
        text = total = 0.0
        near = inside if paths.article[path] else outside
        above, child, up = path, -1, 0
        while above >= 0 and up <= FARTHEST:
            same = paths.article[above] == paths.article[path]
            for depth, (n, scored) in everyone[above].items():
                mine, mine_scored = fellows.get(above, {}).get(depth, (0, 0.0)) if same else (0, 0.0)
                if child >= 0:
                    m, m_scored = everyone[child].get(depth - 1, (0, 0.0))
                    n, scored = n - m, scored - m_scored
                    if same:
                        m, m_scored = fellows.get(child, {}).get(depth - 1, (0, 0.0))
                        mine, mine_scored = mine - m, mine_scored - m_scored
                k = up + depth
                text += mine * near[k] + (n - mine) * border[k]
                total += mine_scored * near[k] + (scored - mine_scored) * border[k]
            above, child, up = paths.parent[above], above, up + 1
        out[path] = total / text
    return out


def content_paths(paths: Paths, found: list[tuple[int, str, int]], threshold: float = THRESHOLD) -> set[int]:
    """The paths whose fused and smoothed ratios are above the threshold."""
    every: dict[int, list[int]] = {}
    for path, text, linked in found:
        if not paths.hidden[path]:
            entry = every.setdefault(path, [0, 0, 0, 0])
            for i, value in enumerate((1, len(text), len(PUNCTUATION.findall(text)), linked)):
                entry[i] += value
    scores, weights = {}, {}
    for path, (n, chars, marks, linked) in every.items():
        free = 1 - linked / chars
        scores[path] = math.sqrt(chars / n) * (1 + min(marks / n, 10.0)) * free * free
        weights[path] = chars * free * free
    named = paths.named(weights)
    sums = {path: entry for path, entry in every.items() if not named[path]}
    smooth = smoothed(paths, {p: entry[1] for p, entry in sums.items()}, scores)
    for path in sums:
        if sums[path][3] * 2 > sums[path][1]:
            smooth[path] = min(smooth[path], scores[path])  # lists of links are not carried by others
    total = sum(entry[1] for entry in sums.values())
    mean = sum(smooth[p] * sums[p][1] for p in sums) / total if total else 0.0
    # the score of a named path is its own, and stands against the mean of the others
    smooth |= {p: NAMED * scores[p] for p in every if named[p]} if sums else {}
    return {p for p, score in smooth.items() if score >= threshold * mean and score > 0}


def main_text(html: str, threshold: float = THRESHOLD) -> str:
    paths, found = blocks(html)
    content = content_paths(paths, found, threshold)
    return "\n".join(text for path, text, _ in found if path in content)


def extracted(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of every page, one row per row.

    Null and empty html have an empty text, as have pages without content paths.
    Html without any tag is one block, and content. Pages of any length are read
    whole, in time that grows with their text and tags. Ties don't arise, as a path
    stays or goes whole. Repeated rows give repeated rows, an empty table none;
    other columns are not read.
    """

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages_ in batches:
            yield pd.Series([main_text(h or "", threshold) for h in pages_], dtype=object)

    text = run(F.coalesce(pages[html_col], F.lit("")))
    rows = pages.select(pages[id_col].alias("page_id"), pages[url_col].alias("url"), text.alias("text"))
    return rows.withColumn("n_chars", F.length("text").cast("long"))
