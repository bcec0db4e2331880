"""Main text of web pages: streaming parser events, text-to-tag ratios per line, smoothing and the subtrees of the dense lines."""

from __future__ import annotations

import re
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from traitloom.llm.common import with_columns

# Element names of the HTML standard by what they do to the text.
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol option p pre section summary table tbody td tfoot th thead tr "
    "ul".split()
)
CONTAINERS = frozenset(
    "article aside blockquote body button details dialog div fieldset footer form header html main menu nav ol section select "
    "table td th tr ul head title script style noscript template iframe object svg canvas textarea".split()
)
UNSEEN = frozenset("head title script style noscript template iframe object svg canvas".split())
NOT_CONTENT = frozenset("nav menu footer aside form button select textarea dialog".split())
LANDMARKS = frozenset(("article", "main"))
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Elements that can hold no article; one that begins in them stands in something that was not closed.
CONTROLS = frozenset("button select textarea".split())
# Words of class, id and role names for parts of a page that are not its article, in the singular.
PART_WORDS = frozenset(
    "ad adv advert advertisement advertising adsense adsbygoogle aside banner breadcrumb captcha comment commentlist complementary "
    "consent contentinfo cookie dialog disqus donate footer gdpr login masthead menu menubar modal nav navbar navigation newsletter "
    "notice notification outbrain overlay pager pagination paywall popup promo promotion recommendation recommended related "
    "reply replies respond search share sharing sidebar signup social sponsor sponsored subscribe subscription taboola teaser "
    "toolbar trending widget".split()
)
#: Words that say where a part stands or what shape it has, and mark nothing by themselves.
SHAPE_WORDS = frozenset(
    "area article bar block bottom box button card column container content element field footer form frame global group header "
    "holder icon inner item layer left link list main media module outer page panel post primary region right row secondary "
    "section site slot story strip tag text thread title top trail unit user wrap wrapper".split()
)
#: Words by which an article element itself is not the article of the page.
ARTICLE_WORDS = frozenset("comment reply replies teaser".split())

#: Standard deviation of the smoothing kernel in lines, and how far it reaches.
SIGMA, REACH = 1.0, 2


@dataclass
class Line:
    """A block of text: its pieces joined, tags met since the last one, characters inside links, and its container."""

    text: str
    tags: int
    link_chars: int
    node: int


class PageEvents(HTMLParser):
    """Turns parser events into lines. Only containers are kept on a stack, so unclosed inline tags do no harm."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.pieces: list[str] = []
        self.tags = self.link_chars = self.links = 0
        #: Element name of each container, the container it stands in, and whether it is in an article or main element.
        self.names: list[str] = [""]
        self.parents: list[int] = [0]
        self.landmarks: list[bool] = [False]
        #: Containers that are no part of the article, by element and by class, id or role.
        self.by_element: set[int] = set()
        self.by_name: set[int] = set()
        #: The class, id and role of each container as written, to find those of the same name.
        self.labels: list[str] = [""]
        # name, unseen, node
        self.stack: list[tuple[str, bool, int]] = [("", False, 0)]

    def flush(self) -> None:
        text = " ".join("".join(self.pieces).split())
        self.pieces.clear()
        if text:
            self.lines.append(Line(text, self.tags, min(self.link_chars, len(text)), self.stack[-1][2]))
            self.tags = self.link_chars = 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.tags += 1
        if tag in BLOCKS or tag in CONTAINERS:
            self.flush()
        if tag == "a":
            self.links += 1
        if tag not in CONTAINERS:
            return
        _, unseen, parent = self.stack[-1]
        node, landmark = len(self.parents), self.landmarks[parent]
        if tag in LANDMARKS and not landmark:
            # An article is read also where something before it was not closed.
            unseen, landmark = False, True
        elif tag == "header" and not landmark:
            self.by_element.add(node)
        if tag in NOT_CONTENT:
            self.by_element.add(node)
        if _is_part(tag, attrs):
            self.by_name.add(node)
        self.names.append(tag)
        self.labels.append(" ".join(v for k, v in attrs if v and k in ("class", "id", "role")))
        self.parents.append(parent)
        self.landmarks.append(landmark)
        self.stack.append((tag, unseen or tag in UNSEEN, node))

    def handle_startendtag(self, tag: str, attrs) -> None:
        self.tags += 1
        if tag in BLOCKS:
            self.flush()

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS or tag in CONTAINERS:
            self.flush()
        if tag == "a":
            self.links = max(0, self.links - 1)
        if tag in CONTAINERS:
            for at in range(len(self.stack) - 1, 0, -1):
                if self.stack[at][0] == tag:
                    del self.stack[at:]
                    break

    def handle_data(self, data: str) -> None:
        if not self.stack[-1][1]:
            self.pieces.append(data)
            if self.links:
                self.link_chars += len(data)


_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")


def _is_part(tag: str, attrs: list[tuple[str, str | None]]) -> bool:
    """Whether a class, id or role names a part that is not the article.

    A name is cut into words (at marks, digits and capitals). It names a part if all its words do but those of place and shape:
    ``user-comments``, ``cookieBanner__text`` and ``related-content`` are such names, ``search-engines``, ``no-sidebar`` and
    ``content-with-sidebar`` say something else. An article element is judged by ``ARTICLE_WORDS`` alone.
    """
    if tag in ("body", "html", "main"):
        return False
    parts = ARTICLE_WORDS if tag == "article" else PART_WORDS
    for attribute, value in attrs:
        for name in (value or "").split() if attribute in ("class", "id", "role") else ():
            words = [w.lower() for w in _WORD.findall(name)]
            words = [w if w in parts or w in SHAPE_WORDS or not w.endswith("s") else w[:-1] for w in words]
            if any(w in parts for w in words) and all(w in parts or w in SHAPE_WORDS for w in words):
                return True
    return False


def events_of(html: str) -> PageEvents:
    events = PageEvents()
    events.feed(html)
    events.close()
    events.flush()
    return events


def excluded_nodes(page: PageEvents, lifted: frozenset[int] = frozenset()) -> list[bool]:
    """Whether each container is, or stands in, a part of the page that is not its article, however much text it holds.

    Marks on ``lifted`` containers do not count. An article in a part that is left out is left out too, save in a control, which
    cannot hold one; a main element never is.
    """
    n = len(page.parents)
    part, control = [False] * n, [False] * n
    for node in range(1, n):
        parent, tag = page.parents[node], page.names[node]
        if tag == "main":
            continue
        control[node] = tag in CONTROLS or (control[parent] and tag != "article")
        marked = (node in page.by_element or node in page.by_name) and tag not in CONTROLS
        part[node] = part[parent] or (marked and node not in lifted)
    return [a or b for a, b in zip(part, control)]


def _plain(line: Line) -> bool:
    """Not mostly links."""
    return 2 * line.link_chars < len(line.text)


def candidates_of(page: PageEvents, smooth: np.ndarray) -> list[int]:
    """Lines that are in no part that is left out.

    If these hold nothing but links, a container that was never closed, or that has the name of a part, holds the article: the
    marks of the containers around the densest other line are lifted, and those of the same name elsewhere with them.
    """
    lines, lifted = page.lines, frozenset()
    while True:
        excluded = excluded_nodes(page, lifted)
        found = [i for i, line in enumerate(lines) if not excluded[line.node]]
        if any(_plain(lines[i]) for i in found):
            return found
        around = []
        for i in sorted((i for i in range(len(lines)) if _plain(lines[i])), key=lambda i: -smooth[i]):
            node, around = lines[i].node, []
            while node:
                around.append(node)
                node = page.parents[node]
            marked = [n for n in around if n not in lifted and (n in page.by_element or n in page.by_name)]
            if page.names[lines[i].node] not in NOT_CONTENT and marked:
                same = {page.labels[n] for n in marked if n in page.by_name}
                lifted = lifted | set(marked) | {n for n in page.by_name if page.labels[n] in same}
                break
        else:
            return found


def smoothed(ratios: np.ndarray) -> np.ndarray:
    """Gaussian smoothing over neighbouring lines; beyond either end there is nothing."""
    offsets = np.arange(-REACH, REACH + 1)
    kernel = np.exp(-(offsets**2) / (2 * SIGMA**2))
    weight = np.convolve(np.ones(len(ratios)), kernel, mode="full")[REACH:-REACH]
    return np.convolve(ratios, kernel, mode="full")[REACH:-REACH] / weight


def threshold(values: np.ndarray) -> float:
    """The cut between the two clusters of lines: midway between their means, found by moving the cut to them."""
    cut = float(values.mean())
    for _ in range(20):
        low, high = values[values < cut], values[values >= cut]
        if not len(low) or not len(high):
            break
        moved = (float(low.mean()) + float(high.mean())) / 2
        if abs(moved - cut) < 1e-9:
            break
        cut = moved
    return cut


def content_lines(page: PageEvents) -> list[Line]:
    """The lines of the content.

    Every line of the page has its text-to-tag ratio, text in links not counted; ratios are smoothed over neighbouring lines and
    cut in two clusters. Candidates are the lines outside menus, adverts, comments and the like (``candidates_of``); where some
    of them stand in article or main elements, only those do, for a landmark is where the article is looked for.

    Candidates of the high cluster that are not mostly links are dense. Content are all candidates from the first dense line to
    the last, and the whole of every container that holds one itself. A candidate before or after them (a title, a closing
    line, a short section) is content too unless it is clearly apart, the text of its innermost container being links for the
    most part; lines right in a container around the dense ones are judged each for itself. If no candidate is dense, the one
    with the highest smoothed ratio stands for it.
    """
    lines = page.lines
    if not lines:
        return []
    ratios = np.array([(len(line.text) - line.link_chars) / (1 + line.tags) for line in lines], dtype=float)
    smooth = smoothed(ratios)
    candidates = candidates_of(page, smooth)
    landmarks = [i for i in candidates if page.landmarks[lines[i].node]]
    if any(_plain(lines[i]) for i in landmarks):
        candidates = landmarks
    if not candidates:
        return []
    high = smooth >= threshold(smooth)
    dense = [i for i in candidates if high[i] and _plain(lines[i])]
    if not dense:
        dense = [max(candidates, key=lambda i: smooth[i])]
    whole = {lines[i].node for i in dense}
    around = set()
    for node in whole:
        while node not in around:
            around.add(node)
            node = page.parents[node]
    whole = {node for node in whole if page.names[node] not in ("", "html", "body")}
    inside = [node in whole for node in range(len(page.parents))]
    for node in range(1, len(inside)):
        inside[node] = inside[node] or inside[page.parents[node]]
    groups: dict[tuple[int, int], list[int]] = {}
    for i in candidates:
        if not dense[0] <= i <= dense[-1] and not inside[lines[i].node]:
            groups.setdefault((lines[i].node, i if lines[i].node in around else -1), []).append(i)
    apart = set()
    for group in groups.values():
        if 2 * sum(lines[i].link_chars for i in group) >= sum(len(lines[i].text) for i in group):
            apart.update(group)
    return [lines[i] for i in candidates if i not in apart]


def main_text(html: str) -> tuple[str, int, int]:
    """Text of the content lines joined by single spaces, lines on the page, lines kept."""
    page = events_of(html)
    kept = content_lines(page)
    return " ".join(line.text for line in kept), len(page.lines), len(kept)


def extract(pages: DataFrame, html: str = "html", text: str = "text") -> DataFrame:
    """The rows with ``text``, ``n_lines`` and ``n_content_lines``.

    Character references are decoded, white space inside a block becomes one space, blocks are joined in page order by one
    space. A null or empty page has an empty text. Every page is parsed whole. Columns of the new names are replaced.
    """

    def make():
        def work(column: pa.Array) -> list[pa.Array]:
            found = [main_text(value or "") for value in column.to_pylist()]
            texts, lines, kept = zip(*found) if found else ((), (), ())
            return [pa.array(texts, pa.string()), pa.array(lines, pa.int64()), pa.array(kept, pa.int64())]

        return work

    return with_columns(pages, [html], StructType.fromDDL(f"`{text}` string, n_lines long, n_content_lines long"), make)
