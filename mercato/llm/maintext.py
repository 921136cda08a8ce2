"""Main text of HTML pages by tree scoring.

Paragraphs pass points for their length and commas to their ancestors, which are discounted by the
share of linked text.  The best container is lifted to the article or main part it is in, or else to what
holds all unlinked text; beside it everything is kept that is not mostly links.
"""

from __future__ import annotations

import html
import re
import sys
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm import tasks

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Elements of HTML by how they are read.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes template xmp".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre "
    "search section summary table tbody td tfoot th thead tr ul".split()
)
# Elements that are never part of an article.
DROPPED = frozenset(
    "applet aside audio button canvas datalist dialog embed fieldset footer form frame frameset head header iframe "
    "input label map math menu meter nav noembed noframes noscript object option output progress script search "
    "select style svg template textarea title video".split()
)
# Those of them that pages put their whole body in all the same.
FRAMING = frozenset("aside dialog fieldset footer form head header map menu nav object search".split())
# What an end tag is implied by: elements closed when one of the set opens.
CLOSED_BY = {
    "p": BLOCKS - {"li", "dd", "dt", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "option", "optgroup"},
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "option": frozenset(["option", "optgroup"]),
    "td": frozenset(["td", "th", "tr", "tbody", "thead", "tfoot"]),
    "th": frozenset(["td", "th", "tr", "tbody", "thead", "tfoot"]),
    "tr": frozenset(["tr", "tbody", "thead", "tfoot"]),
    "thead": frozenset(["tbody", "tfoot"]),
    "tbody": frozenset(["tbody", "tfoot"]),
}
# Where the search for an element to close ends.
SCOPES = {
    "li": frozenset(["ul", "ol", "menu", "dir"]),
    "dt": frozenset(["dl"]),
    "dd": frozenset(["dl"]),
    **dict.fromkeys(["td", "th", "tr", "thead", "tbody"], frozenset(["table"])),
}
# Words of class, id and role that tell what is not the article.
OUTSIDE = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner billboard sponsor sponsored promo promotion "
    "promoted cookie cookies consent gdpr notice notices alert notification popup popover modal overlay lightbox "
    "newsletter subscribe subscription signup login paywall sidebar sidebars side rail menu menus nav navbar navigation "
    "navi breadcrumb breadcrumbs crumbs pager pagination toc footer footers foot copyright legal header headers "
    "masthead topbar toolbar comment comments commentlist commentary disqus discussion replies reply respond feedback "
    "share sharing social follow related recommended recommendations recirc trending popular outbrain taboola widget "
    "widgets skip search tags tagcloud complementary contentinfo form".split()
)
# Words of places and boxes: a compound name is outside if it has only these and words from above.
PLACES = frozenset(
    "site page main global left right top bottom upper lower first last primary secondary inner outer container wrapper "
    "wrap box area block section panel bar row col column list item items group links link button buttons icons icon "
    "posts post entry articles stories unit slot zone region module text title".split()
)
# Words of what readers write, which can be longer than the article.
READERS = frozenset("comment comments commentlist commentary disqus discussion replies reply respond feedback".split())
# Elements that such words do not put outside.
FRAME = frozenset(["html", "body", "article", "main"])
# Elements whose own text counts as a paragraph.
PARAGRAPHS = frozenset("p pre blockquote td li dd div section article main body html figcaption center".split())

# The elements that an opening tag ends.
ENDED_BY: dict[str, list[str]] = {}
for _name, _tags in CLOSED_BY.items():
    for _tag in _tags:
        ENDED_BY.setdefault(_tag, []).append(_name)

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
_PLAIN_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*+)>")
_NAMED = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_HIDDEN = re.compile(
    r"""(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none|visibility\s*:\s*hidden""", re.IGNORECASE
)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_SENTENCE = re.compile(r"[.!?…:;]['\"”’)]*(?:\s|$)")

# An element named as outside stays if it holds more than this share of the text, or of the paragraphs' points.
TOO_MUCH = 0.9
MOST = 0.5
# It also stays with an article in it, if that has this share of the points of the page's largest.
LARGE = 0.2
LINKS_ALONE = 0.8
# What stands beside the best container is kept below this share of linked text.
LINKED_BESIDE = 0.5


class Page:
    """A page as lists: elements in document order, and pieces of text with the element they are in."""

    def __init__(self, source: str) -> None:
        self.tags, self.parents, self.attributes = ["html"], [-1], [""]
        # (element, text), or (element, None) where a block begins or ends
        self.pieces: list[tuple[int, str | None]] = []
        # Elements that are open: by depth, the depths of every tag's, and those of blocks.
        self.stack, self.open, self.blocks = [0], {"html": [0]}, [0]
        self._read(source)

    def _read(self, source: str) -> None:
        stack, at, end = self.stack, 0, len(source)
        # Beyond the last one nothing is a tag.
        last = source.rfind(">")
        tags, parents, attributes, pieces = self.tags, self.parents, self.attributes, self.pieces
        while at < end:
            mark = source.find("<", at)
            if mark < 0:
                mark = end
            if mark > at:
                pieces.append((stack[-1], source[at:mark]))
                at = mark
                continue
            if source.startswith("<!--", at):
                close = source.find("-->", at + 4 if not source.startswith("<!-->", at) else at + 2)
                at = end if close < 0 else close + 3
                continue
            if source.startswith("<![CDATA[", at):
                close = source.find("]]>", at)
                pieces.append((stack[-1], html.escape(source[at + 9 : end if close < 0 else close], False)))
                at = end if close < 0 else close + 3
                continue
            if source.startswith(("<!", "<?"), at):
                close = source.find(">", at)
                at = end if close < 0 else close + 1
                continue
            match = at < last and (_TAG.match(source, at) or _PLAIN_TAG.match(source, at))
            if not match:
                if at < last and source.startswith("</", at) and source[at + 2 : at + 3] not in ("", " "):
                    at = source.find(">", at) + 1
                    continue
                pieces.append((stack[-1], "<"))
                at += 1
                continue
            at = match.end()
            tag = match.group(2).lower()
            if match.group(1):
                self._close(tag)
                continue
            if tag == "br":
                pieces.append((stack[-1], " "))
                continue
            if tag in ("html", "body") and self.open.get(tag):
                continue
            self._imply(tag)
            number = len(tags)
            tags.append(tag)
            parents.append(stack[-1])
            attributes.append(match.group(3))
            if tag in BLOCKS:
                pieces.append((number, None))
            if tag in RAW:
                close = re.compile(f"</{re.escape(tag)}(?=[\\s/>])", re.IGNORECASE).search(source, at)
                if close is None:
                    at = end
                else:
                    after = source.find(">", close.end())
                    at = end if after < 0 else after + 1
                continue
            if tag not in VOID and not (match.group(3).endswith("/") and tag in ("svg", "math", "path")):
                self.open.setdefault(tag, []).append(len(stack))
                if tag in BLOCKS:
                    self.blocks.append(len(stack))
                stack.append(number)

    def _deepest(self, names: Iterable[str]) -> int:
        """Depth of the innermost open element of one of the names; 0 if there is none above the first."""
        return max((depths[-1] for name in names if (depths := self.open.get(name))), default=0)

    def _imply(self, tag: str) -> None:
        """Closes what an opening tag ends, unless it stands in a scope of its own."""
        ended = self._deepest(ENDED_BY.get(tag, ()))
        scope = self._deepest(SCOPES[tag]) if tag in SCOPES else self.blocks[-1]
        if ended and ended >= scope:
            self._cut(ended)

    def _close(self, tag: str) -> None:
        """Closes the innermost element of the tag; an inline end tag does not close blocks."""
        depth = self._deepest((tag,))
        if depth and (tag in BLOCKS or depth > self.blocks[-1]):
            self._cut(depth)

    def _cut(self, depth: int) -> None:
        for number in self.stack[depth:]:
            tag = self.tags[number]
            if tag in BLOCKS:
                self.pieces.append((self.parents[number], None))
        for number in reversed(self.stack[depth:]):
            tag = self.tags[number]
            self.open[tag].pop()
            if tag in BLOCKS:
                self.blocks.pop()
        del self.stack[depth:]


def _named_outside(tag: str, attributes: str) -> tuple[bool, bool]:
    """Whether the names put an element outside, and whether as what readers write."""
    if not attributes or tag in FRAME:
        return False, False
    outside, readers = bool(_HIDDEN.search(attributes)), False
    for match in _NAMED.finditer(attributes):
        value = match.group(2) or match.group(3) or match.group(4) or ""
        for name in value.split():
            words = {word.lower() for word in _WORDS.findall(name)}
            if words & OUTSIDE and words <= OUTSIDE | PLACES:
                outside, readers = True, readers or bool(words & READERS)
    return outside, readers


class _Weights:
    """Text and paragraphs' points below every element, and those of the articles and main parts in it."""

    def __init__(self, page: Page, lengths: list[int], points: list[float], dropped: list[bool]) -> None:
        tags, parents = page.tags, page.parents
        count = len(tags)
        self.text = [0] * count
        for (element, _), length in zip(page.pieces, lengths, strict=True):
            if not dropped[element]:
                self.text[element] += length
        self.points = [0.0 if out else p for p, out in zip(points, dropped, strict=True)]
        self.largest = [0.0] * count
        for i in range(count - 1, 0, -1):
            above = parents[i]
            self.text[above] += self.text[i]
            self.points[above] += self.points[i]
            if tags[i] in ("article", "main"):
                self.largest[i] = max(self.largest[i], self.points[i])
            self.largest[above] = max(self.largest[above], self.largest[i])
        self.end = list(range(1, count + 1))  # after the last element below
        for i in range(count - 1, 0, -1):
            self.end[parents[i]] = max(self.end[parents[i]], self.end[i])
        # The largest article that begins before, or at or after, an element.
        self.before, self.after = [0.0] * (count + 1), [0.0] * (count + 1)
        inside = [0] * count  # the outermost article or main part
        for i in range(1, count):
            inside[i] = inside[parents[i]] or (i if tags[i] in ("article", "main") else 0)
        outer = [self.points[i] if inside[i] == i else 0.0 for i in range(count)]
        for i in range(1, count):
            self.before[i + 1] = max(self.before[i], outer[i])
        for i in range(count - 1, 0, -1):
            self.after[i] = max(self.after[i + 1], outer[i])
        self.inside = inside

    def stays(self, i: int, readers: bool) -> bool:
        """Whether an element holds a large article or most of the points, and no large article is elsewhere."""
        if self.largest[i] and self.largest[i] >= (1.0 if readers else LARGE) * self.largest[0]:
            return True
        # Inside an article, of this article's points.
        most = self.points[i] > (TOO_MUCH if readers else MOST) * self.points[self.inside[i]]
        elsewhere = 0.0 if self.inside[i] else max(self.before[i], self.after[self.end[i]])
        return most and elsewhere < LARGE * self.points[i]


def _points(length: int, commas: int) -> float:
    return 1 + commas + min(length / 100, 3.0) if length else 0.0


def main_text(source: str | None) -> str:
    """The article's blocks, joined by two line feeds; empty if there is none."""
    if not source:
        return ""
    page = Page(source)
    tags, parents = page.tags, page.parents
    count = len(tags)
    texts = [html.unescape(text) if text is not None and "&" in text else text for _, text in page.pieces]
    lengths = [0 if t is None else len("".join(t.split())) for t in texts]

    dropped = [tag in DROPPED and tag not in FRAMING for tag in tags]
    linked = [tag == "a" for tag in tags]
    holder = [0] * count  # the nearest element that text can be a paragraph of
    for i in range(1, count):
        dropped[i] = dropped[i] or dropped[parents[i]]
        linked[i] = linked[i] or linked[parents[i]]
        holder[i] = i if tags[i] in PARAGRAPHS or tags[i] in FRAMING else holder[parents[i]]
    held, marks = [0] * count, [0] * count
    for (element, _), text, length in zip(page.pieces, texts, lengths, strict=True):
        if length and not dropped[element] and not linked[element]:
            held[holder[element]] += len(text)
            marks[holder[element]] += text.count(",") + text.count("，") + text.count("、")
    points = [_points(*pair) for pair in zip(held, marks, strict=True)]
    # Elements that are never the article, unless it or most of the paragraphs are in them.
    weights = _Weights(page, lengths, points, dropped)
    for i in range(1, count):
        dropped[i] = dropped[i] or dropped[parents[i]] or (tags[i] in FRAMING and not weights.stays(i, False))
    # Elements that their names put outside, unless the same holds or most of the text is in them.
    weights = _Weights(page, lengths, points, dropped)
    for i in range(1, count):
        outside, readers = _named_outside(tags[i], page.attributes[i])
        dropped[i] = (
            dropped[i]
            or dropped[parents[i]]
            or (outside and weights.text[i] <= TOO_MUCH * weights.text[0] and not weights.stays(i, readers))
        )

    # Text, linked text and commas of every element's subtree; text of its own paragraph.
    size, links, anchors = [0] * count, [0] * count, [0] * count
    length_in, commas = [0] * count, [0] * count
    for i in range(1, count):
        if tags[i] == "a" and not dropped[i]:
            anchors[i] = 1
    for (element, _), text, length in zip(page.pieces, texts, lengths, strict=True):
        if length and not dropped[element]:
            size[element] += length
            if linked[element]:
                links[element] += length
            else:
                length_in[holder[element]] += len(text)
                commas[holder[element]] += text.count(",") + text.count("，") + text.count("、")
    for i in range(count - 1, 0, -1):
        size[parents[i]] += size[i]
        links[parents[i]] += links[i]
        anchors[parents[i]] += anchors[i]
    if not size[0]:
        return ""

    # Lists and boxes of hardly anything but links are menus.
    for i in range(1, count):
        dropped[i] = dropped[i] or dropped[parents[i]] or (
            tags[i] in ("ul", "ol", "dl", "div", "section", "table", "p")
            and anchors[i] >= 3
            and links[i] >= LINKS_ALONE * size[i]
            and size[i] <= 0.5 * size[0]
        )

    score = [0.0] * count
    for i in range(count):
        if length_in[i] and not dropped[i]:
            # Text that stands in a container itself speaks for this container, a paragraph for those above.
            above = i if tags[i] not in ("p", "pre", "blockquote", "td", "li", "dd", "figcaption") else parents[i]
            share = 1.0
            while above >= 0 and share > 0.1:
                if tags[above] in BLOCKS:
                    score[above] += _points(length_in[i], commas[i]) * share
                    share /= 2
                above = parents[above]
    for i in range(count):
        score[i] *= 1 - links[i] / size[i] if size[i] else 0.0
    best = max(range(count), key=lambda i: (score[i] if not dropped[i] else -1.0, -i))
    # A lone list, table or quotation belongs to what is around it.
    while tags[best] in ("ul", "ol", "dl", "table", "tbody", "tr", "td", "blockquote", "p") and parents[best] > 0:
        best = parents[best]
    above = best
    marked = False
    while above >= 0:
        if tags[above] in ("article", "main"):
            best, marked = above, True
        above = parents[above]

    # What is left, without the menus.
    size, links = [0] * count, [0] * count
    block = [0] * count  # the nearest block
    for i in range(1, count):
        block[i] = i if tags[i] in BLOCKS else block[parents[i]]
    for (element, _), length in zip(page.pieces, lengths, strict=True):
        if length and not dropped[element]:
            size[element] += length
            links[element] += length * linked[element]
    for i in range(count - 1, 0, -1):
        size[parents[i]] += size[i]
        links[parents[i]] += links[i]

    # Opened are containers of which not all is kept: those around the best one (for a marked article the
    # next one), and those of mostly links.
    kept, opened = [False] * count, [False] * count
    kept[best] = True
    above = parents[best]
    while above >= 0:
        opened[above] = True
        above = -1 if marked else parents[above]
    for i in range(1, count):
        if dropped[i]:
            kept[i] = opened[i] = False
        elif kept[parents[i]]:
            kept[i] = True
        elif opened[parents[i]] and not (kept[i] or opened[i]):
            kept[i] = tags[i] in BLOCKS and links[i] < LINKED_BESIDE * size[i]
            opened[i] = not kept[i]
    blocks, words = [], []
    loose = loose_links = 0  # text that stands in opened containers itself
    for (element, text), read, length in zip(page.pieces, texts, lengths, strict=True):
        if text is None:
            blocks.append("".join(words) if loose_links <= LINKED_BESIDE * loose else "")
            words, loose, loose_links = [], 0, 0
        elif dropped[element]:
            continue
        elif kept[element]:
            words.append(read)
        elif opened[block[element]]:
            words.append(read)
            loose += length
            loose_links += length * linked[element]
    blocks.append("".join(words) if loose_links <= LINKED_BESIDE * loose else "")
    return "\n\n".join(b for b in (" ".join(b.split()) for b in blocks) if b)


def extracted(df: DataFrame, key: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """(key, url, text, n_chars) of every row.

    Character references are decoded, white space inside a block becomes one space, blocks are joined by
    two line feeds in page order.  Null and empty pages and pages without text give an empty text; null
    keys and URLs are passed on; repeated rows get equal results; an empty table gives no rows; other
    columns are not read.  No row is shuffled.
    """
    kinds = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in (key, url))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tasks.slices(batch, 2):
                texts = [main_text(page) for page in part.column(2).to_pylist()]
                sizes = pa.array([len(t) for t in texts], pa.int64())
                arrays = [part.column(0), part.column(1), pa.array(texts, pa.string()), sizes]
                yield pa.RecordBatch.from_arrays(arrays, names=[key, url, "text", "n_chars"])

    rows = df.select(F.col(key), F.col(url), F.col(source).cast("string").alias(f"{key} source"))
    return rows.mapInArrow(run, f"{kinds}, text string, n_chars bigint")
