"""HTML extraction: a minimum cut separates the blocks of the article from menus, adverts and the like.

A page is cut into blocks of text. A linear classifier over tags, names, links and length gives every block
a cost for either label: the terminal capacities. Neighbouring blocks, and blocks below the same element, are tied by
capacities that fall with their distance in the element tree. The minimum cut labels all blocks of a page together.

Defined results: null or empty html, and pages without content blocks, give an empty text; markup that never ends counts as
markup up to the end of the page, but svg and math that end in their own tag are empty; unknown references stay as written; repeated rows each get their own result.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from spanloom.llm.maxflow import min_cut

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?:svg|math)(?=[\s/>])(?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+>(?<=/>)"
    r"|<(script|style|template|noscript|iframe|svg|math|textarea|select|object|canvas|title)(?=[\s/>])(?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']++|\"[^\"<]*+\"|'[^'<]*+'|[\"'])*+)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.S | re.I,
)
_NAMES = re.compile(r"""\b(class|id|role|aria-label)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br input meta link base".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Opening one of these ends an open element of the named kinds.
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

_CONTENT_TAGS = frozenset("article main".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: What their names tell is the layout around or the subject of the text in them.
_NEVER_FRAME = _CONTENT_TAGS | _HEADINGS | frozenset("html body".split())
_FRAME_TAGS = frozenset("nav footer aside form menu dialog fieldset button address head".split())
_NOTICES = r"ads?|advert\w*|sponsor\w*|promo\w*|cookies?|consent|notices?|gdpr|newsletter|subscri\w*"
_COMMENTS = r"comments?|disqus|respond|repl(?:y|ies)"
_FRAMES = (
    _NOTICES + "|" + _COMMENTS + r"|nav\w*|menu\w*|foot\w*|header|masthead|side\w*|banner\w*|alert|popup|modal|overlay|responses?|share\w*|social\w*|related|recommend\w*|signup|login"
    r"|search|breadcrumbs?|pagination|pager|widgets?|toolbar|skip|complementary|contentinfo"
)
_FRAME_WORD, _NOTICE_WORD, _LASTING_WORD = (re.compile(words, re.I) for words in (_FRAMES, _NOTICES, f"{_NOTICES}|{_COMMENTS}"))
_ALWAYS_FRAME = frozenset("nav footer menu head".split())
#: Words that names of frames are made of besides. A name that ends in another word may tell what its text is about ("related-work", "search-algorithms").
_PLAIN_WORDS = frozenset(
    "area articles bar bottom box block body btn button buttons col column container content desktop fixed form global icon icons inner item items left link links list main media message mobile"
    " news outer page panel placeholder policy post posts primary right row secondary section site slot sticky stories text thread title top unit wrap wrapper zone".split()
)
#: A flag of the layout, as has-sidebar, tells that something is or isn't elsewhere.
_FLAGS = re.compile(r"(?<![^\s_-])(?:has|no|with|without)[_-]\S*", re.I)
_CONTENT_NAMES = re.compile(r"(?:^|[\s_-])(?:article\w*|post|entry|story|content|main|body|text)(?:$|[\s_-])", re.I)

# Weights of the block classifier (log odds of content).
_BIAS, _IN_ARTICLE, _IN_FRAME, _IN_HEADER, _MAYBE_FRAME, _NAMED_CONTENT = -1.6, 5.0, -9.0, -6.0, -1.0, 1.5
#: A frame that holds more than this share of a page's prose (blocks of ``_PROSE_WORDS`` words and more, half of them unlinked) and all that is marked as an article is none;
#: notices, adverts and comments stay what they are.
_MOST, _PROSE_WORDS = 0.5, 12
_PROSE_TAG, _LINKED, _PER_DOUBLING, _WORDS_UP_TO = 0.8, -4.0, 0.5, 64
# Capacity between blocks next to each other, and between blocks next to each other below one parent; lessened by their distance.
_NEXT, _SIBLING = 0.8, 0.6


def _frame_cost(tag: str, names: str) -> tuple[float, bool]:
    """What an element's own tag and names say against its text, and whether that holds whatever the text is: in comments, adverts, notices, menus."""
    cost, surely = (_IN_FRAME if tag in _FRAME_TAGS else 0.0), tag in _ALWAYS_FRAME
    for name in _FLAGS.sub("", names).split() if tag not in _NEVER_FRAME else ():
        parts = [w for w in re.split(r"[_-]+", name) if w]
        words = [w for w in parts if not w.isdigit()]
        told = [w for w in words if _FRAME_WORD.fullmatch(w)]
        # The number of a paragraph names its place in the text.
        if told and (tag != "p" or words == parts and any(_NOTICE_WORD.fullmatch(w) for w in told)):
            sure = words[-1] in told or all(w in told or w.lower() in _PLAIN_WORDS for w in words)
            cost = min(cost, _IN_FRAME if sure else _MAYBE_FRAME)
            surely |= sure and any(_LASTING_WORD.fullmatch(w) for w in told)
    return cost, surely


class _Element:
    __slots__ = ("tag", "parent", "depth", "article", "own", "surely", "named", "frame", "prose", "marked")

    def __init__(self, tag: str, names: str, parent: _Element | None) -> None:
        self.tag, self.parent = tag, parent
        self.depth = parent.depth + 1 if parent else 0
        self.article = bool(parent and parent.article) or tag in _CONTENT_TAGS
        self.own, self.surely = _frame_cost(tag, names)
        if tag == "header" and not self.article:
            self.own = _IN_HEADER
        self.surely |= bool(parent and parent.surely)
        self.named = bool(parent and parent.named) or bool(names and _CONTENT_NAMES.search(names))
        self.frame, self.prose, self.marked = None, 0, 0

    def settle(self, prose: int, marked: int) -> None:
        """Fix the cost of the element and all around it, given the characters of prose and the blocks of articles on the page. Parents come first."""
        most = self.prose > _MOST * prose and self.marked == marked and not self.surely
        self.frame = min(0.0 if most else self.own, self.parent.frame if self.parent else 0.0)


def _settle_frames(found: list[tuple[str, _Element, float]]) -> None:
    """Weigh what each element holds, then the costs of frames from the page down."""
    prose = marked = 0
    for text, element, linked in found:
        size = len(text) * (linked < 0.5 and text.count(" ") + 1 >= _PROSE_WORDS)
        prose, marked = prose + size, marked + element.article
        above = element
        while above:
            above.prose += size
            above.marked += element.article
            above = above.parent
    for _, element, _ in found:
        chain = []
        while element and element.frame is None:
            chain.append(element)
            element = element.parent
        for element in reversed(chain):
            element.settle(prose, marked)


class _Block:
    __slots__ = ("parts", "element", "linked")

    def __init__(self, element: _Element) -> None:
        self.parts: list[str] = []
        self.element = element
        self.linked = 0


def blocks(page: str) -> list[tuple[str, _Element, float]]:
    """(text, element, share of linked characters) of every block with text, in page order."""
    top = here = _Element("html", "", None)
    done: list[tuple[str, _Element, float]] = []
    block, in_link, at = _Block(top), 0, 0

    def end_block() -> None:
        nonlocal block
        if block.parts:
            text = " ".join(references.unescape("".join(block.parts)).split())
            if text:
                done.append((text, block.element, min(1.0, block.linked / max(1, sum(map(len, block.parts))))))
        block = _Block(here)

    def add(text: str) -> None:
        if block.parts or not text.isspace():
            if not block.parts:
                block.element = here
            block.parts.append(text)
            if in_link:
                block.linked += len(text)

    for found in _TOKEN.finditer(page):
        if found.start() > at:
            add(page[at : found.start()])
        at = found.end()
        tag = found[3]
        if tag is None:
            continue
        tag = tag.lower()
        closing = bool(found[2])
        if tag in _INLINE:
            if tag == "a":
                in_link = 0 if closing else 1
            elif tag == "br":
                add(" ")
            continue
        end_block()
        in_link = 0
        if closing:
            node = here
            while node.parent and node.tag != tag:
                node = node.parent
            if node.parent:
                here = node.parent
        else:
            while here.tag == "p" and here.parent or here.tag in _ENDS.get(tag, ()):
                here = here.parent
            if tag not in _VOID:
                named = _NAMES.findall(found[4]) if found[4] else ()
                # The id of a heading is a slug of its words.
                names = " ".join(
                    "-".join(x.strip("\"'").split()) if kind.lower() == "aria-label" else x.strip("\"'") for kind, x in named if tag not in _HEADINGS or kind.lower() != "id"
                )
                here = _Element(tag, names, here)
        block.element = here
    if at < len(page):
        add(page[at:])
    end_block()
    _settle_frames(done)
    return done


def log_odds(text: str, element: _Element, linked: float) -> float:
    """The classifier: log odds that a block is content."""
    words = min(text.count(" ") + 1, _WORDS_UP_TO)
    score = _BIAS + _PER_DOUBLING * words.bit_length() + _LINKED * linked + element.frame
    if element.article:
        score += _IN_ARTICLE
    if element.named:
        score += _NAMED_CONTENT
    if element.tag in _HEADINGS or element.tag in ("p", "pre", "blockquote", "figcaption"):
        score += _PROSE_TAG
    return score


def _nearness(a: _Element, b: _Element) -> float:
    """1 for siblings of one kind, halved for unlike kinds and by each step in the tree beyond siblings."""
    factor, steps = (1.0 if a.tag == b.tag else 0.5), -2
    while a is not b:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        steps += 1
    return factor * 0.5 ** max(0, steps)


def main_text(page: str | None) -> str:
    """The article of one page, its blocks joined by line feeds."""
    found = blocks(page or "")
    gain = [log_odds(*b) for b in found]
    links = []
    last_below: dict[int, int] = {}
    for i, (_, element, _) in enumerate(found):
        if i:
            links.append((i - 1, i, _NEXT * _nearness(found[i - 1][1], element)))
        parent = id(element.parent or element)
        before = last_below.get(parent)
        if before is not None and before < i - 1:
            links.append((before, i, _SIBLING * _nearness(found[before][1], element)))
        last_below[parent] = i
    return "\n".join(b[0] for b, keep in zip(found, min_cut(gain, links)) if keep)


def extract_text(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of every row of ``pages``; one page at a time, no shuffle."""

    schema = pages.select("page_id", "url").schema.add("text", "string").add("n_chars", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page) for page in batch.column("html").to_pylist()]
            columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(run, schema)
