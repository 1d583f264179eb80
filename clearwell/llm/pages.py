"""Main text of web pages, by rules on blocks of text in two passes.

A page is cut into blocks at block-level tags. The first pass decides each block by its share of link text, its length
and its share of stop words; short blocks, and those of middling length with few stop words, stay open. The second pass
gives an open block the decision of its nearest decided neighbours, a headline that of what follows.

Tags are features: what stands in menus, footers and the like counts as decided, an ``article`` or ``main`` that holds most of the
accepted text rules out what is around it, and a form is left out unless it holds most of that text. A page in a language
without known stop words is decided by length, links and sentence ends.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearwell.llm.common import has

# Frequent function words of the languages that pages are in.
STOP_WORDS = frozenset(
    "a an and are as at be but by for from had has have he her his i in is it its not of on or she that the their"
    " they this to was we were which will with you"
    " au aux avec ce ces dans de des du elle en est et il je la le les leur mais ne nous ou par pas pour que qui"
    " sa se ses son sur un une vous"
    " aber als auch auf aus bei das dem den der des die ein eine einer er es für hat ich im ist mit nicht sich sie"
    " sind und von war wie wir zu"
    " al como con del el ella es esta este la las lo los más no nos o para pero por que se sin su sus un una y".split()
)
#: Content up to the end tag, or to the end of the page, as HTML has it for these.
RAW_CONTENT = frozenset("script style textarea title".split())
#: Content up to the end tag, if there is one.
SKIPPED_CONTENT = RAW_CONTENT | frozenset("noscript template iframe svg canvas object select".split())
#: Tags that never hold main text.
BOILERPLATE_TAGS = frozenset("nav footer aside menu dialog button label legend".split())
CONTENT_TAGS = frozenset(["article", "main"])
BLOCK_TAGS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer"
    " form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead"
    " tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Words in class, id or role that mark boilerplate.
BOILERPLATE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments complementary"
    " contentinfo cookie cookies consent disqus footer hidden login masthead menu modal nav navbar navigation newsletter"
    " notice notices notification popup promo promoted promotion recommended related replies respond share sharing"
    " sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
#: Those of them that mark what is made of other articles: an article inside is not that of the page.
OTHERS_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising comment comments disqus promo promoted promotion recommended related"
    " replies respond sponsor sponsored".split()
)
#: With one of these a name only tells a state, as in has-sidebar, no-sidebar and comments-open.
STATE_WORDS = frozenset("no not non without has have with open opened closed enabled disabled".split())
LINK_SHARE = 0.2
SHORT, LONG = 70, 200
FEW_STOP_WORDS, MANY_STOP_WORDS = 0.1, 0.25
#: Letters of scripts without blanks between words stand for as many letters of others.
UNSPACED_LENGTH = 3
_UNSPACED = re.compile(r"[\u0e01-\u0e4e\u0e80-\u0ecd\u1000-\u103f\u1780-\u17d3\u3041-\u30ff\u3400-\u9fff\uf900-\ufaff]")
_SENTENCE_END = re.compile(r"[.!?]+(?=\s|$)|[\u3002\uff01\uff1f\u0964]")

_ATTRIBUTES = r"(?:[^>\"']|\"[^\"]*\"|'[^']*')*"
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    rf"|<(/?)([a-zA-Z][\w:-]*)({_ATTRIBUTES})(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
_NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_HIDDEN = re.compile(r"(?:^|\s)hidden(?=[\s=/>]|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.IGNORECASE)
_WORD = re.compile(r"[^\W\d_]+")


#: Whether an open tag is boilerplate. A menu is not if an article begins inside; of what is so by name only, such
#: an article is doubtful.
NOT, UNLESS_ARTICLE, NAMED, SURE = 0, 1, 2, 3


def _names(attributes: str) -> set[str]:
    """Words that mark boilerplate in class, id or role, without those of states."""
    out: set[str] = set()
    for groups in _NAMED.findall(attributes):
        for name in "".join(groups).split():
            words = {w.lower() for w in _NAME_WORD.findall(name)}
            if not words & STATE_WORDS:
                out |= words & BOILERPLATE_NAMES
    return out


@dataclass
class Block:
    """Text of a block, how much of it is link text, and where it stands."""

    text: str
    linked: int
    boilerplate: bool
    #: Number of the article or main part it is in, 0 outside.
    content: int
    heading: bool
    #: Whether that part is named as boilerplate or stands in what is.
    doubtful: bool = False
    form: bool = False


@dataclass
class _Reader:
    """Cuts a page into blocks."""

    blocks: list[Block] = field(default_factory=list)
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    #: Open tags: name, how they are boilerplate (NOT, UNLESS_ARTICLE, NAMED or SURE), and the content part they are in.
    open: list[tuple[str, int, int]] = field(default_factory=list)
    #: How many tags of each name are open.
    depth: Counter = field(default_factory=Counter)
    content_parts: int = 0
    doubtful: set[int] = field(default_factory=set)

    def place(self) -> tuple[int, int]:
        return self.open[-1][1:] if self.open else (NOT, 0)

    def flush(self, heading: bool = False) -> None:
        if text := " ".join(html.unescape("".join(self.parts)).split()):
            boilerplate, content = self.place()
            doubtful, form = content in self.doubtful, self.depth["form"] > 0
            self.blocks.append(Block(text, self.linked, bool(boilerplate), content, heading, doubtful, form))
        self.parts, self.linked = [], 0

    def data(self, raw: str) -> None:
        self.parts.append(raw)
        if raw and not raw.isspace() and any(name == "a" for name, *_ in self.open[-4:]):
            self.linked += len(raw.strip())

    def start(self, name: str, attributes: str) -> None:
        if name in BLOCK_TAGS or name == "br":
            if name == "br":
                self.parts.append(" ")
            else:
                self.flush()
        if name in VOID_TAGS or attributes.endswith("/"):
            return
        boilerplate, content = self.place()
        names = _names(attributes) if attributes and boilerplate < NAMED and name not in ("html", "body", "main") else ()
        if name in CONTENT_TAGS and not (content and boilerplate >= NAMED):
            # An article inside a menu means that the menu was not closed; one in comments is a comment.
            if boilerplate != SURE:
                doubtful, boilerplate = boilerplate == NAMED or bool(names), NOT
                if not content:
                    self.content_parts += 1
                    content = self.content_parts
                    if doubtful:
                        self.doubtful.add(content)
                elif names:
                    boilerplate = NAMED
        elif name in ("nav", "menu") or name == "header" and not content:
            boilerplate = boilerplate or UNLESS_ARTICLE
        elif name in BOILERPLATE_TAGS:
            boilerplate = SURE
        elif names and not boilerplate:
            boilerplate = SURE if OTHERS_NAMES.intersection(names) else NAMED
        elif names and OTHERS_NAMES.intersection(names):
            boilerplate = SURE
        if attributes and not boilerplate and name not in ("html", "body") and _HIDDEN.search(attributes):
            boilerplate = SURE
        if name in ("p", "li", "tr", "td", "option", "a"):
            self.end(name, within=name)
        self.open.append((name, boilerplate, content))
        self.depth[name] += 1

    def end(self, name: str, within: str = "") -> None:
        """Close the last open tag of that name; a new paragraph or the like only closes one right above."""
        if not self.depth[name]:
            return
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == name:
                if name in BLOCK_TAGS:
                    self.flush(heading=name in ("h1", "h2", "h3", "h4", "h5", "h6"))
                self.depth.subtract(n for n, *_ in self.open[i:])
                del self.open[i:]
                return
            if within and self.open[i][0] in BLOCK_TAGS:
                return


def blocks(page: str) -> list[Block]:
    """Blocks of a page in its order; markup that is not closed ends with the page."""
    reader, at, never_closed = _Reader(), 0, set()
    while token := _TOKEN.search(page, at):
        reader.data(page[at : token.start()])
        at = token.end()
        if not token[2]:
            continue
        name = token[2].lower()
        if token[1]:
            reader.end(name)
            continue
        if name in SKIPPED_CONTENT and name not in never_closed and not (name == "svg" and token[3].endswith("/")):
            if end := re.compile(rf"</{name}\s*>", re.IGNORECASE).search(page, at):
                at = end.end()
                continue
            if name in RAW_CONTENT:
                at = len(page)
                continue
            never_closed.add(name)
        reader.start(name, token[3])
    reader.data(page[at:])
    reader.flush()
    return reader.blocks


def _length(text: str) -> int:
    """Letters, those of scripts without blanks counted more."""
    if text.isascii():
        return len(text)
    return len(text) + (UNSPACED_LENGTH - 1) * len(_UNSPACED.findall(text))


def _first_pass(block: Block) -> bool | None:
    """Whether a block is main text, or None where that is open."""
    if block.boilerplate or block.linked > LINK_SHARE * len(block.text) and (block.linked > SHORT or not block.content):
        return False
    if "\u00a9" in block.text and not block.content:
        return False
    length = _length(block.text)
    if length < SHORT or block.heading:
        return None
    words = _WORD.findall(block.text.lower())
    share = sum(w in STOP_WORDS for w in words) / max(1, len(words))
    if share >= MANY_STOP_WORDS or length >= LONG and share >= FEW_STOP_WORDS:
        return True
    # An article may quote lists and code; elsewhere hardly any stop words mean boilerplate.
    return None if block.content or share >= FEW_STOP_WORDS else False


def _without_stop_words(block: Block) -> bool | None:
    """The decision in a language whose stop words are not known: long blocks of several sentences are text."""
    if block.boilerplate or block.linked > LINK_SHARE * len(block.text):
        return False
    length = _length(block.text)
    if length >= LONG and len(_SENTENCE_END.findall(block.text)) >= 2:
        return True
    return None if length < LONG or block.content else False


def classify(of: list[Block]) -> list[bool]:
    """Whether each block is main text.

    If the article or main parts of a page hold most of the text that the rules accept, text outside them is not main
    text. Doubtful parts are left out if the others hold as much, and so are forms if most is outside them. An open block
    follows its nearest decided neighbours: both, or the nearer of two that differ, the one before on a tie; a
    headline follows the one behind. Neighbours of a block in an article are blocks of that article; with
    none decided, its open blocks are main text.
    """
    first = [_first_pass(b) for b in of]
    if True not in first:
        first = [_without_stop_words(b) for b in of]
    in_forms = sum(len(b.text) for b, d in zip(of, first, strict=True) if d and b.form)
    if in_forms <= sum(len(b.text) for b, d in zip(of, first, strict=True) if d and not b.form):
        first = [False if b.form else d for b, d in zip(of, first, strict=True)]
    clear, doubtful, outside = 0, 0, 0
    for b, decided in zip(of, first, strict=True):
        if b.content and decided is not False:
            clear, doubtful = clear + len(b.text) * (not b.doubtful), doubtful + len(b.text) * b.doubtful
        elif decided:
            outside += len(b.text)
    if clear >= doubtful:
        first, doubtful = [False if b.doubtful else d for b, d in zip(of, first, strict=True)], 0
    if any(b.content and not b.boilerplate for b in of) and clear + doubtful >= outside:
        first = [d if b.content else False for b, d in zip(of, first, strict=True)]
    before = _nearest_decided(of, first, range(len(of)))
    behind = _nearest_decided(of, first, range(len(of) - 1, -1, -1))
    out = []
    for i, decided in enumerate(first):
        if decided is None:
            found = [(abs(j - i), j > i, first[j]) for j in (before[i], behind[i]) if j is not None]
            if of[i].heading and behind[i] is not None:
                found = [(0, True, first[behind[i]])]
            decided = min(found)[2] if found else bool(of[i].content)
        out.append(decided)
    return out


def _nearest_decided(of: list[Block], first: list[bool | None], order: range) -> list[int | None]:
    """For every block the last decided one in this order: of the same article, or of all for one outside."""
    out: list[int | None] = [None] * len(of)
    last: dict[int, int] = {}
    for i in order:
        out[i] = last.get(of[i].content)
        if first[i] is not None:
            last[0] = i
            if of[i].content and not of[i].boilerplate:
                last[of[i].content] = i
    return out


def main_text(page: str | None) -> str:
    """Main text of a page, its blocks joined by one blank; empty for NULL and pages without any."""
    of = blocks(page or "")
    return " ".join(b.text for b, wanted in zip(of, classify(of), strict=True) if wanted)


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """``key, url, text, n_chars`` of every page.

    NULL and empty pages have an empty text. Repeated rows are each returned, keys keep their type, NULL keys and urls are kept, an empty
    table gives an empty result, and other columns are not read. A page is read whole by one task.
    """
    has(pages, key=key, url=url, page=page)

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p.as_py()) for p in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"), F.col(page).alias("html"))
    kind = rows.schema["page_id"].dataType.simpleString()
    found = rows.mapInArrow(extracted, f"page_id {kind}, url string, text string, n_chars long")
    return found.withColumnsRenamed({"page_id": key, "url": url})
