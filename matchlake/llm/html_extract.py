"""Main text of HTML pages by two-pass block rules.

A page becomes blocks at every block-level tag.  Pass one classifies each block
by itself: link density, length and stop-word density make it good, bad, near good
or short; blocks inside containers that do not hold the article (navigation,
footers, asides, forms, and elements one of whose classes, or whose id, says advert, menu, comments
and the like) are bad.  Pass two: a near-good block becomes good beside a good one;
a short block inherits the label of the nearest decided blocks, and a heading that
of the block it introduces.  Inside ``<article>`` or ``<main>``, undecided blocks lean
to good, outside to bad.

Containers.  A class counts as a whole (``has-sidebar``, ``no-comments`` or ``tag-search`` say
nothing), and never on ``html``, ``body``, ``main`` or ``article`` (but for a comment's ``article``).  A
container that holds ``main`` is none; and where no good text is left outside containers, the outermost one with
the most good text is excused, unless it is one of comments, and so on inwards.

Languages.  Stop words are those of four languages.  A page whose long blocks hold almost none of
them is in another one; its blocks are judged by length and link density alone.

Scanning is linear: a tag ends at the first ``>`` outside quoted values; a quote that is never closed is none, and a
``<`` without such an end is text.

Each row is a job for one task: no shuffle, no state between pages.

Defined cases: null or empty html, and pages without a good block, give the empty
string; unclosed or stray tags end at the next block; script, style and similar
contents are never text; repeated rows are extracted each by itself.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from html import unescape

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .common import ship

# Stop words of the languages that the pages are in.
STOP_WORDS = frozenset("""
the of and to in a is that for it as was with be by on not he his but at are this have from or had an they which one
you were her all she there would their we him been has when who will more no if out so
der die das und in zu den mit von ist im für auf nicht sich des dem ein eine als auch es an werden aus er hat dass sie
nach wird bei einer um am sind noch wie einem über einen so zum war haben nur oder aber vor zur bis mehr durch man
de la le et les des en un du une que est pour qui dans par sur au plus pas ne se ce il avec sont ou mais son aux cette
el los las y un una por con para es se del lo su al como más pero sus le ya o este sí porque esta entre cuando muy sin
""".split())

# Elements.
SKIPPED = frozenset("script style noscript template svg math iframe object select option textarea button canvas audio video head title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup p pre section summary table tbody
td tfoot th thead tr ul""".split())
BOILERPLATE = frozenset("nav footer aside form menu dialog fieldset".split())
MAIN = frozenset(["article", "main"])
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

# Words that begin or end a class, id or role of a boilerplate container.
NAMES = frozenset("""ad ads banner breadcrumb breadcrumbs cookie cookies consent copyright disclaimer footer gdpr legal login masthead
menu modal nav navbar navigation newsletter notice notification alert paywall popup related search share sharing sidebar
signup social subscribe subscription tags toolbar widget complementary contentinfo siteheader topbar""".split())
STEMS = ("advert", "promo", "recommend", "sponsor")
COMMENTS = frozenset("comment comments disqus replies reply respond".split())
WHOLE = frozenset("site-header page-header".split())
# Classes that begin so tell a state, or a subject, of the page, not what the element is.
STATES = frozenset("has no not with without is".split())
SUBJECTS = frozenset("tag category cat type format".split())

# Fixed values of the block rules.
LINKED = 0.35          # link density above which a block is bad
SHORT, LONG = 60, 100  # characters
FEW, MANY = 0.12, 0.22  # stop-word density

NO_STOPS = 0.03        # stop-word density of a page below which its language is another one
WIDE = 2               # how many letters a character of an unspaced script counts for

_NAME = re.compile(r"(/?)([A-Za-z][^\s/<>]*)(?:([^<>=\"']*)>)?")  # the whole tag, if nothing in it is quoted
_STOP = re.compile(r"[>=]")
_BLANK = re.compile(r"\s*")
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff]")
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?=$|[\s=/])|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
_WORD = re.compile(r"[^\W\d_]+")


class Block:
    __slots__ = ("text", "linked", "tag", "within", "main", "label")

    def __init__(self, text, linked, tag, within, main):
        self.text, self.linked, self.tag, self.within, self.main, self.label = text, linked, tag, within, main, ""


class Container:
    """An element that does not hold the article, unless it turns out to."""
    __slots__ = ("outer", "comments", "excused", "bad", "good", "direct")

    def __init__(self, comments, outer):
        self.outer, self.excused, self.bad = outer, False, True
        self.comments = comments or (outer is not None and outer.comments)
        self.good, self.direct = 0, False      # good text within; some of it in no further container


def _named(attributes: str, among: frozenset, silent: frozenset, stems: tuple = ()) -> bool:
    """Whether a class, the id or the role is one of these words, or begins or ends with one."""
    for m in _ATTRIBUTE.finditer(attributes):
        for name in (m[2] or m[3] or m[4] or "").lower().split():
            parts = [x for x in re.split(r"[_-]+", name) if x]
            if name in WHOLE and stems:
                return True
            if not parts or len(parts) > 1 and parts[0] in silent:
                continue
            ends = {parts[0].rstrip("0123456789"), parts[-1].rstrip("0123456789")} | (
                {parts[-2]} if len(parts) > 1 and parts[-1].isdigit() else set())
            if ends & among or any(x.startswith(stem) for x in ends for stem in stems):
                return True
    return False


class _Tags:
    """Finds where tags end, in time linear in the page however it is broken: nothing is looked for
    again that an earlier search, for the same characters or from the same place, has answered."""

    def __init__(self, page: str):
        self.page, self.missing, self.dead = page, set(), set()
        self.asked, self.stop = 0, -1          # the first > or = from ``asked`` on

    def _next(self, at: int) -> int:
        if not self.asked <= at <= self.stop:
            m = _STOP.search(self.page, at)
            self.asked, self.stop = at, m.start() if m else len(self.page)
        return self.stop

    def end(self, at: int) -> int:
        """The index after the ``>`` that ends the tag whose name ends at ``at``; -1 without one."""
        page, passed = self.page, []
        while (stop := self._next(at)) < len(page) and stop not in self.dead:
            if page[stop] == ">":
                return stop + 1
            passed.append(stop)
            at = _BLANK.match(page, stop + 1).end()
            quote = page[at:at + 1]
            if quote in ("'", '"') and quote not in self.missing:
                close = page.find(quote, at + 1)
                if close < 0:
                    self.missing.add(quote)
                else:
                    at = close + 1
        self.dead.update(passed)               # from there, no tag ends
        return -1


def blocks(page: str) -> tuple[list[Block], list[Container]]:
    """The blocks of a page, and its containers, outer ones before inner ones."""
    out: list[Block] = []
    every: list[Container] = []
    stack: list[tuple[str, Container | None]] = []  # open elements, and the container if it is one
    opened: Counter = Counter()
    containers: list[Container] = []           # those that are open, outermost first
    text: list[str] = []
    linked = links = main = 0
    tag, at, tags, unended = "", 0, _Tags(page), set()

    def flush():
        nonlocal linked
        if text:
            words = " ".join(unescape("".join(text)).split())
            if words:
                out.append(Block(words, linked, tag, containers[-1] if containers else None, main > 0))
            text.clear()
        linked = 0

    def add(raw):
        nonlocal linked
        if raw:
            text.append(raw)
            if links:
                linked += len(" ".join(raw.split()))

    def pop() -> str:
        nonlocal main
        name, container = stack.pop()
        opened[name] -= 1
        if container:
            containers.pop()
        main -= name in MAIN
        return name

    def upto(mark: str, begin: int) -> int:
        end = page.find(mark, begin)
        return len(page) if end < 0 else end + len(mark)

    begin = 0                                  # of the text that is not added yet
    while (at := page.find("<", at)) >= 0:
        start = at
        if page.startswith("<!--", at):
            add(page[begin:start])
            at = begin = upto("-->", at + 4)
            continue
        if page.startswith("<![CDATA[", at):
            add(page[begin:start])
            at = begin = upto("]]>", at)
            continue
        if page.startswith(("<!", "<?"), at):
            add(page[begin:start])
            at = begin = upto(">", at)
            continue
        m = _NAME.match(page, at + 1)
        end = -1 if not m else m.end() if m[3] is not None else tags.end(m.end())
        if end < 0:
            at += 1
            continue                           # a < that is text
        add(page[begin:start])
        name, closing, attributes = m[2].lower(), bool(m[1]), page[m.end():end - 1] if m[3] is None else m[3]
        at = begin = end
        if name in SKIPPED and not closing:
            if not attributes.rstrip().endswith("/") and name not in unended:
                over = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
                if not over:
                    unended.add(name)
                at = begin = over.end() if over else (len(page) if name in ("script", "style") else at)
            continue
        if name == "br":
            text.append("\n")
            continue
        if name == "a":
            links = 0 if closing else 1
            continue
        if name not in BLOCKS:
            continue
        flush()
        links = 0
        if closing:
            if opened[name]:
                while pop() != name:
                    pass
            tag = stack[-1][0] if stack else ""
        else:
            tag = name
            if name in ("p", *HEADINGS):       # ends an open paragraph or heading
                while stack and stack[-1][0] in ("p", *HEADINGS):
                    pop()
            if name not in VOID:
                comments = name not in ("html", "body", "main") and _named(attributes, COMMENTS, STATES)
                other = name in BOILERPLATE or _HIDDEN.search(attributes) or (name == "header" and not main) or (
                    name not in ("html", "body", *MAIN) and _named(attributes, NAMES, STATES | SUBJECTS, STEMS))
                container = None
                if comments or other:
                    container = Container(comments, containers[-1] if containers else None)
                    containers.append(container)
                    every.append(container)
                if name == "main":
                    for c in containers:
                        c.excused = not c.comments
                stack.append((name, container))
                opened[name] += 1
                main += name in MAIN
    add(page[begin:])
    flush()
    return out, every


def _excuse(found: list[Block], alone: list[str], containers: list[Container]) -> None:
    """Where no good text is outside containers, the outermost one with the most of it holds the
    article; if that has good text in further containers only, so does one of those."""
    for block, label in zip(found, alone):
        if label == "good":
            if not block.within:
                return
            block.within.good += len(block.text)
            block.within.direct = True
    inner: dict[Container | None, list[Container]] = {}
    for c in reversed(containers):
        if c.outer:
            c.outer.good += c.good
        inner.setdefault(c.outer, []).append(c)
    open_ = [c for c in inner.get(None, []) if c.good and not c.comments]
    queue = [(not c.excused, -c.good, k, c) for k, c in enumerate(open_)]
    heapify(queue)
    number = len(queue)
    while queue:
        *_, c = heappop(queue)
        c.excused = True
        if c.direct:
            return
        for child in inner.get(c, []):
            if child.good and not child.comments:
                number += 1
                heappush(queue, (not child.excused, -child.good, number, child))


def _density(text: str) -> tuple[int, int]:
    words = _WORD.findall(text.lower())
    return sum(map(STOP_WORDS.__contains__, words)), len(words)


def _length(text: str) -> int:
    return len(text) if text.isascii() else len(text) + (WIDE - 1) * len(_UNSPACED.findall(text))


def _alone(block: Block, size: int, stops: int, words: int, listed: bool) -> str:
    """The label of a block by itself, wherever it stands."""
    if block.linked > LINKED * len(block.text) or (not block.main and block.text.startswith(("©", "Copyright"))):
        return "bad"
    if block.tag in HEADINGS or size < SHORT:
        return "short"
    if not listed:                             # length and links alone
        return "good" if size >= LONG or block.main else "near"
    density = stops / max(1, words)
    if density >= MANY:
        return "good" if size >= LONG or block.main else "near"
    if density >= FEW:
        return "near"
    return "short" if block.main else "bad"


def first_pass(found: list[Block], containers: list[Container]) -> list[str]:
    sizes = [_length(b.text) for b in found]
    counts = [_density(b.text) if size >= SHORT else (0, 0) for b, size in zip(found, sizes)]
    listed = sum(s for s, _ in counts) >= NO_STOPS * sum(n for _, n in counts)
    alone = [_alone(b, size, *count, listed) for b, size, count in zip(found, sizes, counts)]
    _excuse(found, alone, containers)
    for c in containers:
        c.bad = not c.excused or (c.outer is not None and c.outer.bad)
    return ["bad" if b.within and b.within.bad else label for b, label in zip(found, alone)]


def second_pass(found: list[Block], containers: list[Container]) -> None:
    """Undecided blocks take the label of the nearest decided block on their side
    of the article's border; a heading that of the next one."""
    first = first_pass(found, containers)

    def nearest(order) -> list:
        """For each block, (label, index) of the last decided one in ``order`` on its side."""
        out, last = [("", -1)] * len(found), {True: ("", -1), False: ("", -1)}
        for i in order:
            out[i] = last[found[i].main]
            if first[i] in ("good", "bad"):
                last[found[i].main] = (first[i], i)
        return out

    before, after = nearest(range(len(found))), nearest(range(len(found) - 1, -1, -1))
    for i, block in enumerate(found):
        (left, at_left), (right, at_right) = before[i], after[i]
        lean = "good" if block.main else "bad"
        if first[i] in ("good", "bad"):
            block.label = first[i]
        elif first[i] == "near":
            block.label = "good" if block.main or "good" in (left, right) else "bad"
        elif block.tag in HEADINGS:
            block.label = right or lean
        elif not (left and right):
            block.label = left or right or lean
        elif left == right:
            block.label = left
        else:
            gap = (i - at_left) - (at_right - i)
            block.label = lean if gap == 0 else left if gap < 0 else right


def extract(page: str | None) -> str:
    found, containers = blocks(page or "")
    second_pass(found, containers)
    return " ".join(b.text for b in found if b.label == "good")


@F.pandas_udf(StringType())
def _extracted(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for part in pages:
        yield part.map(extract)


def with_text(pages: DataFrame, html: str = "html") -> Column:
    return _extracted(F.coalesce(F.col(html).cast("string"), F.lit("")))


def report(pages: DataFrame) -> DataFrame:
    ship(pages.sparkSession)
    df = pages.select("page_id", "url", with_text(pages).alias("text"))
    return df.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
