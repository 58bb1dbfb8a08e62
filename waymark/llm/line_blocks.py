"""Main text of web pages by line-block distribution.

Markup is stripped into lines: a block-level tag or a br ends a line, and a part that its element, class, id or
role names as something else than the article leaves WINDOW empty lines on either side. A line's size is its text
without link texts, times a weight: WEIGHT in an article or main element, one elsewhere, none outside of these
elements on pages that have one. Sizes are summed over sliding windows of WINDOW lines. A surge point is where that
sum first reaches SURGE, or the page's largest sum if that is less; a dive point where it falls back to nothing.
What lies between is kept, with headings that lead up to a surge. So the same windows decide on all pages: of a
marked article they keep what stands together, however short its lines, and leave out scraps between other parts.

Parts with names that are never the article's (adverts, menus, notices, comments) have no size. Names that may be
(LIKELY_WORDS) only set a part apart, with a weight of one: prose in it makes a surge of its own, links don't.

A null or empty page gives an empty text; broken markup is read as far as it can be: where a tag's quotes never
close, quotes no longer hide the end of a tag from there on. Repeated rows and null ids give a row each; extra
columns are ignored; an empty table gives no rows. Work is linear in the page.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Generator, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from waymark.llm.common import small_batches

#: Lines of a window, the characters in a window that make a surge, and how much more they count in a marked article.
WINDOW, SURGE, WEIGHT = 3, 86, 16

BLOCKS = frozenset("address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe legend li link main menu meta nav noscript ol optgroup option p pre section select summary table tbody td template textarea tfoot th thead title tr ul video audio canvas".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
CLOSES_P = BLOCKS - frozenset("br link meta body html head option optgroup template noscript iframe".split())
SKIPPED = frozenset("nav footer aside form button select menu dialog head svg audio video canvas datalist".split())
#: Words of class, id and role that name what is not the article.
SKIPPED_WORDS = frozenset("ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promoted promotion banner cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup signin login menu nav navbar navigation breadcrumb breadcrumbs topbar toolbar masthead footer sidebar widget widgets related recommended recommendations share sharing comment comments commentlist disqus reply replies pagination pager skiplink contentinfo".split())
#: Words that may name a part of the article as well.
LIKELY_WORDS = frozenset("social search complementary dialog respond discussion".split())
#: Elements of running text, which those words don't set apart in a marked article.
RUNNING = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre figcaption td th dd dt em strong b i a span code q cite".split())
COMMENT_WORDS = frozenset("comment comments reply replies".split())
NEVER_BY_WORDS = frozenset("html body main".split())

NAME = re.compile(r"(/?)([a-zA-Z][^\s/>]*+)")
ENDS_OR_VALUE, QUOTE = re.compile("[>=]"), re.compile("\\s*+([\"'])")
NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
HIDDEN = re.compile(r"""\bhidden(?=[\s/>=]|$)(?!\s*=\s*["']?until)|\baria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
ENDS = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I) for name in RAW}

ROWS = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
ROWS_ARROW = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


#: Kinds of parts: not the article's; set apart.
OUT, APART = 1, 2


class Line:
    """A line's text, its size, whether it is in a marked article, and whether it is a heading."""

    __slots__ = ("heading", "main", "size", "text")

    def __init__(self, text: str, size: int, main: bool, heading: bool) -> None:
        self.text, self.size, self.main, self.heading = text, size, main, heading


def tags(page: str) -> Generator[tuple[int, int, str, bool, str], int | None, None]:
    """(start, end, name, closing, attributes) of each piece of markup; comments and declarations have no name.

    A place that is sent is where reading goes on.
    """
    at, quotes = 0, True
    while (at := page.find("<", at)) >= 0:
        found = NAME.match(page, at + 1)
        if found:
            end = _close(page, found.end(), quotes)
            if end < 0 and quotes:
                quotes = False
                end = _close(page, found.end(), quotes)
            stop = len(page) if end < 0 else end + 1
            onward = yield at, stop, found[2].lower(), bool(found[1]), page[found.end() : stop - 1 if end >= 0 else stop]
        elif page[at + 1 : at + 2] in ("!", "?", "/"):
            comment = page.startswith("<!--", at)
            end = page.find("-->", at + 4) if comment else page.find(">", at)
            stop = len(page) if end < 0 else end + (3 if comment else 1)
            onward = yield at, stop, "", False, ""
        else:
            at += 1
            continue
        at = stop
        if onward is not None:
            at = onward
            yield at, at, "", False, ""  # the answer to what was sent


def _close(page: str, at: int, quotes: bool) -> int:
    """Where the tag ends that is open here, or -1; a quoted value may hold the sign."""
    if not quotes:
        return page.find(">", at)
    while found := ENDS_OR_VALUE.search(page, at):
        if found[0] == ">":
            return found.start()
        at = found.end()
        if quote := QUOTE.match(page, at):
            at = page.find(quote[1], quote.end()) + 1
            if not at:
                return -1
    return -1


def _named_words(attributes: str) -> set[str]:
    return {word.lower() for found in NAMED.findall(attributes) for word in WORDS.findall("".join(found))}


def split_lines(page: str, by_words: bool = True) -> tuple[list[Line | None], bool]:
    """Lines in page order, None for each empty one, and whether an article or main part is marked."""
    lines: list[Line | None] = []
    stack: list[tuple[str, int]] = []
    open_count: Counter[str] = Counter()
    skipping = apart = main = links = headings = 0
    marked = False
    parts: list[tuple[str, bool]] = []
    at = 0

    def end_line() -> None:
        if not parts:
            return
        text = " ".join(entities.unescape("".join(x for x, _ in parts)).split())
        if text:
            linked = min(len(text), sum(len(x) for x, link in parts if link))
            size = len(text) if main and not apart else len(text) - linked
            lines.append(Line(text, size * (WEIGHT if main and not apart else 1), main > 0, headings > 0))
        parts.clear()

    def pop() -> None:
        nonlocal skipping, apart, main, links, headings
        name, kind = stack.pop()
        open_count[name] -= 1
        if kind:
            end_line()
            skipping -= kind == OUT
            apart -= kind == APART
            if not skipping:
                lines.extend([None] * WINDOW)
        main -= name in ("article", "main")
        links -= name == "a"
        headings -= len(name) == 2 and name[0] == "h" and name[1].isdigit()

    def pop_to(name: str) -> None:
        while stack[-1][0] != name:
            pop()
        pop()

    reader = tags(page)
    for start, end, name, closing, attributes in reader:
        if start > at and not skipping:
            parts.append((page[at:start], links > 0))
        at = end
        if not name:
            continue
        if name in BLOCKS:
            end_line()
        if closing:
            if open_count[name]:
                pop_to(name)
            continue
        if name in RAW:
            stop = ENDS[name].search(page, at)
            at = stop.end() if stop else len(page)
            reader.send(at)
            continue
        if name in VOID:
            continue
        if name in CLOSES_P and open_count["p"]:
            pop_to("p")
        if name == "li" and stack and stack[-1][0] == "li" or name == "a" and stack and stack[-1][0] == "a":
            pop()
        kind = OUT if name in SKIPPED or name == "header" and not main else 0
        if not kind and attributes:
            words = _named_words(attributes) if by_words and name not in NEVER_BY_WORDS else set()
            if words & (COMMENT_WORDS if name == "article" else SKIPPED_WORDS) or HIDDEN.search(attributes):
                kind = OUT
            elif words & LIKELY_WORDS and name != "article" and not (main and name in RUNNING):
                kind = APART
        if kind:
            end_line()
            if not skipping:
                lines.extend([None] * WINDOW)
            skipping += kind == OUT
            apart += kind == APART
        stack.append((name, kind))
        open_count[name] += 1
        if name in ("article", "main"):
            main += 1
            marked |= not skipping
        links += name == "a"
        headings += len(name) == 2 and name[0] == "h" and name[1].isdigit()
    if at < len(page) and not skipping:
        parts.append((page[at:], links > 0))
    end_line()
    return lines, marked


def choose(lines: list[Line | None], marked: bool) -> list[str]:
    """The texts between surge and dive points."""
    marked = marked and any(line is not None and line.main for line in lines)
    sizes = [0 if line is None or marked and not line.main else line.size for line in lines]
    return [lines[i].text for a, b in spans(sizes, [line is not None and line.heading for line in lines]) for i in range(a, b) if lines[i] is not None and (lines[i].main or not marked)]


def spans(sizes: list[int], headings: list[bool]) -> list[tuple[int, int]]:
    """Ranges of lines from each surge to the dive after it; headings right before a surge belong to it."""
    sums, running = [0] * len(sizes), 0
    for i in range(len(sizes) - 1, -1, -1):  # of the lines from i on
        running += sizes[i] - (sizes[i + WINDOW] if i + WINDOW < len(sizes) else 0)
        sums[i] = running
    threshold = max(1, min(SURGE, max(sums, default=0)))
    found = []
    i = 0
    while i < len(sizes):
        if sums[i] < threshold:
            i += 1
            continue
        start = i
        while not sizes[start]:  # the window reached the threshold by a later line
            start += 1
        while start > (found[-1][1] if found else 0) and headings[start - 1]:
            start -= 1
        while i < len(sizes) and sums[i] > 0:
            i += 1
        found.append((start, i))
    return found


def main_text(page: str | None) -> str:
    """The article's blocks, joined by single spaces."""
    if not page:
        return ""
    lines, marked = split_lines(page)
    kept = choose(lines, marked)
    if not kept:
        kept = choose(*split_lines(page, by_words=False))
    return " ".join(kept)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(page) for page in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1).cast(pa.string()), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], schema=ROWS_ARROW)


def extract_text(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    small_batches(spark)
    return pages.selectExpr("cast(page_id as long) as page_id", "url", "html").mapInArrow(_extract, ROWS)
