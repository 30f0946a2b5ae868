"""Main text of web pages by two passes of rules over blocks.

A page is cut into blocks at block-level tags. The first pass decides blocks by stop-word density,
length, link density and where they stand: a block in navigation, a page's header or footer or a
side bar is bad; so is one that is mostly links, but for paragraphs of an article; a long block
with enough stop words is good. Short blocks that these rules leave open inherit in the second
pass: from the nearest decided block in the same container (article, main, section, div, ..), then
from the nearest on either side, a heading from what follows it. Blocks of an article without any
decided block in it are good; if a page has no decided block at all, blocks outside an article
are bad.

Names are doubts, not proof. Inside a form, or an element that calls itself an advert, notice, menu
or comments, blocks count as bad while the page has main text elsewhere: a block in an article, or
one that the rules find good. Otherwise the rules alone decide them, as if they had no name. A name
tells when it ends in a telling word or only parts follow it (``comment-list``); ``related-work``
and ``has-sidebar`` do not, nor do names on ``body`` and ``main``.

Markup may be broken: unclosed tags end with their container, end tags without a start are
ignored, a page may stop anywhere, and scripts, styles or comments without an end run to it.
Time grows with the length of a page, whatever its nesting.

Defined cases: null and empty html give an empty text; rows that repeat are pages of their own;
nothing is capped; other columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from pricetide.llm.shared import ship, table

SHORT, LONG = 70, 200  # characters
GOOD_STOPS, SOME_STOPS = 0.3, 0.15  # share of words
MOST_LINKS = 0.4  # share of characters
# HTML elements by their role.
RAW = set("script style noscript template svg math iframe object canvas select textarea title button".split())
BLOCKS = set(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html legend li main nav ol option p pre section summary table tbody td tfoot th "
    "thead tr ul".split()
)
CONTAINERS = set("article aside body div fieldset figure footer form header main nav section table".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
PROSE = HEADINGS | set("blockquote dd dt figcaption p pre td th".split())
BAD_PLACES = set("nav footer aside".split())
# Words in class, id, role or aria-label by which parts of pages name themselves.
BAD_NAMES = set(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist complementary "
    "consent contentinfo cookie cookies disclaimer disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice pagination paywall "
    "popup promo promoted recommended related reply replies respond search share sharing sidebar signup social sponsor sponsored "
    "subscribe subscription toolbar widget".split()
)
# Words for parts of such elements, and words that only mention them.
PARTS = set(
    "area articles bar block blocks body bottom box button buttons column container content count feed footer form group header icons "
    "info inner item items law left line link links list main message notice outer overlay panel policy posts right row section "
    "settings slot stories text thread this title top unit wrap wrapper".split()
)
MENTIONS = set("has hide no with without".split())
# Frequent function words of the languages served.
STOP_WORDS = set(
    "a about after all also an and are as at be been but by can for from had has have he her his if in into is it its more no not "
    "of on one only or our out she so some such than that the their them then there these they this to up was we were what when "
    "which who will with would you your "
    "aber als am an auch auf aus bei bis da das dass dem den der des die durch ein eine einem einen einer er es für hat im in ist "
    "mit nach nicht noch nur oder sich sie sind so um und uns vom von vor war wie wir wird zu zum zur über "
    "au aux avec ce ces cette dans de des du elle en est et il ils je la le les leur lui mais ne nous on ont ou par pas plus pour "
    "que qui sa se ses son sont sur un une vous à été "
    "al como con cuando de del desde donde el ella en entre es esta este fue ha hay la las lo los mas me muy no nos o para pero por "
    "que se si sin sobre son su sus también un una uno y ya".split()
)
_TOKEN = re.compile(r"<!--|<[!?]|</?([a-zA-Z][^\s/>]*)")
_TAG_END = re.compile(r"""(?:"[^"]*"|'[^']*'|[^'">])*>""")
_ATTRIBUTE = re.compile(r"""([\w:-]+)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""")
_NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_WORD = re.compile(r"[^\W\d_]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


@dataclass
class Block:
    text: str
    linked: int  # characters inside links
    tag: str  # of the block's start, "" after an end tag
    container: int
    place: str  # "bad", "doubtful", "good" (in an article) or ""
    label: str = ""


def _tells(name: str) -> bool:
    """Whether a class, id or label names a part of pages that is not main text."""
    words = [w.lower() for w in _NAME_WORD.findall(name)]
    if not MENTIONS.isdisjoint(words):
        return False
    at = next((i for i, w in enumerate(words) if w in BAD_NAMES), None)
    return at is not None and (words[-1] in BAD_NAMES or PARTS.issuperset(words[at + 1 :]))


def _place(tag: str, attributes: str, inside: str, first: bool) -> str:
    """What an element says of its content; ``inside`` is what its parents say, ``first`` whether
    no article has ended before it."""
    if inside == "bad" or tag in BAD_PLACES or (tag == "header" and inside != "good"):
        return "bad"
    named = tag == "form"
    if attributes:
        if re.search(r"\bhidden\b(?!=)", attributes) and not re.search(r"""["'][^"']*\bhidden\b""", attributes):
            return "bad"
        for name, value in _ATTRIBUTE.findall(attributes):
            name, value = name.lower(), value.strip("\"'")
            if name == "style" and _HIDDEN.search(value):
                return "bad"
            if name == "role" and value.lower() == "main":
                return "good"
            if name in ("class", "id"):
                named |= any(_tells(v) for v in value.split())
            elif name in ("role", "aria-label"):
                named |= _tells(value)
    if tag in ("article", "main"):
        if tag == "article" and named:
            return "doubtful"
        return "good" if first or inside != "doubtful" else inside  # an unclosed advert swallows no article
    return "doubtful" if named and tag != "body" else inside


def blocks(page: str) -> list[Block]:
    """Blocks of a page in order, with decoded text and single spaces; empty ones left out."""
    found: list[Block] = []
    stack: list[tuple[str, int, str]] = [("", 0, "")]  # tag, container, place
    parts: list[str] = []
    links: list[str] = []
    open_tags: Counter[str] = Counter()
    ended = False  # an article
    containers, depth_a, start, at = 0, 0, "", 0

    def close() -> None:
        nonlocal parts, links
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            linked = len(" ".join(html.unescape("".join(links)).split()))
            found.append(Block(text, linked, start, stack[-1][1], stack[-1][2]))
        parts, links = [], []

    def add(text: str) -> None:
        if text:
            parts.append(text)
            if depth_a:
                links.append(text)

    while at < len(page):
        match = _TOKEN.search(page, at)
        if not match:
            add(page[at:])
            break
        add(page[at : match.start()])
        opened = match.group()
        if opened == "<!--":
            end = page.find("-->", match.end())
            at = len(page) if end < 0 else end + 3
            continue
        end = _TAG_END.match(page, match.end())
        stop = end.end() if end else page.find(">", match.end()) + 1
        if stop <= 0:  # the page stops inside a tag
            break
        at = stop
        tag = match.group(1)
        if not tag:
            continue
        tag, ends = tag.lower(), opened[1] == "/"
        attributes = page[match.end() : stop - 1]
        if tag in RAW and not ends:
            if not attributes.endswith("/"):
                end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
                at = end.end() if end else len(page)
            continue
        if tag == "a":
            depth_a = 0 if ends else 1
        elif tag == "br":
            add(" ")
        elif tag in BLOCKS:
            close()
            depth_a = 0
            if tag in CONTAINERS:
                if ends:
                    while open_tags[tag]:
                        last = stack.pop()[0]
                        open_tags[last] -= 1
                        ended |= last in ("article", "main")
                        if last == tag:
                            break
                elif not attributes.endswith("/"):
                    containers += 1
                    stack.append((tag, containers, _place(tag, attributes, stack[-1][2], not ended)))
                    open_tags[tag] += 1
            start = "" if ends else tag
    close()
    return found


def first_pass(block: Block) -> str:
    words = [w.lower() for w in _WORD.findall(block.text)]
    stops = sum(w in STOP_WORDS for w in words) / max(1, len(words))
    size = len(block.text)
    if block.place in ("bad", "doubtful"):
        return "bad"
    if block.linked > MOST_LINKS * size and not (block.place == "good" and block.tag in PROSE):
        return "bad"
    if size < SHORT or block.tag in HEADINGS:
        return ""
    if stops >= GOOD_STOPS or (size >= LONG and stops >= SOME_STOPS):
        return "good"
    if block.place == "good":
        return "good" if size >= LONG else ""
    return "bad" if size >= LONG else ""


def label(found: list[Block]) -> None:
    """Decide every block of a page; two sweeps find the decided neighbours of all open blocks."""
    for block in found:
        block.label = first_pass(block)
    if not any(b.place == "good" or b.label == "good" for b in found):
        for block in found:
            if block.place == "doubtful":
                block.place = ""
                block.label = first_pass(block)
    sides = []
    for order in (range(len(found)), range(len(found) - 1, -1, -1)):
        at_all, within, seen = None, {}, {}
        for i in order:
            block = found[i]
            if block.label:
                at_all = within[block.container] = (i, block.label)
            else:
                seen[i] = (within.get(block.container), at_all)
        sides.append(seen)
    for i in sides[0]:
        block = found[i]
        for before, after in zip(sides[0][i], sides[1][i]):  # in the container, then anywhere
            if before or after:
                if before and after and before[1] != after[1]:
                    later = block.tag in HEADINGS or after[0] - i < i - before[0]
                    block.label = "good" if block.place == "good" and block.tag in PROSE else (after if later else before)[1]
                else:
                    block.label = (before or after)[1]
                break
        if not block.label or (block.place == "good" and not any(sides[s][i][0] for s in (0, 1))):
            block.label = "good" if block.place == "good" else block.label or "bad"


def main_text(page: str | None) -> tuple[str, int, int]:
    """Text, number of blocks, number of blocks kept."""
    found = blocks(page or "")
    label(found)
    kept = [b.text for b in found if b.label == "good"]
    return "\n".join(kept), len(found), len(kept)


OUT = "page_id bigint, url string, text string, n_chars bigint, n_blocks bigint, n_kept bigint"


def _extract(batches):
    for batch in batches:
        texts = [main_text(p) for p in batch["html"].to_pylist()]
        columns = [
            batch["page_id"],
            batch["url"],
            pa.array([t for t, _, _ in texts], pa.string()),
            pa.array([len(t) for t, _, _ in texts], pa.int64()),
            pa.array([n for _, n, _ in texts], pa.int64()),
            pa.array([k for _, _, k in texts], pa.int64()),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars", "n_blocks", "n_kept"])


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars, n_blocks, n_kept) for each page."""
    ship(pages.sparkSession)
    return pages.select("page_id", "url", "html").mapInArrow(_extract, OUT)


def op8_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return extract(table(spark, folder, "pages"))
