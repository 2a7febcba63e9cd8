"""Main text of web pages by two-pass block rules.

A page is cut into blocks (the text between block-level tags).  The first
pass decides blocks on their own:

* text of menus, headers, footers, sidebars, notices, adverts, forms, hidden
  elements and reader comments, as tags, roles and class names say, and
  scripts and styles, is no block at all;
* blocks made of links are bad;
* long blocks with many stop words are good, long ones with few are bad
  (undecided inside an article element, which is evidence itself);
* short blocks, and middling ones, stay undecided.

The second pass gives undecided blocks the label of the nearest decided
neighbour: a heading looks ahead first, a middling block is good if either
neighbour is, a short one follows the nearer (the good one where they are
equally near).  Where a page marks its article (``article``, ``main``, ...)
only blocks inside it take part, and without any decided neighbour an
undecided block stays.

Rows are independent: one pass of Arrow batches, no shuffle.  The scan is
linear in the page; a tag that never ends is text, an unclosed quote ends
with its tag, an unclosed script reaches the page's end.

A null page is empty; a page without text gives ``""`` and 0; repeated rows
give repeated results; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow

# Characters from which a block can be decided, and from which many stop
# words make it good on its own.
SHORT, LONG = 70, 200
# Shares of stop words: from LOW undecided, from HIGH good.  Shares of
# characters in links beyond which a block is bad.
LOW, HIGH = 0.10, 0.20
MOST_LINKS = 0.4

# Frequent function words of some languages.
STOP_WORDS = frozenset(
    """
    a about after all also an and are as at be been but by can could do for from had has have he her his how i if in
    into is it its more my no not of on one or other our out she so some than that the their them then there these
    they this to up was we were what when which who will with would you your
    au aux avec ce ces cette dans de des du elle en est et il ils je la le les leur mais même ne nous on ou par pas
    plus pour qu que qui sa se ses son sont sur un une vous
    aber als am an auch auf aus bei bin bis das dass dem den der des die durch ein eine einem einen einer er es für
    hat ich ihr im in ist kann mit nach nicht noch nur oder sein sich sie sind so über um und uns von vor war was wenn
    werden wie wir wird zu zum zur
    al como con cuando de del desde donde el ella en entre era es esta este está ha hay la las lo los más me mi muy no
    nos o para pero por porque que se ser si sin sobre su sus también un una y ya
    che chi ci come con da dei del della di e gli ha i il io la le lo ma mi nei nel non per più quando si sono su un
    uno da das do dos e em foi mais mas na nas não no nos os ou para pela pelo por são se sem seu sua uma
    aan als bij dat de die dit een en er het hij ik in is je maar met naar niet nog of om ook op te tot uit van voor
    was wat we zijn
    """.split()
)

# Tags that end a block.
BLOCK_TAGS = frozenset(
    """
    address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure
    footer form frameset h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section
    summary table tbody td tfoot th thead tr ul
    """.split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements whose content is no markup.
RAW_TAGS = frozenset("script style title textarea xmp iframe noembed noframes".split())
# Elements that are never the article.
OUTSIDE_TAGS = frozenset("nav footer aside form noscript template svg object button select menu dialog head".split())
OUTSIDE_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
INSIDE_TAGS = frozenset("article main".split())
# Class names and ids, whole or as the first or last part of one.
OUTSIDE_NAMES = frozenset(
    """
    ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion sidebar nav navbar
    navigation menu breadcrumb breadcrumbs footer masthead cookie cookies consent gdpr notice notices popup modal
    overlay newsletter subscribe subscription signup login share sharing social related recommended comment comments
    disqus replies respond widget toolbar pagination pager copyright
    """.split()
)
OUTSIDE_WHOLE = frozenset("site-header page-header skip-link".split())
# What may carry such names and still hold the article.
ROOTS = frozenset("html body main article".split())

_NAME = re.compile(r"/?([a-zA-Z][^\s/>]*)")
_REST = re.compile(r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+>""")
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
_RAW_END = {name: re.compile(f"</{name}(?=[\\s/>])", re.I) for name in RAW_TAGS}
_LETTERS = re.compile(r"[^\W\d_]+")


def tokens(page: str):
    """(kind, name, attributes or text): ``text``, ``open`` and ``close``."""
    at, n, last = 0, len(page), page.rfind(">")
    quotes = True
    while at < n:
        tag = page.find("<", at)
        if tag < 0 or tag > last:
            yield "text", "", page[at:]
            return
        if page.startswith("<!--", tag):
            end = page.find("-->", tag + 2)
            if tag > at:
                yield "text", "", page[at:tag]
            at = n if end < 0 else end + 3
            continue
        name = _NAME.match(page, tag + 1)
        if name is None and page[tag + 1 : tag + 2] not in ("!", "?", "/"):
            yield "text", "", page[at : tag + 1]
            at = tag + 1
            continue
        if tag > at:
            yield "text", "", page[at:tag]
        start = name.end() if name else tag + 1
        rest = _REST.match(page, start) if quotes and name else None
        if rest is None:
            quotes = quotes and not name  # an unclosed quote: quotes mean nothing from here on
            end = page.find(">", start)
        else:
            end = rest.end() - 1
        at = end + 1
        if name is None:
            continue
        tag_name = name.group(1).lower()
        if page[tag + 1] == "/":
            yield "close", tag_name, ""
            continue
        yield "open", tag_name, page[start:end]
        if tag_name in RAW_TAGS:
            close = _RAW_END[tag_name].search(page, at)
            at = close.start() if close else n


def _outside(tag: str, attributes: str, in_article: bool) -> bool:
    """Whether an element holds no article text."""
    if tag in OUTSIDE_TAGS or tag in RAW_TAGS or (tag == "header" and not in_article):
        return True
    if not attributes or tag in ROOTS:
        return False
    for key, value in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'").lower()
        if key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "role" and value in OUTSIDE_ROLES):
            return True
        if key == "style" and re.search(r"display\s*:\s*none", value):
            return True
        if key in ("class", "id"):
            for word in value.split():
                parts = re.split(r"[-_]+", word)
                if word in OUTSIDE_WHOLE or parts[0] in OUTSIDE_NAMES or (parts[-1] in OUTSIDE_NAMES and parts[0] not in ("has", "no", "with", "without")):
                    return True
    return False


def _inside(tag: str, attributes: str) -> bool:
    if tag in INSIDE_TAGS:
        return True
    return bool(attributes) and bool(re.search(r"""role\s*=\s*["']?main\b|itemprop\s*=\s*["']?articlebody\b""", attributes, re.I))


class Block:
    __slots__ = ("text", "links", "heading", "inside", "label")

    def __init__(self, text: str, links: int, heading: bool, inside: bool):
        self.text, self.links, self.heading, self.inside = text, links, heading, inside
        self.label = None


def _clean(pieces: list[str]) -> str:
    return " ".join(unescape("".join(pieces)).split())


def blocks(page: str) -> list[Block]:
    """Blocks that may be article text, in page order."""
    out: list[Block] = []
    stack: list[tuple[str, bool, bool]] = []  # name, outside, inside
    names: Counter = Counter()
    outside = inside = links = 0
    pieces: list[str] = []
    linked: list[str] = []
    heading = breaks = 0

    def flush():
        nonlocal breaks
        if pieces:
            text = _clean(pieces)
            if text:
                out.append(Block(text, len(_clean(linked)), heading > 0, inside > 0))
            pieces.clear()
            linked.clear()
        breaks = 0

    def pop():
        nonlocal outside, inside, links, heading
        name, was_outside, was_inside = stack.pop()
        if name in BLOCK_TAGS or was_outside or was_inside:
            flush()
        names[name] -= 1
        outside -= was_outside
        inside -= was_inside
        links -= name == "a"
        heading -= name in HEADINGS

    for kind, name, rest in tokens(page):
        if kind == "text":
            if not outside:
                pieces.append(rest)
                if links:
                    linked.append(rest)
                if not rest.isspace():
                    breaks = 0
        elif kind == "open":
            if name == "br":  # a space; two in a row end a block
                if breaks:
                    flush()
                else:
                    pieces.append(" ")
                    breaks = 1
                continue
            if name in BLOCK_TAGS:
                if names["p"]:
                    while stack and names["p"] and stack[-1][0] not in BLOCK_TAGS:
                        pop()
                    if stack and stack[-1][0] == "p":
                        pop()
                if name == "li" and stack and stack[-1][0] == "li":
                    pop()
                flush()
            elif name == "a" and names["a"]:
                while names["a"] and stack[-1][0] not in BLOCK_TAGS:
                    pop()
            if name in VOID_TAGS or rest.endswith("/") and name in ("path", "rect", "circle"):
                continue
            state = _outside(name, rest, inside > 0), _inside(name, rest)
            if any(state):
                flush()
            stack.append((name, *state))
            names[name] += 1
            outside += state[0]
            inside += state[1]
            links += name == "a"
            heading += name in HEADINGS
        elif names[name] > 0:
            while stack[-1][0] != name:
                pop()
            pop()
        elif name in BLOCK_TAGS:
            flush()
    flush()
    return out


def _first_pass(block: Block) -> None:
    """``good``, ``bad``, or None: undecided (``middling`` if long enough)."""
    n = len(block.text)
    if block.links > MOST_LINKS * n:
        block.label = "bad"
    elif n < SHORT or block.heading:
        block.label = "bad" if n < SHORT and "©" in block.text and not block.inside else None
    else:
        found = _LETTERS.findall(block.text.lower())
        share = sum(w in STOP_WORDS for w in found) / len(found) if found else 0.0
        if share >= HIGH and n >= LONG:
            block.label = "good"
        elif share >= LOW or block.inside:
            block.label = "middling"
        else:
            block.label = "bad"


def _second_pass(found: list[Block]) -> None:
    """Undecided blocks inherit from the nearest decided ones."""
    n = len(found)
    decided = [b.label if b.label in ("good", "bad") else None for b in found]
    before, after = [(None, n)] * n, [(None, n)] * n  # (label, distance)
    for order, side in ((range(n), before), (range(n - 1, -1, -1), after)):
        label, far = None, n
        for i in order:
            side[i] = label, far
            far += 1
            if decided[i]:
                label, far = decided[i], 1
    for i, block in enumerate(found):
        if decided[i]:
            continue
        (left, near), (right, far) = before[i], after[i]
        if left is None or right is None:
            choice = left or right or "good"
        elif block.label == "middling":
            choice = "good" if "good" in (left, right) else "bad"
        elif block.heading or near == far:
            choice = right if block.heading else "good" if "good" in (left, right) else "bad"
        else:
            choice = left if near < far else right
        block.label = choice


def main_text(page: str | None) -> str:
    """The article of a page: good blocks joined by line feeds."""
    found = blocks(page or "")
    if any(b.inside for b in found):
        found = [b for b in found if b.inside]
    for block in found:
        _first_pass(block)
    _second_pass(found)
    return "\n".join(b.text for b in found if b.label == "good")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    narrow = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))

    def texts(batches):
        for batch in batches:
            for part in range(0, len(batch), 512):
                rows = batch.slice(part, 512)
                found = [main_text(page) for page in rows.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [rows.column("page_id"), rows.column("url"), pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())],
                    names=["page_id", "url", "text", "n_chars"],
                )

    return map_arrow(narrow, texts, "page_id long, url string, text string, n_chars long")
