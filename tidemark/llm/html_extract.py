"""Main text of web pages by two passes over their blocks.

The first pass decides a block by stop-word density, length and link density;
named containers (menus, footers, adverts, comments ...) are decided against
from the start. The second pass gives each undecided block the label of its
nearest decided neighbours.
"""

from __future__ import annotations

import html as references
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructField

from .batches import extend, texts_of

# Frequent function words of English, French, German and Spanish.
STOP_WORDS = frozenset(
    """a an and are as at be been but by for from had has have he her his i in is it its not of on or she that the
    their they this to was we were which will with you
    au aux avec ce ces dans des du elle en est et il la le les mais ne ou par pas pour que qui sa se son sont sur une un
    aber als auch auf aus bei das dem den der die ein eine einer er für ich im ist mit nicht sich sie sind und von zu
    al como con del el era es esta las lo los más o para pero por su sus una y""".split()
)
# Elements by their part in a page.
RAW = frozenset("script style noscript template iframe textarea title svg math object xmp noembed noframes head".split())
BLOCKS = frozenset(
    """address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure
    footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section
    select summary table tbody tfoot thead tr ul""".split()
)
DROPPED = frozenset("nav footer aside form menu dialog button select datalist search".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 legend summary".split())
LEAVES = frozenset("p li h1 h2 h3 h4 h5 h6 dt dd pre tr caption figcaption legend summary option address".split())
EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split()
)
# Words of class and id names of parts that are not the article.
DROPPED_NAMES = frozenset(
    """ad ads adv advert advertisement advertising adverts adsense sponsor sponsored promo promoted promotion banner nav
    navbar navigation menu menubar breadcrumb breadcrumbs sidebar sidenav aside footer header masthead topbar toolbar cookie
    cookies consent gdpr notice notices newsletter subscribe subscription signup login modal popup overlay share
    sharing social comment comments commentlist respond replies disqus related recommended recommendations
    widget pagination pager legal disclaimer alert paywall toast notification""".split()
)
# Parts of longer names that mean the same.
_DROPPED_PART = re.compile(
    r"sidebar|advert|breadcrumb|newsletter|cookie|masthead|navbar|(?:^|[-_])ads?(?:box|slot|unit|space|wrap|block|container)"
)
_NOT_DROPPED = re.compile(r"(?:^|[-_])(?:has|no|with|without)(?:[-_]|$)|[-_](?:open|closed|enabled|disabled)$")
_OWN_HEADER = frozenset("article post entry content story page title".split())

# What decides a block: code points, share of stop words, share of linked code points.
LONG, STOPS, LINKED = 60, 0.12, 0.5
LONG_INSIDE, STOPS_INSIDE = 25, 0.08
PLAIN_LONG, PLAIN_STOPS = 200, 0.02
# Least share of the good text that a marked article must hold to speak for the page.
MARKED_SHARE = 0.5

_MARKUP = re.compile(
    r"<!--(?:.*?(?:--!?>|\Z)|-?>)"
    r"|<!\[CDATA\[(?P<data>.*?)(?:\]\]>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attributes>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*+)(?P<attributes2>[^>]*+)(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAMED = re.compile(r"\b(?:class|id|role|hidden|style|aria-hidden|itemprop)\b", re.IGNORECASE)
_CAMEL = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_WORD = re.compile(r"\w+")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)", re.IGNORECASE) for name in RAW}


@dataclass
class Block:
    """One block of text with what the two passes need to know."""

    text: str
    linked: int
    heading: bool
    dropped: bool
    scope: int
    parent: int
    label: bool | None = None


@dataclass
class _Open:
    """An open element with what its content inherits."""

    name: str
    number: int
    dropped: bool
    scope: int
    heading: bool


@dataclass
class _Reader:
    """Blocks of one page, in page order."""

    blocks: list[Block] = field(default_factory=list)
    scopes: dict[int, str] = field(default_factory=dict)
    stack: list[_Open] = field(default_factory=lambda: [_Open("", 0, False, 0, False)])
    open_names: dict[str, int] = field(default_factory=dict)
    parts: list[tuple[str, bool]] = field(default_factory=list)
    link_depth: int = 0
    opened: int = 0
    broken: bool = False
    by_name: bool = True

    def flush(self) -> None:
        """End the current block."""
        self.broken = False
        if self.parts:
            text = " ".join("".join(part for part, _ in self.parts).split())
            if text:
                linked = sum(len("".join(part.split())) for part, in_link in self.parts if in_link)
                top = self.stack[-1]
                solid = sum(len(word) for word in text.split())
                parent = self.stack[-2].number if top.name in LEAVES else top.number
                self.blocks.append(
                    Block(text, min(1000, linked * 1000 // solid), top.heading, top.dropped, top.scope, parent)
                )
            self.parts = []

    def text(self, raw: str) -> None:
        if raw and not (self.stack[-1].dropped and self.stack[-1].name not in BLOCKS):
            if not raw.isspace():
                self.broken = False
            self.parts.append((references.unescape(raw), bool(self.link_depth)))

    def line_break(self) -> None:
        """One break is white space, a second one ends the block."""
        if self.broken:
            self.flush()
        self.parts.append((" ", False))
        self.broken = True

    def push(self, name: str, attributes: str) -> None:
        top = self.stack[-1]
        dropped, scope = top.dropped, top.scope
        self.opened += 1
        if name in DROPPED or (name == "header" and not scope):
            dropped = True
        if name in ("article", "main"):
            scope = self.opened
        if _NAMED.search(attributes):
            found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)}
            role = found.get("role", "").lower()
            if role in ("main", "article") or "articlebody" in found.get("itemprop", "").lower():
                scope = self.opened
            style = "".join(found.get("style", "").lower().split())
            if "display:none" in style or "hidden" in found or found.get("aria-hidden") == "true" or role in DROPPED_ROLES:
                dropped = True
            if self.by_name and name not in ("html", "body", "main") and names_a_side_part(
                f"{found.get('class', '')} {found.get('id', '')}"
            ):
                dropped = True
        if scope == self.opened:
            self.scopes[scope] = name if name in ("article", "main") else "main" if "main" in attributes else "article"
        self.stack.append(_Open(name, self.opened, dropped, scope, top.heading or name in HEADINGS))
        self.open_names[name] = self.open_names.get(name, 0) + 1

    def pop(self, name: str) -> None:
        """Close the innermost element of that name and all inside it."""
        while self.open_names.get(name):
            closed = self.stack.pop()
            self.open_names[closed.name] -= 1
            if closed.name == name:
                break
        if len(self.stack) < self.link_depth:
            self.link_depth = 0

    def start(self, name: str, attributes: str) -> None:
        if name == "br":
            self.line_break()
        elif name == "a":
            self.link_depth = len(self.stack)
        elif name in ("td", "th"):
            self.parts.append((" ", False))
        elif name in BLOCKS:
            self.flush()
            if self.stack[-1].name == "p" or (self.stack[-1].name == name and name in ("li", "dt", "dd", "option", "tr")):
                self.pop(self.stack[-1].name)
            if name not in EMPTY and not attributes.endswith("/"):
                self.push(name, attributes)
        elif name == "button":
            self.push(name, attributes)
        elif name not in EMPTY and not attributes.endswith("/"):
            inside = self.open_names.get(name, 0)
            if inside or _NAMED.search(attributes):
                before = self.stack[-1].dropped
                self.push(name, attributes)
                if not inside and self.stack[-1].dropped == before:
                    self.pop(name)

    def end(self, name: str) -> None:
        if name == "a":
            self.link_depth = 0
        elif name in BLOCKS:
            self.flush()
            self.pop(name)
        elif name == "br":
            self.line_break()
        elif self.open_names.get(name):
            self.pop(name)


def names_a_side_part(names: str) -> bool:
    """Whether a class or id name stands for a part that is not the article."""
    for name in names.split():
        if _NOT_DROPPED.search(name.lower()):
            continue
        words = {word.lower() for word in _CAMEL.findall(name)} | set(re.split(r"[^a-z]+", name.lower()))
        side = words & DROPPED_NAMES
        if _DROPPED_PART.search(name.lower()) or _DROPPED_PART.search(re.sub("[-_]", "", name.lower())):
            return True
        if side and not (side == {"header"} and words & _OWN_HEADER):
            return True
    return False


def read_blocks(page: str, by_name: bool = True) -> tuple[list[Block], dict[int, str]]:
    """The blocks of a page, and the marked articles they may lie in; ``by_name``: class and id names count."""
    reader, at = _Reader(by_name=by_name), 0
    while match := _MARKUP.search(page, at):
        reader.text(page[at : match.start()])
        at = match.end()
        if match["data"]:
            reader.text(match["data"])
        name = match["name"] or match["name2"]
        if not name:
            continue
        name = name.lower()
        if match["end"] or match["end2"]:
            reader.end(name)
            continue
        attributes = match["attributes"] if match["name"] else match["attributes2"]
        if name in RAW and not attributes.endswith("/"):
            closing = _RAW_END[name].search(page, at)
            if closing:
                at = closing.end()
            elif name == "head":
                body = re.compile(r"<body\b", re.IGNORECASE).search(page, at)
                at = body.start() if body else at
            else:
                at = len(page)
        else:
            reader.start(name, attributes)
    reader.text(page[at:])
    reader.flush()
    return reader.blocks, reader.scopes


def stop_share(text: str) -> float:
    """Share of a text's words that are function words."""
    words = _WORD.findall(text.lower())
    return sum(word in STOP_WORDS for word in words) / len(words) if words else 0.0


def first_pass(block: Block) -> bool | None:
    """Decide a block by itself: True, False, or None if it stays open."""
    if block.dropped or block.linked > 1000 * LINKED:
        return False
    if block.heading:
        return None
    share, size = stop_share(block.text), len(block.text)
    if block.scope:
        return True if size >= LONG_INSIDE and share >= STOPS_INSIDE else None
    if size >= LONG and share >= STOPS and block.linked <= 300:
        return True
    return False if size >= PLAIN_LONG and share < PLAIN_STOPS else None


def reopen(blocks: list[Block]) -> None:
    """Open again what its words alone speak against, if it stands between two good blocks of its parent.

    A listing, a table of figures or a paragraph in another language is part of
    the article that goes on behind it.
    """
    weak = [
        block.label is False and not block.dropped and not block.scope and block.linked <= 300 for block in blocks
    ]
    before: list[Block | None] = []
    last = None
    for block, open_ in zip(blocks, weak, strict=True):
        before.append(last)
        if block.label is not None and not open_ and not block.dropped:
            last = block
    after = None
    for k in range(len(blocks) - 1, -1, -1):
        block, ahead = blocks[k], before[k]
        if weak[k] and ahead and after and ahead.label and after.label and ahead.parent == block.parent == after.parent:
            block.label = None
        elif block.label is not None and not weak[k] and not block.dropped:
            after = block


def second_pass(blocks: list[Block]) -> None:
    """Give every open block the label of its nearest decided neighbours of the same article.

    Neighbours of the same parent come first, then the nearer one; a tie is kept.
    An open block of a marked article without decided neighbours is kept, one
    outside is dropped.
    """
    before: list[int | None] = []
    last: dict[int, int] = {}
    for k, block in enumerate(blocks):
        before.append(last.get(block.scope))
        if block.label is not None and not block.dropped:
            last[block.scope] = k
    after: list[int | None] = [None] * len(blocks)
    last = {}
    for k in range(len(blocks) - 1, -1, -1):
        after[k] = last.get(blocks[k].scope)
        if blocks[k].label is not None and not blocks[k].dropped:
            last[blocks[k].scope] = k
    labels = []
    for k, block in enumerate(blocks):
        if block.label is not None:
            labels.append(block.label)
            continue
        near = [j for j in (before[k], after[k]) if j is not None]
        if not near:
            labels.append(bool(block.scope))
            continue
        family = [j for j in near if blocks[j].parent == block.parent]
        least = min(abs(j - k) for j in family or near)
        labels.append(any(blocks[j].label for j in (family or near) if abs(j - k) == least))
        if block.scope and not labels[-1]:  # only links decide against a block of a marked article
            labels[-1] = block.linked <= 300
    for block, label in zip(blocks, labels, strict=True):
        block.label = label


def main_blocks(page: str | None, by_name: bool = True) -> list[str]:
    """The blocks of the article, in page order.

    Marked articles speak for the page if they hold most of the good text; several
    that hold less are cards. If the names of containers leave nothing, they may mean the layout of the
    whole page, and the page is read again without them; what is found so counts
    if it is a text of several blocks.
    """
    blocks, scopes = read_blocks(page or "", by_name)
    for block in blocks:
        block.label = first_pass(block)
    reopen(blocks)
    second_pass(blocks)
    good = [block for block in blocks if block.label]
    total = sum(len(block.text) for block in good)
    for kind in ("article", "main"):
        inside = [block for block in good if scopes.get(block.scope) == kind]
        if inside and sum(len(block.text) for block in inside) >= MARKED_SHARE * total:
            good = inside
            break
        if len({block.scope for block in inside}) > 1:  # cards that lead to other pages, beside an unmarked article
            good = [block for block in good if scopes.get(block.scope) != kind]
    if not good:  # nothing decided for: what is neither linked nor a side part
        good = [block for block in blocks if not block.dropped and block.linked <= 1000 * LINKED]
    if not good and by_name and any(block.dropped for block in blocks):
        whole = main_blocks(page, False)
        return whole if len(whole) > 1 and sum(map(len, whole)) >= 2 * LONG else []
    return [block.text for block in good]


def extract_text(pages: DataFrame, html: str = "html") -> DataFrame:
    """The rows of ``pages`` without ``html``, with ``text`` and its code points ``n_chars``.

    Blocks are joined by one newline. Null and empty pages, and pages without an
    article, give an empty text. Existing columns ``text`` and ``n_chars`` are
    replaced; repeated rows give repeated results. No shuffle, whole pages.
    """

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        texts = ["\n".join(main_blocks(page)) for page in texts_of(batch, html)]
        return [pa.array(texts, pa.string()), pa.array([len(text) for text in texts], pa.int64())]

    return extend(pages, [StructField("text", StringType()), StructField("n_chars", LongType())], compute).drop(html)
