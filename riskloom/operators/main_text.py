"""Main text of a page from the stream of its tags: blocks of text, told from menus and footers by words and links.

Text is cut where a block-level element begins or ends. A block is judged by its share of linked words and by its
words and those of the blocks beside it (shallow text features, as published for boilerplate detection); what stands inside
navigation, footers, forms, tables, comments or elements named for such parts is out beforehand. One pass, no tree.
"""

from __future__ import annotations

import re

BLOCKS = frozenset("address article aside blockquote body br dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section table tbody td tfoot th thead tr ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements whose text is never main text.
OUTSIDE = frozenset("nav footer aside form button select menu dialog table figure head title script style noscript iframe svg template textarea".split())
#: Elements that hold main text whatever they are named.
HOLDERS = frozenset("html body main article".split())
NAMED = re.compile(r"(?:^|[\s_-])(?:nav|navbar|navigation|menu|footer|sidebar|breadcrumbs?|cookies?|consent|share|sharing|social|comments?|related|promo|newsletter|subscribe|pagination|pager|toolbar|masthead|copyright|disclaimer|advert|advertisement|ads?|banner|sponsor|sponsored)(?:$|[\s_-])", re.I)
#: Shares of linked words and counts of words at which a block is judged.
LINKED, LINKED_BEFORE = 1 / 3, 5 / 9
SHORT, SHORT_AFTER_LINKS = 16, 40


class Block:
    __slots__ = ("text", "words", "linked", "heading")

    def __init__(self, text: str = "", linked: int = 0, heading: bool = False):
        self.text, self.linked, self.heading = text, linked, heading
        self.words = len(text.split())

    @property
    def links(self) -> float:
        return self.linked / self.words if self.words else 0.0


def is_outside(tag: str, attrs: dict[str, str]) -> bool:
    """Whether an element's text is out, by its tag, its role or its name."""
    if tag in OUTSIDE:
        return True
    if tag in HOLDERS:
        return False
    if "hidden" in attrs or attrs.get("aria-hidden") == "true" or attrs.get("role") in ("navigation", "contentinfo", "banner", "complementary", "search"):
        return True
    return bool(NAMED.search(f"{attrs.get('class', '')} {attrs.get('id', '')}"))


def is_content(before: Block, block: Block, after: Block) -> bool:
    if block.links > LINKED:
        return False
    if before.links <= LINKED_BEFORE:
        return block.words > SHORT or after.words >= SHORT or before.words > 4
    return block.words > SHORT_AFTER_LINKS or after.words > SHORT + 1


class Segments:
    """Collects blocks while tags pass; elements are told in the order in which they open and close."""

    def __init__(self):
        self.blocks: list[Block] = []
        self.outside = self.in_link = 0
        self.parts: list[str] = []
        self.linked = 0
        self.heading = False

    def opened(self, tag: str, outside: bool) -> None:
        if tag in BLOCKS:
            self.cut()
            self.heading = tag in HEADINGS
        self.outside += outside
        self.in_link += tag == "a"

    def closed(self, tag: str, outside: bool) -> None:
        if tag in BLOCKS:
            self.cut()
        self.outside -= outside
        self.in_link -= tag == "a"

    def data(self, text: str) -> None:
        if not self.outside:
            self.parts.append(text)
            if self.in_link:
                self.linked += len(text.split())

    def cut(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.blocks.append(Block(text, self.linked, self.heading))
        self.parts, self.linked, self.heading = [], 0, False

    def text(self) -> str:
        """The blocks that are content, a line each, and headings that stand before one; empty where there is none."""
        self.cut()
        row = [Block(), *self.blocks, Block()]
        kept = [not row[k].heading and is_content(row[k - 1], row[k], row[k + 1]) for k in range(1, len(row) - 1)]
        for k in range(len(kept) - 2, -1, -1):
            if self.blocks[k].heading and self.blocks[k].links <= LINKED:
                kept[k] = kept[k + 1]
        # A page without a block of some length has no main text: its few words are a menu or a notice.
        if not any(k and not b.heading and b.words > SHORT for k, b in zip(kept, self.blocks)):
            return ""
        return "\n".join(b.text for k, b in zip(kept, self.blocks) if k)
