"""Leaf blocks of a page: runs of text between block-level tags, with what stands around them."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

# Element names of HTML by their role.
HIDDEN = "script style noscript template svg iframe title textarea select object"
BLOCK = set(
    "html head body p div section article main aside header footer nav h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table "
    "caption thead tbody tfoot tr td th blockquote pre form fieldset legend figure figcaption address hr details summary "
    "hgroup search dialog menu center".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
CLOSES_P = BLOCK - set("html head body td th tr tbody thead tfoot caption legend figcaption summary".split())
#: A start tag that ends an open element of the same group, up to the group's container.
SIBLINGS = {"li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"), "td": ("td th", "tr table"), "th": ("td th", "tr table")}

#: What may stand in a head; any other start tag ends it, and so does text.
IN_HEAD = set("html head title base link meta style script noscript template basefont bgsound".split())

# Attribute values in quotes may hold '>'. A self-closed svg is empty; on other elements '/>' means nothing in HTML.
ATTRIBUTES = r"""(?:[^>"']++|"[^"]*"|'[^']*'|["'])*+"""
UNSEEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<svg(?=[\s/>]){ATTRIBUTES}(?<=/)>|"
    rf"<({'|'.join(HIDDEN.split())})(?=[\s/>]){ATTRIBUTES}>.*?(?:</\1(?=[\s/>])[^>]*>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
TAG = re.compile(r"""<(/?)([A-Za-z][^\s/>]*+)((?:[^>"']++|"[^"]*"|'[^']*'|["'])*+)>|<[!?/][^>]*>""")
NAMED = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.IGNORECASE)
TOKEN = re.compile(r"[a-z]+")


@dataclass
class Block:
    text: str
    tags: list[str]
    names: list[list[str]]
    link_chars: int
    places: dict = field(default_factory=dict)


class _Reader:
    def __init__(self) -> None:
        self.blocks: list[Block] = []
        self.tags: list[str] = []
        self.names: list[list[str]] = []
        self.text: list[str] = []
        self.link_chars = 0
        self.links = 0
        self.in_head = False

    def flush(self) -> None:
        text = " ".join(html.unescape("".join(self.text)).split()) if self.text else ""
        if text:
            self.blocks.append(Block(text, list(self.tags), list(self.names), min(self.link_chars, len(text))))
        self.text, self.link_chars = [], 0

    def end_head(self) -> None:
        if self.in_head:
            self.close({"head"}, set())
            self.in_head = False

    def words(self, text: str) -> None:
        if self.in_head and not text.isspace():
            self.end_head()
        self.text.append(text)
        if self.links:
            self.link_chars += len(text)

    def close(self, wanted: set[str], until: set[str]) -> None:
        """Ends the innermost open element of ``wanted``, unless one of ``until`` encloses it more closely."""
        for depth in range(len(self.tags) - 1, -1, -1):
            if self.tags[depth] in wanted:
                del self.tags[depth:], self.names[depth:]
                return
            if self.tags[depth] in until:
                return

    def start(self, tag: str, attributes: str) -> None:
        if tag not in IN_HEAD:
            self.end_head()
        if tag == "a":
            self.links += 1
        if tag == "br":
            self.words(" ")
        if tag not in BLOCK:
            return
        self.flush()
        if tag in CLOSES_P:
            self.close({"p"}, BLOCK - {"p"})
        if tag in SIBLINGS:
            wanted, until = SIBLINGS[tag]
            for _ in wanted.split():
                self.close(set(wanted.split()), set(until.split()))
        self.in_head |= tag == "head"
        if tag not in VOID:
            self.tags.append(tag)
            self.names.append([t for _, v in NAMED.findall(attributes) for t in TOKEN.findall(v.lower())])

    def end(self, tag: str) -> None:
        if tag == "a":
            self.links = max(0, self.links - 1)
        if tag in BLOCK:
            self.flush()
            self.close({tag}, set())
            self.in_head &= tag not in ("head", "html")


def blocks_of(page: str) -> list[Block]:
    """The page's leaf blocks in order, white space as single spaces, character references read."""
    reader, done = _Reader(), 0
    page = UNSEEN.sub("", page)
    for m in TAG.finditer(page):
        if m.start() > done:
            reader.words(page[done : m.start()])
        done = m.end()
        if m[2]:
            (reader.end(m[2].lower()) if m[1] else reader.start(m[2].lower(), m[3]))
    if done < len(page):
        reader.words(page[done:])
    reader.flush()
    return reader.blocks
