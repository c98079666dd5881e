"""Markup of one page as plain Python, for the Arrow stages that cut pages into rows.

Each function gives for a text what its namesake in ``structure``, ``markup`` or ``text`` gives for a
column; tests compare them. A page is gone through tag by tag with a stack, in time that grows with
its length, where a column expression works out a tree of expressions for each tag.
"""

from __future__ import annotations

import re
from functools import cache, lru_cache

from docketry.functions.markup import CELL_END, GAP, HARD_SPACE, HIDDEN, TO_FIRST_TEXT, class_pattern
from docketry.functions.structure import BARE_TAG, PLAIN_TAG, SINGLE_QUOTED, TAG_HEAD, VOID_TAGS
from docketry.functions.text import CONTROLS, ENTITY_NAMES, LAWYER_LABEL, PARTY_NOISE, SPACE, WINDOWS


@cache
def pattern(java: str) -> re.Pattern:
    """A pattern of the column functions: ``\\s`` is ASCII there, and ``SPACE`` what it is here."""
    space, any_space = r" \t\n\x0b\f\r", "\0"
    in_class = re.sub(r"\[((?:[^\]\\]|\\.)*)\]", lambda m: "[" + m[1].replace(r"\s", space) + "]", java.replace(SPACE, any_space))
    return re.compile(in_class.replace(r"\s", f"[{space}]").replace(r"\z", r"\Z").replace(any_space, r"\s"))


TAG = pattern("<[^>]*>")
HEAD = pattern(TAG_HEAD.removeprefix("^"))
PLAIN = pattern(PLAIN_TAG)
PARTS = pattern(r"""([a-zA-Z_:][a-zA-Z0-9_:.-]*+)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++))?""")
CELL = pattern(r"</?[tT][rRdDhH]\b[^>]*>")
ROW = pattern(r"<tr(?=[\s/>])")
OPEN_TAG = pattern(r"<([a-z][a-z0-9]*+)\b[^<>]*+\z")
BLANKS = frozenset(" \t\n\x0b\f\r")
AFTER_NAME = BLANKS | {"/", ">"}
TAG_START = pattern(r"<[a-z][a-z0-9]*+\b")
LINE_BREAK = pattern(r"<br\s*/?>")
VOID_OR_CHILD = pattern(r"<(?:br|wbr|img|hr)\b[^>]*+>|<([a-z0-9]++)\b[^>]*+>[^<]*+</\1>")
NO_NOISE = str.maketrans("", "", PARTY_NOISE)
WINDOWS_OF = str.maketrans(CONTROLS, WINDOWS)


def prepare(html: str) -> str:
    return plain_tags(pattern(HIDDEN).sub(GAP, html))


def plain_tags(markup: str) -> str:
    pieces = markup.split("<")[1:]
    # What a head becomes hangs on the head alone, and none holds the start of another: each kind is replaced at once.
    changed = {head: new for head in {piece[: piece.find(">") + 1] for piece in pieces} if (new := HEADS[head]) != head}
    if None in changed.values():
        return _respelt_one_by_one(markup)
    if len(changed) > 64:
        return "<".join([markup.partition("<")[0], *[changed.get(h := p[: p.find(">") + 1], h) + p[len(h) :] for p in pieces]])
    for head, new in changed.items():
        markup = markup.replace("<" + head, "<" + new)
    return markup


def _respelt_one_by_one(markup: str) -> str:
    """``plain_tags`` of a page where a quoted value holds the sign that ends a tag."""
    first, *pieces = markup.split("<")
    heads = [HEAD.match(piece) for piece in pieces]
    return "<".join([first, *[_respelt(m[0]) + piece[m.end() :] if m else piece for m, piece in zip(heads, pieces)]])


class _Heads(dict):
    """Heads of tags, without the sign that starts them, to the one spelling; none where a quoted value goes on."""

    def __missing__(self, head: str) -> str | None:
        if len(self) >= 4096:
            self.clear()
        cut = not HEAD.fullmatch(head) and ('"' in head or "'" in head) and re.match("/?[a-zA-Z]", head)
        new = self[head] = None if cut else _respelt(head)
        return new


HEADS = _Heads()


def _respelt(head: str) -> str:
    """The head of an odd tag in the one spelling; other tags and texts as they are."""
    if PLAIN.match(head) or not HEAD.fullmatch(head):
        return head
    if pattern(BARE_TAG).match(head):
        return head.lower()
    if pattern(SINGLE_QUOTED).match(head):
        return head.replace("'", '"')
    name = re.match("/?[a-zA-Z][a-zA-Z0-9]*", head)[0]
    own = head[len(name) : -1]
    pairs = [f" {k.lower()}" + (f'="{_bare(v)}"' if v else "") for k, v in PARTS.findall(own)]
    return name.lower() + "".join(pairs) + ("/>" if own.rstrip(" ").endswith("/") else ">")


def _bare(value: str) -> str:
    if value[0] in "\"'":
        value = value[1:]
    if value[-1:] in ('"', "'"):
        value = value[:-1]
    return value.replace('"', "&quot;")


def decode_entities(text: str) -> str:
    return re.sub("&([^&;]*);", lambda m: _entity(m[1]) or m[0], text) if "&" in text else text


@lru_cache(maxsize=4096)
def _entity(name: str) -> str | None:
    if not name.startswith("#"):
        return ENTITY_NAMES.get(name)
    found = re.fullmatch("#(?:([0-9]{1,7})|[xX]([0-9a-fA-F]{1,6}))", name)
    code = (int(found[1]) if found[1] else int(found[2], 16)) if found else 0
    return chr(code).translate(WINDOWS_OF) if 1 <= code <= 55295 or 57344 <= code <= 1114111 else None


def inner_text(markup: str) -> str:
    return decode_entities("".join([t.strip() for t in TAG.split(_hard_spaces(markup))]))


def _hard_spaces(markup: str) -> str:
    return re.sub(HARD_SPACE, " ", markup) if "&" in markup else markup


def normalise_space(text: str) -> str:
    return " ".join(text.split())


def own_text(markup: str) -> str:
    return decode_entities(markup.partition("<")[0]).strip()


@cache
def _text_after(opening: str) -> re.Pattern:
    return pattern(rf"{opening}([^<]*+)")


def first_text(markup: str, opening: str) -> str:
    found = _text_after(opening).search(markup)
    return decode_entities(found[1]).strip() if found else ""


def labelled_cells(block: str) -> str:
    texts = TAG.split(CELL.sub(CELL_END, _hard_spaces(block)))
    if len(texts) > 1:
        texts = [texts[0].rstrip(), *[t.strip() for t in texts[1:-1]], texts[-1].lstrip()]
    return decode_entities("".join(texts))


def label_detail(cells: str, label: str) -> str:
    place = cells.find(label)
    return normalise_space(cells[place + len(label) :].partition(CELL_END)[0]) if place >= 0 else ""


@cache
def _titled_link(title: str) -> re.Pattern:
    return pattern(rf'(?s)<a\b[^>]*?\stitle="{re.escape(title)}"[^>]*+>(.*?)</a>')


def link_text_by_title(block: str, title: str) -> str:
    found = _titled_link(title).search(block)
    return inner_text(found[1]) if found else ""


def _tags(markup: str, tag: str) -> list[tuple[int, int]]:
    """Place of each start and end tag of a name, in order, with the step in depth."""
    if not tag:
        return [(m.start(), -1 if markup.startswith("</", m.start()) else 1) for m in pattern(r"</?[\s/>]").finditer(markup)]
    found = []
    for mark, step in ((f"<{tag}", 1), (f"</{tag}", -1)):
        size = len(mark)
        place = markup.find(mark)
        while place >= 0:
            end = place + size
            if markup[end : end + 1] in AFTER_NAME:
                found.append((place, step))
            place = markup.find(mark, end)
    found.sort()
    return found


def inside(rest: str, tag: str) -> str:
    # Most elements hold none of their own name; then the first end tag ends them.
    first = rest.find(f"</{tag}>") if tag else -1
    if first >= 0 and rest.find(f"<{tag}", 0, first) < 0 and rest.find(f"</{tag}", 0, first) < 0:
        return rest[:first]
    depth = 1
    for place, step in _tags(rest, tag):
        depth += step
        if depth == 0:
            return rest[:place]
    return rest


def element(body: str, element_id: str) -> str:
    marker = f'id="{element_id}"'
    tag, rest = None, None
    place = body.find(marker)
    while place >= 0 and (tag is None or rest is None):
        if body[place - 1 : place] in BLANKS:
            end = body.find(">", place + len(marker)) + 1
            rest = body[end:] if rest is None and end else rest
            tag = _tag_at(body, place - 1) if tag is None else tag
        place = body.find(marker, place + len(marker))
    return "" if tag in VOID_TAGS else inside(rest or "", tag or "")


def _tag_at(body: str, place: int) -> str | None:
    """Name of the tag whose attributes reach up to a place."""
    found = OPEN_TAG.match(body[max(body.rfind("<", 0, place), 0) : place])
    return found[1] if found else None


def deep_elements(markup: str, tag: str, depth: int) -> list[str]:
    """Markup inside each ``tag`` at ``depth`` or deeper, in page order."""
    starts, ends, still_open = [], [], []
    for place, step in _tags(markup, tag):
        if step > 0:
            still_open.append(len(starts))
            starts.append((place, len(still_open)))
            ends.append(len(markup))
        elif still_open:
            ends[still_open.pop()] = place
    return [_after_tag(markup[place:end]) for (place, level), end in zip(starts, ends) if level >= depth]


def _after_tag(markup: str) -> str:
    return markup[markup.find(">") + 1 :] if markup.startswith("<") else markup


def last_block(markup: str, tag: str) -> str:
    depth, start = 0, None
    for place, step in _tags(markup, tag):
        if step > 0 and depth == 0:
            start = place
        depth = max(depth + step, 0)
    return inside(" " + markup, tag) if start is None else inside(_after_tag(markup[start:]), tag)


def last_block_text(block: str, row_tag: str, block_tag: str) -> str:
    row = block.rpartition(f"<{row_tag}")[2]
    if "</table" in row:
        row = last_block(closed_rows(block), row_tag)
    return normalise_space(inner_text(last_block(row, block_tag))) if f"<{block_tag}" in row else ""


def closed_rows(markup: str) -> str:
    pieces = ROW.split(markup)
    if len(pieces) - 1 <= markup.count("</tr"):
        return markup
    for n in range(1, len(pieces)):
        own = pieces[n].partition("</table")[0]
        if "</tr" not in own and "<table" not in own:
            pieces[n] = own + "</tr>" + pieces[n][len(own) :]
    return "<tr".join(pieces)


@cache
def _class_tag(name: str) -> re.Pattern:
    return pattern(rf"{class_pattern(name)}[^>]*+>")


def cell_of_class(row: str, name: str) -> str:
    found = _class_tag(name).search(row)
    return inside(row[found.end() :] if found else "", "td")


@cache
def _heads(element_ids: tuple[str, ...]) -> re.Pattern:
    return pattern(rf'id="(?<=\sid=")(?:{"|".join(map(re.escape, element_ids))})"[^>]*+>{TO_FIRST_TEXT}[^<]*+')


def anchored_texts(body: str, element_ids: tuple[str, ...]) -> dict[str, str]:
    """First texts of the anchors a page has, each by the first element with its id: ``head_text`` of ``anchored_heads``."""
    found = {}
    for head in _heads(element_ids).findall(body):
        found.setdefault(head.split('"', 2)[1], head.rpartition(">")[2])
    return {name: decode_entities(text).strip() for name, text in found.items()}


@cache
def _class_texts(tag_class: str) -> re.Pattern:
    inner = r"<(?:br|wbr|img|hr)\b[^>]*+>|<([a-z0-9]++)\b[^>]*+>[^<]*+</\2>"
    return pattern(rf"{class_pattern(tag_class)}[^>]*+>([^<]*+(?:(?:{inner})[^<]*+)*+)")


def tags_joined(body: str, tag_class: str, separator: str = "|") -> str:
    nodes = []
    for found in _class_texts(tag_class).finditer(body):
        own, place = found[1], 0
        for child in VOID_OR_CHILD.finditer(own):
            nodes.append(own[place : child.start()])
            place = child.end()
        nodes.append(own[place:])
    return decode_entities(separator.join(filter(None, nodes))).strip()


@cache
def _text_of_class(names: tuple[str, ...]) -> re.Pattern:
    return pattern(rf"{class_pattern(*names)}[^>]*+>([^<]*+)")


def texts_of_class(body: str, names: tuple[str, ...]) -> list[str]:
    """The raw text that follows each tag with all the class names."""
    return _text_of_class(names).findall(body)


@cache
def _tag_with(tag: str, name: str) -> re.Pattern:
    return pattern(rf"<{tag}\b[^<>]*?\s{class_pattern(name)}[^<>]*+>")


def tag_with_class(body: str, tag: str, name: str) -> str:
    """First opening ``tag`` of a class; blank if absent."""
    found = _tag_with(tag, name).search(body) if name in body else None
    return found[0] if found else ""


@cache
def _labelled(container: str, label_class: str, label: str) -> tuple[re.Pattern, re.Pattern]:
    opening, end = re.escape(container), re.escape(label_class)
    marker = rf"{end}[^>]*>[^<]*{re.escape(label)}"
    return pattern(rf"(?s){opening}[^>]*+>((?:(?!{opening}).)*?{marker}.*)"), pattern(rf"(?s){marker}(.*?)(?:{end}|\z)")


def labelled_block(body: str, container: str, label_class: str, label: str) -> str:
    whole, region = _labelled(container, label_class, label)
    found = whole.search(body) if label in body else None
    found = region.search(inside(found[1], "div")) if found else None
    return found[1] if found else ""


@cache
def _of_class(name: str) -> re.Pattern:
    return pattern(class_pattern(name))


def parties(body: str, party_class: str) -> list[dict[str, list[str]]]:
    starts = set()
    for found in _of_class(party_class).finditer(body) if party_class in body else []:
        # The start of the tag, or of each that stands before the end of one.
        before = body.rfind(">", 0, found.start()) + 1
        starts.update(m.start() for m in TAG_START.finditer(body, before, found.start() - 1))
    ends = sorted(starts)
    return [_party(body[start:end]) for start, end in zip(ends, [*ends[1:], len(body)])]


def _party(cell: str) -> dict[str, list[str]]:
    """Names and lawyers of a party, from the start tag of its cell on."""
    pieces = LINE_BREAK.split(inside(_after_tag(cell), re.match("<([a-z0-9]+)", cell)[1]) + "</td>")
    clean = [decode_entities(TAG.sub("", p)).strip().translate(NO_NOISE) for p in pieces if p.strip()]
    return {"nomes_parte": clean[:1], "advogados_parte": [re.sub(LAWYER_LABEL, "", t).strip() for t in clean[1:]]}
