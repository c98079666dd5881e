"""Nesting and spelling of markup, as column expressions over prepared pages.

Depth is counted over the tags of one name: the text is cut before each of them, and a
running sum of starts and ends tells where an element closes.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from docketry.functions.text import bound

# A tag in the one spelling the patterns read: lower case, double quotes, no odd spaces.
PLAIN_TAG = r'/?[a-z][a-z0-9]*+(?:\s++[a-z][a-z0-9_:-]*+(?:="[^"]*+")?+)*+\s*+/?>'
ODD_TAG = rf"<(?=/?[a-zA-Z])(?!{PLAIN_TAG})"
ATTRIBUTE = r"""([a-zA-Z_:][a-zA-Z0-9_:.-]*+)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++))?"""
START_OF_ROW = r"<tr(?=[\s/>])"
# Elements without content.
VOID_TAGS = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")
# The head of an odd tag, up to the next start of a tag at most.
TAG_HEAD = r"""^/?[a-zA-Z][a-zA-Z0-9]*+(?:[^<>"']++|"[^"<]*+"|'[^'<]*+')*+>"""
BARE_TAG = r"^/?[a-zA-Z][a-zA-Z0-9]*+/?>"
SINGLE_QUOTED = r"""^[a-z][a-z0-9]*+(?: [a-z][a-z0-9_:-]*+(?:="[^"'<>]*+"|='[^"'<>]*+'))++/?>"""


def plain_tags(markup: Column) -> Column:
    """Tags and attribute names in lower case, values in double quotes; other text as it is.

    The text is cut at odd tags alone; most of those are only in upper case, or only in single quotes.
    """

    def respelt(piece: Column, place: Column) -> Column:
        head = F.when(place == 0, F.lit("")).otherwise(F.regexp_extract(piece, TAG_HEAD, 0))
        return bound(head, lambda h: F.when(h == "", piece).otherwise(F.concat(_respelt_tag(h), F.substr(piece, F.length(h) + 1))))

    return F.array_join(F.transform(F.split(markup, ODD_TAG), respelt), "<")


def _respelt_tag(head: Column) -> Column:
    inside = F.regexp_extract(head, r"(?s)^/?[a-zA-Z][a-zA-Z0-9]*+(.*)>", 1)
    return (
        F.when(F.regexp_like(head, F.lit(BARE_TAG)), F.lower(head))
        .when(F.regexp_like(head, F.lit(SINGLE_QUOTED)), F.translate(head, "'", '"'))
        .otherwise(bound(inside, lambda own: _respelt_parts(head, own)))
    )


def _respelt_parts(head: Column, inside: Column) -> Column:
    names = F.regexp_extract_all(inside, F.lit(ATTRIBUTE), F.lit(1))
    values = F.regexp_extract_all(inside, F.lit(ATTRIBUTE), F.lit(2))

    def pair(name: Column, value: Column) -> Column:
        return F.when(value == "", F.concat(F.lit(" "), F.lower(name))).otherwise(
            F.concat(F.lit(" "), F.lower(name), F.lit('="'), bare(value), F.lit('"'))
        )

    def bare(value: Column) -> Column:
        # Most values hold no quotes but those around them.
        plain = F.regexp_like(value, F.lit("""^["'][^"']*+["']$"""))
        stripped = F.regexp_replace(value, "^[\"']|[\"']$", "")
        return F.when(plain, F.translate(value, "\"'", "")).otherwise(F.replace(stripped, F.lit('"'), F.lit("&quot;")))

    tag = F.lower(F.regexp_extract(head, "^/?[a-zA-Z][a-zA-Z0-9]*+", 0))
    closed = F.when(F.endswith(F.rtrim(inside), F.lit("/")), F.lit("/>")).otherwise(F.lit(">"))
    return F.concat(tag, F.array_join(F.zip_with(names, values, pair), ""), closed)


def _cut(markup: Column, tag: Column) -> Column:
    """Pieces that each start with a tag of the name; the first one holds a space and what stands before them."""
    # Matches that follow one another are found in one pass; a split before each tag would look ahead at every character.
    start = F.concat(F.lit("/?"), tag, F.lit(r"[\s/>]"))
    pattern = F.concat(F.lit("(?:^ |<"), start, F.lit(")(?:[^<]++|<(?!"), start, F.lit("))*+"))
    return F.regexp_extract_all(F.concat(F.lit(" "), markup), pattern, F.lit(0))


def _step(piece: Column, tag: Column) -> Column:
    start = F.startswith(piece, F.concat(F.lit("<"), tag))
    return F.when(F.startswith(piece, F.concat(F.lit("</"), tag)), -1).when(start, 1).otherwise(0)


def inside(rest: Column, tag: Column | str) -> Column:
    """Markup of an element, from the text after its start tag up to its own end tag (or the end)."""
    name = F.lit(tag) if isinstance(tag, str) else tag

    def up_to_end(pieces: Column) -> Column:
        def add(state: Column, piece: Column) -> Column:
            depth = state["depth"] + _step(piece, name)
            still = (state["depth"] > 0) & (depth > 0)
            return F.struct(
                F.when(state["depth"] > 0, depth).otherwise(0).alias("depth"),
                F.when(still, state["n"] + 1).otherwise(state["n"]).alias("n"),
            )

        start = F.struct(F.lit(1).alias("depth"), F.lit(0).alias("n"))
        kept = F.aggregate(pieces, start, add, lambda state: state["n"])
        return F.substr(F.array_join(F.slice(pieces, F.lit(1), kept), ""), F.lit(2))

    # Most elements hold none of their own name; then the first end tag ends them, and a plain search finds it.
    end = F.concat(F.lit("</"), name, F.lit(">"))

    def up_to_first_end(own: Column) -> Column:
        text, first = own["text"], own["first"]
        begun = F.contains(first, F.concat(F.lit("<"), name)) | F.contains(first, F.concat(F.lit("</"), name))
        flat = (F.length(first) < F.length(text)) & ~begun
        return F.when(flat, first).otherwise(bound(_cut(text, name), up_to_end))

    def cut(text: Column) -> Column:
        first = F.call_function("substring_index", text, end, F.lit(1))
        return bound(F.struct(text.alias("text"), first.alias("first")), up_to_first_end)

    return bound(rest, cut)


def element(body: Column, element_id: str) -> Column:
    """Markup inside the element with an id, whatever its tag; blank if absent or of a kind that holds nothing."""
    marker = rf'\sid="{_quoted(element_id)}"'
    tag = F.regexp_extract(body, rf"<([a-z][a-z0-9]*+)\b[^<>]*{marker}", 1)
    rest = F.regexp_extract(body, rf"(?s){marker}[^>]*+>(.*)", 1)

    def found(own: Column) -> Column:
        return F.when(own["tag"].isin(*VOID_TAGS), F.lit("")).otherwise(inside(own["rest"], own["tag"]))

    # Most pages lack most ids, and the plain search is far cheaper than the patterns.
    present = F.contains(body, F.lit(f'id="{element_id}"'))
    return F.when(present, bound(F.struct(tag.alias("tag"), rest.alias("rest")), found)).otherwise(F.lit(""))


def closed_rows(markup: Column) -> Column:
    """Table rows with the end tags that a page may leave out: a row ends where the next one of its table starts, or its table ends."""

    def closed(piece: Column, place: Column) -> Column:
        return bound(F.substring_index(piece, "</table", 1), lambda own: with_end(piece, own, place))

    def with_end(piece: Column, own: Column, place: Column) -> Column:
        is_open = (place > 0) & ~F.contains(own, F.lit("</tr")) & ~F.contains(own, F.lit("<table"))
        return F.when(is_open, F.concat(own, F.lit("</tr>"), F.substr(piece, F.length(own) + 1))).otherwise(piece)

    def rows(body: Column) -> Column:
        repaired = F.array_join(F.transform(F.split(body, START_OF_ROW), closed), "<tr")
        return F.when(F.regexp_count(body, F.lit(START_OF_ROW)) > times(body, "</tr"), repaired).otherwise(body)

    return bound(markup, rows)


def times(markup: Column, text: str) -> Column:
    """How often a plain text stands in the markup."""
    return (F.length(markup) - F.length(F.replace(markup, F.lit(text), F.lit("")))) / len(text)


def _quoted(text: str) -> str:
    return "".join(c if c.isalnum() else "\\" + c for c in text)


def deep_elements(markup: Column, tag: str, depth: int) -> Column:
    """Markup inside each ``tag`` at ``depth`` or deeper, in page order."""
    name = F.lit(tag)

    def found(pieces: Column) -> Column:
        depths = F.aggregate(
            pieces,
            F.array(F.lit(0)),
            lambda seen, piece: F.array_append(seen, F.greatest(F.element_at(seen, -1) + _step(piece, name), F.lit(0))),
        )
        return bound(depths, lambda d: _from_depths(pieces, d, name, depth))

    # Each piece starts with a tag of the name; what stands before the first of them lies in none.
    pieces = rf"</?{tag}[\s/>](?:[^<]++|<(?!/?{tag}[\s/>]))*+"
    return bound(markup, lambda text: _flat_elements(text, tag, bound(F.regexp_extract_all(text, F.lit(pieces), F.lit(0)), found), depth))


def _flat_elements(markup: Column, tag: str, otherwise: Column, depth: int) -> Column:
    """The elements of a text where each start tag is followed by its end tag before the next one starts."""
    if depth > 1:
        return otherwise
    flat = rf"<{tag}(?=[\s/>])[^>]*+>((?:[^<]++|<(?!/?{tag}[\s/>]))*+)</{tag}>"

    def all_of(found: Column) -> Column:
        flat_only = (F.size(found) == times(markup, f"<{tag}")) & (F.size(found) == times(markup, f"</{tag}"))
        return F.when(flat_only, found).otherwise(otherwise)

    return bound(F.regexp_extract_all(markup, F.lit(flat), F.lit(1)), all_of)


def _from_depths(pieces: Column, depths: Column, name: Column, depth: int) -> Column:
    # depths[n] is the depth after the n-th piece, counted from one; depths[0] is before the first.
    starts = F.filter(
        F.sequence(F.lit(1), F.size(pieces)),
        lambda n: (F.get(depths, n) >= depth) & (F.get(depths, n) > F.get(depths, n - 1)),
    )

    def markup(n: Column) -> Column:
        own = F.get(depths, n)
        after = F.transform(F.slice(depths, n + 2, F.size(depths)), lambda d: d < own)
        return bound(F.array_position(after, F.lit(True)).cast("int"), lambda size: kept(n, size))

    def kept(n: Column, size: Column) -> Column:
        own = F.array_join(F.slice(pieces, n, F.when(size == 0, F.size(pieces)).otherwise(size)), "")
        return F.regexp_replace(own, "^<[^>]*+>", "")

    return F.when(F.size(pieces) > 0, F.transform(starts, markup)).otherwise(F.array().cast("array<string>"))


def last_block(markup: Column, tag: str) -> Column:
    """Markup inside the last ``tag`` that lies in no other."""
    name = F.lit(tag)

    def found(pieces: Column) -> Column:
        def add(state: Column, piece: Column) -> Column:
            step = _step(piece, name)
            opens = (state["depth"] == 0) & (step == 1)
            return F.struct(
                F.greatest(state["depth"] + step, F.lit(0)).alias("depth"),
                (state["n"] + 1).alias("n"),
                F.when(opens, state["n"] + 1).otherwise(state["start"]).alias("start"),
            )

        zero = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("n"), F.lit(1).alias("start"))
        start = F.aggregate(pieces, zero, add, lambda state: state["start"])
        rest = F.array_join(F.slice(pieces, start, F.size(pieces)), "")
        return inside(F.regexp_replace(rest, "^<[^>]*+>", ""), tag)

    return bound(_cut(markup, name), found)
