"""Secret scans with a worklist of decoded layers.

The text is the first layer. Each codec (URL escapes, Unicode escapes, base64, also over
gzip, zlib or zstd) that changes a layer gives a new one, with for each of its characters
the span of the original text that it came from. New layers go on the worklist; a layer
seen before, by its digest, does not, so cycles end. Every layer is scanned with the base
patterns, and a hit in a decoded layer is reported at the original span under a kind that
names the codecs, such as ``base64>assign``. Escapes and base64 map character by character.
An escaped escape sign (``%2525...41``) is unwrapped down to its character in one step, as one
layer, so that deep nesting takes time and spans in proportion to the text; a codec met more than twice
in a row is written with its count, ``base64*3>assign``.

A base64 run may go over several lines. If it isn't one readable text, all stretches of text
and all compressed parts in it count, from any place on, in the standard and the URL-safe
alphabet, as ASCII (so UTF-8 and Latin-1 too) or UTF-16, where a pattern or a codec finds something in them.

One compressed run is unpacked up to ``LAYER_BYTES``. Beyond that (an archive bomb) the run
is itself reported, as kind ``unread``, and so treated as a secret.

Null text counts as empty; an empty text has no spans, an empty table no rows. Repeated rows, and rows with
one id or none, are each scanned on their own; columns beside ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import base64
import re
import zlib
from bisect import bisect_right
from collections import Counter, deque
from hashlib import blake2b, sha256
from typing import NamedTuple

import numpy as np
import zstandard
from pyspark.sql import DataFrame, functions as F

from docketry.llm.common import append_column, filled, free_name, map_rows

BASE_KINDS = ("assign", "access", "hex")
LAYER_BYTES = 32_000_000
MASK = "[REDACTED]"

# The key words and patterns of the base kinds.
KEY_WORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")
ASSIGN = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
# A shorter run fails as a whole, and so do its parts: the length can stand in the pattern.
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")

# The escape signs %, \\ and & may themselves be escaped, any number of times.
URL_CHAR = re.compile(r"%(?:25)*[0-9A-Fa-f]{2}")
URL_ESCAPE = re.compile(rf"(?:{URL_CHAR.pattern})+")
UNICODE_ESCAPE = re.compile(
    r"\\(?:u005[Cc]|x5[Cc])*(?:u([0-9A-Fa-f]{4})|x([0-9A-Fa-f]{2}))|&(?:#38;|#x26;)*#(?:x([0-9A-Fa-f]{1,6})|([0-9]{1,7}));"
)
# A run with the lines that follow it; a line break may also be written as an escape.
BASE64 = re.compile(
    r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+={0,2}(?:[\x20\t]*+(?:\r?\n|(?:\\r)?\\n)[\x20\t]*+[A-Za-z0-9+/_-]++={0,2})*+"
)
LINE = re.compile(r"(?<!\\)[A-Za-z0-9+/_-]+|(?<=\\[nr])[A-Za-z0-9+/_-]+")
ALPHABETS = (re.compile(r"[A-Za-z0-9+/]{16,}"), re.compile(r"[A-Za-z0-9_-]{16,}"))
MAGIC = re.compile(rb"\x1f\x8b\x08[\x00-\x1f]|\x78[\x01\x5e\x9c\xda]|\x28\xb5\x2f\xfd", re.DOTALL)
# No hit is shorter (token=12345678), and all hits are ASCII: plain, as UTF-16 with the low or with the high byte first.
STRETCHES = (
    (re.compile(rb"[\t\n\r\x20-\x7e]{14,}"), 1),
    (re.compile(rb"(?:[\t\n\r\x20-\x7e]\x00){14,}|(?:\x00[\t\n\r\x20-\x7e]){14,}"), 2),
)

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """By start, then kind as listed."""
    found = []
    low = text.lower()
    if any(word in low for word in KEY_WORDS):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[1]) >= 8]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text)]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda x: (x[1], BASE_KINDS.index(x[0]), x[2]))


def _readable(content: bytes) -> str | None:
    try:
        text = content.decode("utf-8")
    except UnicodeDecodeError:
        return None
    return text if all(c.isprintable() or c in "\n\r\t" for c in text) else None


class TooLarge(ValueError):
    pass


def _header_end(content: bytes, start: int) -> int:
    """Where the header of a gzip member ends: found at once, however long its names are."""
    flags, end = content[start + 3], start + 10
    if flags & 4:
        end += 2 + int.from_bytes(content[end : end + 2], "little")
    for bit in (8, 16):
        if flags & bit:
            end = content.find(b"\0", end) + 1 or len(content)
    return end


def _members(content: bytes, start: int) -> tuple[bytes, int, bool]:
    """What the compressed members or frames from ``start`` on give, where they end, and whether they are sound; else up to the damage."""
    out, size, done = [], 0, start
    step = 1 if len(content) - start < 65_536 else 64
    while MAGIC.match(content, done):
        zstd = content[done] == 0x28
        reader = zstandard.ZstdDecompressor().decompressobj() if zstd else zlib.decompressobj(47)
        try:
            if content[done] == 0x1F:
                end = _header_end(content, done)
                if end >= len(content):
                    return b"".join(out), done, False
                reader.decompress(content[done:end])
                done = end
            while not reader.eof and done < len(content):
                piece = content[done : done + step]
                got = reader.decompress(piece) if zstd else reader.decompress(piece, LAYER_BYTES + 1 - size)
                out.append(got)
                size += len(got)
                if size > LAYER_BYTES:
                    raise TooLarge
                done += len(piece) - len(reader.unused_data)
        except (zlib.error, zstandard.ZstdError):
            return b"".join(out), done, False
    return b"".join(out), done, True


def unpack(content: bytes) -> bytes | None:
    """The content of all members or frames of gzip, zlib or zstd bytes; None for others."""
    return _members(content, 0)[0] or None


def _useful(text: str) -> bool:
    return bool(base_spans(text) or POSSIBLE.search(text))


class Reading(NamedTuple):
    """A text found in bytes, with the first byte and the number of bytes of each character, or of the compressed part."""

    text: str
    first: np.ndarray | int
    sizes: np.ndarray | int


def _whole(content: bytes) -> Reading | None:
    """Content that is readable from end to end."""
    text = _readable(content)
    if not text:
        return None
    sizes = np.array([len(c.encode()) for c in text]) if len(text) < len(content) else np.ones(len(text), np.int64)
    return Reading(text, np.cumsum(sizes) - sizes, sizes)


def _readings(content: bytes) -> list[Reading]:
    """The stretches of text and the compressed parts of any bytes in which a pattern or a codec finds something."""
    out, seen, work = [], set(), [(content, None)]
    while work:
        raw, packed = work.pop()
        digest = blake2b(raw, digest_size=16).digest()
        if digest in seen:
            continue
        seen.add(digest)
        done, within = 0, []
        while m := MAGIC.search(raw, done):
            got, end, sound = _members(raw, m.start())
            done = max(end, m.start() + 1) if got else m.start() + 1
            if got:
                work.append((got, packed or (m.start(), (end if sound else len(raw)) - m.start())))
                within += [(m.start(), end)] * sound
        found = [x] if packed and (x := _whole(raw)) else []
        if not found:
            for pattern, width in STRETCHES:
                for m in pattern.finditer(raw):
                    text = m[0][width == 2 and m[0][0] == 0 :: width].decode("ascii")
                    part = bisect_right(within, m.start(), key=lambda x: x[0])
                    if _useful(text) and not (part and m.end() <= within[part - 1][1]):
                        found.append(Reading(text, m.start() + width * np.arange(len(text)), np.full(len(text), width)))
        out += [Reading(x.text, *packed) for x in found] if packed else found
    return out


def _bytes_of(chars: str) -> bytes:
    body = chars.replace("-", "+").replace("_", "/")
    body = body[: len(body) - (len(body) % 4 == 1)]
    return base64.b64decode(body + "=" * (-len(body) % 4))


class Piece(NamedTuple):
    """A replaced part of a layer and its text; the places are those of each character, or of the text as one."""

    start: int
    end: int
    text: str
    starts: np.ndarray
    ends: np.ndarray
    exact: bool


def _from_url(m: re.Match) -> list[Piece]:
    escapes = URL_CHAR.findall(m[0])
    text = bytes.fromhex("".join([x[-2:] for x in escapes])).decode("utf-8", "surrogateescape")
    borders = m.start() + np.cumsum([0, *map(len, escapes)])
    last = np.cumsum([1 if "\udc80" <= c <= "\udcff" else len(c.encode("utf-8")) for c in text])
    ends = borders[last]
    starts = np.concatenate([borders[:1], ends[:-1]])
    return [Piece(*m.span(), re.sub("[\udc80-\udcff]", "\ufffd", text), starts, ends, True)]


def _from_unicode(m: re.Match) -> list[Piece]:
    code = int(m[1] or m[2] or m[3] or "0", 16) or int(m[4] or 0)
    if not 0 < code < 0x110000 or 0xD800 <= code < 0xE000:
        return []
    return [Piece(*m.span(), chr(code), np.array([m.start()]), np.array([m.end()]), True)]


def _from_base64(m: re.Match) -> list[Piece]:
    """All lines as one, if that is readable; else what is found in them from any place on, in either alphabet; else the readable lines."""
    lines = [(x.start(), x[0]) for x in LINE.finditer(m[0])]
    chars = "".join(x for _, x in lines)
    places = np.concatenate([np.arange(s, s + len(x)) for s, x in lines]) + m.start()

    def piece(reading: Reading, own: np.ndarray, start: int, end: int) -> Piece:
        if isinstance(reading.first, int):
            last = reading.first + reading.sizes
            until = m.end() if last * 4 // 3 >= len(own) - 1 else own[-(-last * 4 // 3) - 1] + 1
            return Piece(start, end, reading.text, own[[reading.first * 4 // 3]], np.array([until]), False)
        low, high = reading.first * 4 // 3, -(-(reading.first + reading.sizes) * 4 // 3)
        return Piece(start, end, reading.text, own[low], own[high - 1] + 1, True)

    plain = len(lines) == 1 or "=" not in m[0].rstrip("=")
    raw = _bytes_of(chars)
    if plain and (whole := _whole(raw)):
        return [piece(whole, places, *m.span())]
    out = [piece(x, places, *m.span()) for x in _readings(raw)]
    if plain and any(not x.exact and (x.starts[0], x.ends[0]) == m.span() for x in out):
        return out  # compressed from end to end
    parts = {x.span() for alphabet in ALPHABETS for x in alphabet.finditer(chars)}
    for start, end in sorted(parts):
        for first in range(start + (start == 0 and end == len(chars)), min(start + 4, end)):
            out += [piece(x, places[first:end], *m.span()) for x in _readings(_bytes_of(chars[first:end]))]
    out = list({(int(x.starts[0]), x.text): x for x in out}.values())
    if not out and len(lines) > 1:
        for start, line in lines:
            whole = _whole(_bytes_of(line)) if len(line) >= 16 else None
            if whole:
                start += m.start()
                out.append(piece(whole, np.arange(start, start + len(line)), start, start + len(line)))
    return out


CODECS = (("url", URL_ESCAPE, _from_url), ("unicode", UNICODE_ESCAPE, _from_unicode), ("base64", BASE64, _from_base64))
POSSIBLE = re.compile(rf"{URL_ESCAPE.pattern}|{UNICODE_ESCAPE.pattern}|{BASE64.pattern}")


def longer_path(path: str, name: str) -> str:
    """A path with one more codec; from three in a row on, the codec is written once, with their number."""
    head, last = re.fullmatch(r"(.*>)?(.*)>", path).groups(default="") if path else ("", "")
    codec, _, times = last.partition("*")
    if codec == name and times:
        return f"{head}{name}*{int(times) + 1}>"
    twice = f"{name}>{name}>"
    if path == twice or path.endswith(">" + twice):
        return f"{path[: -len(twice)]}{name}*3>"
    return f"{path}{name}>"


class Layer:
    """A text with the original span of each of its characters; none for the original itself.

    Characters out of one compressed run share its span; ``marks`` tell them apart. Others have mark 0.
    """

    def __init__(self, text: str, path: str = "", places: np.ndarray | None = None):
        self.text, self.path, self.places = text, path, places

    def origin(self, start: int, end: int) -> tuple[int, int]:
        if self.places is None:
            return start, end
        return int(self.places[0, start:end].min()), int(self.places[1, start:end].max())

    def marks(self, start: int, end: int) -> tuple[int, int]:
        return (0, 0) if self.places is None else (int(self.places[2, start]), int(self.places[2, end - 1]))

    def decoded(self, name: str, pattern: re.Pattern, decode, marks: dict) -> tuple[Layer | None, list[tuple[int, int]]]:
        """The next layer, if this codec changes anything, and the runs too large to unpack."""
        parts, places, done, unread = [], [], 0, []
        for m in pattern.finditer(self.text):
            try:
                pieces = decode(m)
            except TooLarge:
                unread.append(self.origin(*m.span()))
                continue
            for i, x in enumerate(pieces):
                again = i and x.start < done  # another reading of the same run; no pattern goes across the sign between
                parts += ["\0" if again else self.text[done : x.start], x.text]
                places.append(self._run(m.start(), m.end(), 1) if again else self._own(done, x.start))
                places.append(self._mapped(x, marks))
                done = x.end
        if not parts:
            return None, unread
        places.append(self._own(done, len(self.text)))
        return Layer("".join(parts) + self.text[done:], longer_path(self.path, name), np.concatenate(places, axis=1)), unread

    def _own(self, start: int, end: int) -> np.ndarray:
        if self.places is not None:
            return self.places[:, start:end]
        at = np.arange(start, end)
        return np.stack([at, at + 1, np.zeros_like(at)])

    def _run(self, start: int, end: int, n: int) -> np.ndarray:
        return np.repeat(np.array([[*self.origin(start, end), 0]]).T, n, axis=1)

    def _mapped(self, x: Piece, marks: dict) -> np.ndarray:
        if not x.exact:
            out = self._run(int(x.starts[0]), int(x.ends[0]), len(x.text))
            known = (int(out[0, 0]), int(out[1, 0]), blake2b(x.text.encode("utf-8", "surrogatepass"), digest_size=16).digest())
            first = marks.setdefault(known, marks["next"])
            marks["next"] = max(marks["next"], first + len(x.text))
            out[2] = first + np.arange(len(x.text))
            return out
        if self.places is None:
            return np.stack([x.starts, x.ends, np.zeros_like(x.starts)])
        return np.stack([self.places[0, x.starts], self.places[1, x.ends - 1], self.places[2, x.starts]])


def find(text: str) -> list[Span]:
    """All spans: the base ones by start and kind, then those of decoded layers, each place under its shortest path.

    Where several hits of a kind share the span of a compressed run, each has its place in the layer
    before the base kind: ``base64@20-45>assign``.
    """
    found = base_spans(text)
    if not POSSIBLE.search(text):
        return found
    known = {(*x, 0, 0) for x in found}
    hits, more, work, seen, marks = [], [], deque([Layer(text)]), set(), {"next": 1}
    while work:
        layer = work.popleft()
        digest = blake2b(layer.text.encode("utf-8", "surrogatepass"), digest_size=16).digest()
        if digest in seen:
            continue
        seen.add(digest)
        if layer.path:
            for kind, start, end in base_spans(layer.text):
                span = (kind, *layer.origin(start, end))
                if (own := (*span, *layer.marks(start, end))) not in known:
                    known.add(own)
                    hits.append((layer.path, *span, start, end))
        for codec in CODECS:
            after, unread = layer.decoded(*codec, marks)
            more += [x for x in ((f"{layer.path}unread", *span) for span in unread) if x not in more]
            if after is not None:
                work.append(after)
    shared = Counter(x[:4] for x in hits)
    for path, kind, start, end, low, high in hits:
        place = f"{path[:-1]}@{low}-{high}>" if shared[path, kind, start, end] > 1 else path
        more.append((place + kind, start, end))
    return found + sorted(more, key=lambda x: (x[1], x[2], x[0]))


def redact(text: str, spans: list[Span]) -> str:
    """The text with every span, overlapping ones as one, replaced by MASK."""
    out, done = [], 0
    for _, start, end in sorted(spans, key=lambda x: (x[1], x[2])):
        if start >= done:
            out += [text[done:start], MASK]
        done = max(done, end)
    return "".join(out) + text[done:]


SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def _columns(rows: dict) -> dict:
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    out: dict[str, list] = {name: [] for name in names}
    for doc_id, text in zip(rows["doc_id"], rows["text"]):
        spans = find(text)
        base = [x for x in spans if x[0] in BASE_KINDS]
        out["doc_id"].append(doc_id)
        for kind in BASE_KINDS:
            out[f"n_{kind}"].append(sum(x[0] == kind for x in base))
        out["base_sha256"].append(sha256(_joined(base).encode()).hexdigest())
        out["spans"].append(_joined(sorted(spans, key=lambda x: x[1])))
    return out


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def scan(docs: DataFrame) -> DataFrame:
    """Spans of every whole text, with counts and digest of the base spans; a narrow pass."""
    return map_rows(docs.select("doc_id", filled().alias("text")), _columns, SCHEMA)


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with secrets in ``text`` masked and ``n_chars`` to match; other columns and null texts as they are."""
    masked = free_name(docs, "masked")
    texts = append_column(docs, masked, "string", lambda batch: [None if t is None else redact(t, find(t)) for t in batch])
    out = texts.withColumn("text", F.col(masked)).drop(masked)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out
