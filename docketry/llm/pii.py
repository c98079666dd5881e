"""Personal data: patterns propose spans, checksums confirm them, context words adjust the score.

Kinds email, ip, card and phone are found as the base patterns say (leftmost, not
overlapping, dropped without another try where their test fails). Beside them:
``iban`` (mod-97, at its country's length) and ``phone_local``, a number without ``+`` that only its context makes
a phone number. A span's score starts at the kind's own, and words nearby raise it;
a span beyond the base is kept at ``MIN_SCORE`` or more.

Null text counts as empty, and an empty text has no spans. Work per text is linear in
its length, however long one run of digits or letters is.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from hashlib import sha256
from itertools import accumulate

from pyspark.sql import DataFrame

from docketry.llm.common import filled, map_rows

BASE_KINDS = ("email", "ip", "card", "phone")
CONTEXT_CHARS = 48
MIN_SCORE = 0.6

# Start score of a kind, and what a word nearby adds.
START_SCORE = {"email": 0.8, "ip": 0.5, "card": 0.7, "phone": 0.6, "iban": 0.9, "phone_local": 0.3}
CONTEXT_BONUS = 0.3
CONTEXT_WORDS = {
    "email": ("mail", "contact", "correo", "courriel"),
    "ip": ("ip", "address", "host", "server", "adresse"),
    "card": ("card", "visa", "credit", "karte", "carte", "tarjeta"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "telefon"),
    "iban": ("iban", "account", "konto", "compte", "cuenta"),
    "phone_local": ("phone", "tel", "call", "mobile", "fax", "telefon"),
}

LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match can't begin inside a run of digits: the run's start would have matched before.
IP = re.compile(r"(?<![0-9])([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
# Runs of fewer than 16 digits fail as a whole, and so does every run inside them.
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9]){15,}")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# A candidate begins at a word; its end is found by iban_end.
IBAN = re.compile(r"(?<![A-Za-z0-9])(?=[A-Z]{2}[0-9]{2}((?:\x20?[A-Z0-9]){11,30}))")
# The length of an IBAN by country.
IBAN_LENGTHS = {
    country: int(length)
    for length, countries in (x.split(":") for x in (
        "15:NO 16:BE 18:DK,FI,FK,FO,GL,NL,SD 19:MK,SI 20:AT,BA,EE,KZ,LT,LU,MN,XK 21:CH,HR,LI,LV 22:BG,BH,CR,DE,GB,GE,IE,ME,RS,VA "
        "23:AE,GI,IL,IQ,OM,SO,TL 24:AD,CZ,ES,MD,PK,RO,SA,SE,SK,TN,VG 25:LY,PT,ST 26:IS,TR 27:BI,DJ,FR,GR,IT,MC,MR,SM "
        "28:AL,AZ,BY,CY,DO,GT,HN,HU,LB,NI,PL,SV 29:BR,EG,PS,QA,UA 30:JO,KW,MU,YE 31:MT,SC 32:LC 33:RU"
    ).split())
    for country in countries.split(",")
}
IBAN_WORD = re.compile(r"[A-Z0-9]+(?![A-Za-z0-9])")
PHONE_LOCAL = re.compile(r"(?<![0-9A-Za-z+().-])\(?[0-9]{2,4}\)?[\x20.-][0-9]{3,4}[\x20.-][0-9]{4}(?![0-9A-Za-z])")
NOT_DIGITS = re.compile(r"[^0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    compact = iban.replace(" ", "")
    number = "".join(str(int(c, 36)) for c in compact[4:] + compact[:4])
    return int(number) % 97 == 1


def iban_end(text: str, start: int, end: int) -> int | None:
    """The end of a word, up to ``end``, to which the candidate is a valid IBAN of its country's length; else the last, if that is unknown."""
    length = IBAN_LENGTHS.get(text[start : start + 2])
    ends = [m.end() for m in IBAN_WORD.finditer(text, start, min(len(text), end + 1)) if m.end() <= end]
    sizes = ((e, len(text[start:e].replace(" ", ""))) for e in reversed(ends))
    return next((e for e, n in sizes if (n == length if length else n >= 15) and mod97(text[start:e])), None)


def small_part(digits: str) -> bool:
    tail = digits.lstrip("0")
    return len(tail) <= 3 and int(tail or "0") <= 255


def emails(text: str) -> list[tuple[int, int]]:
    """By the at signs: each takes the local part before it, back to the last match, and the domain after it."""
    found, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and LOCAL.match(text, start - 1):
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            found.append((start, domain.end()))
        end = domain.end() if domain else at + 1
        at = text.find("@", end)
    return found


def _score(kind: str, text: str, start: int, end: int) -> float:
    near = (text[max(0, start - CONTEXT_CHARS) : start] + " " + text[end : end + CONTEXT_CHARS]).lower()
    bonus = CONTEXT_BONUS if any(word in near for word in CONTEXT_WORDS[kind]) else 0.0
    return round(min(1.0, START_SCORE[kind] + bonus), 2)


def find(text: str) -> list[tuple[str, int, int, float]]:
    """Spans as (kind, start, end, score), by kind as listed and then start."""
    spans = []
    if "@" in text:
        spans += [("email", *x) for x in emails(text)]
    for m in IP.finditer(text):
        if all(map(small_part, m.groups())):
            spans.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        digits = NOT_DIGITS.sub("", m[0])
        if len(digits) <= 19 and luhn(digits):
            spans.append(("card", *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= len(NOT_DIGITS.sub("", m[0])) <= 15:
                spans.append(("phone", *m.span()))
    scored = [(*x, _score(x[0], text, x[1], x[2])) for x in spans]
    ibans, done = [], 0
    for m in IBAN.finditer(text):
        end = iban_end(text, m.start(), m.end(1)) if m.start() >= done else None
        if end:
            ibans.append(("iban", m.start(), end))
            done = end
    local = [("phone_local", *m.span()) for m in PHONE_LOCAL.finditer(text)]
    for more in (ibans, local):
        taken = sorted(x[1:3] for x in scored)
        starts, reach = [s for s, _ in taken], list(accumulate((e for _, e in taken), max))
        for x in more:
            score = _score(x[0], text, x[1], x[2])
            before = bisect_left(starts, x[2])  # spans that start before this one ends
            if score >= MIN_SCORE and not (before and reach[before - 1] > x[1]):
                scored.append((*x, score))
    return scored


def _columns(rows: dict) -> dict:
    out: dict[str, list] = {name: [] for name in COLUMNS}
    for doc_id, text in zip(rows["doc_id"], rows["text"]):
        spans = find(text)
        base = [x for x in spans if x[0] in BASE_KINDS]
        out["doc_id"].append(doc_id)
        for kind in BASE_KINDS:
            out[f"n_{kind}"].append(sum(x[0] == kind for x in base))
        out["base_sha256"].append(sha256(_joined(base).encode()).hexdigest())
        out["spans"].append(_joined(spans))
        out["scores"].append([x[3] for x in spans])
    return out


def _joined(spans: list[tuple]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end, _ in spans)


SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, scores array<double>"
COLUMNS = [x.split()[0] for x in SCHEMA.split(", ")]


def scan(docs: DataFrame) -> DataFrame:
    """Spans of every whole text, with counts and digest of the base spans; a narrow pass."""
    return map_rows(docs.select("doc_id", filled().alias("text")), _columns, SCHEMA)
