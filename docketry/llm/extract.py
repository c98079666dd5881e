"""Main text of pages by a linear-chain conditional random field over DOM leaf blocks.

Each leaf block is content or not. Its features are the tags and class names of its
ancestors, its place, its share of link text, its length, its punctuation and some telling
phrases; the field also weighs each step from block to block. It is trained by maximum
conditional likelihood on labelled pages, written here in many layouts, and decoded by
Viterbi.

The text is the content blocks, one per line. White space (line breaks too) inside a block
is one space. Null and empty pages, and pages without content, give the empty text. Repeated
pages give repeated rows.
"""

from __future__ import annotations

import random
import re
from functools import cache

import numpy as np
from pyspark.sql import DataFrame

from docketry.llm.blocks import Block, blocks_of
from docketry.llm.common import filled, map_rows

TRAINING_PAGES = 400
RIDGE = 0.02
STEPS = 150
END_SIGNS = ".!?…:;\"'”»)"
PHRASES = re.compile(
    r"©|copyright|all rights reserved|cookie|subscribe|newsletter|log ?in|sign ?(?:in|up)|advertis|sponsored|read more|"
    r"share (?:this|on)|privacy|terms of|related|leave a (?:comment|reply)|skip to|replied|says:",
    re.IGNORECASE,
)
SECTIONS = ("article", "main", "nav", "footer", "aside", "header", "form", "section")


def features(blocks: list[Block]) -> list[list[str]]:
    out = []
    for place, b in enumerate(blocks):
        n = len(b.text.split())
        link = b.link_chars / len(b.text)
        inner = next((t for t in reversed(b.tags) if t in SECTIONS), "none")
        found = [
            "own=" + (b.tags[-1] if b.tags else "none"),
            "inner=" + inner,
            "link=" + ("none" if link == 0 else "some" if link < 0.5 else "most"),
            "words=" + ("few" if n < 3 else "some" if n < 10 else "many" if n < 40 else "lots"),
            "ends" if b.text[-1] in END_SIGNS else "open",
            *{"in=" + t for t in b.tags},
            *{"name=" + t for names in b.names for t in names},
            *{"says=" + m.lower() for m in PHRASES.findall(b.text)},
        ]
        found += ["first"] * (place == 0) + ["last"] * (place == len(blocks) - 1)
        out.append(found)
    return out


# --- labelled pages -----------------------------------------------------------------

WORDS = "river stone winter market garden signal quiet letter engine harbour window meadow copper lantern orchard tunnel".split()
# Names that pages give to what isn't their main text, and to what is.
CHROME = {
    "menu": "menu nav navbar navigation breadcrumb breadcrumbs topbar toolbar tabs pagination pager skip",
    "ad": "ad ads advert advertisement adbox adsense banner sponsor sponsored promo promotion outbrain taboola",
    "side": "sidebar side widget related recommended trending popular recent archive tags share social author bio rail",
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay message disclaimer paywall",
    "form": "form search subscribe newsletter signup login contact poll",
    "comments": "comments comment respond reply discussion disqus thread replies feedback",
    "foot": "footer foot bottom copyright legal credits colophon",
    "head": "header masthead logo brand top site",
}
CONTENT = "content post entry story article body text main page blog news single hentry copy prose"


def _prose(rng: random.Random, low: int, high: int) -> str:
    words = [rng.choice(WORDS) for _ in range(rng.randint(low, high))]
    return " ".join(words).capitalize() + rng.choice([".", ".", ".", "!", "?", ""])


def _link(rng: random.Random) -> str:
    return f'<a href="/{rng.choice(WORDS)}">{_prose(rng, 1, 3)[:-1]}</a>'


def _name(rng: random.Random, kind: str) -> str:
    own = rng.choice(kind.split())
    attribute = rng.choice(["class", "class", "id"])
    return f' {attribute}="{own}{rng.choice(["", "", "-box", "_wrap", " block", "-inner"])}"'


def _chrome(rng: random.Random) -> str:
    kind = rng.choice(list(CHROME))
    name = _name(rng, CHROME[kind]) if rng.random() < 0.9 else ""
    items = "".join(f"<li>{_link(rng)}</li>" for _ in range(rng.randint(2, 6)))
    prose = "".join(f"<p>{_prose(rng, 4, 30)}</p>" for _ in range(rng.randint(1, 3)))
    said = rng.choice(["We use cookies.", "Subscribe to our newsletter", "Log in", "All rights reserved", "Advertisement", "Read more"])
    if kind == "menu":
        return rng.choice([f"<nav{name}><ul>{items}</ul></nav>", f"<nav>{_link(rng)} | {_link(rng)}</nav>"] + [f"<div{name}><ul>{items}</ul></div>"] * bool(name))
    if kind == "foot":
        return f"<footer>{rng.choice([prose, said, '&copy; ' + _prose(rng, 2, 12), items])}</footer>" if rng.random() < 0.7 or not name else f"<div{name}>{said} {_prose(rng, 1, 8)}</div>"
    if kind == "head":
        return f"<header{name}>{rng.choice([_prose(rng, 1, 4), '<h1>' + _prose(rng, 1, 3) + '</h1>', '<ul>' + items + '</ul>', '<p>' + _prose(rng, 3, 9) + '</p>'])}</header>"
    if kind == "form":
        return f"<form{name}><p>{rng.choice([said, _prose(rng, 2, 14)])}</p><label>{_prose(rng, 1, 2)}</label><input name=x><button>Go</button></form>"
    if kind == "side":
        return rng.choice([f"<aside{name}>{rng.choice([prose, items, _prose(rng, 3, 20)])}</aside>"] + [f"<div{name}>{rng.choice([prose, '<ul>' + items + '</ul>', '<h3>' + _prose(rng, 1, 3) + '</h3>' + prose])}</div>"] * bool(name))
    if not name:
        return f"<aside>{prose}</aside>"
    tag = rng.choice(["div", "section", "div", "p" if kind in ("ad", "notice") else "div"])
    inner = _prose(rng, 4, 25) if tag == "p" or rng.random() < 0.5 else prose
    if kind == "comments":
        inner = rng.choice([prose, f"<ul><li><p>{_prose(rng, 4, 40)}</p></li></ul>", f"<h3>Comments</h3>{prose}", f"<article>{prose}</article>"])
    return f"<{tag}{name}>{inner if rng.random() < 0.8 else said}</{tag}>"


def _content(rng: random.Random) -> str:
    """One piece of main text; its blocks are marked by the sign that labelled_page takes out."""
    mark = "\x02"
    pick = rng.random()
    if pick < 0.6:
        return f"<p>{mark}{_prose(rng, 1, 60)}</p>" if rng.random() < 0.7 else f"<p>{mark}<b>{_prose(rng, 2, 20)}</b> {_link(rng)} {_prose(rng, 0, 20)}<br>"
    if pick < 0.72:
        return f"<h2>{mark}{_prose(rng, 1, 6)}</h2>"
    if pick < 0.8:
        return "<ul>" + "".join(f"<li>{mark}{_prose(rng, 1, 15)}</li>" for _ in range(3)) + "</ul>"
    if pick < 0.86:
        return f"<blockquote><p>{mark}{_prose(rng, 4, 30)}</p></blockquote>"
    if pick < 0.92:
        return f"<div>{mark}{_prose(rng, 3, 40)}</div>"
    return f"<table><tr><td>{mark}{_prose(rng, 1, 4)}<td>{mark}{_prose(rng, 1, 6)}</table>"


def labelled_page(rng: random.Random) -> str:
    """A page; blocks of its main text begin with a sign that no other text has."""
    inside = [f"<h1>\x02{_prose(rng, 1, 9)}</h1>"] * (rng.random() < 0.8)
    for _ in range(rng.randint(1, 9)):
        inside.append(_content(rng) if rng.random() < 0.88 else _chrome(rng))
    name = _name(rng, CONTENT)
    around = [("<article>", "</article>"), ("<main>", "</main>"), (f"<article{name}>", "</article>"), (f"<div{name}>", "</div>"), (f"<div{name}><article>", "</article></div>"), ("<main><section>", "</section></main>"), (f"<section{name}>", "</section>")]
    start, end = rng.choice(around + around[:1] * 3)
    before = "".join(_chrome(rng) for _ in range(rng.randint(0, 4)))
    after = "".join(_chrome(rng) for _ in range(rng.randint(0, 4)))
    wrap = rng.choice([("", ""), ("<div id=wrapper>", "</div>"), ('<div class="container">', "</div>")])
    return f"<html><head><title>x</title></head><body>{wrap[0]}{before}{start}{''.join(inside)}{end}{after}{wrap[1]}</body></html>"


def labelled(page: str) -> tuple[list[Block], list[int]]:
    blocks = blocks_of(page)
    labels = [int("\x02" in b.text) for b in blocks]
    for b in blocks:
        b.text = b.text.replace("\x02", "").strip() or "x"
    return blocks, labels


# --- the field ----------------------------------------------------------------------


def train(pages: list[tuple[list[list[str]], list[int]]]) -> tuple[dict[str, float], list[list[float]], float]:
    """Weights by feature (towards content), step weights [from][to] and the start's weight, by gradient ascent."""
    names = sorted({f for rows, _ in pages for row in rows for f in row})
    place = {f: i for i, f in enumerate(names)}
    n, length = len(pages), max(len(rows) for rows, _ in pages)
    x = np.zeros((n, length, len(names)), bool)
    y, real = np.zeros((n, length), np.int64), np.zeros((n, length), bool)
    for p, (rows, labels) in enumerate(pages):
        for t, row in enumerate(rows):
            x[p, t, [place[f] for f in row]] = True
        y[p, : len(labels)], real[p, : len(labels)] = labels, True
    flat = x[real].astype(np.float64)
    gold_steps = np.zeros((2, 2))
    both = real[:, 1:]
    np.add.at(gold_steps, (y[:, :-1][both], y[:, 1:][both]), 1)
    # One vector of parameters: features, four steps, start; Adam keeps a mean and a spread of its gradient.
    theta, mean, spread = (np.zeros(len(names) + 5) for _ in range(3))
    for step in range(1, STEPS + 1):
        weights, steps, first = theta[:-5], theta[-5:-1].reshape(2, 2), theta[-1]
        emit = np.zeros((n, length, 2))
        emit[real, 1] = flat @ weights
        emit[:, 0, 1] += first
        one, two = _posteriors(emit, steps, real)
        gradient = np.concatenate([flat.T @ (y[real] - one[real]), (gold_steps - two).ravel(), [(y[:, 0] - one[:, 0]).sum()]])
        gradient = gradient / n - RIDGE * theta / 10
        mean, spread = 0.9 * mean + 0.1 * gradient, 0.99 * spread + 0.01 * gradient**2
        theta = theta + 0.1 * (mean / (1 - 0.9**step)) / (np.sqrt(spread / (1 - 0.99**step)) + 1e-6)
    return dict(zip(names, theta[:-5].tolist())), theta[-5:-1].reshape(2, 2).tolist(), float(theta[-1])


def _posteriors(emit: np.ndarray, steps: np.ndarray, real: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chance of content by block, and expected number of steps, by forward and backward sums over all pages at once."""
    n, length, _ = emit.shape
    forward, backward = np.zeros_like(emit), np.zeros_like(emit)
    forward[:, 0] = emit[:, 0]
    for t in range(1, length):
        new = np.logaddexp(forward[:, t - 1, :1] + steps[0], forward[:, t - 1, 1:] + steps[1]) + emit[:, t]
        forward[:, t] = np.where(real[:, t, None], new, forward[:, t - 1])
    for t in range(length - 2, -1, -1):
        after = emit[:, t + 1] + backward[:, t + 1]
        new = np.logaddexp(after[:, :1] + steps[:, 0], after[:, 1:] + steps[:, 1])
        backward[:, t] = np.where(real[:, t + 1, None], new, 0)
    total = np.logaddexp(forward[:, -1, 0], forward[:, -1, 1])
    one = np.exp(forward[:, :, 1] + backward[:, :, 1] - total[:, None])
    pair = forward[:, :-1, :, None] + steps + (emit + backward)[:, 1:, None, :] - total[:, None, None, None]
    return one, np.exp(pair[real[:, 1:]]).sum(0)


@cache
def field() -> tuple[dict[str, float], list[list[float]], float]:
    rng = random.Random(7)
    pages = []
    for _ in range(TRAINING_PAGES):
        blocks, labels = labelled(labelled_page(rng))
        pages.append((features(blocks), labels))
    return train(pages)


def decode(rows: list[list[str]], model: tuple[dict[str, float], list[list[float]], float]) -> list[int]:
    """The most likely labels, by Viterbi."""
    if not rows:
        return []
    weights, steps, first = model
    emits = [sum(weights.get(f, 0.0) for f in row) for row in rows]
    out, inside, back = 0.0, emits[0] + first, []
    for e in emits[1:]:
        to_out = (out + steps[0][0], inside + steps[1][0])
        to_in = (out + steps[0][1], inside + steps[1][1])
        back.append((to_out[1] > to_out[0], to_in[1] > to_in[0]))
        out, inside = max(to_out), max(to_in) + e
    labels = [int(inside > out)]
    for step in reversed(back):
        labels.append(int(step[labels[-1]]))
    return labels[::-1]


def main_text(page: str | None, model=None) -> str:
    blocks = blocks_of(page or "")
    labels = decode(features(blocks), model or field())
    return "\n".join(b.text for b, label in zip(blocks, labels) if label)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page; a narrow pass."""
    model = field()

    def run(rows: dict) -> dict:
        texts = [main_text(page, model) for page in rows["html"]]
        return {"page_id": rows["page_id"], "url": rows["url"], "text": texts, "n_chars": [len(t) for t in texts]}

    plain = pages.select("page_id", "url", filled("html").alias("html"))
    return map_rows(plain, run, "page_id long, url string, text string, n_chars long")
