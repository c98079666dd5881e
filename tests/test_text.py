"""Text functions against plain Python on awkward strings."""

from __future__ import annotations

import html
import random
import re
import urllib.parse

import pytest

from docketry.functions import maps, predicates, text
from docketry.functions.links import has_suffix, host_allowed, quote_text, rebuild_link

ALPHABET = "ab/çé(); ,'\"&=\t\n\r\x0b\x1c\x85  　😀*~+%"


@pytest.fixture(scope="module")
def samples():
    rng = random.Random(7)
    made = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 40))) for _ in range(400)]
    return [*made, "", " ", "  ", "()", "a ( b ) c (d", "a(b)\n(c\nd)"]


def python_clean(x):
    x = " ".join(x.split())
    return " ".join(re.sub(r"[;,'\"\r]", "", x).split())


CASES = {
    "normalise_space": (text.normalise_space, lambda x: " ".join(x.split())),
    "strip_space": (text.strip_space, str.strip),
    "drop_parens": (text.drop_parens, lambda x: re.sub(r"\s*\(.*?\)\s*", "", x)),
    "paren_text": (text.paren_text, lambda x: (re.search(r"\((.*?)\)", x) or [None, ""])[1]),
    "before_paren": (
        text.before_paren,
        lambda x: (x.split("(")[0] if re.search(r"\((.*?)\)", x) else x).strip(),
    ),
    "delete_chars": (text.delete_chars, lambda x: re.sub(r"[\n\t ]", "", x)),
    "clean_document": (text.clean_document, python_clean),
    "quote_text": (quote_text, urllib.parse.quote),
    "later_slash_parts": (
        text.later_slash_parts,
        lambda x: "|".join(x.split("/")[1:]).strip() if "/" in x else x,
    ),
}


@pytest.mark.parametrize("name", CASES)
def test_equals_python(evaluate, samples, name):
    function, wanted = CASES[name]
    assert evaluate(function, samples) == [wanted(s) for s in samples]


def test_strip_of_a_long_run_of_spaces(evaluate):
    x = "a" + " " * 200_000 + "b"
    assert evaluate(text.strip_space, [x]) == [x]
    assert evaluate(text.drop_parens, [x + "(c)"]) == [x]


def test_entities(evaluate):
    texts = ["a&amp;b", "&amp;eacute;", "&eacute;&#233;&#xE9;", "&#x1F600;", "R&D &; &foo; &#0; &#55296;", "&lt;b&gt;&ordf;", "x"]
    known = [html.unescape(t) for t in texts]
    known[4] = texts[4]
    assert evaluate(text.decode_entities, texts) == known


def test_lawyer_label(evaluate):
    texts = ["Advogado: Ana", "Advogada: Rui ", "Advogado", "Dr. Advogado: X"]
    assert evaluate(text.strip_lawyer_label, texts) == ["Ana", "Rui", "Advogado", "Dr. Advogado: X"]


def test_page_number(evaluate):
    assert evaluate(text.next_page_number, [" 7\n", "", "x", None]) == [8, None, None, None]


def test_query_params(evaluate):
    links = ["/a?x=1&y&x=2&z=a=b", "/a", "/a?x=1?y=2", ""]
    assert evaluate(maps.query_params, links) == [{"x": "2", "z": "a=b"}, {}, {"x": "1"}, {}]


def test_rebuild_link(evaluate):
    names = ["nuProcesso", "cdProcessoSg", "cdForoSg", "isProcessoOrigemCr"]
    full = "/x?" + "&".join(f"{n}={i}" for i, n in enumerate(names, 1))
    got = evaluate(lambda c: rebuild_link("https://e.org/a", c), [full, full.replace("=4", "="), "/x", full[:-5]])
    assert got[0] == "https://e.org/a/abrirConsultaProcessoSG.do?" + full[3:]
    assert got[1:] == ["", "", ""]


def test_hosts_and_suffixes(evaluate):
    urls = ["https://a.example.org/x.pdf", "https://example.org", "https://badexample.org/", "not a url", None]
    assert evaluate(lambda c: host_allowed(c, ["example.org"]), urls) == [True, True, False, None, None]
    assert evaluate(has_suffix, urls) == [True, False, False, False, None]


def test_phrases(evaluate):
    phrases = predicates.phrases_of('"LGPD" OU "Proteção de Dados"')
    assert phrases == ["LGPD", "Proteção de Dados"]
    texts = ["a lgpd b", "PROTECAO DE DADOS", "proteção  de dados", "nada"]
    assert evaluate(lambda c: predicates.any_phrase(c, phrases), texts) == [True, True, False, False]


def test_dates(evaluate):
    assert evaluate(lambda c: predicates.until_date(c, "2024-02-09"), ["09/02/2024", "10/02/2024", "x"]) == [True, False, None]


def test_every_named_entity_and_windows_codes(evaluate):
    names = ["Scaron", "trade", "le", "Alpha", "hearts", "nbsp", "amp", "apos", "euro"]
    got = evaluate(text.decode_entities, [f"a&{n};b" for n in names] + ["&#150;&#128;&#x93;", "&nope; &#0;"])
    assert got == [html.unescape(f"a&{n};b") for n in names] + [html.unescape("&#150;&#128;&#x93;"), "&nope; &#0;"]


def test_folding_in_every_script(evaluate):
    assert evaluate(predicates.folded, ["Ação", "ΆΈΉ", "Ёлка Й", "e\u0301", "Ǻ"]) == ["acao", "αεη", "елка и", "e", "a"]


def test_unquoted_words_are_searched_too():
    assert predicates.phrases_of('"LGPD" OU 13.709') == ["LGPD", "13.709"]
    assert predicates.phrases_of('"a b" E "c"') == ["a b", "c"] and predicates.phrases_of("x OU y") == ["x OU y"]


def test_many_parameters_end_soon(evaluate):
    query = "?" + "&".join(f"k{i % 5000}={i}" for i in range(15_000))
    got = evaluate(maps.query_params, [query])[0]
    assert len(got) == 5000 and got["k0"] == "10000"
