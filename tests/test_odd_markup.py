"""Pages that leave out end tags, put tables into cells, or show a decision in an unusual way."""

from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from docketry.functions import markup, structure
from docketry.operators import blocks
from docketry.plans import layouts as at
from docketry.plans import records
from docketry.sources.captures import as_captures


def captures(spark, kind, *bodies):
    rows = spark.createDataFrame(list(enumerate(bodies)), "seq long, body string")
    return as_captures(rows, kind=kind, body=F.col("body"), seq=F.col("seq"), meta=F.create_map(F.lit("numero_processo"), F.lit("1")))


def decision(number, rows):
    return f'<table><tr><td><a title="{at.FULL_TEXT_TITLE}" href="#">{number}</a></td></tr>{rows}</table>'


def test_decisions_without_a_div_and_with_a_table_in_the_summary(spark):
    plain = decision("1", "<tr><td>resumo em texto</td></tr>")
    usual = decision("2", "<tr><td><div>ementa <table><tr><td>nota</td></tr></table> fim</div></td></tr>")
    unclosed = decision("3", "<tr><td>x<tr><td><div>ementa <table><tr><td>nota</table> fim</div>")
    page = f'<td id="{at.RESULTS_ID}"><table>' + "".join(f"<tr><td>{x}</td></tr>" for x in (plain, usual, unclosed)) + "</table></td>"
    found = records.first_degree_decisions(captures(spark, at.FIRST_SEARCH, page)).collect()
    assert {r.numero_processo: r.ementa for r in found} == {"1": None, "2": "ementanotafim", "3": "ementanotafim"}


def test_links_around_a_table(spark):
    link = at.DOCUMENT_LINKS
    one, two = (f'<a class="{link["link_class"]}" {link["document_attr"]}="{n}">t{n}</a>' for n in (1, 2))
    page = f'<table><tr><td class="{link["cell_class"]}">{one}<table><tr><td>x</td></tr></table>{two}<span>d</span></td><td>{one}</td></tr></table>'
    found = records.document_links(captures(spark, at.SECOND_CASE, page)).orderBy("seq").collect()
    assert [(r.documento, r.descricao) for r in found] == [("1", "d"), ("2", "d")]


@pytest.mark.parametrize("end", ["</tr>", ""])
def test_movement_rows_without_end_tags(spark, end):
    date, text = at.MOVEMENTS["date_class"], at.MOVEMENTS["text_class"]
    rows = f'<tr><td>no cells of a movement{end}' + "".join(f'<tr><td class="{date}">{n}<td class="{text}">t{n}{end}' for n in (1, 2))
    page = f'<table><tbody id="{at.MOVEMENTS["table_id"]}">{rows}</tbody></table>'
    pages = captures(spark, at.FIRST_CASE, page)
    found = blocks.movements(pages, F.lit("1"), at.MOVEMENTS).orderBy("seq").filter("data <> ''").collect()
    assert [(r.data, r.titulo) for r in found] == [("1", "t1"), ("2", "t2")]


def test_void_elements_and_names_that_only_start_alike(evaluate):
    pages = ['<input id="a"><p>after</p>', '<td id="a"><td-x>in</td-x></td><td>out</td>', '<div id="a">x<divider>y</divider></div>z']
    assert evaluate(lambda x: structure.element(x, "a"), pages) == ["", "<td-x>in</td-x>", "x<divider>y</divider>"]


def test_rows_get_the_end_tags_they_lack(evaluate):
    pages = ["<tr><td>1<tr><td>2", "<tr>a</tr><tr>b</tr>", "<tr><td><table><tr>x</table></td></tr>", "", "no rows"]
    want = ["<tr><td>1</tr><tr><td>2</tr>", "<tr>a</tr><tr>b</tr>", "<tr><td><table><tr>x</tr></table></td></tr>", "", "no rows"]
    assert evaluate(structure.closed_rows, pages) == want


def test_time_of_an_element_grows_with_the_page(spark):
    """A page of twice the pieces may take twice the time, not four times."""

    def seconds(n):
        page = '<div id="a">' + "<div>x &amp; y</div>" * n + "</div>"
        df = spark.range(8).select(F.concat(F.lit(page), F.col("id").cast("string")).alias("body"))
        query = df.select(F.sum(F.length(markup.inner_text(structure.element(F.col("body"), "a")))))
        query.collect()
        best = []
        for _ in range(3):
            start = time.perf_counter()
            query.collect()
            best.append(time.perf_counter() - start)
        return min(best)

    assert seconds(8000) < 10 * seconds(2000)
