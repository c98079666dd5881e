"""Pages are written once and after the rows are dealt; nesting by plain search equals nesting by depth."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from docketry.functions import structure
from docketry.queries import records
from docketry.queries.common import spelt, text_of


@pytest.mark.parametrize("name", ["cases_first", "cases_second", "first_instance"])
def test_no_page_is_written_below_the_repartition(spark, tmp_path, name):
    rows = spark.range(3).select(
        F.col("id").alias("o_orderkey"), F.col("id").alias("o_custkey"), F.lit("F").alias("o_orderstatus"),
        F.lit("1-URGENT").alias("o_orderpriority"), F.current_date().alias("o_orderdate"),
    )
    rows.write.parquet(f"{tmp_path}/orders.parquet")
    plan = records.QUERIES[name][0](spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Repartition") :]
    assert "<html" not in below and "modal__lista-processos" not in below


def test_row_cut_by_plain_search_or_by_depth(spark):
    pages = {
        "flat": "x<tr>a</tr>\n<tr class=\"c\">b<td>1</td></tr>y",
        "nested": "<tr>a<table><tr>in</tr></table></tr><tr>b</tr>",
        "open": "<tr>a<tr>b</tr>",
        "stray": "</tr><tr>a</tr>",
        "other name": "<track><tr>a</tr></track>",
        "none": "text",
    }
    df = spark.createDataFrame(list(pages.items()), "name string, page string")
    found = dict(df.select("name", structure.deep_elements(F.col("page"), "tr", 1)).collect())
    assert found == {
        "flat": ["a", "b<td>1</td>"],
        "nested": ["a<table><tr>in</tr></table>", "in", "b"],
        "open": ["a<tr>b</tr>", "b"],
        "stray": ["a"],
        "other name": ["a"],
        "none": [],
    }


def test_inside_ends_at_the_own_end_tag(spark):
    rests = ["a<b>c</b></td>z", "a<td>b</td>c</td>z", "a</td-x>b</td>z", "a", "</td>", None]
    df = spark.createDataFrame([(r,) for r in rests], "rest string")
    found = [r[0] for r in df.select(structure.inside(F.col("rest"), "td")).collect()]
    assert found == ["a<b>c</b>", "a<td>b</td>c", "a</td-x>b", "a", "", None]


def test_odd_tags_are_respelt_between_plain_ones(spark):
    pages = {
        "<P>a<TD CLASS = x y='1\"'>b</TD ><br/>": '<p>a<td class="x" y="1&quot;">b</td><br/>',
        "<i class='a b' id=\"c\"/>&": '<i class="a b" id="c"/>&',
        "<A title=\"x<Y>\">z": '<A title="x<y>">z',
        "1 < 2 <- <P": "1 < 2 <- <P",
    }
    df = spark.createDataFrame([(p,) for p in pages], "page string")
    assert [r[0] for r in df.select(structure.plain_tags(F.col("page"))).collect()] == [*pages.values()]


def test_values_with_markup_are_spelt_as_the_page_is(spark):
    df = spark.createDataFrame([(k, v) for k in range(4) for v in ('a', '<td id="x">')], "key long, value string")

    def page():
        return text_of('<table id="t"><tr class="c"><td title="1">', F.col("value"), "</td></tr></table>")

    found = {(r[0], r[1]): r[2] for r in df.select("key", "value", spelt(page, F.col("key"), [F.col("value")])).collect()}
    assert found[0, "a"] == '<table id="t"><tr class="c"><td title="1">a</td></tr></table>'
    assert found[1, "a"] == '<TABLE DATA-X="1" id = "t"><TR DATA-X="1" class = "c"><TD DATA-X="1" title = "1">a</TD></TR></TABLE>'
    assert found[2, '<td id="x">'].endswith('<td data-id="tdResultados" id="x"></td></tr></table>')
    assert found[3, '<td id="x">'] == "<table id='t'><tr class='c'><td title='1'><td id='x'></td></tr></table>"
