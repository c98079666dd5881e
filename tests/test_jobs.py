"""Whole table updates from captures."""

from __future__ import annotations

from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from docketry.operators import writes
from docketry.operators.documents import utf8_pages
from docketry.operators.writes import DOCUMENT_KEY
from docketry.plans import jobs, records
from docketry.plans import layouts as at
from docketry.sources import captures, tables
from docketry.sources.tables import string_schema
from tests import portal

BASE = "https://portal.example.org/app"


@pytest.mark.parametrize(("name", "after_two"), [("second_degree_cases", 2), ("first_instance_links", 2), ("first_degree_cases", 4)])
def test_updates_follow_the_table_s_mode(spark, tmp_path, name, after_two):
    kind = at.FIRST_CASE if name == "first_degree_cases" else at.SECOND_CASE
    page = portal.FIRST_CASE if kind == at.FIRST_CASE else portal.SECOND_CASE
    captures = portal.captures(
        spark, portal.capture(1, kind, page, "c1"), portal.capture(2, kind, page.replace("2000-1", "2000-2"), "c2")
    )
    v0, v1, v2 = (str(tmp_path / f"v{i}") for i in range(3))
    assert jobs.update(captures, name, v0, v1, BASE).count() == 2
    assert jobs.update(captures, name, v1, v2, BASE).count() == after_two
    assert jobs.stored(spark, name, v1).count() == 2


def test_second_degree_decisions_are_stored_once(spark, tmp_path):
    block = portal.block("9", [("Classe:", "A")], "e")
    captures = portal.captures(spark, portal.capture(1, at.SECOND_SEARCH, portal.results(block, block)))
    v = str(tmp_path / "v")
    assert jobs.update(captures, "second_degree_decisions", v + "0", v + "1").count() == 1


def test_case_requests_resume_and_skip_what_is_stored(spark):
    decisions = spark.createDataFrame(list(enumerate("abcad", 1)), "seq long, numero_processo string")
    cases = spark.createDataFrame([(1, "d"), (2, "b")], "seq long, numero_processo string")
    left = jobs.next_case_requests(decisions, cases, BASE).orderBy("seq").collect()
    assert [r["meta"]["numero_processo"] for r in left] == ["c", "a"]


def test_documents_are_asked_for_until_their_text_is_stored(spark, tmp_path):
    links = records.document_links(portal.captures(spark, portal.capture(1, at.SECOND_CASE, portal.SECOND_CASE, "c")))
    schema = string_schema(at.DOCUMENT_COLUMNS)
    rows = [(1, "x", "c", "007", "t", "d", "p", "text"), (2, "y", "c", "7", "t", "d", "p", None)]
    new = spark.createDataFrame(rows, schema)
    documents = jobs.update_documents(new, str(tmp_path / "v0"), str(tmp_path / "v1"))
    assert documents.select(*DOCUMENT_KEY).distinct().count() == 2
    left = jobs.next_document_requests(links, documents, BASE).collect()
    assert [r["meta"]["documento"] for r in left] == ["7"]


def contents(root):
    return {p: p.read_bytes() for p in root.rglob("*.parquet")}


@pytest.mark.parametrize("name", ["first_degree_cases", "second_degree_decisions", "second_degree_cases"])
def test_updates_write_new_rows_alone(spark, tmp_path, name):
    table = jobs.TABLES[name]
    key_at = table.columns.index("numero_processo")

    def captured(*rows):
        values = [(seq, *[key if i == key_at else word for i in range(len(table.columns))]) for seq, key, word in rows]
        return spark.createDataFrame(values, string_schema(table.columns))

    parts = [
        captured(*[(n, f"k{n}", "a") for n in range(50)], (90, None, "n")),
        captured((101, "k1", "b"), (102, "new", "c"), (103, "new", "d"), (104, "", "m")),
        captured((201, "k1", "e"), (202, "new", "f")),
    ]
    wanted = spark.createDataFrame([], parts[0].schema)
    for n, part in enumerate(parts):
        before = contents(tmp_path)
        got = jobs._add(part, name, str(tmp_path / f"v{n}"), str(tmp_path / f"v{n + 1}"))
        wanted = tables.stage(table.mode(wanted, part))
        assert sorted(got.collect(), key=str) == sorted(wanted.collect(), key=str)
        assert {p: c for p, c in contents(tmp_path).items() if p in before} == before
        rows = next(p for p in tmp_path.iterdir() if p.name.startswith(f"v{n + 1}.rows"))
        assert spark.read.parquet(str(rows)).count() <= part.count()
    whole = jobs.compact(spark, name, str(tmp_path / "v3"), str(tmp_path / "v4"))
    assert sorted(whole.collect(), key=str) == sorted(wanted.collect(), key=str)
    assert len(tables.table_folders(spark, str(tmp_path / "v4"))) == 1
    after = jobs._add(parts[1], name, str(tmp_path / "v4"), str(tmp_path / "v5"))
    assert sorted(after.collect(), key=str) == sorted(table.mode(wanted, parts[1]).collect(), key=str)


def test_a_version_without_its_list_is_not_seen(spark, tmp_path):
    rows = spark.createDataFrame([(1, "k", "a")], "seq long, numero_processo string, a string")
    schema = string_schema(["numero_processo", "a"])
    v1 = str(tmp_path / "v1")
    folders = tables.write_folder(rows, 1, v1)
    assert tables.table_folders(spark, v1) == {}
    tables.publish(spark, folders, v1)
    assert tables.read_folders(spark, tables.table_folders(spark, v1), schema).collect() == [(1, "k", "a", 1)]
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        tables.publish(spark, folders, v1)


def test_a_plain_table_is_a_first_version(spark, tmp_path):
    name, plain = "first_instance_links", str(tmp_path / "plain")
    columns = jobs.TABLES[name].columns
    old = spark.createDataFrame([(1, *["k"] * len(columns)), (2, *["j"] * len(columns))], string_schema(columns))
    old.write.parquet(plain)
    new = spark.createDataFrame([(3, "k", *["z"] * (len(columns) - 1))], string_schema(columns))
    if columns[0] != "numero_processo":
        new = new.withColumn("numero_processo", F.lit("k"))
    got = jobs._add(new, name, plain, str(tmp_path / "v1"))
    assert sorted(got.collect(), key=str) == sorted(writes.upsert(old, new).collect(), key=str)


def test_document_records_from_captured_files(spark, tmp_path):
    """The context comes over three requests; failing, empty and unknown files keep their record."""
    meta = {"numero_processo": "c", "documento": "1", "titulo": "t", "descricao": "d", "processo": "p"}
    made = [("a", None, meta), ("v", "a", None), ("f", "v", {}), ("g", "f", {"titulo": "own"}), ("h", "g", None), ("i", "unseen", None)]
    files = [(1, "f", b"one\fpage"), (2, "g", b"x"), (3, "h", b"\xff"), (4, "i", b""), (5, None, None), (6, "f", b"one\fpage"), (7, "unseen", b"y")]
    files = spark.createDataFrame([(n, r, c if c is None else bytearray(c)) for n, r, c in files], captures.FILE_SCHEMA)
    rows, failed = jobs.document_records(files, spark.createDataFrame(made, captures.REQUEST_SCHEMA), utf8_pages)
    got = {r.seq: r for r in rows.collect()}
    assert [got[n].titulo for n in range(1, 8)] == ["t", "own", "own", None, None, "t", None]
    assert [got[n].conteudo for n in range(1, 8)] == ["onepage", "x", None, None, None, "onepage", "y"]
    assert got[1].numero_processo == "c" and got[1].pdf_name == got[6].pdf_name == sha256(b"one\fpage").hexdigest() and got[5].pdf_name is None
    reasons = {(r.seq, r.reason.split(":")[0]) for r in failed.collect()}
    assert reasons == {(3, "UnicodeDecodeError"), (4, "no request"), (5, "no request"), (5, "no bytes"), (7, "no request")}
    assert jobs.update_documents(rows, str(tmp_path / "v0"), str(tmp_path / "v1")).filter("documento = '1'").count() == 1
    nothing = spark.createDataFrame([], captures.FILE_SCHEMA)
    assert [x.count() for x in jobs.document_records(nothing, spark.createDataFrame([], captures.REQUEST_SCHEMA), utf8_pages)] == [0, 0]
