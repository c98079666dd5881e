"""Write modes and joins against a row-by-row loop on random small tables."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from docketry.operators import aggregates, joins, writes
from docketry.operators.documents import case_documents
from docketry.plans.layouts import DOCUMENT_COLUMNS
from docketry.session import work_dir
from docketry.sources.tables import string_schema

TARGET = "seq long, numero_processo string, a string, b string"
NEW = "seq long, numero_processo string, a string, c string"
KEYS = ["k1", "k2", "k.1", "k", "kx1", None, ""]


def random_tables(seed):
    rng = random.Random(seed)

    def rows(start, count):
        return [(start + i, rng.choice(KEYS), rng.choice("pqr"), rng.choice(["x", "y", None])) for i in range(count)]

    return rows(0, rng.randint(0, 12)), rows(100, rng.randint(0, 14))


def loop_upsert(target, new):
    """One new row at a time over the whole table."""
    table = [dict(zip(("seq", "key", "a", "b"), r), c=None) for r in target]
    for seq, key, a, c in new:
        same = [r for r in table if key and r["key"] == key]
        for r in same:
            r.update(a=a, c=c)
        if not same:
            table.append(dict(seq=seq, key=key, a=a, b=None, c=c))
    return Counter((r["seq"], r["key"], r["a"], r["b"], r["c"]) for r in table)


def loop_insert(target, new):
    table = [(*r, None) for r in target]
    for seq, key, a, c in new:
        if not key or all(r[1] != key for r in table):
            table.append((seq, key, a, None, c))
    return Counter(table)


def counted(df):
    return Counter(tuple(r) for r in df.select("seq", "numero_processo", "a", "b", "c").collect())


@pytest.mark.parametrize("seed", range(8))
def test_writes_equal_a_loop(spark, seed):
    target_rows, new_rows = random_tables(seed)
    target, new = spark.createDataFrame(target_rows, TARGET), spark.createDataFrame(new_rows, NEW)
    assert counted(writes.upsert(target, new)) == loop_upsert(target_rows, new_rows)
    assert counted(writes.insert_if_absent(target, new)) == loop_insert(target_rows, new_rows)


def test_writes_twice_are_writes_once(spark):
    target_rows, new_rows = random_tables(3)
    new_rows = [r for r in new_rows if r[1]]
    target, new = spark.createDataFrame(target_rows, TARGET), spark.createDataFrame(new_rows, NEW)
    for mode in (writes.upsert, writes.insert_if_absent):
        once = mode(target, new)
        assert counted(mode(once, new)) == counted(once)


def test_two_upserts_equal_one(spark):
    target_rows, new_rows = random_tables(5)
    target, new = spark.createDataFrame(target_rows, TARGET), spark.createDataFrame(new_rows, NEW)
    early, late = new.filter(F.col("seq") < 105), new.filter(F.col("seq") >= 105)
    assert counted(writes.upsert(writes.upsert(target, early), late)) == counted(writes.upsert(target, new))


def test_document_key_keeps_a_case_s_documents_apart(spark):
    schema = "seq long, numero_processo string, documento string, titulo string"
    target = spark.createDataFrame([(1, "c", "001", "a"), (2, "c", "002", "b")], schema)
    new = spark.createDataFrame([(3, "c", "002", "B"), (4, "c", "1", "z")], schema)
    got = {tuple(r) for r in writes.upsert(target, new, writes.DOCUMENT_KEY).collect()}
    assert got == {(1, "c", "001", "a"), (2, "c", "002", "B"), (4, "c", "1", "z")}


def test_pending_is_equality_not_substring(spark):
    work = spark.createDataFrame([(1, "k1"), (2, "k.1"), (3, "k"), (4, None), (5, "k1")], "seq long, numero_processo string")
    stored = spark.createDataFrame([("k.1",), (None,)], "numero_processo string")
    left = joins.pending(work, stored, ["numero_processo"]).collect()
    assert sorted(r["seq"] for r in left) == [1, 3, 4, 5]
    assert [r["seq"] for r in joins.known(work, stored, ["numero_processo"]).collect()] == [2]


def test_pending_documents_keep_leading_zeros(spark):
    schema = "seq long, numero_processo string, documento string"
    work = spark.createDataFrame([(1, "c", "007"), (2, "c", "7")], schema)
    stored = spark.createDataFrame([(1, "c", "7")], schema)
    assert [r["documento"] for r in joins.pending(work, stored, writes.DOCUMENT_KEY).collect()] == ["007"]


@pytest.mark.parametrize(
    ("stored", "wanted"),
    [(["b"], [3, 4, 5]), (["a", "c"], [4, 5]), (["zz"], [1, 2, 3, 4, 5]), ([], [1, 2, 3, 4, 5]), (["e"], [])],
)
def test_resume_starts_after_the_first_place_of_the_last_key(spark, stored, wanted):
    work = spark.createDataFrame(list(enumerate("abcbe", 1)), "seq long, numero_processo string")
    table = spark.createDataFrame(list(enumerate(stored)), "seq long, numero_processo string")
    assert sorted(r["seq"] for r in joins.resume_after(work, table).collect()) == wanted


def test_document_text_in_page_order(spark):
    pages = [("d", n, f"{n};") for n in range(1000)] + [("e", 2, "b"), ("e", 1, "a"), ("e", 3, None), ("n", 1, None)]
    df = spark.createDataFrame(pages, "doc string, page_no long, text string").repartition(7)
    got = {r["doc"]: r["text"] for r in aggregates.document_text(df, ["doc"]).collect()}
    assert got == {"d": "".join(f"{n};" for n in range(1000)), "e": "ab", "n": ""}
    unnumbered = spark.createDataFrame([("d", None, "x"), ("d", 200, "z"), ("d", -5, "y")], df.schema)
    assert aggregates.document_text(unnumbered, ["doc"]).collect()[0]["text"] == "xyz"


def test_every_document_keeps_its_record(spark):
    pages = spark.createDataFrame([(1, 1, "text"), (3, 1, " ")], "seq long, page_no long, text string")
    links = spark.createDataFrame([(n, f"f{n}", "c", str(n), "t", "d", "p") for n in (1, 2, 3)], string_schema(DOCUMENT_COLUMNS[:-1]))
    got = {r["seq"]: r["conteudo"] for r in case_documents(pages, links).collect()}
    assert got == {1: "text", 2: None, 3: None}


def test_blank_keys_are_never_known(spark):
    work = spark.createDataFrame([(1, ""), (2, None), (3, "a")], "seq long, numero_processo string")
    assert sorted(r["seq"] for r in joins.pending(work, work, ["numero_processo"]).collect()) == [1, 2]
    assert [r["seq"] for r in joins.known(work, work, ["numero_processo"]).collect()] == [3]


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    class Session:
        conf = type("C", (), {"get": staticmethod(lambda *a: None)})
        sparkContext = type("S", (), {"getCheckpointDir": staticmethod(lambda: None), "master": "spark://host:7077"})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work_dir(Session, "x")
    Session.sparkContext.master = "local[4]"
    assert "/x-" in work_dir(Session, "x")


def test_aggregates_of_empty_tables(spark):
    empty = spark.createDataFrame([], "seq long, numero_processo string")
    assert aggregates.any_match(empty, F.col("seq") > 0).collect()[0]["found"] is False
    assert aggregates.last_key(empty).collect()[0]["numero_processo"] is None
    assert aggregates.distinct_keys(empty).count() == 0


@pytest.mark.parametrize("hot", ["k1", "", None, "gone"])
def test_upsert_with_a_hot_key_equals_a_loop(spark, hot):
    rng = random.Random(4)
    target_rows = [(n, hot if n % 3 else f"o{n % 40}", rng.choice("pqr"), None) for n in range(900)]
    new_rows = [(2000 + n, rng.choice([*KEYS, "o1", "o2", "new", "gone"]), rng.choice("xyz"), "c") for n in range(60)]
    target, new = spark.createDataFrame(target_rows, TARGET), spark.createDataFrame(new_rows, NEW)
    got = writes.upsert(target, new)
    assert counted(got) == loop_upsert(target_rows, new_rows)


def test_upsert_reads_the_target_once_beside_the_sketch(spark, tmp_path):
    spark.createDataFrame(random_tables(0)[0] or [(1, "k", "a", "b")], TARGET).write.parquet(str(tmp_path / "t"))
    spark.createDataFrame([(9, "k", "z", "c")], NEW).write.parquet(str(tmp_path / "n"))
    merged = writes.upsert(spark.read.parquet(str(tmp_path / "t")), spark.read.parquet(str(tmp_path / "n")))
    assert merged._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1
    physical = merged._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in physical.splitlines() if "FileScan" in line and str(tmp_path / "t") in line]
    wide = [line for line in scans if "b:string" in line.split("ReadSchema")[-1]]
    assert len(wide) == 1
