"""Readers, writers and incremental runs."""

from __future__ import annotations

from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from docketry.operators import writes
from docketry.sources.captures import decode_body, read_captures
from docketry.sources.files import new_files, read_files, store_files
from docketry.sources.tables import import_csv, read_csv, read_table, string_schema, write_csv, write_version
from docketry.streaming import ingest
from tests import portal

SCHEMA = string_schema(["numero_processo", "a"])
FIELDS = "seq long, numero_processo string, a string"


def test_csv_keeps_every_text(spark, tmp_path):
    rows = [("1", 'say "x"'), ("2", "line\nbreak, comma"), ("007", "\\ back"), ("3", None), ("4", "  pad ")]
    write_csv(spark.createDataFrame(rows, "k string, v string"), str(tmp_path / "t"))
    assert sorted(map(tuple, read_csv(spark, str(tmp_path / "t"), ["k", "v"], line_breaks=True).collect()), key=str) == sorted(rows, key=str)


def test_import_of_a_plain_csv_file_keeps_its_order(spark, tmp_path):
    path = tmp_path / "old.csv"
    path.write_text('"k","v"\n' + "".join(f'"{i}","a\nb"\n' for i in range(50)), encoding="utf-8")
    got = import_csv(spark, str(path), ["k", "v"]).orderBy("seq").collect()
    assert [r["k"] for r in got] == [str(i) for i in range(50)]
    empty = tmp_path / "empty.csv"
    empty.write_text("")
    assert read_csv(spark, str(empty), ["k", "v"]).count() == 0


def test_a_missing_table_is_empty(spark, tmp_path):
    table = read_table(spark, str(tmp_path / "no"), SCHEMA)
    assert table.schema == SCHEMA and table.count() == 0


def test_a_version_is_never_written_over(spark, tmp_path):
    path = str(tmp_path / "v1")
    df = spark.createDataFrame([(1, "k", "x")], FIELDS)
    assert write_version(df, path).count() == 1
    with pytest.raises(Exception, match="(?i)already exists"):
        write_version(df, path)


@pytest.mark.parametrize("source_format", ["parquet", "json", "orc"])
def test_captures_round_trip(spark, tmp_path, source_format):
    df = portal.captures(spark, portal.capture(1, "first_case", "<p>", "c", headers=[("A", "b")]))
    df.write.format(source_format).save(str(tmp_path / "c"))
    assert read_captures(spark, str(tmp_path / "c"), source_format).collect() == df.collect()


def test_latin1_bytes_read_as_html_readers_do(spark):
    df = spark.createDataFrame([(b"\x80\x81\x93x\x94\x96\xe9",)], "b binary")
    assert df.select(decode_body(F.col("b"))).collect()[0][0] == "€\x81“x”–é"


def test_bodies_in_latin1(spark):
    df = spark.createDataFrame([("Próxima".encode("latin1"),)], "b binary")
    assert df.select(decode_body(F.col("b")), decode_body(F.col("b"), "UTF-8")).collect()[0] == ("Próxima", None)


def test_files_are_stored_under_a_name_from_their_bytes(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.pdf").write_bytes(b"one")
    (tmp_path / "in" / "b.txt").write_bytes(b"two")
    store_files(read_files(spark, str(tmp_path / "in")), str(tmp_path / "out"))
    store_files(read_files(spark, str(tmp_path / "in")), str(tmp_path / "out"))
    stored = spark.read.parquet(str(tmp_path / "out")).collect()
    assert len(stored) == 1 and len(stored[0]["pdf_name"]) == 64


@pytest.fixture
def deliveries(spark, tmp_path):
    rows = [
        [(1, "k1", "a"), (2, "k2", "b"), (3, None, "n")],
        [(4, "k1", "A"), (5, "k3", "c"), (6, "k3", "d"), (7, None, "m")],
        [(8, "k3", None)],
    ]
    landing = str(tmp_path / "landing")

    def run(each):
        for part in rows:
            spark.createDataFrame(part, FIELDS).write.mode("append").parquet(landing)
            ingest.run_available(ingest.new_captures(spark, landing, SCHEMA), each, str(tmp_path / "progress"))
        return [spark.createDataFrame(part, FIELDS) for part in rows]

    return run


def as_set(df):
    return sorted((tuple(r) for r in df.select("numero_processo", "a").collect()), key=str)


def test_incremental_insert_equals_batches_and_retries_are_safe(spark, tmp_path, deliveries):
    stored = str(tmp_path / "stored")
    write = ingest.insert_batch(lambda df: df, stored, SCHEMA)
    parts = deliveries(write)
    wanted = read_table(spark, str(tmp_path / "none"), SCHEMA)
    for part in parts:
        wanted = writes.insert_if_absent(wanted, part)
    assert as_set(ingest.stored_batches(spark, stored, SCHEMA)) == as_set(wanted)
    write(parts[1], 1)
    assert as_set(ingest.stored_batches(spark, stored, SCHEMA)) == as_set(wanted)


def test_incremental_upsert_equals_batches_and_retries_are_safe(spark, tmp_path, deliveries):
    changes = str(tmp_path / "changes")
    write = ingest.append_batch(lambda df: df, changes)
    parts = deliveries(write)
    base = spark.createDataFrame([(0, "k2", "old"), (0, "k2", "twin")], FIELDS)
    wanted = base
    for part in parts:
        wanted = writes.upsert(wanted, part)
    write(parts[0], 0)
    assert as_set(ingest.upserted_view(base, ingest.stored_batches(spark, changes, SCHEMA))) == as_set(wanted)


@pytest.mark.parametrize("when", [0, 1, 2])
def test_compaction_between_runs_changes_nothing(spark, tmp_path, deliveries, when):
    changes, base = str(tmp_path / "changes"), str(tmp_path / "base0")
    rows = spark.createDataFrame([(0, "k2", "old"), (0, "k2", "twin"), (0, "", "blank")], FIELDS)
    rows.write.parquet(base)
    write, seen = ingest.append_batch(lambda df: df, changes), []

    def each(df, batch_id):
        write(df, batch_id)
        seen.append(batch_id)

    bases = [base]

    def run_and_compact(df, batch_id):
        each(df, batch_id)
        if batch_id == when:  # the batch just written is whole
            bases.append(str(tmp_path / "base1"))
            ingest.compact(spark, base, changes, bases[-1], SCHEMA)
            ingest.compact(spark, bases[-1], changes, str(tmp_path / "base2"), SCHEMA)
            bases.append(str(tmp_path / "base2"))

    wanted = rows
    for part in deliveries(run_and_compact):
        wanted = writes.upsert(wanted, part)
    assert seen == [0, 1, 2]
    for path in bases:
        assert as_set(ingest.current(spark, path, changes, SCHEMA)) == as_set(wanted)


def test_file_bytes_stay_out_of_the_first_exchange(spark, tmp_path):
    rows = [("b", b"one"), ("a", b"one"), ("c", b"two"), ("d", None), ("e", b""), ("f", b"three")]
    spark.createDataFrame(rows, "url string, content binary").write.parquet(str(tmp_path / "in"))
    stored = spark.createDataFrame([(sha256(b"three").hexdigest(),), (None,)], "pdf_name string")
    fresh = new_files(spark.read.parquet(str(tmp_path / "in")), stored)
    assert sorted((r["url"], bytes(r["content"])) for r in fresh.collect()) == [("a", b"one"), ("c", b"two"), ("e", b"")]
    plan = fresh._jdf.queryExecution().optimizedPlan().toString()
    grouped = next(line for line in plan.splitlines() if "Aggregate" in line and "min(url" in line)
    assert "content" not in grouped
