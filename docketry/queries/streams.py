"""Incremental runs: the events table arrives in three deliveries, one run after each."""

from __future__ import annotations

from pyspark.sql import functions as F

from docketry.queries.common import table
from docketry.session import work_dir
from docketry.sources.tables import string_schema
from docketry.streaming import ingest

RECORD = ["numero_processo", "situacao", "classe"]
SCHEMA = string_schema(RECORD)
# Deliveries by kind of event; whatever is not named comes last.
DELIVERIES = ["click", "view"]


def records_of(events):
    key = F.when(F.col("event_type") != "error", F.col("user_id").cast("string"))
    return events.select(
        F.col("event_id").alias("seq"), key.alias("numero_processo"), F.col("event_type").alias("situacao"), F.col("props").alias("classe")
    )


def _deliver(spark, sf, each, between=lambda n: None):
    """Write each delivery to the landing folder, run the stream over what is new, and then ``between``."""
    events = table(spark, sf, "events")
    landing, checkpoint = work_dir(spark, "landing"), work_dir(spark, "progress")
    named = F.col("event_type").isin(DELIVERIES)
    for n, part in enumerate([*[F.col("event_type") == d for d in DELIVERIES], ~named], 1):
        events.filter(part).write.mode("append").parquet(landing)
        ingest.run_available(ingest.new_captures(spark, landing, events.schema), each, checkpoint)
        between(n)


def stream_ingest(spark, sf):
    stored = work_dir(spark, "append")
    _deliver(spark, sf, ingest.append_batch(records_of, stored))
    return ingest.stored_batches(spark, stored, SCHEMA)


def stream_insert_if_absent(spark, sf):
    stored = work_dir(spark, "insert")
    _deliver(spark, sf, ingest.insert_batch(records_of, stored, SCHEMA))
    return ingest.stored_batches(spark, stored, SCHEMA).drop("batch_id")


def stream_upsert(spark, sf):
    changes, none, base = (work_dir(spark, name) for name in ("changes", "none", "base"))

    def halfway(n):
        if n == len(DELIVERIES):
            ingest.compact(spark, none, changes, base, SCHEMA)

    _deliver(spark, sf, ingest.append_batch(records_of, changes), halfway)
    return ingest.current(spark, base, changes, SCHEMA).drop("seq")


BATCHES_SQL = """batches AS (SELECT event_id AS seq, CASE WHEN event_type <> 'error' THEN CAST(user_id AS VARCHAR) END AS numero_processo,
    event_type AS situacao, props AS classe,
    CAST(CASE event_type WHEN 'click' THEN 0 WHEN 'view' THEN 1 ELSE 2 END AS BIGINT) AS batch_id FROM events)"""

QUERIES = {
    "stream_ingest": (
        stream_ingest,
        f"WITH {BATCHES_SQL} SELECT seq, numero_processo, situacao, classe, batch_id FROM batches",
    ),
    "stream_insert_if_absent": (
        stream_insert_if_absent,
        f"""WITH {BATCHES_SQL} SELECT seq, numero_processo, situacao, classe FROM (SELECT *, row_number() OVER
            (PARTITION BY numero_processo ORDER BY batch_id, seq) AS rn FROM batches) WHERE rn = 1 OR numero_processo IS NULL""",
    ),
    "stream_upsert": (
        stream_upsert,
        f"""WITH {BATCHES_SQL} SELECT numero_processo, situacao, classe FROM (SELECT *, row_number() OVER
            (PARTITION BY numero_processo ORDER BY batch_id DESC, seq DESC) AS rn FROM batches)
            WHERE rn = 1 OR numero_processo IS NULL""",
    ),
}
