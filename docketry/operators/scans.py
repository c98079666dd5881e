"""Pages through a small Python function in Arrow batches: one page in, its rows out, no shuffle."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Rows that a task holds as Python values at a time.
HELD_ROWS = 64


def scanned(df: DataFrame, page: str, rows_of: Callable[[str], Iterable[tuple]], fields: str) -> DataFrame:
    """The rows that ``rows_of`` gives for each text of the column ``page``, after the row's other columns.

    A null text has no rows.
    """
    kept = [n for n, c in enumerate(df.columns) if c != page]
    at = df.columns.index(page)
    made = StructType.fromDDL(fields)
    schema = StructType([*[df.schema.fields[n] for n in kept], *made.fields])
    arrow = to_arrow_schema(schema)

    def batch_of(batch: pa.RecordBatch, places: tuple[int, ...], rows: tuple[tuple, ...]) -> pa.RecordBatch:
        own = pa.array(places, pa.int32())
        columns = [batch.column(n).take(own).cast(arrow.field(m).type) for m, n in enumerate(kept)]
        columns += [pa.array(v, arrow.field(m).type) for m, v in enumerate(zip(*rows), len(kept))]
        return pa.RecordBatch.from_arrays(columns, schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, HELD_ROWS):
                part = batch.slice(first, HELD_ROWS)
                texts = enumerate(part.column(at).to_pylist())
                found = [(place, row) for place, text in texts if text is not None for row in rows_of(text)]
                if found:
                    yield batch_of(part, *zip(*found))

    return df.mapInArrow(run, schema)
