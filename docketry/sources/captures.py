"""Captured pages as a table: the input of every job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from docketry.functions.text import windows_text

HEADERS = T.ArrayType(T.StructType([T.StructField("name", T.StringType()), T.StructField("value", T.StringType())]))
CAPTURE_SCHEMA = T.StructType(
    [
        T.StructField("capture_id", T.LongType()),
        T.StructField("request_kind", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("meta", T.MapType(T.StringType(), T.StringType())),
        T.StructField("headers", HEADERS),
        T.StructField("body", T.StringType()),
        T.StructField("seq", T.LongType()),
    ]
)


FILE_SCHEMA = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("request_id", T.StringType()),
        T.StructField("content", T.BinaryType()),
    ]
)
#: Every request that was made; ``parent_id`` is the request whose answer led to it.
REQUEST_SCHEMA = T.StructType(
    [
        T.StructField("request_id", T.StringType()),
        T.StructField("parent_id", T.StringType()),
        T.StructField("meta", T.MapType(T.StringType(), T.StringType())),
    ]
)


def read_files(spark: SparkSession, path: str, source_format: str = "parquet") -> DataFrame:
    """Captured files with their bytes, one row per capture."""
    return spark.read.schema(FILE_SCHEMA).format(source_format).load(path)


def read_requests(spark: SparkSession, path: str, source_format: str = "parquet") -> DataFrame:
    """The requests made, one row per id."""
    return spark.read.schema(REQUEST_SCHEMA).format(source_format).load(path)


def read_captures(spark: SparkSession, path: str, source_format: str = "parquet") -> DataFrame:
    """Captures in Parquet, ORC or JSON. Keep them partitioned by ``request_kind``: jobs filter on it."""
    return spark.read.schema(CAPTURE_SCHEMA).format(source_format).load(path)


def as_captures(
    df: DataFrame,
    *,
    kind: Column | str,
    body: Column,
    seq: Column,
    url: Column | None = None,
    meta: Column | None = None,
    headers: Column | None = None,
) -> DataFrame:
    """Any table projected to the capture schema."""
    given = {
        "capture_id": seq,
        "request_kind": F.lit(kind) if isinstance(kind, str) else kind,
        "url": F.lit(None) if url is None else url,
        "meta": F.lit(None) if meta is None else meta,
        "headers": F.lit(None) if headers is None else headers,
        "body": body,
        "seq": seq,
    }
    return df.select(*[given[f.name].cast(f.dataType).alias(f.name) for f in CAPTURE_SCHEMA.fields])


def decode_body(content: Column, charset: str = "ISO-8859-1") -> Column:
    """Bytes to text in the charset the portal answers in; null where they are not UTF-8 but should be.

    Latin-1 is read as HTML readers do, that is as windows-1252.
    """
    if charset.upper() == "UTF-8":
        return F.try_validate_utf8(content.cast("string"))
    return windows_text(F.decode(content, charset))
