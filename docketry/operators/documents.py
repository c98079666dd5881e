"""Document bytes to text and records."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from docketry.functions.text import blank_to_null, clean_document
from docketry.operators.aggregates import document_text
from docketry.plans.layouts import DOCUMENT_COLUMNS

#: Characters of page text, and of each row's own cost, that a task holds before it hands them on.
HELD, PAGE_COST = 2**21, 2**6
PAGE_SCHEMA = "seq long, page_no long, text string, reason string"


def document_id(content: Column) -> Column:
    """A name that stays the same when a task is run again."""
    return F.sha2(content, 256)


def decode_pages(files: DataFrame, read_pages: Callable[[bytes], list[str | None]]) -> DataFrame:
    """Page texts of ``files(seq, content)`` through the user's decoder of one file's bytes.

    Files stream through in Arrow batches, and the pages of one
    file, or of short files up to ``HELD`` characters, are held. A file the decoder fails on gives one row with the reason, and the rest go on.
    """

    def pages_of(seq: int, content: bytes) -> list[tuple]:
        try:
            return [(seq, n, text, None) for n, text in enumerate(read_pages(bytes(content)), start=1)]
        except Exception as error:  # noqa: BLE001 - whatever the decoder raises
            return [(seq, None, None, f"{type(error).__name__}: {error}")]

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # A frame for each file would cost more than most files' decoding; a long file's pages leave at once.
        held, size = [], 0
        for batch in batches:
            for seq, content in zip(batch["seq"], batch["content"]):
                pages = pages_of(seq, content)
                held.extend(pages)
                size += sum(PAGE_COST + len(page[2] or "") for page in pages)
                if size >= HELD:
                    yield _frame(held)
                    held, size = [], 0
        if held:
            yield _frame(held)

    return files.select("seq", "content").mapInPandas(decode, PAGE_SCHEMA)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["seq", "page_no", "text", "reason"]).astype({"seq": "int64", "page_no": "Int64"})


def utf8_pages(content: bytes) -> list[str]:
    """Stand-in decoder: UTF-8 text with form feeds between pages."""
    return content.decode("utf-8").split("\f")


def case_documents(pages: DataFrame, links: DataFrame) -> DataFrame:
    """Document records: ``pages(seq, page_no, text)`` joined to ``links`` on ``seq``.

    ``links`` has one row per captured file: seq, pdf_name, numero_processo, documento,
    titulo, descricao, processo. Every file gets its record, one without pages a blank text.
    """
    # One row per file on both sides, so no key is hot; the texts stay where they were joined.
    joined = links.join(document_text(pages, ["seq"]), ["seq"], "left")
    return joined.withColumn("conteudo", blank_to_null(clean_document(F.col("text")))).select("seq", *DOCUMENT_COLUMNS)
