"""Record jobs: captures of one kind to the rows of one published table.

Each is a chain of narrow steps: the page body is read once, and leaves the
plan as soon as the fields are out. Blank fields are stored as null.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, functions as F

from docketry.functions import scan
from docketry.functions.links import absolute_link, rebuild_link
from docketry.functions.markup import (
    anchor_text,
    anchored_heads,
    attr_value,
    class_pattern,
    head_ids,
    head_text,
    head_texts,
    prepare,
    value_text,
)
from docketry.functions.structure import element
from docketry.functions.text import (
    blank_to_null,
    decode_entities,
    drop_parens,
    first_slash_part,
    later_slash_parts,
    normalise_space,
    strip_space,
)
from docketry.operators import blocks
from docketry.operators.scans import scanned
from docketry.plans import layouts as at
from docketry.plans.pages import case_key, of_kind, page_kind_flags


def _record(df: DataFrame, fields: dict[str, Column], columns: list[str]) -> DataFrame:
    return df.select("seq", *[blank_to_null(fields[c]).alias(c) for c in columns])


def _anchored_fields(anchors: dict[str, str]) -> dict[str, Column]:
    return {name: head_text(F.col("head_ids"), F.col("head_texts"), anchor) for name, anchor in anchors.items()}


def _decisions(captures: DataFrame, kind: str, labels: dict[str, str]) -> DataFrame:
    """Decisions of result pages: number, summary, and the text after each label."""

    def read(block: str) -> list[str] | None:
        if not blocks.is_decision(block, at.FULL_TEXT_TITLE):
            return None
        cells = scan.labelled_cells(block)
        found = [scan.label_detail(cells, label) for label in labels.values()]
        return [scan.link_text_by_title(block, at.FULL_TEXT_TITLE), scan.last_block_text(block, "tr", "div"), *found]

    pages = of_kind(captures, kind).select("seq", "body")
    return blocks.result_blocks(pages, at.RESULTS_ID, ["numero_processo", "ementa", *labels], read)


def first_degree_decisions(captures: DataFrame) -> DataFrame:
    df = _decisions(captures, at.FIRST_SEARCH, at.FIRST_SEARCH_LABELS)
    return _record(df, {c: F.col(c) for c in at.FIRST_DECISION_COLUMNS}, at.FIRST_DECISION_COLUMNS)


def second_degree_decisions(captures: DataFrame) -> DataFrame:
    combined = {"class_subject": at.CLASS_SUBJECT_LABEL, "class": at.CLASS_LABEL, "subject": at.SUBJECT_LABEL}
    df = _decisions(captures, at.SECOND_SEARCH, {**at.SECOND_SEARCH_LABELS, **combined})
    fields = {c: F.col(c) for c in ("numero_processo", "ementa", *at.SECOND_SEARCH_LABELS)}
    fields["classe"] = first_slash_part(F.col("class_subject"), F.col("class"))
    fields["assunto"] = later_slash_parts(F.col("subject"))
    return _record(df, fields, at.SECOND_DECISION_COLUMNS)


def first_degree_cases(captures: DataFrame, base_url: str) -> DataFrame:
    anchors = {**at.FIRST_CASE_SPAN_ANCHORS, **at.FIRST_CASE_OWN_ANCHORS}
    labelled = {
        "subjects": (at.OTHER_SUBJECTS["container"], at.OTHER_SUBJECTS["label"]),
        "enforcement": (at.ENFORCEMENT["container"], at.ENFORCEMENT["label"]),
        "main_case": (at.RELATED_CONTAINER, at.MAIN_CASE_LABEL),
        "attached_case": (at.RELATED_CONTAINER, at.ATTACHED_CASE_LABEL),
    }

    def rows_of(captured: str) -> Iterator[tuple]:
        body = scan.prepare(captured)
        texts = scan.anchored_texts(body, tuple(anchors.values()))
        yield (
            scan.tags_joined(body, at.STATUS_CLASS),
            scan.inner_text(scan.element(body, at.AREA_ANCHOR)),
            scan.texts_of_class(body, tuple(at.ROLE_CLASSES)),
            scan.parties(body, at.PARTY_CLASS),
            scan.tag_with_class(body, "a", at.SECOND_DEGREE_LINK_CLASS),
            *[texts.get(element_id, "") for element_id in anchors.values()],
            *[scan.labelled_block(body, container, at.LABEL_CLASS, label) for container, label in labelled.values()],
        )

    party = "struct<nomes_parte: array<string>, advogados_parte: array<string>>"
    made = ["situacao string", "area string", "roles array<string>", f"parties array<{party}>", "second_tag string"]
    pages = _shown(captures, at.FIRST_CASE).select("seq", case_key().alias("numero_processo"), "body")
    df = scanned(pages, "body", rows_of, ", ".join([*made, *[f"{name} string" for name in (*anchors, *labelled)]]))
    fields = {name: F.col(name) for name in ("numero_processo", "situacao", "area", *anchors)}
    fields["valor_acao"] = normalise_space(fields["valor_acao"])
    for place in (0, 1):
        slot = f"partes_processo_{place + 1}"
        role = strip_space(decode_entities(F.get(F.col("roles"), F.lit(place))))
        fields[f"{slot}_tipo_participacao"] = F.when(F.size("parties") > place, role)
        fields[f"{slot}_nome_parte"] = blocks.party_at(F.col("parties"), place, "nomes_parte")
        fields[f"{slot}_advogados"] = blocks.party_at(F.col("parties"), place, "advogados_parte")
    link = r"<a\b[^>]*+>"
    fields["outros_assuntos"] = value_text(
        F.col("subjects"), rf'<div\b[^>]*class="{re.escape(at.OTHER_SUBJECTS["value"])}"[^>]*+>\s*+<span\b[^>]*+>'
    )
    fields["execucao_sentenca"] = drop_parens(
        strip_space(value_text(F.col("enforcement"), rf'<span\b[^>]*{class_pattern(at.ENFORCEMENT["value"])}[^>]*+>'))
    )
    fields["processo_principal"] = value_text(F.col("main_case"), link)
    fields["link_processo_principal"] = absolute_link(base_url, attr_value(F.col("main_case"), "href"))
    fields["numero_processo_apensado"] = value_text(F.col("attached_case"), link)
    fields["link_processo_apensado"] = absolute_link(base_url, attr_value(F.col("attached_case"), "href"))
    fields["link_consulta_sg"] = rebuild_link(base_url, attr_value(F.col("second_tag"), "href"))
    return _record(df, fields, at.FIRST_CASE_COLUMNS)


def case_movements(captures: DataFrame) -> DataFrame:
    rows = blocks.movements(_case_pages(captures, at.FIRST_CASE), case_key(), at.MOVEMENTS)
    return _record(rows, {c: F.col(c) for c in at.MOVEMENT_COLUMNS}, at.MOVEMENT_COLUMNS)


def second_degree_cases(captures: DataFrame) -> DataFrame:
    body = F.col("body")
    details = element(body, at.DETAILS_ID)
    origin = rf"(?s)<span\b[^>]*+>[^<]*{at.ORIGIN_LABEL}[^<]*</span>(?:[^<]++|<(?!span\b))*+<span\b[^>]*+>([^<]*+)"
    df = _case_pages(captures, at.SECOND_CASE).select(
        "seq",
        case_key().alias("numero_processo"),
        anchored_heads(body, list(at.SECOND_CASE_ANCHORS.values())).alias("heads"),
        decode_entities(F.regexp_extract(details, origin, 1)).alias("comarca"),
    ).select("*", head_ids(F.col("heads")).alias("head_ids"), head_texts(F.col("heads")).alias("head_texts"))
    fields = _anchored_fields(at.SECOND_CASE_ANCHORS)
    fields |= {name: F.col(name) for name in ("numero_processo", "comarca")}
    return _record(df, fields, at.SECOND_CASE_COLUMNS)


def first_instance_links(captures: DataFrame) -> DataFrame:
    pages = _case_pages(captures, at.SECOND_CASE)
    fields = blocks.first_instance(F.col("body"), at.FIRST_INSTANCE_LABEL)
    fields["numero_processo"] = anchor_text(F.col("body"), at.CASE_NUMBER_ID)
    return _record(pages, fields, at.FIRST_INSTANCE_COLUMNS)


def document_links(captures: DataFrame) -> DataFrame:
    return blocks.document_links(_case_pages(captures, at.SECOND_CASE), case_key(), at.DOCUMENT_LINKS)


def _shown(captures: DataFrame, kind: str) -> DataFrame:
    """Pages of a kind that show a case; pages with a list of cases give no record."""
    return of_kind(captures, kind).filter(~page_kind_flags()["has_case_list"])


def _case_pages(captures: DataFrame, kind: str) -> DataFrame:
    return _shown(captures, kind).select("seq", "meta", prepare(F.col("body")).alias("body"))
