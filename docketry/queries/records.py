"""Record jobs on pages written from orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from docketry.operators.documents import utf8_pages
from docketry.operators.quarantine import split_bad
from docketry.plans import jobs, records
from docketry.plans import layouts as at
from docketry.functions.markup import script_param
from docketry.queries import render
from docketry.queries.common import BASE, customer, day, key, pages_from, priority, spelt, status, table, text_of
from docketry.queries.text import sql_clean


def decisions_first(spark, sf):
    def page():
        paging = render.pager(at.FIRST_SEARCH, key(), F.lit(True))
        return render.result_page(render.first_decision_blocks(), anchored=True, paging=paging)

    captures = pages_from(table(spark, sf, "orders"), at.FIRST_SEARCH, spelt(page, key(), [priority(), status()]), "o_orderkey")
    return records.first_degree_decisions(captures).drop("seq")


def decisions_second(spark, sf):
    def page():
        return render.result_page(render.second_decision_blocks(), anchored=False)

    captures = pages_from(table(spark, sf, "orders"), at.SECOND_SEARCH, spelt(page, key(), [priority(), status()]), "o_orderkey")
    return records.second_degree_decisions(captures).drop("seq")


def first_case_page():
    related = at.RELATED_CONTAINER
    href = text_of("/x?cdProcessoSg=", key(), "&amp;nuProcesso=", customer(), "&amp;cdForoSg=9&amp;isProcessoOrigemCr=", status())
    value = at.OTHER_SUBJECTS["value"]
    case = text_of(
        f'<html><body><span class="{at.STATUS_CLASS}">', status(), f'</span><span class="a {at.STATUS_CLASS} b">Digital</span>',
        render.span_anchor("classeProcesso", priority()),
        render.own_anchor("assuntoProcesso", text_of(priority(), " &amp; ", status())),
        f'<div id="{at.AREA_ANCHOR}"><span>', render.ODD, "Cível", "</span> </div>",
        render.own_anchor("juizProcesso", text_of("Juiz ", customer())),
        render.span_anchor("valorAcaoProcesso", text_of("R$  \n ", customer(), ",00")),
        render.own_anchor("foroProcesso", "Foro Central"),
        render.own_anchor("varaProcesso", text_of(status(), "&ordf; Vara")),
        render.own_anchor("dataHoraDistribuicaoProcesso", day("o_orderdate")),
        render.own_anchor("numeroControleProcesso", text_of("2024/", key())),
        "<table>", render.role_cell("Reqte"), render.party_cell(text_of("Autor ", customer()), [priority(), status()]),
        render.role_cell("Reqdo"), render.party_cell(text_of("Parte ", key()), []), "</table>",
        render.labelled_container(
            at.OTHER_SUBJECTS["container"], at.OTHER_SUBJECTS["label"],
            text_of(f'<div class="{value}">\n<span title="s">', priority(), "</span></div>"),
        ),
        render.labelled_container(
            at.ENFORCEMENT["container"], at.ENFORCEMENT["label"],
            text_of(f'<div><span class="{at.ENFORCEMENT["value"]}"> Início (', status(), ") ", customer(), " </span></div>"),
        ),
        F.when(
            status() == "F",
            render.labelled_container(related, at.MAIN_CASE_LABEL, text_of('<div><a href="/show?c=', key(), '">', key(), "</a></div>")),
        ).otherwise(render.labelled_container(related, at.ATTACHED_CASE_LABEL, text_of('<div><a href="/att">', customer(), "</a></div>"))),
        f'<a class="x {at.SECOND_DEGREE_LINK_CLASS}" href="', href, '">2</a></body></html>',
    )
    return F.when(status() == "P", text_of("<html>", render.case_list(key(), customer()), "</html>")).otherwise(case)


def first_case_captures(spark, sf):
    return pages_from(table(spark, sf, "orders"), at.FIRST_CASE, first_case_page(), "o_orderkey", key())


def cases_first(spark, sf):
    return records.first_degree_cases(first_case_captures(spark, sf), BASE).drop("seq")


def second_case_page():
    case = text_of(
        f'<html><span id="{at.CASE_NUMBER_ID}" class="n">\n', key(), "</span>",
        render.own_anchor("situacaoProcesso", status()),
        *[
            render.span_anchor(at.SECOND_CASE_ANCHORS[name], value)
            for name, value in [
                ("classe", priority()), ("assunto", text_of(priority(), "-", status())), ("secao", "Direito"),
                ("orgao_julgador", text_of(status(), " Câmara")), ("area", "Cível"), ("relator_a", text_of("Des. ", customer())),
            ]
        ],
        f'<div id="{at.DETAILS_ID}"><div><span class="{at.LABEL_CLASS}">{at.ORIGIN_LABEL}</span><div><div><span>Comarca ', customer(),
        "</span></div></div></div><div><span>Outro</span><div><span>x</span></div></div></div>",
        F.when(status() == "F", render.first_instance_tables(text_of(customer(), " (", priority(), ")"), "Foro", "1", "Juiz", "obs"))
        .otherwise(F.lit("<table><tr><td>none</td></tr></table>")),
        "</html>",
    )
    return F.when(status() == "P", text_of("<html>", render.case_list(key()), "</html>")).otherwise(case)


def second_case_captures(spark, sf):
    return pages_from(table(spark, sf, "orders"), at.SECOND_CASE, second_case_page(), "o_orderkey", key())


def cases_second(spark, sf):
    return records.second_degree_cases(second_case_captures(spark, sf)).drop("seq")


def first_instance(spark, sf):
    return records.first_instance_links(second_case_captures(spark, sf)).drop("seq")


def case_movements(spark, sf):
    rows = render.movement_table(
        render.movement_row(day("o_orderdate"), priority(), text_of("Desc ", customer()), linked=True),
        render.movement_row("01/01/2020", status(), "", linked=False),
    )
    captures = pages_from(table(spark, sf, "orders"), at.FIRST_CASE, rows, "o_orderkey", key())
    return records.case_movements(captures).drop("seq")


def quarantine_counts(spark, sf):
    page = F.when(status() == "P", F.lit("<html><script>{}</script></html>")).otherwise(render.viewer_page(text_of("a=", key())))
    parsed = table(spark, sf, "orders").select("o_orderkey", script_param(page, at.VIEWER_PARAM).alias("parameters"))
    good, bad = split_bad(parsed, F.when(F.col("parameters").isNull(), "no viewer parameter"))
    outcome = good.select(F.lit("stored").alias("outcome")).union(bad.select("reason"))
    return outcome.groupBy("outcome").agg(F.count("*").alias("n"))


DAY = "strftime(o_orderdate, '%d/%m/%Y')"

def document_job(spark, sf):
    """Documents as captured files: some that the decoder fails on, some empty, without bytes or of an unknown request.

    The context stands in the access request, two requests before the file's, or for some in the file's own.
    """
    docs, doc = table(spark, sf, "documents"), F.col("doc_id")
    kind, text = F.pmod(doc, F.lit(7)), F.col("text").cast("binary")
    content = F.when(kind == 1, F.concat(F.unhex(F.lit("FF")), text)).when(kind == 2, F.unhex(F.lit(""))).when(kind != 3, text)
    files = docs.select(doc.alias("seq"), text_of("file-", doc).alias("request_id"), content.alias("content"))

    def request(name, parent, rows, title=None):
        fields = [text_of("case-", doc), doc, title, F.col("source"), F.col("n_chars")] if title is not None else []
        pairs = [x for c, v in zip(jobs.DOCUMENT_CONTEXT, fields) for x in (F.lit(c), v.cast("string"))]
        meta = F.create_map(*pairs).cast("map<string,string>")
        before = text_of(f"{parent}-", doc) if parent else F.lit(None).cast("string")
        return rows.select(text_of(f"{name}-", doc).alias("request_id"), before.alias("parent_id"), meta.alias("meta"))

    own = F.pmod(doc, F.lit(5)) == 0
    made = request("access", None, docs, F.col("lang")).unionByName(request("viewer", "access", docs))
    made = made.unionByName(request("file", "viewer", docs.filter(own), F.lit("own")))
    made = made.unionByName(request("file", "viewer", docs.filter(F.pmod(doc, F.lit(5)).between(1, 3))))
    found, failed = jobs.document_records(files, made, utf8_pages)
    return found.withColumn("reason", F.lit(None).cast("string")).unionByName(failed, allowMissingColumns=True)


BAD_BYTES = "UnicodeDecodeError: ''utf-8'' codec can''t decode byte 0xff in position 0: invalid start byte"
DOCUMENT_JOB_SQL = f"""WITH files AS (SELECT *, doc_id % 5 = 4 AS unknown, CASE doc_id % 7 WHEN 1 THEN unhex('FF') || encode(text)
        WHEN 2 THEN encode('') WHEN 3 THEN NULL ELSE encode(text) END AS content FROM documents)
    SELECT doc_id AS seq, sha256(content) AS pdf_name, CASE WHEN NOT unknown THEN 'case-' || doc_id END AS numero_processo,
        CASE WHEN NOT unknown THEN CAST(doc_id AS VARCHAR) END AS documento,
        CASE WHEN doc_id % 5 = 0 THEN 'own' WHEN NOT unknown THEN lang END AS titulo, CASE WHEN NOT unknown THEN source END AS descricao,
        CASE WHEN NOT unknown THEN CAST(n_chars AS VARCHAR) END AS processo,
        CASE WHEN doc_id % 7 NOT IN (1, 2, 3) THEN nullif({sql_clean("replace(text, chr(12), '')")}, '') END AS conteudo,
        NULL AS reason FROM files
    UNION ALL SELECT doc_id, NULL, NULL, NULL, NULL, NULL, NULL, NULL, '{BAD_BYTES}' FROM files WHERE doc_id % 7 = 1 AND content IS NOT NULL
    UNION ALL SELECT doc_id, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'no bytes' FROM files WHERE content IS NULL
    UNION ALL SELECT doc_id, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'no request' FROM files WHERE unknown"""

QUERIES = {
    "document_job": (document_job, DOCUMENT_JOB_SQL),
    "decisions_first": (
        decisions_first,
        f"""SELECT CAST(o_orderkey AS VARCHAR) AS numero_processo, o_orderstatus AS classe, o_orderpriority AS assunto,
            'Juiz ' || o_custkey AS magistrado, 'Foro ' || o_custkey AS foro, o_orderstatus || 'ª Vara' AS vara,
            {DAY} AS data_disponibilizacao, 'Texto ' || o_orderkey || ' & ' || o_orderpriority || 'fim.' AS ementa FROM orders
            UNION ALL SELECT o_orderkey || '-R', 'Recurso', o_orderpriority || ' / ' || o_orderstatus, NULL, NULL, NULL, NULL,
            'Recurso ' || o_custkey || 'fim.' FROM orders""",
    ),
    "decisions_second": (
        decisions_second,
        f"""SELECT CAST(o_orderkey AS VARCHAR) AS numero_processo, o_orderstatus AS classe,
            o_orderpriority || ' | ' || o_custkey AS assunto, 'Des. ' || o_custkey AS relator_a,
            o_orderstatus || ' Câmara' AS orgao_julgador, 'Comarca ' || o_custkey AS comarca, {DAY} AS data_julgamento,
            {DAY} AS data_publicacao, 'EMENTA ' || o_orderkey || 'fim.' AS ementa FROM orders
            UNION ALL SELECT o_orderkey || '-R', o_orderstatus, o_orderpriority, NULL, NULL, NULL, NULL, NULL,
            o_orderpriority || 'fim.' FROM orders""",
    ),
    "cases_first": (
        cases_first,
        f"""SELECT CAST(o_orderkey AS VARCHAR) AS numero_processo, o_orderstatus || '|Digital' AS situacao,
            o_orderpriority AS classe, o_orderpriority || ' & ' || o_orderstatus AS assunto, 'Cível' AS area,
            'Juiz ' || o_custkey AS juiz, 'R$ ' || o_custkey || ',00' AS valor_acao, 'Foro Central' AS foro,
            o_orderstatus || 'ª Vara' AS vara, {DAY} AS distribuicao, '2024/' || o_orderkey AS controle,
            'Reqte' AS partes_processo_1_tipo_participacao, 'Autor ' || o_custkey AS partes_processo_1_nome_parte,
            o_orderpriority || '|' || o_orderstatus AS partes_processo_1_advogados,
            'Reqdo' AS partes_processo_2_tipo_participacao, 'Parte ' || o_orderkey AS partes_processo_2_nome_parte,
            CAST(NULL AS VARCHAR) AS partes_processo_2_advogados, o_orderpriority AS outros_assuntos,
            'Início' || o_custkey AS execucao_sentenca,
            CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderkey AS VARCHAR) END AS processo_principal,
            CASE WHEN o_orderstatus = 'F' THEN '{BASE}/show?c=' || o_orderkey END AS link_processo_principal,
            CASE WHEN o_orderstatus = 'O' THEN CAST(o_custkey AS VARCHAR) END AS numero_processo_apensado,
            CASE WHEN o_orderstatus = 'O' THEN '{BASE}/att' END AS link_processo_apensado,
            '{BASE}/abrirConsultaProcessoSG.do?nuProcesso=' || o_custkey || '&cdProcessoSg=' || o_orderkey ||
            '&cdForoSg=9&isProcessoOrigemCr=' || o_orderstatus AS link_consulta_sg FROM orders WHERE o_orderstatus <> 'P'""",
    ),
    "cases_second": (
        cases_second,
        """SELECT CAST(o_orderkey AS VARCHAR) AS numero_processo, o_orderstatus AS situacao, o_orderpriority AS classe,
           o_orderpriority || '-' || o_orderstatus AS assunto, 'Direito' AS secao, o_orderstatus || ' Câmara' AS orgao_julgador,
           'Cível' AS area, 'Des. ' || o_custkey AS relator_a, CAST(NULL AS VARCHAR) AS valor_acao,
           'Comarca ' || o_custkey AS comarca FROM orders WHERE o_orderstatus <> 'P'""",
    ),
    "first_instance": (
        first_instance,
        """SELECT CAST(o_orderkey AS VARCHAR) AS numero_processo, CAST(o_custkey AS VARCHAR) AS n_processo_1_instancia,
           o_orderpriority AS tipo, 'Foro' AS foro, '1' AS vara, 'Juiz' AS juiz, 'obs' AS obs FROM orders WHERE o_orderstatus = 'F'
           UNION ALL SELECT CAST(o_orderkey AS VARCHAR), NULL, NULL, NULL, NULL, NULL, NULL FROM orders WHERE o_orderstatus = 'O'""",
    ),
    "case_movements": (
        case_movements,
        f"""SELECT CAST(o_orderkey AS VARCHAR) AS numero_processo, {DAY} AS data, o_orderpriority AS titulo,
            'Desc ' || o_custkey AS descricao FROM orders
            UNION ALL SELECT CAST(o_orderkey AS VARCHAR), '01/01/2020', o_orderstatus, NULL FROM orders""",
    ),
    "quarantine_counts": (
        quarantine_counts,
        """SELECT CASE WHEN o_orderstatus = 'P' THEN 'no viewer parameter' ELSE 'stored' END AS outcome, count(*) AS n
           FROM orders GROUP BY 1""",
    ),
}
