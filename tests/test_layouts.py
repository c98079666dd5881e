"""Record jobs on invented portal pages, with one pin per known weak spot of page scraping."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from docketry.functions import markup
from docketry.functions.maps import cookies
from docketry.operators import blocks, documents, writes
from docketry.operators.quarantine import split_bad
from docketry.plans import layouts as at
from docketry.plans import records, requests
from docketry.plans.pages import current_page, listed_case_code, page_kind_flags
from tests import portal

BASE = "https://portal.example.org/app"


def rows(df):
    return [r.asDict() for r in df.orderBy("seq").collect()]


@pytest.fixture(scope="module")
def first_search(spark):
    one = portal.block(
        "0001-1",
        [("Classe:", "Comum"), ("Assunto:", "Dados"), ("Magistrado:", "A&nbsp; B"), ("Data de Disponibilização:", "01/02/2024")],
        " Texto  com <b> marca </b>&amp; fim ",
    )
    blank = portal.block(None, [("Foro:", "")], "")
    return portal.captures(
        spark,
        portal.capture(1, at.FIRST_SEARCH, portal.results(one, blank)),
        portal.capture(2, at.FIRST_SEARCH, portal.results(page="", more=True)),
        portal.capture(3, at.SECOND_SEARCH, portal.results(one)),
    )


def test_first_degree_decisions(first_search):
    got = rows(records.first_degree_decisions(first_search))
    assert len(got) == 2
    assert list(got[0])[1:] == at.FIRST_DECISION_COLUMNS
    assert got[0] | {"seq": 0} == {
        "seq": 0, "numero_processo": "0001-1", "classe": "Comum", "assunto": "Dados", "magistrado": "A B", "foro": None,
        "vara": None, "data_disponibilizacao": "01/02/2024", "ementa": "Texto commarca& fim",
    }
    assert set(list(got[1].values())[1:]) == {None}


@pytest.mark.parametrize("anchored", [True, False])
def test_second_degree_decisions(spark, anchored):
    blocks = [
        portal.block("1", [("Classe/Assunto:", "Apelação / Direito Civil / Contratos"), ("Relator(a):", "X"), ("Órgão julgador:", "1ª C")], "e"),
        portal.block("2", [("Classe/Assunto:", "Apelação")], "e"),
        portal.block("3", [("Classe:", "Agravo"), ("Assunto:", "Multa")], "e"),
    ]
    page = portal.captures(spark, portal.capture(1, at.SECOND_SEARCH, portal.results(*blocks, anchored=anchored)))
    got = rows(records.second_degree_decisions(page))
    assert [r["numero_processo"] for r in got] == ["1", "2", "3"]
    assert [r["classe"] for r in got] == ["Apelação", None, "Agravo"]
    # The label is cut where it ends, so nothing of "Classe/Assunto:" stays in a lone part.
    assert [r["assunto"] for r in got] == ["Direito Civil | Contratos", "Apelação", "Multa"]
    assert got[0]["relator_a"] == "X" and got[0]["orgao_julgador"] == "1ª C" and got[0]["comarca"] is None
    assert list(got[0])[1:] == at.SECOND_DECISION_COLUMNS


def test_next_page_requests(spark, first_search):
    later = portal.captures(
        spark,
        portal.capture(4, at.SECOND_SEARCH, portal.results(anchored=False, page="7")),
        portal.capture(5, at.SECOND_SEARCH, portal.results(anchored=False, page="8", more=False)),
    )
    got = rows(requests.next_page_requests(first_search.filter("seq < 3").union(later), "https://f.example.org", "https://s.example.org"))
    # Page 2 shows no number: no request and no failure.
    assert [(r["seq"], r["url"]) for r in got] == [
        (1, "https://f.example.org/trocarDePagina.do?pagina=4"),
        (4, "https://s.example.org/trocaDePagina.do?tipoDeDecisao=A&pagina=8"),
    ]
    numbers = first_search.select("seq", current_page(F.col("body"), F.col("request_kind")).alias("n"))
    assert [r["n"] for r in rows(numbers)] == [3, None, None]


@pytest.fixture(scope="module")
def cases(spark):
    return portal.captures(
        spark,
        portal.capture(1, at.FIRST_CASE, portal.FIRST_CASE, "c1"),
        portal.capture(2, at.FIRST_CASE, portal.BARE_CASE, "c2"),
        portal.capture(3, at.FIRST_CASE, portal.CASE_LIST, "c3"),
        portal.capture(4, at.SECOND_CASE, portal.SECOND_CASE, "c4"),
        portal.capture(5, at.SECOND_CASE, portal.BARE_CASE, "c5"),
        portal.capture(6, at.SECOND_CASE, portal.CASE_LIST, "c6"),
    )


def test_first_degree_case(cases):
    full, bare = rows(records.first_degree_cases(cases, BASE))
    assert list(full)[1:] == at.FIRST_CASE_COLUMNS
    assert {k: v for k, v in full.items() if v is not None} == {
        "seq": 1,
        "numero_processo": "c1",
        "situacao": "Extinto|Digital",
        "classe": "Procedimento Comum",
        "assunto": "Indenização",
        "area": "Área:Cível",
        "juiz": "Ana   Exemplo",
        "valor_acao": "R$ 1.000,00",
        "foro": "Foro Central",
        "distribuicao": "01/02/2020 às 10:00",
        "partes_processo_1_tipo_participacao": "Reqte",
        "partes_processo_1_nome_parte": "Empresa Exemplo",
        # The break before the closing tag leaves one blank lawyer.
        "partes_processo_1_advogados": "Rui Modelo|Eva Modelo|",
        # Fewer role labels than parties: the second role is null, the rest is kept.
        "partes_processo_2_nome_parte": "Outra Parte",
        "outros_assuntos": "Contratos & mais",
        "execucao_sentenca": "Inícioem curso",
        "processo_principal": "0001-1",
        "link_processo_principal": BASE + "/show.do?a=1&b=2",
        "link_consulta_sg": BASE + "/abrirConsultaProcessoSG.do?nuProcesso=1&cdProcessoSg=2&cdForoSg=3&isProcessoOrigemCr=4",
    }
    assert {k for k, v in bare.items() if v is not None} == {"seq", "numero_processo"}


def test_a_long_page_with_an_unanswered_label(spark):
    filler = "<p>texto &amp; mais</p>" * 60_000
    page = f'<div class="{at.RELATED_CONTAINER}">{filler}<b>{at.MAIN_CASE_LABEL}</b></div>{portal.FIRST_CASE}{filler}'
    captures = portal.captures(spark, portal.capture(1, at.FIRST_CASE, page, "c"))
    case = rows(records.first_degree_cases(captures, BASE))[0]
    assert case["processo_principal"] == "0001-1" and case["numero_processo_apensado"] is None
    assert len(rows(records.case_movements(captures))) == 2


def test_movements(cases):
    got = rows(records.case_movements(cases).drop("x"))
    assert [tuple(r[c] for c in at.MOVEMENT_COLUMNS) for r in got] == [
        ("c1", "02/03/2021", "Sentença", "Julgada"),
        ("c1", "01/03/2021", "Conclusos", None),
    ]


def test_second_degree_case(cases):
    full, bare = rows(records.second_degree_cases(cases))
    assert list(full)[1:] == at.SECOND_CASE_COLUMNS
    assert full["situacao"] == "Julgado" and full["classe"] == "Apelação" and full["relator_a"] == "Des. Exemplo"
    assert full["comarca"] == "Comarca de Exemplo" and full["secao"] is None
    assert bare["comarca"] is None


def test_first_instance(cases):
    full, bare = rows(records.first_instance_links(cases))
    assert full == {
        "seq": 4, "numero_processo": "2000-1", "n_processo_1_instancia": "1000-1", "tipo": "Principal", "foro": "Foro A",
        "vara": "2", "juiz": "Juiz B", "obs": None,
    }
    assert {k for k, v in bare.items() if v is not None} == {"seq"}


def test_case_lists_lead_to_follow_ups(cases):
    first = rows(requests.follow_ups(cases, at.FIRST_CASE, BASE))
    assert [(r["url"], r["meta"]) for r in first] == [(BASE + "/show.do?processo.codigo=ABC", {"numero_processo": "c3"})]
    flags = cases.select("seq", *[f.alias(n) for n, f in page_kind_flags().items()], listed_case_code(F.col("body")).alias("code"))
    assert [r["seq"] for r in flags.filter("has_case_list").orderBy("seq").collect()] == [3, 6]
    assert {r["code"] for r in flags.filter("not has_case_list").collect()} == {""}


def test_document_links_and_requests(cases):
    links = records.document_links(cases).orderBy("seq", "link_no")
    got = [r.asDict() for r in links.collect()]
    assert [(r["documento"], r["titulo"], r["descricao"], r["origem"], r["processo"]) for r in got] == [
        ("007", "Acórdão", "Negado", "R", "P&1"),
        ("7", "Outro", "", "P", "P&1"),
    ]
    urls = [r["url"] for r in requests.doc_requests(links, BASE).orderBy("seq").collect()]
    assert urls[0] == BASE + "/verificarAcessoMovimentacao.do?cdDocumento=007&origemRecurso=R&cdProcesso=P&1"


def test_viewer_pages_without_parameter_are_set_aside(spark):
    page = '<script>a</script><script>x = {"t":1,"parametros":"a=1&b=2"}</script>'
    pages = portal.captures(
        spark,
        portal.capture(1, at.DOC_VIEWER, page, "c1", documento="007"),
        portal.capture(2, at.DOC_VIEWER, "<script>none</script>", "c2"),
        portal.capture(3, at.DOC_ACCESS, "https://viewer.example.org/x", "c3", documento="8"),
    )
    good, bad = requests.pdf_requests(pages, BASE)
    assert [(r["url"], r["meta"]["documento"]) for r in good.collect()] == [(BASE + "/getPDF.do?a=1&b=2", "007")]
    assert [(r["seq"], r["reason"]) for r in bad.collect()] == [(2, "no viewer parameter")]
    hop = requests.viewer_requests(pages)[0].collect()
    assert [(r["kind"], r["url"], r["meta"]["documento"]) for r in hop] == [(at.DOC_VIEWER, "https://viewer.example.org/x", "8")]


def test_documents_from_bytes_to_records(spark):
    pages = ["um;\tdois\r\n", "'tres' ", "\"quatro\", cinco"]
    files = spark.createDataFrame([(1, "\f".join(pages).encode()), (2, b"")], "seq long, content binary")
    texts = documents.decode_pages(files, documents.utf8_pages)
    assert texts.count() == 4
    links = files.select(
        "seq", documents.document_id(F.col("content")).alias("pdf_name"), F.lit("c").alias("numero_processo"),
        F.col("seq").cast("string").alias("documento"), F.lit("t").alias("titulo"), F.lit(None).cast("string").alias("descricao"),
        F.lit("p").alias("processo"),
    )
    full, blank = rows(documents.case_documents(texts, links))
    assert list(full)[1:] == at.DOCUMENT_COLUMNS
    assert full["conteudo"] == "um dois tres quatro cinco" and blank["conteudo"] is None
    # Two documents of one case are two rows.
    assert writes.upsert(spark.createDataFrame([], documents.case_documents(texts, links).schema), documents.case_documents(texts, links), writes.DOCUMENT_KEY).count() == 2


def test_a_decoder_may_give_null_pages(spark):
    files = spark.createDataFrame([(1, b"x")], "seq long, content binary")
    texts = documents.decode_pages(files, lambda content: ["a", None, "b"])
    assert [(r["page_no"], r["text"]) for r in texts.orderBy("page_no").collect()] == [(1, "a"), (2, None), (3, "b")]


def test_a_file_the_decoder_fails_on_does_not_stop_the_rest(spark):
    files = spark.createDataFrame([(1, b"ok"), (2, b"\xff"), (3, None)], "seq long, content binary")
    good, bad = split_bad(documents.decode_pages(files, documents.utf8_pages).withColumnRenamed("reason", "why"), F.col("why"))
    assert [(r["seq"], r["text"]) for r in good.collect()] == [(1, "ok")]
    assert sorted((r["seq"], r["reason"].split(":")[0]) for r in bad.collect()) == [(2, "UnicodeDecodeError"), (3, "TypeError")]


def test_positions_too_large_for_a_place_in_the_page_stop_the_job(spark):
    block = portal.block("9", [("Classe:", "A")], "e")
    captures = portal.captures(spark, portal.capture(2**36, at.SECOND_SEARCH, portal.results(block)))
    with pytest.raises(Exception, match="(?i)overflow"):
        records.second_degree_decisions(captures).collect()


def test_cookies(spark):
    headers = [("Set-Cookie", "a=1; Path=/"), ("set-cookie", "b=x=y"), ("Set-Cookie", "a=2"), ("Date", "d=1"), ("Set-Cookie", "flag")]
    page = portal.captures(spark, portal.capture(1, at.FIRST_SEARCH, "", headers=headers))
    assert page.select(cookies(F.col("headers")).alias("c")).collect()[0]["c"] == {"a": "2", "b": "x=y"}


def test_one_bad_row_does_not_stop_the_rest(spark):
    df = spark.createDataFrame([(1, "10"), (2, "x")], "seq long, n string")
    good, bad = split_bad(df, F.when(F.col("n").try_cast("int").isNull(), "not a number"))
    assert [r["seq"] for r in good.collect()] == [1] and [r["reason"] for r in bad.collect()] == ["not a number"]


def test_search_and_case_requests(spark):
    searches = spark.createDataFrame([(1, '"a b" OU "é/2"')], "seq long, search string")
    first = requests.first_search_requests(searches, BASE, "09/02/2024").collect()[0]["url"]
    assert "pesquisaLivre=%22a%20b%22%20OU%20%22%C3%A9/2%22&" in first and "dtFim=09%2F02%2F2024&" in first
    work = spark.createDataFrame([(1, "c1"), (2, "c2"), (3, "c1")], "seq long, numero_processo string")
    once = requests.batch_requests(work, BASE).orderBy("seq").collect()
    assert [r["meta"]["numero_processo"] for r in once] == ["c1", "c2"]
    assert "valorConsulta=c1&" in once[0]["url"]
    assert "dePesquisa=c1&" in requests.case_requests(work, BASE, at.SECOND_CASE).orderBy("seq").collect()[0]["url"]


def test_a_table_inside_one_block_loses_no_other(spark):
    inner = "<table><tr><td>small</td></tr></table>"
    blocks_ = [portal.block(n, [("Classe:", f"C{n}" + (inner if n == "2" else ""))], "e") for n in "123"]
    foot = "<table><tr><td><table><tr><td>FOOT</td></tr></table></td></tr></table>"
    page = portal.results(*blocks_).replace("</body>", foot + "</body>")
    got = rows(records.first_degree_decisions(portal.captures(spark, portal.capture(1, at.FIRST_SEARCH, page))))
    assert [r["numero_processo"] for r in got if r["numero_processo"]] == ["1", "2", "3"]
    assert "FOOT" not in str(got)


def test_outer_last_div_is_the_summary(spark, evaluate):
    block = "<tr><td><div>no</div><div>parte um <div>parte dois</div> fim</div></td></tr>"
    assert evaluate(lambda x: markup.last_block_text(x, "tr", "div"), [block, "<tr><td>x</td></tr>"]) == ["parte umparte doisfim", ""]


def test_spelling_of_tags_and_attributes(spark, evaluate):
    def juiz(x):
        return markup.anchor_text(markup.prepare(x), "juizProcesso")

    pages = [
        "<DIV ID='juizProcesso'>Ana</DIV>", "<div id=juizProcesso class=x>Ana</div>", '<p data-id="juizProcesso">no</p><div id="juizProcesso">Ana</div>',
        '<div title="a > b" id = "juizProcesso" hidden>Ana</div>', '<div id="juizProcesso"><b>cargo</b> Ana</div>',
    ]
    assert evaluate(juiz, pages) == ["Ana"] * 5
    assert evaluate(lambda x: markup.attr_value(markup.prepare(x), "href"), ["<a href=\"/x?n=D'Agua\">", "<A HREF=/y>"]) == ["/x?n=D'Agua", "/y"]
    cells = evaluate(lambda x: F.array_join(markup.cells_of(markup.prepare(x)), "|"), ["<TR><td>a<td>b</tr>", "<td>a</td><td>b</td>"])
    assert cells == ["a|b", "a|b"]
    assert evaluate(lambda x: markup.tags_joined(x, "t"), ['<i class="t">a<br>b<b>no</b></i><i class="t">c</i>']) == ["a|b|c"]


def test_an_empty_block_takes_nothing_from_what_follows(spark, evaluate):
    container, label = at.RELATED_CONTAINER, at.ATTACHED_CASE_LABEL
    page = f'<div class="{container}"><span class="{at.LABEL_CLASS}">{label}</span><div></div></div><footer><div><a href="/ajuda">Ajuda</a></div></footer>'
    found = evaluate(lambda x: markup.attr_value(markup.labelled_block(x, container, at.LABEL_CLASS, label), "href"), [page])
    assert found == [""]


def test_a_table_in_a_movement_cell_ends_nothing(spark):
    def row(n, extra=""):
        return f'<tr><td class="dataMovimentacao">{n}</td><td class="descricaoMovimentacao">t{n}{extra}<span>d</span></td></tr>'

    table_ = f'<table><tbody id="{at.MOVEMENTS["table_id"]}">{row(1)}{row(2, "<table><tbody><tr><td>z</td></tr></tbody></table>")}{row(3)}</tbody></table>'
    got = rows(records.case_movements(portal.captures(spark, portal.capture(1, at.FIRST_CASE, table_, "c"))))
    assert [r["data"] for r in got if r["data"]] == ["1", "2", "3"]


def test_a_party_name_in_a_div_keeps_its_lawyers(spark, evaluate):
    cell = f'<td class="{at.PARTY_CLASS}"><div>Ana</div><br>Advogado: B<br>Advogada: C</td>'
    names = evaluate(lambda x: blocks.party_at(blocks.parties(x, at.PARTY_CLASS), 0, "advogados_parte"), [cell])
    assert names == ["B|C"]
