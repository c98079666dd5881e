"""The portal's layout and the published column contract.

Ids, class names, labels and titles are those of the captured pages; column
names and their order are those of the published tables; query strings are those
the portal understands. They are data: change them here when the pages change.
"""

from __future__ import annotations

# --- kinds of captured pages -------------------------------------------------

FIRST_SEARCH = "first_search"
SECOND_SEARCH = "second_search"
FIRST_CASE = "first_case"
SECOND_CASE = "second_case"
DOC_ACCESS = "doc_access"
DOC_VIEWER = "doc_viewer"
DOC_FILE = "doc_file"

# --- result pages ------------------------------------------------------------

RESULTS_ID = "tdResultados"
FULL_TEXT_TITLE = "Visualizar Inteiro Teor"
CLASS_LABEL = "Classe:"
SUBJECT_LABEL = "Assunto:"
CLASS_SUBJECT_LABEL = "Classe/Assunto:"
FIRST_SEARCH_LABELS = {
    "classe": "Classe:",
    "assunto": "Assunto:",
    "magistrado": "Magistrado:",
    "foro": "Foro:",
    "vara": "Vara:",
    "data_disponibilizacao": "Data de Disponibilização:",
}
SECOND_SEARCH_LABELS = {
    "relator_a": "Relator(a):",
    "orgao_julgador": "Órgão julgador:",
    "comarca": "Comarca:",
    "data_julgamento": "Data do julgamento:",
    "data_publicacao": "Data de publicação:",
}
NEXT_PAGE_MARKER = 'title="Próxima página"'
PAGER_CLASS = "trocaDePagina"
CURRENT_PAGE_STYLE = 'style="font-weight:bold;"'
CURRENT_PAGE_CLASS = "paginaAtual"

# --- case pages --------------------------------------------------------------

CASE_LIST_CLASS = "modal__lista-processos"
CASE_LIST_HEADER = "modal__lista-processos__item__header"
CASE_LIST_INPUT = "processoSelecionado"
STATUS_CLASS = "unj-tag"
FIRST_CASE_SPAN_ANCHORS = {
    "classe": "classeProcesso",
    "assunto": "assuntoProcesso",
    "valor_acao": "valorAcaoProcesso",
}
FIRST_CASE_OWN_ANCHORS = {
    "juiz": "juizProcesso",
    "foro": "foroProcesso",
    "vara": "varaProcesso",
    "distribuicao": "dataHoraDistribuicaoProcesso",
    "controle": "numeroControleProcesso",
}
AREA_ANCHOR = "areaProcesso"
ROLE_CLASSES = ["mensagemExibindo", "tipoDeParticipacao"]
PARTY_CLASS = "nomeParteEAdvogado"
LABEL_CLASS = "unj-label"
OTHER_SUBJECTS = {"container": "col-lg-2 mb-2", "label": "Outros assuntos", "value": "line-clamp__2"}
ENFORCEMENT = {"container": "col-lg-12 col-xl-13", "label": "Execução de Sentença", "value": "unj-larger"}
RELATED_CONTAINER = "col-lg-4 col-xl-3 mb-2"
MAIN_CASE_LABEL = "Processo principal"
ATTACHED_CASE_LABEL = "Apensado ao"
SECOND_DEGREE_LINK_CLASS = "linkConsultaSG"
MOVEMENTS = {
    "table_id": "tabelaTodasMovimentacoes",
    "date_class": "dataMovimentacao",
    "text_class": "descricaoMovimentacao",
}

SECOND_CASE_ANCHORS = {
    "situacao": "situacaoProcesso",
    "classe": "classeProcesso",
    "assunto": "assuntoProcesso",
    "secao": "secaoProcesso",
    "orgao_julgador": "orgaoJulgadorProcesso",
    "area": "areaProcesso",
    "relator_a": "relatorProcesso",
    "valor_acao": "valorAcaoProcesso",
}
DETAILS_ID = "maisDetalhes"
ORIGIN_LABEL = "Origem"
CASE_NUMBER_ID = "numeroProcesso"
FIRST_INSTANCE_LABEL = "Nº de 1ª instância"
DOCUMENT_LINKS = {
    "cell_class": "descricaoMovimentacaoProcesso",
    "link_class": "linkMovVincProc",
    "document_attr": "cddocumento",
    "origin_attr": "name",
    "code_input": "cdProcesso",
}
VIEWER_PARAM = "parametros"

# --- published columns -------------------------------------------------------

FIRST_DECISION_COLUMNS = [
    "numero_processo", "classe", "assunto", "magistrado", "foro", "vara", "data_disponibilizacao", "ementa",
]
SECOND_DECISION_COLUMNS = [
    "numero_processo", "classe", "assunto", "relator_a", "orgao_julgador", "comarca", "data_julgamento",
    "data_publicacao", "ementa",
]
FIRST_CASE_COLUMNS = [
    "numero_processo", "situacao", "classe", "assunto", "area", "juiz", "valor_acao", "foro", "vara",
    "distribuicao", "controle",
    "partes_processo_1_tipo_participacao", "partes_processo_1_nome_parte", "partes_processo_1_advogados",
    "partes_processo_2_tipo_participacao", "partes_processo_2_nome_parte", "partes_processo_2_advogados",
    "outros_assuntos", "execucao_sentenca", "processo_principal", "link_processo_principal",
    "numero_processo_apensado", "link_processo_apensado", "link_consulta_sg",
]
MOVEMENT_COLUMNS = ["numero_processo", "data", "titulo", "descricao"]
SECOND_CASE_COLUMNS = [
    "numero_processo", "situacao", "classe", "assunto", "secao", "orgao_julgador", "area", "relator_a",
    "valor_acao", "comarca",
]
FIRST_INSTANCE_COLUMNS = ["numero_processo", "n_processo_1_instancia", "tipo", "foro", "vara", "juiz", "obs"]
DOCUMENT_COLUMNS = ["pdf_name", "numero_processo", "documento", "titulo", "descricao", "processo", "conteudo"]

# --- request query strings ---------------------------------------------------

FIRST_SEARCH_QUERY = (
    "/pesquisar.do?conversationId=&dadosConsulta.pesquisaLivre={search}&tipoNumero=UNIFICADO"
    "&numeroDigitoAnoUnificado=&foroNumeroUnificado=&dadosConsulta.nuProcesso=&dadosConsulta.nuProcessoAntigo="
    "&classeTreeSelection.values=&classeTreeSelection.text=&assuntoTreeSelection.values=&assuntoTreeSelection.text="
    "&agenteSelectedEntitiesList=&contadoragente=0&contadorMaioragente=0&cdAgente=&nmAgente="
    "&dadosConsulta.dtInicio=&dadosConsulta.dtFim={until}&varasTreeSelection.values=&varasTreeSelection.text="
    "&dadosConsulta.ordenacao=DESC"
)
SECOND_SEARCH_QUERY = (
    "/resultadoCompleta.do?conversationId=&dados.buscaInteiroTeor={search}&dados.pesquisarComSinonimos=S"
    "&dados.pesquisarComSinonimos=S&dados.buscaEmenta=&dados.nuProcOrigem=&dados.nuRegistro="
    "&agenteSelectedEntitiesList=&contadoragente=0&contadorMaioragente=0&codigoCr=&codigoTr=&nmAgente="
    "&juizProlatorSelectedEntitiesList=&contadorjuizProlator=0&contadorMaiorjuizProlator=0&codigoJuizCr="
    "&codigoJuizTr=&nmJuiz=&classesTreeSelection.values=&classesTreeSelection.text=&assuntosTreeSelection.values="
    "&assuntosTreeSelection.text=&comarcaSelectedEntitiesList=&contadorcomarca=0&contadorMaiorcomarca=0&cdComarca="
    "&nmComarca=&secoesTreeSelection.values=&secoesTreeSelection.text=&dados.dtJulgamentoInicio="
    "&dados.dtJulgamentoFim=&dados.dtPublicacaoInicio=&dados.dtPublicacaoFim=&dados.origensSelecionadas=T"
    "&tipoDecisaoSelecionados=A&dados.ordenarPor=dtPublicacao"
)
FIRST_NEXT_PAGE = "/trocarDePagina.do?pagina={page}"
SECOND_NEXT_PAGE = "/trocaDePagina.do?tipoDeDecisao=A&pagina={page}"
ONE_CASE_QUERY = (
    "/search.do?conversationId=&cbPesquisa=NUMPROC&numeroDigitoAnoUnificado=&foroNumeroUnificado="
    "&dadosConsulta.valorConsultaNuUnificado=&dadosConsulta.valorConsultaNuUnificado=UNIFICADO"
    "&dadosConsulta.valorConsulta={case}&dadosConsulta.tipoNuProcesso=SAJ"
)
LISTED_CASE_QUERY = (
    "/search.do?conversationId=&paginaConsulta=0&cbPesquisa=NUMPROC&numeroDigitoAnoUnificado=&foroNumeroUnificado="
    "&dePesquisaNuUnificado=&dePesquisaNuUnificado=UNIFICADO&dePesquisa={case}&tipoNuProcesso=SAJ"
)
SHOW_CASE_QUERY = "/show.do?processo.codigo={code}"
DOC_ACCESS_QUERY = (
    "/verificarAcessoMovimentacao.do?cdDocumento={document}&origemRecurso={origin}&cdProcesso={process}"
)
DOC_FILE_QUERY = "/getPDF.do?{parameters}"
