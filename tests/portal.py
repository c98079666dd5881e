"""Invented portal pages, one or more per kind of capture."""

from __future__ import annotations

from docketry.plans import layouts as at
from docketry.sources.captures import CAPTURE_SCHEMA


def capture(seq, kind, body, case=None, headers=None, **meta):
    context = {"numero_processo": case, **meta} if case else meta
    return (seq, kind, f"https://portal.example.org/{seq}", context, headers, body, seq)


def captures(spark, *rows):
    return spark.createDataFrame(list(rows), CAPTURE_SCHEMA)


def block(number, labelled, summary):
    rows = "".join(f"<tr><td><strong>{label}</strong>\n  {value}</td></tr>" for label, value in labelled)
    link = f'<a href="#" title="{at.FULL_TEXT_TITLE}">\n {number} </a>' if number is not None else ""
    return f"<table><tr><td>{link}</td></tr>{rows}<tr><td><div>Ementa: curta</div><div>{summary}</div></td></tr></table>"


def results(*blocks, anchored=True, page="3", more=True):
    outer = "<table>" + "".join(f"<tr><td>{b}</td></tr>" for b in blocks) + "</table>"
    following = f'<a {at.NEXT_PAGE_MARKER} href="#">&gt;</a>' if more else ""
    if not anchored:
        pager = f'<div class="{at.PAGER_CLASS}"><span class="{at.CURRENT_PAGE_CLASS}"> {page} </span>{following}</div>'
        return f"{outer}{pager}"
    pager = f'<div class="{at.PAGER_CLASS}"><span {at.CURRENT_PAGE_STYLE}> {page} </span>{following}</div>'
    menu = "<table><tr><td><table><tr><td>menu</td></tr></table></td></tr></table>"
    return f'<html>{menu}<!-- {outer} -->{pager}<table><tr><td id="{at.RESULTS_ID}">{outer}</td></tr></table></html>'


FIRST_CASE = """<html><script>var x = "<span id='classeProcesso'>no</span>";</script>
<span class="unj-tag">Extinto</span> <span class="x unj-tag">Digital</span> <span class="unj-tagged">no</span>
<div id="classeProcesso"> <span title="c">
   Procedimento&nbsp;Comum </span></div>
<span id="assuntoProcesso" title="x">Indeniza&ccedil;&atilde;o</span>
<div id="areaProcesso"><span>&Aacute;rea:</span> C&iacute;vel </div>
<div id="juizProcesso">  Ana   Exemplo </div>
<div id="valorAcaoProcesso"><span>R$    1.000,00
  </span></div>
<div id="foroProcesso">Foro Central</div><div id="varaProcesso"></div>
<div id="dataHoraDistribuicaoProcesso">01/02/2020 &agrave;s 10:00</div>
<table>
<tr><td><span class="mensagemExibindo tipoDeParticipacao">Reqte&nbsp;</span></td>
<td class="nomeParteEAdvogado" width="141">
	Empresa Exemplo<br/>
	<span class="mensagemExibindo">Advogado:&nbsp;</span>
	Rui Modelo<br />
	<span class="mensagemExibindo">Advogada:&nbsp;</span>Eva Modelo<br>
</td></tr>
<tr><td class="nomeParteEAdvogado">Outra Parte</td></tr>
<tr><td class="nomeParteEAdvogado">Terceira</td></tr>
</table>
<div class="col-lg-2 mb-2"><span class="unj-label">Foro</span><div class="line-clamp__2"><span>no</span></div></div>
<div class="col-lg-2 mb-2"><span class="unj-label">Outros assuntos</span><div class="line-clamp__2"><span title="t">Contratos &amp; mais</span></div></div>
<div class="col-lg-12 col-xl-13"><span class="unj-label">Execução de Sentença</span><div><span class="unj-larger a"> Início (2020) em curso </span></div></div>
<div class="row col-lg-4 col-xl-3 mb-2"><span class="unj-label">Processo principal</span><div><a class="p" href="/show.do?a=1&amp;b=2">0001-1</a></div></div>
<div class="row col-lg-4 col-xl-3 mb-2"><span class="unj-label">Apensado ao</span><div></div></div>
<div><span class="unj-label">Outro</span><a href="/z">0009-9</a></div>
<a class="linkConsultaSG btn" href="/abrir.do?nuProcesso=1&amp;cdProcessoSg=2&amp;cdForoSg=3&amp;isProcessoOrigemCr=4">2</a>
<table><tbody id="tabelaTodasMovimentacoes">
<tr><td class="dataMovimentacao"> 02/03/2021 </td><td></td><td class="descricaoMovimentacao"><a href="#d"> Senten&ccedil;a </a><br><span style="x"> Julgada </span></td></tr>
<tr><td class="dataMovimentacao">01/03/2021</td><td></td><td class="descricaoMovimentacao">
  Conclusos<br><span></span></td></tr>
</tbody></table><table><tr><td class="dataMovimentacao">no</td></tr></table></html>"""

BARE_CASE = "<html><div id='x'></div></html>"

CASE_LIST = """<div class="modal modal__lista-processos"><div class="modal__lista-processos__item__header">
<input type="radio" value="ABC" class="r" id="processoSelecionado"></div>
<div class="modal__lista-processos__item__header"><input id="processoSelecionado" value="DEF"></div></div>"""

SECOND_CASE = """<html><span id="numeroProcesso"> 2000-1 </span><div id="situacaoProcesso">Julgado</div>
<div id="classeProcesso"><span>Apelação</span></div><div id="relatorProcesso"><span> Des. Exemplo </span></div>
<div id="maisDetalhes"><div><span class="unj-label">Outro</span><div><span>no</span></div></div>
<div><span class="unj-label">Origem</span><div><div><span>Comarca de Exemplo</span></div></div></div></div>
<input name="cdProcesso" type="hidden" value="P&amp;1">
<table><tr><td class="x descricaoMovimentacaoProcesso"><a cddocumento="007" class="linkMovVincProc" name="R" href="#"> Acórdão </a><br><span> Negado </span></td></tr>
<tr><td class="descricaoMovimentacaoProcesso"><a class="linkMovVincProc" cddocumento="7" name="P">Outro</a></td></tr>
<tr><td class="descricaoMovimentacaoProcesso"><a class="other" cddocumento="8" name="P">Não</a></td></tr></table>
<table><tr><th>Nº de 1ª instância</th></tr></table>
<br><table><tr><th>h</th></tr><tr><td> 1000-1 <b>(Principal)</b></td><td>Foro A</td><td> 2 </td><td>Juiz B</td><td></td></tr></table></html>"""
