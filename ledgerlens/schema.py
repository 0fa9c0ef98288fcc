"""Table schemas and the column sets each classifier reads."""

from __future__ import annotations

from pyspark.sql import types as T

# The display names of the source columns, in source order.
SOURCE_HEADERS = [
    "Exercício do orçamento (Ano)",
    "Órgão (Código/Nome)",
    "Órgão Sucessor Atual (Código/Nome)",
    "Tipo Administração (Nome)",
    "Tipo Poder (Nome)",
    "Classificação orçamentária (Descrição)",
    "Função (Cod/Nome)",
    "Subfunção (Cod/Nome)",
    "Programa (Cod/Nome)",
    "Ação (Cod/Nome)",
    "Natureza Despesa (Cod)",
    "Natureza Despesa (Nome)",
    "Grupo Despesa (Cod/Nome)",
    "Elemento Despesa (Cod/Nome)",
    "Formalidade (Nome)",
    "Modalidade Licitação (Nome)",
    "Fonte Recurso (Cod)",
    "Fonte Recurso (Nome)",
    "Beneficiário (Nome)",
    "Beneficiário (CPF)",
    "Beneficiário (CNPJ)",
    "Beneficiário (CPF/CNPJ)",
    "Período (Dia/Mes/Ano)",
    "Empenho (Sequencial Empenho)",
    "Empenho (Histórico)",
    "Empenho (Número do Processo)",
    "Valor Empenhado",
    "Valor Anulação Empenho",
    "Valor Estorno Anulação Empenho",
    "Valor Cancelamento Empenho",
    "Valor Anulação Cancelamento Empenho",
    "Valor Liquidação Empenho",
    "Valor Anulação Liquidacao Empenho",
    "Valor Ordem de Pagamento",
    "Valor Guia Recolhimento",
    "Valor Anulação Ordem de Pagamento",
    "Valor Estorno Anulação O. Pagamento",
    "Valor Estorno Guia Recolhimento",
    "Valor Saldo do Empenho",
    "Valor Saldo Liquidado",
    "Valor Saldo Pago",
    "Valor Saldo a Pagar",
    "Valor a Liquidar",
    "Valor a Pagar Liquidado",
]

ID = "empenho_sequencial_empenho"
CODE = "natureza_despesa_cod"
BALANCE = "valor_saldo_do_empenho"
PROCESS = "empenho_numero_do_processo"
PERIOD = "periodo"
YEAR = "exercicio_do_orcamento_ano"
ORGAN = "orgao"
SUCCESSOR = "orgao_sucessor_atual"
HISTORY = "empenho_historico"
CPF = "beneficiario_cpf"
CNPJ = "beneficiario_cnpj"
CPF_CNPJ = "beneficiario_cpf/cnpj"
VERDICT = "analise"

VERDICTS = ["OK", "INCONCLUSIVO", "INCORRETO"]

# The categorical columns of each classifier, in source order, before the derived
# flags replace some of them. The order is that of the stacked features.
CODE_CATEGORIES = [
    "orgao",
    "orgao_sucessor_atual",
    "tipo_administracao_nome",
    "tipo_poder_nome",
    "funcao",
    "subfuncao",
    "programa",
    "acao",
    "modalidade_licitacao_nome",
    "fonte_recurso_nome",
    "beneficiario_cnpj",
    "beneficiario_cpf",
    "beneficiario_cpf/cnpj",
    "periodo",
    "empenho_numero_do_processo",
]
VERDICT_CATEGORIES = [
    "orgao",
    "orgao_sucessor_atual",
    "tipo_administracao_nome",
    "tipo_poder_nome",
    "funcao",
    "subfuncao",
    "programa",
    "acao",
    "grupo_despesa",
    "natureza_despesa_cod",
    "modalidade_licitacao_nome",
    "fonte_recurso_nome",
    "beneficiario_cnpj",
    "beneficiario_cpf",
    "beneficiario_cpf/cnpj",
    "periodo",
]
ANOMALY_CATEGORIES = [
    *CODE_CATEGORIES, "grupo_despesa", "elemento_despesa", CODE,
    "natureza_despesa_nome", "formalidade_nome",
]

AMOUNTS = [
    "valor_empenhado", "valor_anulacao_empenho", "valor_cancelamento_empenho", BALANCE,
    "valor_liquidacao_empenho", "valor_anulacao_liquidacao_empenho", "valor_saldo_liquidado",
    "valor_ordem_de_pagamento", "valor_guia_recolhimento", "valor_anulacao_ordem_de_pagamento",
    "valor_estorno_anulacao_o_pagamento", "valor_estorno_guia_recolhimento",
    "valor_saldo_pago", "valor_saldo_a_pagar", "valor_a_liquidar", "valor_a_pagar_liquidado",
]

COLUMN_SETS = {
    "code": [*CODE_CATEGORIES, HISTORY, *AMOUNTS],
    "correctness": [*VERDICT_CATEGORIES, HISTORY, *AMOUNTS],
    "anomaly": [*ANOMALY_CATEGORIES, HISTORY, *AMOUNTS],
    "text": [HISTORY, CODE],
}


def commitment_schema() -> T.StructType:
    """Schema of a commitment table whose headers were already normalised."""
    from ledgerlens.functions.names import normalise_name

    def kind(name: str) -> T.DataType:
        if name == YEAR:
            return T.IntegerType()
        return T.DoubleType() if name.startswith("valor_") else T.StringType()

    names = [normalise_name(header) for header in SOURCE_HEADERS]
    return T.StructType([T.StructField(name, kind(name)) for name in names])


RESULT_COLUMNS = [
    "Identificador", "Natureza Real", "Natureza Predita", "Corretude",
    "Data Predicao", "Resultado",
]
