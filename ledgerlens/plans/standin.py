"""Commitments stand-in: one row per order, derived from the star-schema test tables.

Column definitions are SQL expressions, so the same text serves Spark and the DuckDB checks; the
few expressions whose spelling differs between the two are given twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.sources.scan import spread

CODE_SQL = """'3.' || substr(o_orderpriority, 1, 1) || '.90.'
 || case when o_orderkey % 20 = 0 then '92' else cast(30 + c_nationkey % 5 as string) end || '.'
 || case when o_orderkey % 2 = 0 then '01' when o_orderkey % 3 = 0 then '02'
         when o_orderkey % 7 = 0 then '03' when o_orderkey % 101 = 0 then '04' else '05' end"""
CPF_SQL = "case when c_mktsegment = 'BUILDING' then '-' else lpad(cast(o_custkey as string), 11, '0') end"
CNPJ_SQL = "case when c_mktsegment = 'BUILDING' then lpad(cast(o_custkey as string), 14, '0') else '-' end"

# name -> (expression, tables needed besides orders)
COLUMNS: dict[str, tuple[str, str]] = {
    "exercicio_do_orcamento_ano": ("cast(year(o_orderdate) as int)", ""),
    "orgao": ("n_name", "customer nation"),
    "orgao_sucessor_atual": (
        "case when n_nationkey % 5 = 0 then 'NATION_' || cast((n_nationkey + 1) % 25 as string) "
        "else n_name end", "customer nation"),
    "tipo_administracao_nome": ("r_name", "customer nation region"),
    "tipo_poder_nome": ("o_orderstatus", ""),
    "classificacao_orcamentaria_descricao": ("c_mktsegment || '/' || o_orderstatus", "customer"),
    "funcao": ("c_mktsegment", "customer"),
    "subfuncao": ("c_mktsegment || '-' || o_orderstatus", "customer"),
    "programa": (
        "cast(1000 + o_custkey % 10 as string) || ' - PROGRAMA ' || cast(o_custkey % 3 as string)",
        ""),
    "acao": (
        "cast(2000 + o_custkey % 77 as string) || ' - ACAO ' || cast(o_custkey % 7 as string)", ""),
    "natureza_despesa_cod": (CODE_SQL, "customer"),
    "natureza_despesa_nome": (f"'NATUREZA ' || {CODE_SQL}", "customer"),
    "grupo_despesa": (f"substr({CODE_SQL}, 1, 3)", "customer"),
    "elemento_despesa": (f"substr({CODE_SQL}, 8, 2)", "customer"),
    "formalidade_nome": ("o_orderpriority", ""),
    "modalidade_licitacao_nome": ("c_mktsegment", "customer"),
    "fonte_recurso_cod": ("cast(n_nationkey as string)", "customer nation"),
    "fonte_recurso_nome": ("n_name", "customer nation"),
    "beneficiario_nome": ("c_name", "customer"),
    "beneficiario_cpf": (CPF_SQL, "customer"),
    "beneficiario_cnpj": (CNPJ_SQL, "customer"),
    "beneficiario_cpf/cnpj": (
        "case when c_mktsegment = 'BUILDING' then lpad(cast(o_custkey as string), 14, '0') "
        "else lpad(cast(o_custkey as string), 11, '0') end", "customer"),
    "periodo": ("date_format(o_orderdate, 'yyyy/MM/dd')", ""),
    "empenho_sequencial_empenho": ("cast(o_orderkey as string)", ""),
    "empenho_historico": ("text", "documents"),
    "empenho_numero_do_processo": ("cast(o_custkey as string)", ""),
    "valor_empenhado": ("o_totalprice", ""),
    "valor_anulacao_empenho": ("cast(coalesce(discounted, 0) as double) / 100", "lineitem"),
    "valor_estorno_anulacao_empenho": ("cast(0 as double)", ""),
    "valor_cancelamento_empenho": ("cast(0 as double)", ""),
    "valor_anulacao_cancelamento_empenho": ("cast(0 as double)", ""),
    "valor_liquidacao_empenho": ("cast(coalesce(extended, 0) as double) / 100", "lineitem"),
    "valor_anulacao_liquidacao_empenho": ("cast(0 as double)", ""),
    "valor_ordem_de_pagamento": ("o_totalprice / 2", ""),
    "valor_guia_recolhimento": ("cast(coalesce(taxed, 0) as double) / 100", "lineitem"),
    "valor_anulacao_ordem_de_pagamento": ("cast(0 as double)", ""),
    "valor_estorno_anulacao_o_pagamento": ("cast(0 as double)", ""),
    "valor_estorno_guia_recolhimento": ("cast(0 as double)", ""),
    "valor_saldo_do_empenho": (
        "case when o_orderkey % 11 = 0 then cast(0 as double) "
        "when o_orderkey % 13 = 0 then -o_totalprice else o_totalprice end", ""),
    "valor_saldo_liquidado": ("o_totalprice / 4", ""),
    "valor_saldo_pago": ("o_totalprice / 8", ""),
    "valor_saldo_a_pagar": ("cast(0 as double)", ""),
    "valor_a_liquidar": ("cast(o_custkey % 100 as double)", ""),
    "valor_a_pagar_liquidado": ("cast(o_custkey % 7 as double)", ""),
    # Not source columns, but handy for the checks.
    "order_key": ("o_orderkey", ""),
    "customer_key": ("o_custkey", ""),
    "order_date": ("cast(o_orderdate as date)", ""),
    "doc_id": ("doc_id", "documents"),
}
DUCKDB_SPELLING = {"periodo": "strftime(o_orderdate, '%Y/%m/%d')"}

ITEM_TOTALS = """select l_orderkey,
    cast(sum(cast(round(l_extendedprice * 100) as bigint)) as bigint) as extended,
    cast(sum(cast(round(l_extendedprice * l_discount * 100) as bigint)) as bigint) as discounted,
    cast(sum(cast(round(l_extendedprice * l_tax * 100) as bigint)) as bigint) as taxed
  from lineitem group by l_orderkey"""


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _needed(names: tuple[str, ...]) -> set[str]:
    return {table for name in names for table in COLUMNS[name][1].split()}


def commitments(spark: SparkSession, sf_dir: str, *names: str) -> DataFrame:
    """The named columns (all source columns if none is named), joining only what they need."""
    names = names or tuple(list(COLUMNS)[:44])
    needed = _needed(names)
    rows = read(spark, sf_dir, "orders")
    if "documents" in needed:
        rows = spread(rows, "o_orderkey")
    if "customer" in needed:
        rows = rows.join(read(spark, sf_dir, "customer"), F.expr("o_custkey = c_custkey"))
    if "nation" in needed:
        rows = rows.join(read(spark, sf_dir, "nation"), F.expr("c_nationkey = n_nationkey"))
    if "region" in needed:
        rows = rows.join(read(spark, sf_dir, "region"), F.expr("n_regionkey = r_regionkey"))
    if "lineitem" in needed:
        items = read(spark, sf_dir, "lineitem")

        def cents(amount: str):
            return F.sum(F.expr(f"cast(round({amount} * 100) as bigint)"))

        totals = items.groupBy("l_orderkey").agg(
            cents("l_extendedprice").alias("extended"),
            cents("l_extendedprice * l_discount").alias("discounted"),
            cents("l_extendedprice * l_tax").alias("taxed"))
        rows = rows.join(totals, F.expr("l_orderkey = o_orderkey"), "left")
    if "documents" in needed:
        # Last, so that no later join shuffles a text once for each of its rows.
        documents = read(spark, sf_dir, "documents").select("doc_id", "text")
        rows = rows.join(documents, F.expr(f"doc_id = o_orderkey % {documents.count()}"))
    return rows.select(*[F.expr(COLUMNS[name][0]).alias(name) for name in names])


def commitments_sql(*names: str) -> str:
    """The same view as a DuckDB query."""
    names = names or tuple(list(COLUMNS)[:44])
    needed = _needed(names)
    joins = ["orders"]
    if "customer" in needed:
        joins.append("join customer on o_custkey = c_custkey")
    if "nation" in needed:
        joins.append("join nation on c_nationkey = n_nationkey")
    if "region" in needed:
        joins.append("join region on n_regionkey = r_regionkey")
    if "documents" in needed:
        joins.append("join (select doc_id, text from documents) d "
                     "on doc_id = o_orderkey % (select count(*) from documents)")
    if "lineitem" in needed:
        joins.append(f"left join ({ITEM_TOTALS}) i on l_orderkey = o_orderkey")
    columns = [f'{DUCKDB_SPELLING.get(n, COLUMNS[n][0])} as "{n}"' for n in names]
    return f"select {', '.join(columns)} from {' '.join(joins)}"


def expired_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = commitments(spark, sf_dir, "natureza_despesa_cod").distinct()
    return codes.where("natureza_despesa_cod like '3.5.%.05'").select(
        F.col("natureza_despesa_cod").alias("nat_despesa"))


EXPIRED_SQL = ("select distinct natureza_despesa_cod as nat_despesa from commitments "
               "where natureza_despesa_cod like '3.5.%.05'")

ANALISE_SQL = ("case when toxic = 1 then 'INCORRETO' when quality = 1 then 'OK' "
               "else 'INCONCLUSIVO' end")


def validated(spark: SparkSession, sf_dir: str, *names: str) -> DataFrame:
    """Commitments whose document carries expert labels, with the verdict ``analise``."""
    rows = commitments(spark, sf_dir, *dict.fromkeys([*(names or list(COLUMNS)[:44]), "doc_id"]))
    labels = read(spark, sf_dir, "labels").select(
        "doc_id", F.expr(ANALISE_SQL).alias("analise"))
    return rows.join(labels, "doc_id").drop(*({"doc_id"} - set(names)))


# Given predictions: deterministic stand-ins for the two classifiers.
PREDICTED_SQL = ("case when order_key % 4 = 0 then substr(natureza_despesa_cod, 1, 10) || '02' "
                 "else natureza_despesa_cod end")
VERDICT_SQL = ("case when customer_key % 3 = 0 then 'OK' when customer_key % 3 = 1 "
               "then 'INCONCLUSIVO' else 'INCORRETO' end")


def given_predictions(rows: DataFrame) -> DataFrame:
    return rows.withColumns({
        "predicted": F.expr(PREDICTED_SQL), "verdict": F.expr(VERDICT_SQL)})
