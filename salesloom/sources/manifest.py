"""The files a delivery has to contain."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

# fixed values: extracts per source system, <name>.csv each
EXTRACTS: Mapping[str, Sequence[str]] = {
    "erp": ("produtos", "pedidos", "itens_pedido", "pagamentos", "estoque"),
    "crm": ("clientes", "vendedores", "carteira", "oportunidades", "visitas"),
}

# fixed values: columns the cleaning stage reads from each extract
COLUMNS: Mapping[str, Sequence[str]] = {
    "produtos": ("sku", "descricao", "categoria", "marca", "nota_olfativa", "preco_tabela",
                 "custo_unitario", "unidade", "ativo", "data_lancamento"),
    "pedidos": ("pedido_id", "cliente_id", "vendedor_id", "data_pedido", "canal", "status",
                "valor_total"),
    "itens_pedido": ("item_id", "pedido_id", "sku", "quantidade", "valor_bruto", "desconto_pct",
                     "preco_praticado"),
    "pagamentos": ("pagamento_id", "pedido_id", "forma_pagamento", "parcelas", "valor",
                   "valor_liquido", "taxa_pct", "data_vencimento", "data_pagamento",
                   "status_pagamento"),
    "estoque": ("data_snapshot", "sku", "saldo"),
    "clientes": ("cliente_id", "cnpj", "razao_social", "data_cadastro", "ativo", "segmento",
                 "cidade", "uf", "bairro"),
    "vendedores": ("vendedor_id", "nome", "regiao", "uf", "data_admissao", "data_desligamento",
                   "meta_mensal"),
    "carteira": ("carteira_id", "cliente_id", "vendedor_id", "data_inicio", "data_fim"),
    "oportunidades": ("oportunidade_id", "cliente_id", "vendedor_id", "origem", "data_abertura",
                      "data_fechamento", "etapa", "probabilidade_pct", "ciclo_dias",
                      "valor_estimado", "motivo_perda"),
    "visitas": ("visita_id", "cliente_id", "vendedor_id", "data_visita", "resultado",
                "duracao_min"),
}


def manifest(spark: SparkSession, extracts: Mapping[str, Sequence[str]] = EXTRACTS) -> DataFrame:
    """The expected files as rows (system, file)."""
    return spark.createDataFrame(
        [(system, f"{name}.csv") for system, names in extracts.items() for name in names],
        "system string, file string",
    )
