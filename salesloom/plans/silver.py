"""Raw text extracts -> typed, deduplicated canonical tables.

The raw tables carry the column names of the extracts; every column is text.
Ids stay as they come (text), the canonical tables only fix names and types.
Casts never abort: text that is no number becomes NULL, and
``conversion_losses`` reports how much of it there was.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.functions import columns as C
from salesloom.operators.contracts import Check
from salesloom.operators.rank import survivors

CUSTOMER_CHECKS = (
    Check("tax_id_length", f"length(tax_id) = {C.TAX_ID_WIDTH}"),
    Check("registered_on_present", "registered_on IS NOT NULL"),
)
ORDER_CHECKS = (
    Check("order_date_present", "order_date IS NOT NULL"),
    Check("cancelled_has_no_value", "NOT cancelled OR net_value = 0"),
)
ITEM_CHECKS = (Check("quantity_positive", "quantity_abs > 0"),)


def _text(c: str) -> Column:
    return F.col(c)


def _identity_columns() -> list[Column]:
    return [
        _text("cliente_id").alias("customer_id"),
        C.normalise_tax_id("cnpj").alias("tax_id"),
        C.tax_id_valid("cnpj").alias("tax_id_valid"),
        C.normalise_name("razao_social").alias("name"),
        C.parse_date("data_cadastro").alias("registered_on"),
        C.flag("ativo").alias("active"),
    ]


def standardise_identities(raw: DataFrame) -> DataFrame:
    """Only what tells customers apart, typed."""
    return raw.select(*_identity_columns())


def standardise_customers(raw: DataFrame) -> DataFrame:
    """Typed customers, duplicates still in."""
    return raw.select(
        *_identity_columns(),
        _text("segmento").alias("segment"), _text("cidade").alias("city"),
        _text("uf").alias("state"), _text("bairro").alias("district"),
    )


def identity_key() -> Column:
    """What makes two customer rows the same: a valid tax id, else only their own id."""
    return F.when(F.col("tax_id_valid"), F.col("tax_id")).otherwise(
        F.concat(F.lit("id:"), F.col("customer_id").cast("string"))
    )


def survivor_order() -> list[Column]:
    """The oldest registration survives, the smaller id on a tie."""
    return [F.col("registered_on").asc_nulls_last(), F.col("customer_id").asc()]


def clean_customers(raw: DataFrame, ids_unique: bool = False) -> DataFrame:
    """One row per tax id; rows without a valid one are never merged.

    With ``ids_unique`` the second pass over customer ids is left out.
    """
    rows = standardise_customers(raw).withColumn("_identity", identity_key())
    if not ids_unique:
        rows = survivors(rows, ["customer_id"], [*survivor_order(), F.col("_identity")])
    return survivors(rows, ["_identity"], survivor_order()).drop("_identity")


def clean_products(raw: DataFrame) -> DataFrame:
    return raw.select(
        _text("sku"), _text("descricao").alias("name"), _text("categoria").alias("category"),
        _text("marca").alias("brand"), _text("nota_olfativa").alias("scent_note"),
        C.try_number("preco_tabela", "decimal(12,2)").alias("list_price"),
        C.try_number("custo_unitario", "decimal(12,2)").alias("unit_cost"),
        _text("unidade").alias("unit"), C.parse_date("data_lancamento").alias("launch_date"),
        C.flag("ativo").alias("active"),
    )


def clean_sellers(raw: DataFrame) -> DataFrame:
    return raw.select(
        _text("vendedor_id").alias("seller_id"), _text("nome").alias("name"),
        _text("regiao").alias("region"), _text("uf").alias("state"),
        C.parse_date("data_admissao").alias("hired_on"),
        C.parse_date("data_desligamento").alias("left_on"),
        C.try_number("meta_mensal", "decimal(12,2)").alias("monthly_target"),
    )


def clean_orders(raw: DataFrame) -> DataFrame:
    date = C.parse_date("data_pedido")
    total = C.try_number("valor_total", "decimal(18,2)")
    cancelled = C.flag("status", C.CANCELLED_STATUS)
    return raw.select(
        _text("pedido_id").alias("order_id"), _text("cliente_id").alias("customer_id"),
        _text("vendedor_id").alias("seller_id"), date.alias("order_date"),
        F.year(date).alias("year"), F.month(date).alias("month"), _text("canal").alias("channel"),
        F.trim("status").alias("status"), cancelled.alias("cancelled"),
        total.alias("total_value"),
        C.net_value(total, cancelled).cast("decimal(18,2)").alias("net_value"),
    )


def clean_items(raw: DataFrame) -> DataFrame:
    """Order lines; negative quantities are returns and stay in."""
    quantity = C.try_number("quantidade", "int")
    price = C.try_number("preco_praticado", "decimal(12,2)")
    return raw.select(
        _text("item_id"), _text("pedido_id").alias("order_id"), _text("sku"),
        C.default(quantity < 0, False).alias("is_return"),
        quantity.alias("quantity"), F.abs(quantity).alias("quantity_abs"),
        C.try_number("valor_bruto", "decimal(12,2)").alias("gross_value"),
        C.try_number("desconto_pct", "decimal(6,2)").alias("discount_pct"),
        price.alias("unit_price"), (quantity * price).alias("revenue"),
    )


def flag_discontinued(items: DataFrame, products: DataFrame) -> DataFrame:
    """A line is discontinued when its product is unknown or inactive."""
    known = products.select("sku", F.col("active").alias("_active"))
    return items.join(known, "sku", "left").withColumn(
        "discontinued", ~C.default("_active", False)
    ).drop("_active")


def clean_payments(raw: DataFrame) -> DataFrame:
    return raw.select(
        _text("pagamento_id").alias("payment_id"), _text("pedido_id").alias("order_id"),
        _text("forma_pagamento").alias("method"),
        C.try_number("parcelas", "int").alias("installments"),
        C.try_number("valor", "decimal(12,2)").alias("amount"),
        C.try_number("taxa_pct", "decimal(6,2)").alias("fee_pct"),
        C.try_number("valor_liquido", "decimal(12,2)").alias("net_amount"),
        C.parse_date("data_vencimento").alias("due_on"),
        C.parse_date("data_pagamento").alias("paid_on"),
        _text("status_pagamento").alias("status"),
    )


def clean_stock(raw: DataFrame) -> DataFrame:
    """Snapshots; the stock-out flag of the source is not trusted but recomputed."""
    balance = C.try_number("saldo", "int")
    return raw.select(
        _text("data_snapshot").alias("snapshot_text"),
        C.parse_date("data_snapshot").alias("snapshot_on"), _text("sku"),
        balance.alias("balance"), C.default(balance == 0, False).alias("stock_out"),
    )


def clean_assignments(raw: DataFrame, sellers: DataFrame) -> DataFrame:
    return assignment_state(
        raw.select(
            _text("carteira_id").alias("assignment_id"), _text("cliente_id").alias("customer_id"),
            _text("vendedor_id").alias("seller_id"),
            C.parse_date("data_inicio").alias("started_on"),
            C.parse_date("data_fim").alias("ended_on"),
            F.col("data_fim").isNull().alias("is_open"),
        ),
        sellers,
    )


def assignment_state(assignments: DataFrame, sellers: DataFrame) -> DataFrame:
    """Current: open and the seller still there.  Orphaned: open, seller gone.

    Open means that no end is recorded, also not one that does not parse
    (``is_open`` when the input has it).  A seller missing from ``sellers``
    counts as present, which ``seller_known`` lets a reader tell apart.
    """
    is_open = F.col("is_open") if "is_open" in assignments.columns else F.col("ended_on").isNull()
    state = sellers.select("seller_id", "left_on", F.lit(True).alias("_known"))
    return assignments.join(state, "seller_id", "left").select(
        "assignment_id", "customer_id", "seller_id", "started_on", "ended_on",
        (is_open & F.col("left_on").isNull()).alias("current"),
        (is_open & F.col("left_on").isNotNull()).alias("orphaned"),
        C.default("_known", False).alias("seller_known"),
    )


def clean_opportunities(raw: DataFrame) -> DataFrame:
    return raw.select(
        _text("oportunidade_id").alias("opportunity_id"), _text("cliente_id").alias("customer_id"),
        _text("vendedor_id").alias("seller_id"), _text("origem").alias("origin"),
        C.parse_date("data_abertura").alias("opened_on"),
        C.map_values("etapa", C.STAGE_NAMES).alias("stage"),
        C.try_number("probabilidade_pct", "int").alias("probability_pct"),
        C.try_number("valor_estimado", "decimal(18,2)").alias("estimated_value"),
        C.parse_date("data_fechamento").alias("closed_on"),
        C.try_number("ciclo_dias", "int").alias("cycle_days"),
        _text("motivo_perda").alias("loss_reason"),
    )


def clean_visits(raw: DataFrame) -> DataFrame:
    return raw.select(
        _text("visita_id").alias("visit_id"), _text("cliente_id").alias("customer_id"),
        _text("vendedor_id").alias("seller_id"), C.parse_date("data_visita").alias("visited_on"),
        _text("resultado").alias("outcome"),
        C.try_number("duracao_min", "int").alias("duration_minutes"),
    )


def stamp(df: DataFrame, source: DataFrame) -> DataFrame:
    """Add when a row was processed and how many rows the source had."""
    return df.withColumns({
        "_processed_at": F.current_timestamp(),
        "_source_rows": source.agg(F.count(F.lit(1))).scalar(),
    })


def conversion_losses(raw: DataFrame, typed: Mapping[str, Column]) -> DataFrame:
    """Per column: filled in the text, and lost when typed; one pass over ``raw``.

    ``typed`` maps a raw column to the expression that types it.
    """
    names: Sequence[str] = list(typed)
    filled = [F.coalesce(F.trim(F.col(c)) != "", F.lit(False)) for c in names]
    counts = raw.agg(*[
        agg for c, has in zip(names, filled)
        for agg in (F.count_if(has).alias(f"{c}__filled"),
                    F.count_if(has & typed[c].isNull()).alias(f"{c}__lost"))
    ])
    rows = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"{c}__filled").alias("filled"),
                 F.col(f"{c}__lost").alias("lost"))
        for c in names
    ])
    return counts.select(F.inline(rows))


def typed_columns() -> dict[str, dict[str, Column]]:
    """Of each extract the columns that are typed, and how."""
    dates = {
        "produtos": ["data_lancamento"], "pedidos": ["data_pedido"],
        "pagamentos": ["data_vencimento", "data_pagamento"], "estoque": ["data_snapshot"],
        "clientes": ["data_cadastro"], "vendedores": ["data_admissao", "data_desligamento"],
        "carteira": ["data_inicio", "data_fim"], "visitas": ["data_visita"],
        "oportunidades": ["data_abertura", "data_fechamento"],
    }
    numbers = {
        "produtos": {"preco_tabela": "decimal(12,2)", "custo_unitario": "decimal(12,2)"},
        "pedidos": {"valor_total": "decimal(18,2)"},
        "itens_pedido": {"quantidade": "int", "valor_bruto": "decimal(12,2)",
                         "desconto_pct": "decimal(6,2)", "preco_praticado": "decimal(12,2)"},
        "pagamentos": {"parcelas": "int", "valor": "decimal(12,2)", "taxa_pct": "decimal(6,2)",
                       "valor_liquido": "decimal(12,2)"},
        "estoque": {"saldo": "int"}, "vendedores": {"meta_mensal": "decimal(12,2)"},
        "oportunidades": {"probabilidade_pct": "int", "valor_estimado": "decimal(18,2)",
                          "ciclo_dias": "int"},
        "visitas": {"duracao_min": "int"},
    }
    typed: dict[str, dict[str, Column]] = {}
    for name, columns in dates.items():
        typed.setdefault(name, {}).update({c: C.parse_date(c) for c in columns})
    for name, kinds in numbers.items():
        typed.setdefault(name, {}).update({c: C.try_number(c, k) for c, k in kinds.items()})
    typed["clientes"]["cnpj"] = F.nullif(C.tax_id_digits("cnpj"), F.lit(""))
    return typed


CLEANERS = {
    "produtos": ("products", clean_products),
    "pedidos": ("orders", clean_orders),
    "itens_pedido": ("items", clean_items),
    "pagamentos": ("payments", clean_payments),
    "estoque": ("stock", clean_stock),
    "clientes": ("customers", clean_customers),
    "vendedores": ("sellers", clean_sellers),
    "oportunidades": ("opportunities", clean_opportunities),
    "visitas": ("visits", clean_visits),
}
