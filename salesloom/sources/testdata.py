"""The TPC-H-like parquet tables as canonical tables of a run.

Only expressions and key joins; each table is built when a query asks for it
and reads just the columns that query needs.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.context import Ctx, Store
from salesloom.functions import columns as C
from salesloom.operators.rank import survivor_map
from salesloom.plans import conform, silver
from salesloom.plans.features import scoring_set, training_set
from salesloom.sources.manifest import EXTRACTS

AS_OF = dt.date(2001, 8, 2)
TRAIN_AS_OF = dt.date(2001, 7, 25)
EVENT_SHIFT_DAYS = 8218  # January 2024 -> July 2001, where the orders end


def _read(ctx: Ctx, sf_dir: str, name: str) -> DataFrame:
    return ctx.spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _date_plus(start: str, days: Column) -> Column:
    return F.date_add(F.lit(start).cast("date"), days.cast("int"))


def _br_or_iso(date: Column, key: str) -> Column:
    """Text in one of the two formats, every 101st unreadable."""
    return (
        F.when(F.col(key) % 101 == 0, F.lit("31/02/2024"))
        .when(F.col(key) % 2 == 0, F.date_format(date, "dd/MM/yyyy"))
        .otherwise(F.date_format(date, "yyyy-MM-dd"))
    )


def raw_customers(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """Customers as dirty text with the place they are in."""
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    return raw_identities(customer).join(
        places, F.col("_nation") == F.col("n_nationkey"), "left"
    ).select(
        "cliente_id", "cnpj", "razao_social", "data_cadastro", "ativo", "segmento",
        F.col("n_name").alias("cidade"), F.col("r_name").alias("uf"),
        F.lit(None).cast("string").alias("bairro"),
    )


def raw_identities(customer: DataFrame) -> DataFrame:
    """Shared, punctuated and blank tax ids, mixed dates.

    Every key divisible by 50 takes the tax id of its successor.
    """
    key = F.col("c_custkey")
    digits = (
        F.lit(10_000_000_000) + key + F.when(key % 50 == 0, 1).otherwise(0)
    ).cast("string")
    dotted = F.concat(
        F.lit(" "), F.substring(digits, 1, 2), F.lit("."), F.substring(digits, 3, 3), F.lit("."),
        F.substring(digits, 6, 3), F.lit("/"), F.substring(digits, 9, 3), F.lit(" "),
    )
    tax_id = F.when(key % 97 == 5, F.lit(" - ")).when(key % 3 == 0, dotted).otherwise(digits)
    return customer.select(
        key.alias("cliente_id"), tax_id.alias("cnpj"),
        F.concat(F.lit("  "), F.upper(F.regexp_replace("c_name", "#", "   ")), F.lit(" "))
        .alias("razao_social"),
        _br_or_iso(_date_plus("1994-01-01", key * 7 % 365), "c_custkey").alias("data_cadastro"),
        F.when(key % 10 == 3, "N").when(key % 10 == 4, F.lit(None)).otherwise(" S").alias("ativo"),
        F.col("c_mktsegment").alias("segmento"), F.col("c_nationkey").alias("_nation"),
    )


def products(part: DataFrame) -> DataFrame:
    price = F.col("p_retailprice").cast("decimal(12,2)")
    key = F.col("p_partkey")
    note = F.when(F.col("p_size") <= 15, "light").when(F.col("p_size") <= 35, "medium")
    return part.select(
        key.alias("sku"), F.col("p_name").alias("name"), F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"), note.otherwise("heavy").alias("scent_note"),
        price.alias("list_price"), price.alias("unit_cost"), F.lit("UN").alias("unit"),
        F.when(key % 6 == 0, _date_plus("1996-01-01", key * 37 % 2030)).alias("launch_date"),
        (key % 10 != 0).alias("active"),
    )


def sellers(supplier: DataFrame, nation: DataFrame) -> DataFrame:
    key = F.col("s_suppkey")
    target = F.col("s_acctbal").cast("decimal(12,2)")
    return supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left").select(
        key.alias("seller_id"), F.col("s_name").alias("name"), F.col("n_name").alias("region"),
        F.col("n_regionkey").cast("string").alias("state"),
        F.lit("1994-01-01").cast("date").alias("hired_on"),
        F.when(key % 7 == 0, F.lit("2001-06-30").cast("date")).alias("left_on"),
        F.when(target > 0, target).alias("monthly_target"),
    )


def orders(orders: DataFrame) -> DataFrame:
    date = F.col("o_orderdate").cast("date")
    cancelled = F.col("o_orderstatus") == "P"
    total = F.col("o_totalprice").cast("decimal(18,2)")
    return orders.select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
        date.alias("order_date"), F.year(date).alias("year"), F.month(date).alias("month"),
        F.col("o_orderpriority").alias("channel"), F.col("o_orderstatus").alias("status"),
        cancelled.alias("cancelled"), total.alias("total_value"),
        C.net_value(total, cancelled).cast("decimal(18,2)").alias("net_value"),
    )


def items(lineitem: DataFrame) -> DataFrame:
    """Order lines with the seller on the line; flag R is a return."""
    is_return = F.col("l_returnflag") == "R"
    sign = F.when(is_return, -1).otherwise(1)
    gross = F.col("l_extendedprice").cast("decimal(12,2)")
    discount = F.col("l_discount").cast("decimal(6,2)")
    net = (gross * (F.lit(1).cast("decimal(6,2)") - discount)).cast("decimal(18,4)")
    quantity = F.col("l_quantity").cast("int")
    return lineitem.select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("sku"),
        F.col("l_suppkey").alias("seller_id"), is_return.alias("is_return"),
        (sign * quantity).alias("quantity"), quantity.alias("quantity_abs"),
        gross.alias("gross_value"), (discount * 100).cast("decimal(6,2)").alias("discount_pct"),
        (net / F.nullif(quantity, F.lit(0))).cast("decimal(12,2)").alias("unit_price"),
        (sign * net).cast("decimal(18,4)").alias("revenue"),
    )


def payments(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """One payment per line: due when shipped, paid when ordered, tax as the fee."""
    amount = F.col("l_extendedprice").cast("decimal(12,2)")
    fee = F.col("l_tax").cast("decimal(6,2)")
    return lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_orderkey").alias("order_id"), F.col("o_orderpriority").alias("method"),
        amount.alias("amount"), (fee * 100).cast("decimal(6,2)").alias("fee_pct"),
        (amount * (F.lit(1).cast("decimal(6,2)") - fee)).cast("decimal(18,4)").alias("net_amount"),
        F.col("l_shipdate").cast("date").alias("due_on"),
        F.when(F.col("l_linestatus") == "F", F.col("o_orderdate").cast("date")).alias("paid_on"),
        F.when(F.col("l_linestatus") == "F", C.PAID_STATUS).otherwise("Aberto").alias("status"),
    )


def stock(events: DataFrame) -> DataFrame:
    """Stock per SKU and day: the last event of the day counts."""
    balance = F.floor("value").cast("int")
    return events.groupBy(
        F.col("user_id").alias("sku"), F.to_date("ts").alias("snapshot_on")
    ).agg(F.max_by(balance, "event_id").alias("balance")).select(
        F.date_format("snapshot_on", "dd/MM/yyyy").alias("snapshot_text"), "snapshot_on", "sku",
        "balance", (F.col("balance") == 0).alias("stock_out"),
    )


def _shifted_day() -> Column:
    return F.date_sub(F.to_date("ts"), EVENT_SHIFT_DAYS)


def raw_opportunities(events: DataFrame) -> DataFrame:
    """Opportunities under the stage names of the source."""
    kind = F.col("event_type")
    stage = (
        F.when(kind == "purchase", "Fechado ganho").when(kind == "error", "Fechado perdido")
        .when(kind == "view", "Proposta").otherwise("Negociacao")
    )
    closed = kind.isin("purchase", "error")
    return events.select(
        F.col("event_id").alias("opportunity_id"), F.col("user_id").alias("customer_id"),
        _shifted_day().alias("opened_on"), stage.alias("stage"),
        F.col("value").cast("decimal(18,2)").alias("estimated_value"),
        F.when(closed, F.date_add(_shifted_day(), (F.col("event_id") % 10).cast("int")))
        .alias("closed_on"),
    )


def opportunities(events: DataFrame) -> DataFrame:
    return raw_opportunities(events).withColumn("stage", C.map_values("stage", C.STAGE_NAMES))


def visits(events: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    return events.select(
        F.col("event_id").alias("visit_id"), F.col("user_id").alias("customer_id"),
        _shifted_day().alias("visited_on"),
        F.when(kind == "purchase", "Fez PEDIDO").when(kind == "click", "Promete pedido")
        .otherwise("Sem interesse").alias("outcome"),
    )


def raw_assignments(customer: DataFrame, supplier: DataFrame) -> DataFrame:
    """Customers to sellers: mostly one open row; some closed, doubled or unknown."""
    key = F.col("c_custkey")
    count = supplier.agg(F.count(F.lit(1))).scalar()
    first = F.struct(
        F.lit(0).alias("slot"),
        F.when(key % 17 == 0, F.col("_n") + key % 5).otherwise(key % F.col("_n")).alias("seller"),
        F.when(key % 11 == 0, F.lit("1999-12-31").cast("date")).alias("ended_on"),
    )
    second = F.when(key % 13 == 0, F.struct(
        F.lit(1).alias("slot"), ((key + 1) % F.col("_n")).alias("seller"),
        F.lit(None).cast("date").alias("ended_on"),
    ))
    return customer.withColumn("_n", count).select(
        "c_custkey", F.inline(F.array_compact(F.array(first, second)))
    ).select(
        (F.col("c_custkey") * 2 + F.col("slot")).alias("assignment_id"),
        F.col("c_custkey").alias("customer_id"), F.col("seller").alias("seller_id"),
        _date_plus("1995-01-01", F.col("c_custkey") % 365 + F.col("slot") * 400)
        .alias("started_on"), "ended_on",
    )


def raw_feedback(events: DataFrame) -> DataFrame:
    """Call outcomes by event type; sign-ups carry a status that is not allowed."""
    kind = F.col("event_type")
    status = (
        F.when(kind == "purchase", "vendeu").when(kind == "view", "vai_pensar")
        .when(kind == "error", "sem_interesse").when(kind == "click", "nao_atendeu")
        .otherwise("talvez")
    )
    comment = F.when(F.col("event_id") % 40 == 0, F.repeat(F.lit("x"), 501)).otherwise(
        F.get_json_object("props", "$.k")
    )
    return events.select(
        "event_id", F.col("user_id").cast("string").alias("customer_id"),
        F.concat(F.lit("seller "), (F.col("event_id") % 7).cast("string")).alias("seller"),
        status.alias("status"), comment.alias("comment"),
        (F.col("ts") - F.expr(f"INTERVAL {EVENT_SHIFT_DAYS} DAYS")).alias("recorded_at"),
        F.lit(None).cast("string").alias("reference"),
    )


def extracts(ctx: Ctx) -> dict[str, DataFrame]:
    """The tables as the ten text extracts a delivery consists of.

    Order totals are made to agree with the lines, registration dates to parse.
    """
    def br(c: str) -> Column:
        return F.date_format(c, "dd/MM/yyyy")

    def name(**columns: str | Column) -> list[Column]:
        return [(F.col(c) if isinstance(c, str) else c).cast("string").alias(n)
                for n, c in columns.items()]

    none = F.lit(None).cast("string")
    lines = ctx["items"].withColumn("line_value", F.col("quantity") * F.col("unit_price"))
    totals = lines.groupBy("order_id").agg(F.sum("line_value").alias("lines_total"))
    sellers_of = lines.groupBy("order_id").agg(F.min("seller_id").alias("seller_id"))
    status = F.when(F.col("cancelled"), C.CANCELLED_STATUS).otherwise("Faturado")
    active = F.when(F.col("active"), C.YES).otherwise("N")
    raw = ctx["raw.customers"]
    return {
        "clientes": raw.select(*[F.col(c).cast("string") for c in raw.columns]).withColumn(
            "data_cadastro", F.date_format(
                _date_plus("1994-01-01", F.col("cliente_id").cast("bigint") % 365), "dd/MM/yyyy")),
        "vendedores": ctx["sellers"].select(*name(
            vendedor_id="seller_id", nome="name", regiao="region", uf="state",
            data_admissao="hired_on", data_desligamento="left_on", meta_mensal="monthly_target")),
        "produtos": ctx["products"].select(*name(
            sku="sku", descricao="name", categoria="category", marca="brand",
            nota_olfativa="scent_note", preco_tabela="list_price", custo_unitario="unit_cost",
            unidade="unit", ativo=active, data_lancamento="launch_date")),
        "pedidos": ctx["orders"].join(totals, "order_id", "left").join(
            sellers_of, "order_id", "left").select(*name(
                pedido_id="order_id", cliente_id="customer_id", vendedor_id="seller_id",
                data_pedido=br("order_date"), canal="channel", status=status,
                valor_total=C.default("lines_total", 0))),
        "itens_pedido": lines.select(*name(
            item_id=F.monotonically_increasing_id(), pedido_id="order_id", sku="sku",
            quantidade="quantity", valor_bruto="gross_value", desconto_pct="discount_pct",
            preco_praticado="unit_price")),
        "pagamentos": ctx["payments"].select(*name(
            pagamento_id=F.monotonically_increasing_id(), pedido_id="order_id",
            forma_pagamento="method", parcelas=F.lit(1), valor="amount",
            valor_liquido="net_amount", taxa_pct="fee_pct", data_vencimento=br("due_on"),
            data_pagamento="paid_on", status_pagamento="status")),
        "estoque": ctx["stock"].select(*name(
            data_snapshot="snapshot_text", sku="sku", saldo="balance")),
        "carteira": ctx["raw.assignments"].select(*name(
            carteira_id="assignment_id", cliente_id="customer_id", vendedor_id="seller_id",
            data_inicio=br("started_on"), data_fim=br("ended_on"))),
        "oportunidades": ctx["raw.opportunities"].select(*name(
            oportunidade_id="opportunity_id", cliente_id="customer_id", vendedor_id=none,
            origem=none, data_abertura="opened_on", data_fechamento=br("closed_on"),
            etapa="stage", probabilidade_pct=F.lit(50), ciclo_dias=F.lit(7),
            valor_estimado="estimated_value", motivo_perda=none)),
        "visitas": ctx["visits"].select(*name(
            visita_id="visit_id", cliente_id="customer_id", vendedor_id=none,
            data_visita=br("visited_on"), resultado="outcome", duracao_min=F.lit(30))),
    }


def deliver(ctx: Ctx, root: str, only: Sequence[str] | None = None) -> None:
    """Write the extracts below ``root`` as folders of part files, each with a header."""
    write_extracts(extracts(ctx), root, only)


def write_extracts(
    made: Mapping[str, DataFrame], root: str, only: Sequence[str] | None = None
) -> None:
    for system, names in EXTRACTS.items():
        for name in names:
            if only is None or name in only:
                made[name].write.mode("overwrite").option("header", "true").option(
                    "escape", '"').csv(f"{root}/{system}/{name}.csv")


def context(
    spark: SparkSession, sf_dir: str, as_of: dt.date = AS_OF, train_as_of: dt.date = TRAIN_AS_OF,
    stored: bool = True,
) -> Ctx:
    """All canonical tables over ``sf_dir``.

    The fact is a written table by default, partitioned as it would be in
    production; ``stored=False`` leaves it a plan over the source tables.
    """
    def src(name):
        return lambda c: _read(c, sf_dir, name)

    def fact(c: Ctx) -> DataFrame:
        if not stored:
            return conform.sales_fact(c)
        return c.store.table(
            "sales_fact", lambda: conform.sales_fact(c), conform.FACT_PARTITIONS
        )

    def raw_customers_of(c: Ctx) -> DataFrame:
        return raw_customers(c["src.customer"], c["src.nation"], c["src.region"])

    def customer_map(c: Ctx) -> DataFrame:
        rows = silver.standardise_identities(raw_identities(c["src.customer"])).select(
            silver.identity_key().alias("_identity"), "customer_id", "registered_on"
        )
        return survivor_map(rows, ["_identity"], silver.survivor_order(), "customer_id")

    def survivors_of(c: Ctx) -> DataFrame:
        # c_custkey is a primary key
        return silver.clean_customers(c["raw.customers"], ids_unique=True)

    names = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
    tables = {f"src.{n}": src(n) for n in names}
    tables |= {
        "raw.customers": raw_customers_of,
        "raw.opportunities": lambda c: raw_opportunities(c["src.events"]),
        "raw.assignments": lambda c: raw_assignments(c["src.customer"], c["src.supplier"]),
        "raw.feedback": lambda c: raw_feedback(c["src.events"]),
        "customers": lambda c: c.store.table("customers", lambda: survivors_of(c)),
        "customer_map": customer_map,
        "products": lambda c: products(c["src.part"]),
        "sellers": lambda c: sellers(c["src.supplier"], c["src.nation"]),
        "orders": lambda c: orders(c["src.orders"]),
        "items": lambda c: items(c["src.lineitem"]),
        "payments": lambda c: payments(c["src.lineitem"], c["src.orders"]),
        "stock": lambda c: stock(c["src.events"]),
        "opportunities": lambda c: opportunities(c["src.events"]),
        "visits": lambda c: visits(c["src.events"]),
        "assignments": lambda c: silver.assignment_state(c["raw.assignments"], c["sellers"]),
        "fact": fact,
        "features.train": lambda c: c.store.table("features_train", lambda: training_set(c)),
        "features.score": lambda c: c.store.table("features_score", lambda: scoring_set(c)),
    }
    return Ctx(spark, tables, as_of, train_as_of, Store(spark, sf_dir))
