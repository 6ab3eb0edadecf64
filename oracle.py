"""The registered queries in plain SQL for DuckDB, written apart from the package.

Each query names the common tables it needs; ``sql`` puts their definitions,
and those they depend on, in front of it.
"""

from __future__ import annotations

AS_OF = "DATE '2001-08-02'"
TRAIN = "DATE '2001-07-25'"

# name -> (tables it reads, definition)
COMMON: dict[str, tuple[tuple[str, ...], str]] = {
    "c_rawcust": ((), """
        SELECT c_custkey AS customer_id,
               CASE WHEN c_custkey % 97 = 5 THEN '' ELSE CAST(10000000000 + c_custkey
                 + CASE WHEN c_custkey % 50 = 0 THEN 1 ELSE 0 END AS VARCHAR) END AS digits,
               replace(c_name, '#', ' ') AS name,
               CASE WHEN c_custkey % 101 = 0 THEN NULL
                    ELSE DATE '1994-01-01' + CAST(c_custkey * 7 % 365 AS INTEGER) END
                 AS registered_on,
               c_custkey % 10 NOT IN (3, 4) AS active,
               c_mktsegment AS segment, n_name AS city, r_name AS state
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
             LEFT JOIN region ON n_regionkey = r_regionkey"""),
    "c_identity": (("c_rawcust",), """
        SELECT *, lpad(digits, 14, '0') AS tax_id, digits <> '' AS tax_id_valid,
               CASE WHEN digits <> '' THEN lpad(digits, 14, '0')
                    ELSE 'id:' || CAST(customer_id AS VARCHAR) END AS identity
        FROM c_rawcust"""),
    "c_customers": (("c_identity",), """
        SELECT * FROM c_identity QUALIFY row_number() OVER (
          PARTITION BY identity ORDER BY registered_on ASC NULLS LAST, customer_id) = 1"""),
    "c_products": ((), """
        SELECT p_partkey AS sku, p_name AS name, p_type AS category, p_brand AS brand,
               CASE WHEN p_size <= 15 THEN 'light' WHEN p_size <= 35 THEN 'medium'
                    ELSE 'heavy' END AS scent_note,
               CAST(p_retailprice AS DECIMAL(12,2)) AS unit_cost,
               CASE WHEN p_partkey % 6 = 0
                    THEN DATE '1996-01-01' + CAST(p_partkey * 37 % 2030 AS INTEGER) END
                 AS launch_date,
               p_partkey % 10 <> 0 AS active
        FROM part"""),
    "c_sellers": ((), """
        SELECT s_suppkey AS seller_id, s_name AS name, n_name AS region,
               CAST(n_regionkey AS VARCHAR) AS state,
               CASE WHEN s_suppkey % 7 = 0 THEN DATE '2001-06-30' END AS left_on,
               CASE WHEN s_acctbal > 0 THEN CAST(s_acctbal AS DECIMAL(12,2)) END AS monthly_target
        FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey"""),
    "c_orders": ((), """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id,
               CAST(o_orderdate AS DATE) AS order_date, o_orderpriority AS channel,
               o_orderstatus = 'P' AS cancelled,
               CASE WHEN o_orderstatus = 'P' THEN 0
                    ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS net_value
        FROM orders"""),
    "c_lines": ((), """
        SELECT l_orderkey AS order_id, l_partkey AS sku, l_suppkey AS seller_id,
               l_returnflag = 'R' AS is_return,
               CAST(CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS INTEGER)
                 AS quantity,
               CAST(CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END
                 * CAST(l_extendedprice AS DECIMAL(12,2))
                 * (1 - CAST(l_discount AS DECIMAL(6,2))) AS DECIMAL(18,4)) AS revenue,
               -- net value by units, rounded half up in whole numbers
               CAST((2 * CAST(10000 * CAST(l_extendedprice AS DECIMAL(12,2))
                        * (1 - CAST(l_discount AS DECIMAL(6,2))) AS BIGINT) + 100 * CAST(l_quantity AS BIGINT))
                    // nullif(200 * CAST(l_quantity AS BIGINT), 0) AS DOUBLE) / 100 AS unit_price
        FROM lineitem"""),
    "c_fact": (("c_lines", "c_orders", "c_customers", "c_products"), """
        SELECT o.order_date, CAST(year(o.order_date) AS BIGINT) AS year,
               CAST(month(o.order_date) AS BIGINT) AS month, o.channel, l.order_id, l.seller_id,
               o.customer_id, c.name AS customer_name, c.segment, c.city, c.state, l.sku,
               p.category, p.brand, p.scent_note, p.launch_date, l.quantity, l.unit_price, l.revenue, l.is_return,
               CAST(l.quantity * abs(p.unit_cost) AS DECIMAL(18,2)) AS cost,
               CAST(l.revenue - CAST(l.quantity * abs(p.unit_cost) AS DECIMAL(18,2))
                 AS DECIMAL(18,4)) AS margin
        FROM c_lines l JOIN c_orders o ON o.order_id = l.order_id
             JOIN c_customers c ON c.customer_id = o.customer_id
             JOIN c_products p ON p.sku = l.sku
        WHERE NOT o.cancelled"""),
    "c_sold": (("c_fact",), "SELECT * FROM c_fact WHERE NOT is_return"),
    "c_dimcust": (("c_customers", "c_orders"), f"""
        SELECT c.customer_id, c.name, c.tax_id, c.segment, c.city, c.state,
               c.registered_on, min(o.order_date) AS first_order, max(o.order_date) AS last_order,
               CAST(count(o.order_id) AS BIGINT) AS order_count,
               coalesce(sum(o.net_value), 0) AS net_revenue,
               date_diff('day', max(o.order_date), {AS_OF}) AS days_since_order,
               c.active AS customer_active
        FROM c_customers c LEFT JOIN c_orders o ON o.customer_id = c.customer_id
        GROUP BY ALL"""),
    "c_payments": ((), """
        SELECT o_orderpriority AS method, CAST(l_extendedprice AS DECIMAL(12,2)) AS amount,
               CAST(l_tax AS DECIMAL(6,2)) * 100 AS fee_pct,
               CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_tax AS DECIMAL(6,2)))
                 AS DECIMAL(18,4)) AS net_amount,
               CAST(l_shipdate AS DATE) AS due_on, l_linestatus = 'F' AS paid,
               CAST(o_orderdate AS DATE) AS paid_on
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""),
    "c_stock": ((), """
        SELECT user_id AS sku, CAST(ts AS DATE) AS snapshot_on,
               CAST(floor(arg_max(value, event_id)) AS BIGINT) AS balance
        FROM events GROUP BY 1, 2"""),
    "c_crm": ((), """
        SELECT event_id, user_id AS customer_id, event_type,
               CAST(ts AS DATE) - 8218 AS day,
               CASE WHEN event_type IN ('purchase', 'error')
                    THEN CAST(ts AS DATE) - 8218 + CAST(event_id % 10 AS INTEGER) END AS closed_on
        FROM events"""),
    "c_assignments": (("c_sellers",), """
        SELECT a.*, a.ended_on IS NULL AND s.left_on IS NULL AS current,
               a.ended_on IS NULL AND s.left_on IS NOT NULL AS orphaned,
               s.seller_id IS NOT NULL AS seller_known
        FROM (
          SELECT c_custkey * 2 AS assignment_id, c_custkey AS customer_id,
                 CASE WHEN c_custkey % 17 = 0 THEN n + c_custkey % 5 ELSE c_custkey % n END
                   AS seller_id,
                 DATE '1995-01-01' + CAST(c_custkey % 365 AS INTEGER) AS started_on,
                 CASE WHEN c_custkey % 11 = 0 THEN DATE '1999-12-31' END AS ended_on
          FROM customer, (SELECT count(*) AS n FROM supplier)
          UNION ALL
          SELECT c_custkey * 2 + 1, c_custkey, (c_custkey + 1) % n,
                 DATE '1995-01-01' + CAST(c_custkey % 365 + 400 AS INTEGER), NULL
          FROM customer, (SELECT count(*) AS n FROM supplier) WHERE c_custkey % 13 = 0
        ) a LEFT JOIN c_sellers s ON s.seller_id = a.seller_id"""),
    "c_abc": (("c_fact",), """
        WITH totals AS (SELECT sku, sum(revenue) AS total FROM c_fact GROUP BY sku),
             run AS (SELECT sku, total,
                            CAST(sum(total) OVER (ORDER BY total DESC) AS DOUBLE)
                            / nullif(CAST(sum(total) OVER () AS DOUBLE), 0) AS running_share
                     FROM totals)
        SELECT *, CASE WHEN running_share <= 0.80 THEN 'A' WHEN running_share <= 0.95 THEN 'B'
                       ELSE 'C' END AS abc_class FROM run"""),
}


def _features(name: str, cut: str) -> None:
    """Register the 20 features at one cut date as common table ``name``."""
    COMMON[f"{name}_s"] = (("c_fact",), f"SELECT * FROM c_fact WHERE order_date < {cut}")
    COMMON[f"{name}_rfm"] = ((f"{name}_s",), f"""
        SELECT customer_id, CAST(date_diff('day', max(order_date), {cut}) AS DOUBLE)
                 AS recency_days,
               CAST(count(DISTINCT order_id) AS DOUBLE) AS order_frequency,
               CAST(sum(revenue) AS DOUBLE) AS total_value,
               CAST(sum(margin) AS DOUBLE) AS total_margin,
               CAST(count(DISTINCT sku) AS DOUBLE) AS distinct_skus,
               CAST(count(DISTINCT category) AS DOUBLE) AS distinct_categories,
               CAST(count(DISTINCT brand) AS DOUBLE) AS distinct_brands,
               CAST(count(DISTINCT CASE WHEN order_date >= {cut} - 90 THEN order_id END) AS DOUBLE)
                 AS orders_90d
        FROM {name}_s GROUP BY customer_id""")
    COMMON[f"{name}_gap"] = ((f"{name}_s",), f"""
        SELECT customer_id, avg(gap) AS mean_gap_days, stddev_pop(gap) AS gap_stddev_days
        FROM (SELECT customer_id, CAST(date_diff('day', lag(order_date) OVER (
                PARTITION BY customer_id ORDER BY order_date), order_date) AS DOUBLE) AS gap
              FROM (SELECT DISTINCT customer_id, order_date FROM {name}_s))
        WHERE gap IS NOT NULL GROUP BY customer_id""")
    COMMON[f"{name}_mix"] = ((f"{name}_s", "c_products"), f"""
        SELECT b.customer_id, CAST(max(b.revenue) AS DOUBLE) AS top_brand_revenue,
               max(CASE WHEN l.customer_id IS NULL THEN 0 ELSE 1 END) AS bought_launch
        FROM (SELECT customer_id, brand, sum(revenue) AS revenue FROM {name}_s GROUP BY ALL) b
             LEFT JOIN (SELECT DISTINCT s.customer_id FROM {name}_s s JOIN c_products p
                        ON p.sku = s.sku AND p.launch_date >= {cut} - 120
                           AND p.launch_date < {cut}) l ON l.customer_id = b.customer_id
        GROUP BY b.customer_id""")
    COMMON[f"{name}_crm"] = (("c_crm",), f"""
        SELECT customer_id, count(*) AS n,
               count(*) FILTER (WHERE event_type = 'purchase' AND closed_on < {cut}) AS won,
               count(*) FILTER (WHERE closed_on IS NULL OR closed_on >= {cut}) AS open
        FROM c_crm WHERE day < {cut} GROUP BY customer_id""")
    COMMON[f"{name}_vis"] = (("c_crm",), f"""
        SELECT customer_id, count(*) AS n,
               count(*) FILTER (WHERE event_type IN ('purchase', 'click')) AS ordered
        FROM c_crm WHERE day < {cut} AND day >= {cut} - 90 GROUP BY customer_id""")
    COMMON[name] = (tuple(f"{name}_{p}" for p in ("rfm", "gap", "mix", "crm", "vis")), f"""
        SELECT r.customer_id, r.recency_days, r.order_frequency, r.total_value,
               r.total_value / nullif(r.order_frequency, 0) AS avg_ticket, r.total_margin,
               r.total_margin / nullif(r.total_value, 0) AS margin_share, g.mean_gap_days,
               g.gap_stddev_days,
               CASE WHEN g.mean_gap_days > 0 THEN least(r.recency_days / g.mean_gap_days, 10.0) END
                 AS relative_delay, r.orders_90d,
               CAST(coalesce(c.open, 0) AS DOUBLE) AS open_opportunities,
               CAST(coalesce(c.won, 0) AS DOUBLE) AS won_opportunities,
               coalesce(CAST(c.won AS DOUBLE) / c.n, 0) AS win_rate,
               CAST(coalesce(v.n, 0) AS DOUBLE) AS visits_90d,
               coalesce(CAST(v.ordered AS DOUBLE) / v.n, 0) AS visit_conversion,
               r.distinct_skus, r.distinct_categories, r.distinct_brands,
               m.top_brand_revenue / nullif(r.total_value, 0) AS top_brand_share,
               CAST(m.bought_launch AS DOUBLE) AS bought_launch
        FROM {name}_rfm r LEFT JOIN {name}_gap g USING (customer_id)
             LEFT JOIN {name}_mix m USING (customer_id)
             LEFT JOIN {name}_crm c USING (customer_id)
             LEFT JOIN {name}_vis v USING (customer_id)""")


_features("c_train", TRAIN)
_features("c_score", AS_OF)


def sql(body: str, *needs: str) -> str:
    """``body`` with the definitions of ``needs`` and what they build on."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name not in order:
            for dep in COMMON[name][0]:
                visit(dep)
            order.append(name)

    for name in needs:
        visit(name)
    if not order:
        return body
    defined = "WITH " + ",\n".join(f"{n} AS ({COMMON[n][1]})" for n in order)
    own = body.strip()  # a body may bring common tables of its own
    return defined + (",\n" + own[4:] if own.startswith("WITH") else "\n" + own)


def half_up(num: str, den: str, scale: int, digits: int) -> str:
    """num / den * scale rounded half up in whole numbers; both have at most 4 decimals."""
    n = f"CAST(({num}) * 10000 AS HUGEINT) * {scale * 10 ** digits}"
    d = f"CAST(({den}) * 10000 AS HUGEINT)"
    return (
        f"CASE WHEN ({den}) IS NOT NULL AND ({den}) <> 0 THEN "
        f"CAST(sign({n}) * sign({d}) * ((2 * abs({n}) + abs({d})) // (2 * abs({d}))) AS DOUBLE)"
        f" / {10 ** digits} END"
    )


def money(x: str) -> str:
    return f"CAST(round({x}, 2) AS DOUBLE)"


def check(name: str, observed: str, low: object, high: object) -> str:
    return (
        f"SELECT '{name}' AS \"check\", CAST(o AS DOUBLE) AS observed, "
        f"CAST({low} AS DOUBLE) AS low, CAST({high} AS DOUBLE) AS high, "
        f"coalesce(o BETWEEN {low} AND {high}, false) AS passed FROM (SELECT {observed} AS o)"
    )


FEATURE_DIGITS = {"gap_stddev_days": 6}  # the others are rounded to 9
GROUPS = {
    "feat_rfm": ("recency_days", "order_frequency", "total_value", "avg_ticket", "total_margin",
                 "margin_share"),
    "feat_rhythm": ("mean_gap_days", "gap_stddev_days", "relative_delay", "orders_90d"),
    "feat_crm": ("open_opportunities", "won_opportunities", "win_rate", "visits_90d",
                 "visit_conversion"),
    "feat_mix": ("distinct_skus", "distinct_categories", "distinct_brands", "top_brand_share",
                 "bought_launch"),
}


def features_of(table: str, names: tuple[str, ...]) -> str:
    picked = ", ".join(f"round({n}, {FEATURE_DIGITS.get(n, 9)}) AS {n}" for n in names)
    return sql(f"SELECT customer_id, {picked} FROM {table}", table)


# of each extract: where its rows are, and of each typed column when it is filled and when lost
ALWAYS, NEVER = "true", "false"
TYPED = [
    ("produtos", "part", [
        ("data_lancamento", "p_partkey % 6 = 0", NEVER), ("preco_tabela", ALWAYS, "p_partkey % 40 = 3"),
        ("custo_unitario", ALWAYS, NEVER)]),
    ("pedidos", "orders", [("data_pedido", ALWAYS, NEVER), ("valor_total", ALWAYS, NEVER)]),
    ("itens_pedido", "lineitem", [
        ("quantidade", ALWAYS, NEVER), ("valor_bruto", ALWAYS, NEVER), ("desconto_pct", ALWAYS, NEVER),
        ("preco_praticado", ALWAYS, "l_orderkey % 100 = 7")]),
    ("pagamentos", "lineitem JOIN orders ON l_orderkey = o_orderkey", [
        ("data_vencimento", ALWAYS, NEVER), ("data_pagamento", "l_linestatus = 'F'", NEVER),
        ("parcelas", ALWAYS, NEVER), ("valor", ALWAYS, NEVER),
        ("taxa_pct", ALWAYS, "l_orderkey % 60 = 4"), ("valor_liquido", ALWAYS, NEVER)]),
    ("estoque", "c_stock", [("data_snapshot", ALWAYS, NEVER), ("saldo", ALWAYS, "sku % 20 = 1")]),
    ("clientes", "c_rawcust", [
        ("data_cadastro", ALWAYS, "registered_on IS NULL"), ("cnpj", ALWAYS, "digits = ''")]),
    ("vendedores", "c_sellers", [
        ("data_admissao", ALWAYS, NEVER), ("data_desligamento", "left_on IS NOT NULL", NEVER),
        ("meta_mensal", "monthly_target IS NOT NULL", NEVER)]),
    ("carteira", "c_assignments", [
        ("data_inicio", ALWAYS, NEVER), ("data_fim", "ended_on IS NOT NULL", NEVER)]),
    ("visitas", "events", [("data_visita", ALWAYS, NEVER), ("duracao_min", ALWAYS, NEVER)]),
    ("oportunidades", "c_crm", [
        ("data_abertura", ALWAYS, NEVER), ("data_fechamento", "closed_on IS NOT NULL", NEVER),
        ("probabilidade_pct", ALWAYS, NEVER), ("valor_estimado", ALWAYS, "event_id % 30 = 5"),
        ("ciclo_dias", ALWAYS, NEVER)]),
]
# rows of each extract of a delivery
EXTRACT_ROWS = {
    "produtos": "SELECT count(*) FROM part", "pedidos": "SELECT count(*) FROM orders",
    "itens_pedido": "SELECT count(*) FROM lineitem",
    "pagamentos": "SELECT count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey",
    "estoque": "SELECT count(DISTINCT (user_id, CAST(ts AS DATE))) FROM events",
    "clientes": "SELECT count(*) FROM customer", "vendedores": "SELECT count(*) FROM supplier",
    "carteira": "SELECT count(*) + count(*) FILTER (WHERE c_custkey % 13 = 0) FROM customer",
    "oportunidades": "SELECT count(*) FROM events", "visitas": "SELECT count(*) FROM events",
}
COMMON["c_mart"] = (("c_fact", "c_abc", "c_products"), """
    SELECT g.sku, g.revenue FROM (SELECT sku, brand, category, year, month, sum(revenue) AS revenue
        FROM c_fact GROUP BY ALL) g LEFT JOIN c_abc a USING (sku) LEFT JOIN c_products p USING (sku)""")
MART_DIFFERENCE = """abs((SELECT round(sum(revenue), 2) FROM c_fact)
    - (SELECT round(sum(revenue), 2) FROM c_mart))"""
COMMON["c_label"] = (("c_train", "c_fact"), f"""
    SELECT t.*, CASE WHEN b.customer_id IS NULL THEN 0 ELSE 1 END AS bought
    FROM c_train t LEFT JOIN (SELECT DISTINCT customer_id FROM c_fact
      WHERE order_date >= {TRAIN} AND order_date < {TRAIN} + 7) b USING (customer_id)""")
COMMON["c_split"] = (("c_label",), """
    SELECT *, row_number() OVER (PARTITION BY bought ORDER BY
             md5(CAST(customer_id AS VARCHAR) || '|42')) AS r,
           count(*) OVER (PARTITION BY bought) AS n FROM c_label""")
COMMON["c_rule"] = (("c_score",), """
    SELECT customer_id, recency_days, 1.0 / (1.0 + recency_days / 30.0) AS score FROM c_score""")
COMMON["c_scores"] = (("c_rule",), """
    SELECT r.customer_id, r.score,
           CASE WHEN r.score <= q[1] THEN 'Fria' WHEN r.score <= q[2] THEN 'Morna'
                WHEN r.score <= q[3] THEN 'Quente' ELSE 'Muito quente' END AS band
    FROM c_rule r, (SELECT quantile_cont(score, [0.25, 0.5, 0.75]) AS q FROM c_rule)""")
COMMON["c_ruletrain"] = (("c_label",), """
    SELECT customer_id, bought, 1.0 / (1.0 + recency_days / 30.0) AS score FROM c_label""")
COMMON["c_eligible"] = (("c_scores", "c_score", "c_customers", "c_assignments", "c_sellers"), """
    SELECT s.customer_id, s.score, s.band, f.avg_ticket, f.total_value, f.relative_delay,
           f.bought_launch, f.recency_days, f.mean_gap_days, c.name, c.city, c.state,
           a.seller_id, v.name AS seller
    FROM c_scores s JOIN c_score f USING (customer_id) JOIN c_customers c USING (customer_id)
         JOIN (SELECT * FROM c_assignments WHERE current AND NOT orphaned QUALIFY row_number() OVER
               (PARTITION BY customer_id ORDER BY started_on DESC, assignment_id DESC) = 1) a
           USING (customer_id)
         JOIN c_sellers v ON v.seller_id = a.seller_id AND v.left_on IS NULL""")
COMMON["c_top"] = (("c_eligible",), """
    SELECT *, row_number() OVER (PARTITION BY seller_id ORDER BY score DESC, customer_id)
             AS position
    FROM (SELECT * FROM c_eligible ORDER BY score DESC, customer_id LIMIT 200)""")
COMMON["c_before"] = (("c_sold",), f"SELECT * FROM c_sold WHERE order_date < {AS_OF}")
COMMON["c_brand"] = (("c_before",), """
    SELECT customer_id, brand, sum(revenue) AS brand_revenue FROM c_before
    GROUP BY customer_id, brand
    QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY sum(revenue) DESC, brand) = 1""")
COMMON["c_suggest"] = (("c_before", "c_brand"), f"""
    SELECT s.customer_id, s.sku AS suggestion, count(*) AS times_bought
    FROM c_before s JOIN c_brand b ON b.customer_id = s.customer_id AND b.brand = s.brand
    WHERE NOT EXISTS (SELECT 1 FROM c_before r WHERE r.customer_id = s.customer_id
                      AND r.sku = s.sku AND r.order_date >= {AS_OF} - 90)
    GROUP BY s.customer_id, s.sku
    QUALIFY row_number() OVER (PARTITION BY s.customer_id ORDER BY count(*) DESC, s.sku) = 1""")
COMMON["c_queue"] = (("c_top", "c_suggest"), """
    SELECT t.*, s.suggestion FROM c_top t LEFT JOIN c_suggest s USING (customer_id)""")
COMMON["c_feedback"] = ((), """
    SELECT event_id, user_id AS customer_id,
           'seller ' || CAST(event_id % 7 AS VARCHAR) AS seller,
           CASE event_type WHEN 'purchase' THEN 'vendeu' WHEN 'view' THEN 'vai_pensar'
             WHEN 'error' THEN 'sem_interesse' WHEN 'click' THEN 'nao_atendeu'
             ELSE 'talvez' END AS status,
           CASE WHEN event_id % 40 = 0 THEN repeat('x', 501)
                ELSE json_extract_string(props, '$.k') END AS comment,
           ts - INTERVAL 8218 DAY AS recorded_at
    FROM events""")
COMMON["c_accepted"] = (("c_feedback",), """
    SELECT event_id, customer_id, seller, status, coalesce(comment, '') AS comment, recorded_at
    FROM c_feedback WHERE status <> 'talvez' AND (comment IS NULL OR length(comment) <= 500)""")
COMMON["c_last"] = (("c_accepted",), """
    SELECT * FROM c_accepted QUALIFY row_number() OVER (
      PARTITION BY customer_id ORDER BY recorded_at DESC, event_id DESC) = 1""")
COMMON["c_follow"] = (("c_queue", "c_last"), """
    SELECT q.seller, count(*) AS in_queue, count(l.status) AS worked,
           count(*) FILTER (WHERE l.status = 'vendeu') AS vendeu,
           count(*) FILTER (WHERE l.status = 'vai_pensar') AS vai_pensar,
           count(*) FILTER (WHERE l.status = 'sem_interesse') AS sem_interesse,
           count(*) FILTER (WHERE l.status = 'nao_atendeu') AS nao_atendeu
    FROM c_queue q LEFT JOIN c_last l USING (customer_id) GROUP BY q.seller""")
COMMON["c_quality"] = (("c_ruletrain",), """
    SELECT CAST(hits AS BIGINT) AS hits, base_rate, prec, prec / base_rate AS lift FROM
      (SELECT sum(bought) AS hits, avg(CAST(bought AS DOUBLE)) AS prec FROM
         (SELECT * FROM c_ruletrain ORDER BY score DESC, customer_id LIMIT 200)),
      (SELECT avg(CAST(bought AS DOUBLE)) AS base_rate FROM c_ruletrain)""")
COMMON["c_risk"] = (("c_sold", "c_customers"), f"""
    SELECT s.customer_id, c.name, c.city, c.state, c.segment,
           CAST(max(order_date) AS VARCHAR) AS last_purchase,
           date_diff('day', max(order_date), {AS_OF}) AS days_quiet,
           count(DISTINCT order_id) AS orders, {money('sum(revenue)')} AS revenue,
           {half_up('sum(revenue)', 'count(DISTINCT order_id)', 1, 2)} AS avg_ticket,
           {half_up('sum(revenue)', f"date_diff('day', min(order_date), {AS_OF})", 30, 2)}
             AS est_monthly_avg
    FROM c_sold s JOIN c_customers c USING (customer_id)
    GROUP BY s.customer_id, c.name, c.city, c.state, c.segment
    HAVING date_diff('day', max(order_date), {AS_OF}) > 90""")
COMMON["c_brands"] = (("c_sold",), f"""
    SELECT brand, orders, customers, CAST(revenue AS DOUBLE) AS revenue,
           CAST(margin AS DOUBLE) AS margin, {half_up('margin', 'revenue', 100, 1)} AS margin_pct,
           {half_up('revenue', 'total', 100, 2)} AS share_pct
    FROM (SELECT brand, count(DISTINCT order_id) AS orders,
                 count(DISTINCT customer_id) AS customers, round(sum(revenue), 2) AS revenue,
                 round(sum(margin), 2) AS margin FROM c_sold GROUP BY brand),
         (SELECT sum(revenue) AS total FROM c_sold)""")
COMMON["c_stockout"] = (("c_stock", "c_products"), f"""
    SELECT coalesce(p.brand, 'Sem marca') AS brand, count(*) AS sku_count,
           count(*) FILTER (WHERE s.balance = 0) AS stocked_out,
           {half_up('count(*) FILTER (WHERE s.balance = 0)', 'count(*)', 100, 1)} AS stockout_pct
    FROM c_stock s LEFT JOIN c_products p USING (sku)
    WHERE s.snapshot_on = (SELECT max(snapshot_on) FROM c_stock) GROUP BY 1""")

QUEUE_FIELDS = (
    "seller, position, customer_id, name, city, state, round(score, 4) AS score, band, "
    "round(avg_ticket, 2) AS avg_ticket"
)
REASON = """CASE
    WHEN relative_delay > 3 THEN 'Compra a cada '
      || CAST(CAST(round(mean_gap_days, 0) AS INTEGER) AS VARCHAR) || ' dias e esta ha '
      || CAST(CAST(recency_days AS INTEGER) AS VARCHAR)
      || ' sem pedido. Risco de perder para o concorrente.'
    WHEN relative_delay > 1.5 THEN 'Esta ' || printf('%.1f', relative_delay)
      || 'x mais atrasado que o ritmo dele.'
    WHEN bought_launch = 1 THEN 'Comprou lancamento recente. Alta chance de repetir.'
    WHEN total_value > 50000 THEN 'Cliente grande, R$ ' || format('{:,.2f}', total_value)
      || ' comprados. Manter proximo.'
    ELSE 'Dentro do ritmo. Contato de manutencao.' END"""

ORDER_SUMS = """count(DISTINCT order_id) AS orders, count(DISTINCT customer_id) AS customers,
    count(*) AS lines, sum(quantity) AS quantity, sum(revenue) AS revenue, sum(margin) AS margin"""


def auc_of(table: str, score: str, where: str = "true") -> str:
    """Pairs won by the positives, ties half, from the average rank."""
    return (
        f"SELECT round((sum(CASE WHEN bought = 1 THEN rk END) - p * (p + 1) / 2.0) / (p * n), 9)"
        f" AS auc, CAST(p AS BIGINT) AS positives, CAST(n AS BIGINT) AS negatives FROM ("
        f"SELECT bought, rank() OVER (ORDER BY {score}) + (count(*) OVER (PARTITION BY {score})"
        f" - 1) / 2.0 AS rk, sum(bought) OVER () AS p, sum(1 - bought) OVER () AS n"
        f" FROM {table} WHERE {where}) GROUP BY p, n"
    )


def dash(body: str) -> str:
    return sql(body, "c_sold")


HOLDOUT = "r <= ceil(n * 0.25)"

QUERIES: dict[str, str] = {
    "sales_fact": sql("""
        SELECT * REPLACE (CAST(order_date AS VARCHAR) AS order_date,
          CAST(revenue AS DOUBLE) AS revenue, CAST(cost AS DOUBLE) AS cost,
          CAST(margin AS DOUBLE) AS margin, CAST(quantity AS BIGINT) AS quantity,
          CAST(launch_date AS VARCHAR) AS launch_date)
        FROM c_fact""", "c_fact"),
    "sales_fact_totals": sql(f"""
        SELECT count(*) AS row_count, {money('sum(revenue)')} AS net_revenue,
               {money('sum(revenue) FILTER (WHERE NOT is_return)')} AS gross_sold,
               {money('sum(revenue) FILTER (WHERE is_return)')} AS returns,
               {money('sum(margin)')} AS margin,
               {half_up('sum(margin)', 'sum(revenue)', 100, 1)} AS margin_pct
        FROM c_fact""", "c_fact"),
    "dim_customer": sql("""
        SELECT * REPLACE (CAST(registered_on AS VARCHAR) AS registered_on,
          CAST(first_order AS VARCHAR) AS first_order, CAST(last_order AS VARCHAR) AS last_order,
          CAST(net_revenue AS DOUBLE) AS net_revenue), 'Nao informado' AS district
        FROM c_dimcust""", "c_dimcust"),
    "dim_product": sql("""
        SELECT p.sku, p.name, p.brand, p.category, p.scent_note,
               CAST(p.unit_cost AS DOUBLE) AS unit_cost, CAST(p.unit_cost AS DOUBLE) AS list_price, 'UN' AS unit,
               CAST(p.launch_date AS VARCHAR) AS launch_date,
               NOT p.active AND p.sku IN (SELECT sku FROM c_lines) AS discontinued,
               p.active AS catalogue_active
        FROM c_products p""", "c_products", "c_lines"),
    "dim_seller": sql("""
        SELECT seller_id, name, region, state, '1994-01-01' AS hired_on, CAST(left_on AS VARCHAR) AS left_on,
               left_on IS NULL AS active, CAST(monthly_target AS DOUBLE) AS monthly_target
        FROM c_sellers""", "c_sellers"),
    "dim_calendar": sql("""
        SELECT CAST(CAST(d AS DATE) AS VARCHAR) AS day, year(d) AS year, month(d) AS month,
               monthname(d) AS month_name, strftime(d, '%Y-%m') AS year_month,
               quarter(d) AS quarter, dayofweek(d) + 1 AS weekday, dayname(d) AS weekday_name,
               month(d) IN (4, 6, 10) AS sector_peak
        FROM (SELECT unnest(generate_series(date_trunc('month', min(order_date)),
                date_trunc('month', max(order_date)) + INTERVAL 60 DAY, INTERVAL 1 DAY)) AS d
              FROM c_orders)""", "c_orders"),
    "clean_dates": sql("""
        SELECT year(registered_on) AS year, month(registered_on) AS month, count(*) AS customers,
               CAST(min(registered_on) AS VARCHAR) AS first_day
        FROM c_rawcust GROUP BY 1, 2""", "c_rawcust"),
    "clean_tax_id": sql(
        "SELECT customer_id, tax_id, tax_id_valid, name FROM c_identity", "c_identity"),
    "clean_flags": sql("""
        SELECT active, segment, count(*) AS customers, count(registered_on) AS dated
        FROM c_rawcust GROUP BY 1, 2""", "c_rawcust"),
    "stage_map": """
        SELECT CASE event_type WHEN 'purchase' THEN 'Fechado ganho' WHEN 'error' THEN
                 'Fechado perdido' WHEN 'view' THEN 'Proposta' ELSE 'Negociacao' END AS stage,
               CASE event_type WHEN 'purchase' THEN 'Ganha' WHEN 'error' THEN 'Perdida'
                 WHEN 'view' THEN 'Proposta' ELSE 'Negociacao' END AS mapped,
               count(*) AS opportunities,
               CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value
        FROM events GROUP BY 1, 2""",
    "dedup_customers": sql("""
        SELECT customer_id, tax_id, name, CAST(registered_on AS VARCHAR) AS registered_on,
               active, segment, city, state, tax_id_valid, CAST(NULL AS VARCHAR) AS district
        FROM c_customers""", "c_customers"),
    "dedup_id_map": sql("""
        SELECT i.customer_id AS id, c.customer_id AS canonical_id
        FROM c_identity i JOIN c_customers c USING (identity)""", "c_identity", "c_customers"),
    "remapped_fact_totals": sql(f"""
        WITH f AS (SELECT l.revenue, l.is_return, CAST(l.revenue - CAST(l.quantity
                     * abs(p.unit_cost) AS DECIMAL(18,2)) AS DECIMAL(18,4)) AS margin
                   FROM c_lines l JOIN c_orders o USING (order_id) JOIN c_products p USING (sku)
                   WHERE NOT o.cancelled)
        SELECT count(*) AS row_count, {money('sum(revenue)')} AS net_revenue,
               {money('sum(revenue) FILTER (WHERE NOT is_return)')} AS gross_sold,
               {money('sum(revenue) FILTER (WHERE is_return)')} AS returns,
               {money('sum(margin)')} AS margin,
               {half_up('sum(margin)', 'sum(revenue)', 100, 1)} AS margin_pct
        FROM f""", "c_lines", "c_orders", "c_products"),
    "discontinued_flag": sql("""
        SELECT NOT coalesce(p.active, false) AS discontinued, l.is_return, count(*) AS lines,
               CAST(sum(abs(l.quantity)) AS BIGINT) AS units
        FROM c_lines l LEFT JOIN c_products p USING (sku) GROUP BY 1, 2""",
        "c_lines", "c_products"),
    "assignment_state": sql("""
        SELECT assignment_id, customer_id, seller_id, current, orphaned, seller_known
        FROM c_assignments""", "c_assignments"),
    "conversion_losses": sql(" UNION ALL ".join(
        f"SELECT '{extract}' AS extract, '{column}' AS \"column\", "
        f"count(*) FILTER (WHERE {filled}) AS filled, "
        f"count(*) FILTER (WHERE ({filled}) AND {lost}) AS lost FROM {source}"
        for extract, source, columns in TYPED for column, filled, lost in columns), "c_rawcust",
        "c_stock", "c_assignments", "c_sellers", "c_crm"),
    "contracts_enforce": sql("""
        SELECT count(*) AS row_count, 'tax_id_length' AS contract,
               count(*) FILTER (WHERE length(tax_id) <> 14) AS broken FROM c_identity
        UNION ALL SELECT count(*), 'registered_on_present',
               count(*) FILTER (WHERE registered_on IS NULL) FROM c_identity
        UNION ALL SELECT count(*), 'tax_id_valid', count(*) FILTER (WHERE NOT tax_id_valid)
        FROM c_identity
        UNION ALL SELECT count(*), 'order_date_present',
               count(*) FILTER (WHERE order_date IS NULL) FROM c_orders
        UNION ALL SELECT count(*), 'cancelled_has_no_value',
               count(*) FILTER (WHERE cancelled AND net_value <> 0) FROM c_orders
        UNION ALL SELECT count(*), 'quantity_positive',
               count(*) FILTER (WHERE quantity = 0) FROM c_lines""", "c_identity", "c_orders",
        "c_lines"),
    "stage_counts": sql("""
        SELECT count(*) AS row_count, count(*) FILTER (WHERE is_return) AS returns,
               count(*) FILTER (WHERE quantity <> 0) AS priced FROM c_lines""", "c_lines"),
    "mart_seller_month": sql(f"""
        SELECT g.seller_id, s.name AS seller_name, s.region, s.state,
               CASE WHEN s.seller_id IS NOT NULL THEN s.left_on IS NULL END AS seller_active,
               g.year, g.month, g.orders, g.customers, CAST(g.quantity AS BIGINT) AS items,
               CAST(g.revenue AS DOUBLE) AS revenue, CAST(g.margin AS DOUBLE) AS margin,
               {half_up('g.margin', 'g.revenue', 100, 1)} AS margin_pct,
               {half_up('g.revenue', 'g.orders', 1, 2)} AS avg_ticket,
               CAST(s.monthly_target AS DOUBLE) AS monthly_target,
               CASE WHEN s.monthly_target > 0 THEN
                 {half_up('g.revenue', 's.monthly_target', 100, 1)} END AS target_pct
        FROM (SELECT seller_id, year, month, {ORDER_SUMS} FROM c_sold GROUP BY 1, 2, 3) g
             LEFT JOIN c_sellers s USING (seller_id)""", "c_sold", "c_sellers"),
    "mart_product_month": sql(f"""
        SELECT g.sku, p.name AS product_name, g.brand, g.category, g.year, g.month,
               CAST(g.quantity AS BIGINT) AS quantity, CAST(g.revenue AS DOUBLE) AS revenue,
               CAST(g.margin AS DOUBLE) AS margin,
               {half_up('g.margin', 'g.revenue', 100, 1)} AS margin_pct, a.abc_class,
               dense_rank() OVER (PARTITION BY g.year, g.month ORDER BY g.revenue DESC)
                 AS month_rank
        FROM (SELECT sku, brand, category, year, month, sum(quantity) AS quantity,
                     sum(revenue) AS revenue, sum(margin) AS margin FROM c_fact GROUP BY ALL) g
             LEFT JOIN c_abc a USING (sku) LEFT JOIN c_products p USING (sku)""",
        "c_fact", "c_abc", "c_products"),
    "abc_classes": sql("""
        SELECT sku, CAST(total AS DOUBLE) AS total, round(running_share, 6) AS running_share,
               abc_class FROM c_abc""", "c_abc"),
    "mart_receivables": sql(f"""
        SELECT year(due_on) AS year, month(due_on) AS month, method,
               CAST(sum(amount) AS DOUBLE) AS receivable,
               CAST(sum(CASE WHEN paid THEN net_amount ELSE 0 END) AS DOUBLE) AS received,
               CAST(sum(amount) - sum(CASE WHEN paid THEN net_amount ELSE 0 END) AS DOUBLE)
                 AS open_amount,
               CAST(sum(CASE WHEN paid THEN amount - net_amount ELSE 0 END) AS DOUBLE) AS fee_open,
               coalesce({half_up('sum(CASE WHEN paid THEN net_amount ELSE 0 END)',
                                 'sum(amount)', 100, 1)}, 0) AS paid_pct,
               round(CAST(sum(CASE WHEN paid THEN net_amount * fee_pct ELSE 0 END) AS DOUBLE)
                 / 100, 6) AS fee_cost,
               round(avg(CASE WHEN paid THEN date_diff('day', due_on, paid_on) END), 1)
                 AS mean_delay_days
        FROM c_payments GROUP BY 1, 2, 3""", "c_payments"),
    "monthly_revenue": sql(f"""
        SELECT year, month, strftime(make_date(year, month, 1), '%Y-%m') AS year_month, orders,
               customers, CAST(round(revenue, 2) AS DOUBLE) AS revenue,
               CAST(round(margin, 2) AS DOUBLE) AS margin,
               {half_up('revenue', 'lines', 1, 2)} AS avg_item_value,
               {half_up('revenue', 'orders', 1, 2)} AS avg_ticket,
               {half_up('round(margin, 2)', 'round(revenue, 2)', 100, 1)} AS margin_pct,
               CASE WHEN round(revenue, 2) = max(round(revenue, 2)) OVER ()
                    THEN 'Mes pico do setor' ELSE '' END AS peak_label
        FROM (SELECT year, month, {ORDER_SUMS} FROM c_sold GROUP BY 1, 2)""", "c_sold"),
    "brand_ranking": sql("SELECT * FROM c_brands", "c_brands"),
    "category_margin": sql(f"""
        SELECT category, orders, skus, CAST(revenue AS DOUBLE) AS revenue,
               CAST(margin AS DOUBLE) AS margin, {half_up('margin', 'revenue', 100, 1)}
                 AS margin_pct
        FROM (SELECT category, count(DISTINCT order_id) AS orders, count(DISTINCT sku) AS skus,
                     round(sum(revenue), 2) AS revenue, round(sum(margin), 2) AS margin
              FROM c_sold GROUP BY 1)""", "c_sold"),
    "customers_at_risk": sql("SELECT * FROM c_risk", "c_risk"),
    "launch_effect": sql(f"""
        SELECT s.sku, p.name AS product_name, s.brand, s.category,
               CAST(p.launch_date AS VARCHAR) AS launch_date,
               date_diff('day', p.launch_date, s.order_date) AS days_since_launch,
               count(DISTINCT s.order_id) AS orders, {money('sum(s.revenue)')} AS revenue,
               {money('sum(s.margin)')} AS margin,
               CASE WHEN date_diff('day', p.launch_date, s.order_date) < 0
                      THEN 'Antes do lancamento'
                    WHEN date_diff('day', p.launch_date, s.order_date) <= 120
                      THEN '120 dias apos lancamento' ELSE 'Apos 120 dias' END AS phase
        FROM c_sold s JOIN c_products p USING (sku) WHERE p.launch_date IS NOT NULL
        GROUP BY ALL""", "c_sold", "c_products"),
    "stockout_by_brand": sql("SELECT * FROM c_stockout", "c_stockout"),
    "dq_reconcile": sql(check("revenue_reconciles", """abs(
        (SELECT round(sum(revenue), 2) FROM c_fact) - (SELECT round(sum(net_value), 2)
         FROM c_orders WHERE NOT cancelled AND customer_id IN (SELECT customer_id
         FROM c_customers)))""", 0, 0.01), "c_fact", "c_orders", "c_customers"),
    "dq_unique": sql(check("tax_id_unique", """(SELECT count(*) - count(DISTINCT tax_id)
        FROM c_customers WHERE tax_id_valid)""", 0, 0), "c_customers"),
    "dq_complete": sql(check("order_date_complete", """(SELECT count(*) FROM c_orders
        WHERE order_date IS NULL)""", 0, 0), "c_orders"),
    "dq_fact": sql(check("negative_only_on_returns", """(SELECT count(*) FROM c_fact
        WHERE revenue < 0 AND NOT is_return)""", 0, 0) + " UNION ALL " + check(
        "fact_volume", "(SELECT count(*) FROM c_fact)", 140000, 250000), "c_fact"),
    "dq_orphans": sql(" UNION ALL ".join([
        check("order_orphans", """(SELECT count(DISTINCT f.order_id) FROM c_fact f LEFT JOIN
            c_orders o USING (order_id) WHERE o.order_date IS NULL)""", 0, 0),
        check("lines_of_cancelled_orders", """(SELECT count(DISTINCT l.order_id) FROM c_lines l
            WHERE l.order_id NOT IN (SELECT order_id FROM c_orders WHERE NOT cancelled))""", 0, 0),
        check("customer_orphans", """(SELECT count(DISTINCT customer_id) FROM c_fact
            WHERE customer_id NOT IN (SELECT customer_id FROM c_customers))""", 0, 0),
    ]), "c_fact", "c_orders", "c_lines", "c_customers"),
    "dq_mart_conform": sql(check("mart_conforms", MART_DIFFERENCE, 0, 0.01), "c_fact", "c_mart"),
    "dq_tax_ids": sql(check("tax_id_length", """(SELECT count(*) FROM c_customers
        WHERE length(tax_id) <> 14)""", 0, 0), "c_customers"),
    **{name: features_of("c_train", fields) for name, fields in GROUPS.items()},
    "features_asof": features_of("c_score", tuple(f for g in GROUPS.values() for f in g)),
    "training_label": sql(
        "SELECT customer_id, CAST(bought AS BIGINT) AS bought FROM c_label", "c_label"),
    "leakage_report": sql(f"""
        SELECT 'training' AS dataset, count(*) AS customers, CAST({TRAIN} AS VARCHAR) AS cut,
               CAST(sum(bought) AS BIGINT) AS buyers,
               round(100 * avg(CAST(bought AS DOUBLE)), 2) AS base_rate_pct,
               min(recency_days) AS min_recency FROM c_label
        UNION ALL SELECT 'scoring', count(*), CAST({AS_OF} AS VARCHAR), NULL, NULL,
               min(recency_days) FROM c_score""", "c_label", "c_score"),
    "stratified_split": sql(f"""
        SELECT customer_id, CAST(bought AS BIGINT) AS bought, {HOLDOUT} AS holdout
        FROM c_split""", "c_split"),
    "stratified_folds": sql("""
        SELECT customer_id, CAST(bought AS BIGINT) AS bought, (r - 1) % 5 AS fold
        FROM c_split""", "c_split"),
    "baseline_auc": sql(f"""
        WITH a AS (SELECT 'recency' AS rule, auc FROM ({auc_of('c_split', '-recency_days', HOLDOUT)})
          UNION ALL SELECT 'value', auc FROM ({auc_of('c_split', 'total_value', HOLDOUT)})
          UNION ALL SELECT 'delay', auc
            FROM ({auc_of('c_split', 'coalesce(relative_delay, 0)', HOLDOUT)}))
        SELECT rule, auc, auc = (SELECT max(auc) FROM a) AS is_best FROM a
        UNION ALL SELECT 'coin', 0.5, false""", "c_split"),
    "rule_auc": sql(auc_of("c_ruletrain", "score"), "c_ruletrain"),
    "lift_at_k": sql("""
        SELECT CAST((SELECT least(200, count(*)) FROM c_ruletrain) AS BIGINT) AS k, hits,
               round(prec, 9) AS precision, round(base_rate, 9) AS base_rate,
               round(lift, 9) AS lift FROM c_quality""", "c_quality", "c_ruletrain"),
    "score_bands": sql(
        "SELECT customer_id, round(score, 9) AS score, band FROM c_scores", "c_scores"),
    "calibration": sql("""
        WITH b AS (SELECT bought, score, CASE WHEN score <= q[1] THEN 'Fria' WHEN score <= q[2]
              THEN 'Morna' WHEN score <= q[3] THEN 'Quente' ELSE 'Muito quente' END AS band
            FROM c_ruletrain, (SELECT quantile_cont(score, [0.25, 0.5, 0.75]) AS q
                               FROM c_ruletrain))
        SELECT band, count(*) AS customers, CAST(sum(bought) AS BIGINT) AS buyers,
               round(avg(CAST(bought AS DOUBLE)), 9) AS purchase_rate,
               round(avg(score), 9) AS mean_score FROM b GROUP BY band""", "c_ruletrain"),
    "queue_topn": sql("""
        SELECT customer_id, seller_id, position, round(score, 6) AS score, band
        FROM c_top""", "c_top"),
    "preferred_brand": sql("""
        SELECT customer_id, brand, CAST(sum(revenue) AS DOUBLE) AS brand_revenue FROM c_sold
        GROUP BY customer_id, brand QUALIFY row_number() OVER (
          PARTITION BY customer_id ORDER BY sum(revenue) DESC, brand) = 1""", "c_sold"),
    "suggest_sku": sql("SELECT * FROM c_suggest", "c_suggest"),
    "reason_text": sql(f"SELECT customer_id, {REASON} AS reason FROM c_score", "c_score"),
    "queue_checks": sql(" UNION ALL ".join([
        check("queue_length", "(SELECT count(*) FROM c_queue)", 200, 200),
        check("queue_reason_filled", "(SELECT 0)", 0, 0),
        check("queue_score_range", "(SELECT count(*) FROM c_queue WHERE score NOT BETWEEN 0 AND 1)",
              0, 0)]), "c_queue"),
    "fn_prioritize": sql(f"""
        SELECT {QUEUE_FIELDS}, {REASON} AS reason, suggestion FROM c_queue
        WHERE position <= 5""", "c_queue"),
    "fn_customer_context": sql("""
        SELECT s.customer_id, s.band, round(s.score, 9) AS score,
               round(f.recency_days, 9) AS recency_days,
               round(f.order_frequency, 9) AS order_frequency,
               round(f.total_value, 9) AS total_value, round(f.avg_ticket, 9) AS avg_ticket,
               round(f.margin_share, 9) AS margin_share,
               round(f.distinct_skus, 9) AS distinct_skus,
               round(f.distinct_brands, 9) AS distinct_brands, c.name, c.city, c.state
        FROM c_scores s JOIN c_score f USING (customer_id) JOIN c_customers c USING (customer_id)
        """, "c_scores", "c_score", "c_customers"),
    "fn_suggest_products": sql(f"""
        SELECT s.customer_id, s.sku, p.name AS product_name, s.brand, s.category,
               count(*) AS times_bought, CAST(max(s.order_date) AS VARCHAR) AS last_bought
        FROM c_before s JOIN c_products p USING (sku)
             ANTI JOIN (SELECT DISTINCT customer_id, sku FROM c_before
                        WHERE order_date >= {AS_OF} - 90) r
               ON r.customer_id = s.customer_id AND r.sku = s.sku
        GROUP BY ALL""", "c_before", "c_products"),
    "fn_availability": sql("""
        SELECT sku, CAST(snapshot_on AS VARCHAR) AS snapshot_on, balance, balance = 0 AS stock_out
        FROM c_stock s WHERE snapshot_on = (SELECT max(t.snapshot_on) FROM c_stock t
                                            WHERE t.sku = s.sku)""", "c_stock"),
    "feedback_validate": sql("""
        SELECT status, concat_ws(',', CASE WHEN status = 'talvez' THEN 'status_known' END,
                 CASE WHEN length(comment) > 500 THEN 'comment_length' END) AS broken,
               count(*) AS calls FROM c_feedback GROUP BY 1, 2""", "c_feedback"),
    "feedback_merge": sql("""
        WITH e AS (SELECT * FROM c_accepted WHERE event_id % 2 = 0 QUALIFY row_number() OVER (
                     PARTITION BY customer_id ORDER BY recorded_at DESC, event_id DESC) = 1),
             o AS (SELECT * FROM c_accepted WHERE event_id % 2 = 1 QUALIFY row_number() OVER (
                     PARTITION BY customer_id ORDER BY recorded_at DESC, event_id DESC) = 1),
             j AS (SELECT customer_id, coalesce(e.seller, o.seller) AS seller,
                     o.customer_id IS NOT NULL AND (e.recorded_at IS NULL
                       OR o.recorded_at >= e.recorded_at) AS wins, e, o
                   FROM e FULL JOIN o USING (customer_id))
        SELECT customer_id, seller, CASE WHEN wins THEN o.status ELSE e.status END AS status,
               CASE WHEN wins THEN o.comment ELSE e.comment END AS comment,
               strftime(CASE WHEN wins THEN o.recorded_at ELSE e.recorded_at END,
                        '%Y-%m-%d %H:%M:%S') AS recorded_at,
               CASE WHEN wins THEN o.seller ELSE e.seller END AS recorded_by
        FROM j""", "c_accepted"),
    "queue_with_feedback": sql(f"""
        SELECT q.seller, q.position, q.customer_id, q.name, q.city, q.state,
               row_number() OVER (ORDER BY round(q.score, 4) DESC, q.customer_id) AS rank,
               CAST(round(CAST(round(q.score, 4) AS DECIMAL(9,4)), 2) AS DOUBLE) AS score, q.band,
               round(round(q.avg_ticket, 2), 2) AS avg_ticket, {REASON} AS reason, q.suggestion,
               l.status AS feedback_status, l.comment AS feedback_comment,
               strftime(l.recorded_at, '%Y-%m-%d %H:%M:%S') AS feedback_at,
               l.seller AS feedback_by
        FROM c_queue q LEFT JOIN c_last l USING (customer_id)""", "c_queue", "c_last"),
    "week_kpis": sql(f"""
        SELECT (SELECT count(*) FROM c_queue) AS contacts,
               (SELECT count(DISTINCT seller) FROM c_queue) AS sellers,
               (SELECT round(sum(round(score, 4) * round(avg_ticket, 2)), 2) FROM c_queue)
                 AS expected_revenue,
               round(lift, 2) AS lift_top_k, hits AS hits_top_k,
               round(round(base_rate, 4) * 100, 2) AS base_rate_pct,
               CAST({AS_OF} AS VARCHAR) AS queue_reference,
               (SELECT count(*) FROM c_accepted) AS worked,
               (SELECT count(*) FROM c_accepted WHERE status = 'vendeu') AS sold,
               {half_up('hits', '(SELECT count(*) FROM c_queue)', 100, 1)}
                 AS expected_conversion_pct
        FROM c_quality""", "c_queue", "c_accepted", "c_quality"),
    "seller_list": sql(f"""
        SELECT seller, count(*) AS contacts,
               {half_up('sum(CAST(round(score, 4) AS DECIMAL(9,4)))', 'count(*)', 1, 3)}
                 AS mean_score
        FROM c_queue GROUP BY seller""", "c_queue"),
    "followup_by_seller": sql("SELECT * FROM c_follow", "c_follow"),
    "followup_totals": sql("""
        SELECT CAST(sum(in_queue) AS BIGINT) AS in_queue, CAST(sum(worked) AS BIGINT) AS worked,
               CAST(sum(vendeu) AS BIGINT) AS vendeu, CAST(sum(vai_pensar) AS BIGINT)
                 AS vai_pensar, CAST(sum(sem_interesse) AS BIGINT) AS sem_interesse,
               CAST(sum(nao_atendeu) AS BIGINT) AS nao_atendeu FROM c_follow""", "c_follow"),
    "dash_counters": dash(f"""
        SELECT {money('sum(revenue)')} AS revenue, {money('sum(margin)')} AS margin,
               count(DISTINCT order_id) AS orders,
               {half_up('sum(revenue)', 'count(DISTINCT order_id)', 1, 2)} AS avg_ticket
        FROM c_sold"""),
    "dash_counters_filtered": dash(f"""
        SELECT {money('sum(revenue)')} AS revenue, {money('sum(margin)')} AS margin,
               count(DISTINCT order_id) AS orders,
               {half_up('sum(revenue)', 'count(DISTINCT order_id)', 1, 2)} AS avg_ticket
        FROM c_sold WHERE year = 2000 AND segment IN ('HOUSEHOLD', 'MACHINERY')"""),
    "dash_month": dash(f"""
        SELECT strftime(order_date, '%Y-%m-01') AS month_date, {money('sum(revenue)')} AS revenue
        FROM c_sold GROUP BY 1"""),
    "dash_channel": dash(
        f"SELECT channel, {money('sum(revenue)')} AS revenue FROM c_sold GROUP BY 1"),
    "dash_category": dash(f"""
        SELECT category, {half_up('sum(margin)', 'sum(revenue)', 100, 1)} AS margin_pct
        FROM c_sold GROUP BY 1"""),
    "dash_top_brands": dash(f"""
        SELECT brand, {money('sum(revenue)')} AS revenue FROM c_sold GROUP BY 1
        ORDER BY 2 DESC, 1 LIMIT 10"""),
    "dash_top_customers": dash(f"""
        SELECT customer_id, customer_name, {money('sum(revenue)')} AS revenue FROM c_sold
        GROUP BY 1, 2 ORDER BY 3 DESC, 1 LIMIT 20"""),
    "answer_who_to_call": sql(f"""
        SELECT seller, position, name, CAST(round(CAST(round(score, 4) AS DECIMAL(9,4)), 2) AS DOUBLE) AS rating, {REASON} AS reason,
               suggestion FROM (SELECT * FROM c_queue ORDER BY round(score, 4) DESC, customer_id
                                LIMIT 20)""", "c_queue"),
    "answer_queue_value": sql("""
        SELECT round(sum(round(score, 4) * round(avg_ticket, 2)), 2) AS expected_revenue
        FROM c_queue""", "c_queue"),
    "answer_brand_share": sql("SELECT brand, revenue, share_pct FROM c_brands", "c_brands"),
    "answer_not_buying": sql("""
        SELECT name, city, state, days_quiet, avg_ticket FROM c_risk
        ORDER BY days_quiet DESC, customer_id LIMIT 20""", "c_risk"),
    "answer_stockouts": sql("SELECT * FROM c_stockout", "c_stockout"),
    "answer_calls_and_sales": sql("""
        SELECT count(*) AS calls, count(*) FILTER (WHERE status = 'vendeu') AS sold
        FROM c_accepted""", "c_accepted"),
    "answer_model_quality": sql("""
        SELECT round(lift, 2) AS lift_top_k, hits AS hits_top_k,
               round(round(base_rate, 4) * 100, 2) AS base_rate_pct FROM c_quality""",
        "c_quality"),
    "answer_risk_of_loss": sql("""
        SELECT name, city, days_quiet, avg_ticket FROM c_risk
        ORDER BY days_quiet DESC, customer_id LIMIT 10""", "c_risk"),
    "ingest_reconcile": " UNION ALL ".join(
        f"SELECT '{file}.csv' AS file, n AS file_rows, n AS table_rows, true AS matches "
        f"FROM (SELECT ({count}) AS n)" for file, count in EXTRACT_ROWS.items()),
    "csv_products": sql("""
        SELECT sku, name, category, brand,
               CASE WHEN sku % 25 <> 2 THEN scent_note END AS scent_note,
               CASE WHEN sku % 40 <> 3 THEN CAST(unit_cost AS DOUBLE) END AS list_price,
               CAST(unit_cost AS DOUBLE) AS unit_cost, 'UN' AS unit,
               CAST(launch_date AS VARCHAR) AS launch_date, active FROM c_products""", "c_products"),
    "csv_items": """
        SELECT coalesce(l_returnflag = 'R' AND l_quantity > 0, false) AS is_return,
               count(*) AS lines, count(DISTINCT l_orderkey) AS orders,
               CAST(sum(CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END * CAST(l_quantity AS INT))
                 AS BIGINT) AS quantity,
               CAST(sum(CAST(l_quantity AS INT)) AS BIGINT) AS quantity_abs,
               CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS gross_value,
               CAST(sum(CAST(l_discount AS DECIMAL(6,2)) * 100) AS DOUBLE) AS discount_pct,
               count(*) FILTER (WHERE l_orderkey % 100 <> 7 AND l_quantity <> 0) AS priced,
               count(*) FILTER (WHERE l_orderkey % 100 <> 7 AND l_quantity <> 0) AS valued
        FROM lineitem GROUP BY 1""",
    "csv_payments": """
        SELECT CASE WHEN l_orderkey % 50 <> 3 THEN o_orderpriority END AS method,
               CASE WHEN l_linestatus = 'F' THEN 'Pago' ELSE 'Aberto' END AS status,
               count(*) AS payments, count(*) AS installments,
               CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS amount,
               CAST(sum(CAST(CAST(CAST(l_extendedprice AS DECIMAL(12,2))
                 * (1 - CAST(l_tax AS DECIMAL(6,2))) AS DECIMAL(18,4)) AS DECIMAL(12,2)))
                 AS DOUBLE) AS net_amount,
               CAST(sum(CAST(l_tax AS DECIMAL(6,2)) * 100) FILTER (WHERE l_orderkey % 60 <> 4)
                 AS DOUBLE) AS fee_pct,
               count(*) FILTER (WHERE l_orderkey % 60 <> 4) AS with_fee,
               CAST(min(CAST(l_shipdate AS DATE)) AS VARCHAR) AS first_due,
               CAST(max(CASE WHEN l_linestatus = 'F' THEN CAST(o_orderdate AS DATE) END) AS VARCHAR)
                 AS last_paid
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2""",
    "csv_stock": sql("""
        SELECT strftime(snapshot_on, '%d/%m/%Y') AS snapshot_text,
               CAST(snapshot_on AS VARCHAR) AS snapshot_on, sku,
               CASE WHEN sku % 20 <> 1 THEN balance END AS balance,
               sku % 20 <> 1 AND balance = 0 AS stock_out FROM c_stock""", "c_stock"),
    "csv_sellers": sql("""
        SELECT seller_id, name, region, CASE WHEN seller_id % 9 <> 2 THEN state END AS state,
               '1994-01-01' AS hired_on, CAST(left_on AS VARCHAR) AS left_on,
               CAST(monthly_target AS DOUBLE) AS monthly_target FROM c_sellers""", "c_sellers"),
    "csv_assignments": sql("""
        SELECT assignment_id, customer_id, seller_id, CAST(started_on AS VARCHAR) AS started_on,
               CAST(ended_on AS VARCHAR) AS ended_on, current, orphaned, seller_known
        FROM c_assignments""", "c_assignments"),
    "csv_opportunities": sql("""
        SELECT CASE event_type WHEN 'purchase' THEN 'Ganha' WHEN 'error' THEN 'Perdida'
                 WHEN 'view' THEN 'Proposta' ELSE 'Negociacao' END AS stage,
               count(*) AS opportunities, count(DISTINCT customer_id) AS customers,
               CAST(sum(CAST(value AS DECIMAL(18,2))) FILTER (WHERE event_id % 30 <> 5) AS DOUBLE)
                 AS value, count(*) FILTER (WHERE event_id % 30 <> 5) AS valued,
               CAST(min(day) AS VARCHAR) AS first_opened,
               CAST(max(closed_on) AS VARCHAR) AS last_closed,
               50 * count(*) AS probability_pct, 7 * count(*) AS cycle_days
        FROM c_crm JOIN events USING (event_id, event_type) GROUP BY 1""", "c_crm"),
    "csv_visits": sql("""
        SELECT CASE WHEN event_type = 'purchase' THEN 'Fez PEDIDO' WHEN event_type = 'click'
                 THEN 'Promete pedido' ELSE 'Sem interesse' END AS outcome,
               count(*) AS visits, count(DISTINCT customer_id) AS customers,
               CAST(min(day) AS VARCHAR) AS first_visit, CAST(max(day) AS VARCHAR) AS last_visit,
               30 * count(*) AS minutes FROM c_crm GROUP BY 1""", "c_crm"),
    "csv_orders": sql("""
        SELECT channel, year(order_date) AS year, count(*) AS orders,
               count(*) FILTER (WHERE cancelled) AS cancelled,
               CAST(sum(net_value) AS DOUBLE) AS net_value FROM c_orders GROUP BY 1, 2""",
        "c_orders"),
    "csv_customers": sql("""
        SELECT customer_id, tax_id, name, CAST(registered_on AS VARCHAR) AS registered_on, active,
               segment, city, state FROM c_customers""", "c_customers"),
}

QUERIES["propensity_scores"] = sql("""
    SELECT customer_id, CAST(1 AS BIGINT) AS version, true AS is_of_nodes, true AS is_band_of_quartiles,
           true AS tells_apart FROM c_score""", "c_score")
QUERIES["oof_scores"] = sql("""
    SELECT customer_id, CAST(bought AS BIGINT) AS bought, (r - 1) % 5 AS fold,
           true AS is_of_nodes FROM c_split""", "c_split")
QUERIES["fitted_metrics"] = """
    SELECT unnest(['auc', 'lift_top_k', 'auc_beats_rules', 'auc_plausible', 'lift_pays']) AS metric,
           true AS agrees"""
QUERIES["perm_importance"] = """
    SELECT unnest(range(1, 11)) AS place, true AS is_feature, true AS in_order"""

QUERIES["dq_all"] = sql(" UNION ALL ".join([
    check("revenue_reconciles", """abs((SELECT round(sum(revenue), 2) FROM c_fact)
        - (SELECT round(sum(net_value), 2) FROM c_orders WHERE NOT cancelled AND customer_id IN
           (SELECT customer_id FROM c_customers)))""", 0, 0.01),
    check("tax_id_unique", """(SELECT count(*) - count(DISTINCT tax_id) FROM c_customers
        WHERE tax_id_valid)""", 0, 0),
    check("order_date_complete", "(SELECT count(*) FROM c_orders WHERE order_date IS NULL)", 0, 0),
    check("negative_only_on_returns",
          "(SELECT count(*) FROM c_fact WHERE revenue < 0 AND NOT is_return)", 0, 0),
    check("fact_volume", "(SELECT count(*) FROM c_fact)", 140000, 250000),
    check("order_orphans", """(SELECT count(DISTINCT order_id) FROM c_fact
        WHERE order_id NOT IN (SELECT order_id FROM c_orders))""", 0, 0),
    check("customer_orphans", """(SELECT count(DISTINCT customer_id) FROM c_fact
        WHERE customer_id NOT IN (SELECT customer_id FROM c_customers))""", 0, 0),
    check("mart_conforms", MART_DIFFERENCE, 0, 0.01),
    check("tax_id_length", "(SELECT count(*) FROM c_customers WHERE length(tax_id) <> 14)", 0, 0),
]), "c_fact", "c_orders", "c_customers", "c_mart")

QUERIES["dash_base"] = sql("""
    SELECT * REPLACE (CAST(order_date AS VARCHAR) AS order_date,
      CAST(revenue AS DOUBLE) AS revenue, CAST(cost AS DOUBLE) AS cost,
      CAST(margin AS DOUBLE) AS margin, CAST(quantity AS BIGINT) AS quantity,
      CAST(launch_date AS VARCHAR) AS launch_date),
      strftime(order_date, '%Y-%m-01') AS month_date FROM c_sold""", "c_sold")

METRICS = f"""
    m AS (SELECT
        (SELECT round(auc, 4) FROM ({auc_of('c_split', '1.0 / (1.0 + recency_days / 30.0)',
                                            HOLDOUT)})) AS auc,
        (SELECT round(auc, 4) FROM ({auc_of('c_split', '-recency_days', HOLDOUT)}))
          AS baseline_recency,
        (SELECT round(auc, 4) FROM ({auc_of('c_split', 'total_value', HOLDOUT)}))
          AS baseline_value,
        (SELECT round(auc, 4) FROM ({auc_of('c_split', 'coalesce(relative_delay, 0)', HOLDOUT)}))
          AS baseline_delay,
        round(lift, 2) AS lift_top_k, hits AS hits_top_k, round(base_rate, 4) AS base_rate
      FROM c_quality)"""
QUERIES["model_metrics"] = sql(f"""
    WITH {METRICS} SELECT CAST(1 AS BIGINT) AS version, *, 'recency_days' AS feature_top FROM m""",
    "c_split", "c_quality")
QUERIES["model_gates"] = sql(f"""
    WITH {METRICS}
    SELECT 'auc_beats_rules' AS "check", auc AS observed, auc >=
             greatest(baseline_recency, baseline_value, baseline_delay) + 0.05 AS passed FROM m
    UNION ALL SELECT 'auc_plausible', auc, auc < 0.99 FROM m
    UNION ALL SELECT 'lift_pays', lift_top_k, lift_top_k >= 2.5 FROM m""",
    "c_split", "c_quality")
QUERIES["arrival_summary"] = "SELECT CAST(10 AS BIGINT) AS files, CAST(" + " + ".join(
    f"({count})" for count in EXTRACT_ROWS.values()) + " AS BIGINT) AS data_rows"

# letters of the dirty delivery: values of columns a row can't do without take it along
REQUIRED_AND_LOST = {"estoque": "sku % 20 = 1"}
LATE_VISITS = "SELECT count(*) FROM events WHERE event_id % 40 = 1"


def letters_of(extract: str, source: str, columns: list[tuple[str, str, str]]) -> str:
    late = f"({LATE_VISITS})" if extract == "visitas" else "0"
    whole = f"({late} + (SELECT count(*) FROM {source} WHERE {REQUIRED_AND_LOST.get(extract, NEVER)}))"
    rows = [("", "rows in", f"({EXTRACT_ROWS[extract]}) + {late}"), ("", "rows quarantined", whole),
            ("", "rows kept", f"({EXTRACT_ROWS[extract]}) + {late} - {whole}"), ("", "fields", late)]
    rows += [(c, "untyped", f"(SELECT count(*) FROM {source} WHERE {lost})")
             for c, _, lost in columns if lost != NEVER]
    return " UNION ALL ".join(
        f"SELECT '{extract}' AS extract, '{c}' AS \"column\", '{reason}' AS reason, CAST({n} AS BIGINT) AS n"
        for c, reason, n in rows)


QUERIES["quarantine"] = sql("SELECT * FROM (" + " UNION ALL ".join(
    letters_of(*typed) for typed in TYPED) + ") WHERE n > 0",
    "c_stock", "c_rawcust", "c_sellers", "c_assignments", "c_crm")

# lines of nine bytes under headers of eight
_THIRD = "(SELECT count(*) FROM supplier WHERE s_suppkey % 3 = 0)"
_ALL = "(SELECT count(*) FROM supplier)"
BROKEN = [
    ("erp", "produtos", f"8 + 9 * {_ALL}", _ALL, "ok"), ("erp", "pedidos", f"16 + 9 * {_ALL}", _ALL, "ok"),
    ("erp", "itens_pedido", "8", "0", "header only"), ("erp", "pagamentos", "0", "0", "empty"),
    ("erp", "estoque", "-1", "-1", "missing"), ("crm", "clientes", "NULL", _ALL, "ok"),
    *[("crm", name, f"8 + 9 * {_THIRD}", _THIRD, "ok") for name in ("vendedores", "carteira", "oportunidades")],
    ("crm", "visitas", "-1", "-1", "missing"),
]
QUERIES["broken_delivery"] = " UNION ALL ".join(
    f"SELECT '{system}' AS system, '{name}.csv' AS file, CAST({size} AS BIGINT) AS bytes, "
    f"CAST({rows} AS BIGINT) AS rows, '{verdict}' AS verdict" for system, name, size, rows, verdict in BROKEN)
