"""The batch from dirty CSV files to the call queue."""

import csv
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from salesloom.plans import pipeline
from salesloom.sources.manifest import COLUMNS, EXTRACTS

AS_OF = dt.date(2024, 6, 30)
TRAIN = dt.date(2024, 6, 20)


def text(day, i):
    return day.strftime("%d/%m/%Y") if i % 3 else day.isoformat()


def rows_of_delivery():
    random.seed(11)
    start = dt.date(2023, 9, 1)
    customers = [
        {"cliente_id": i, "cnpj": f"{10**13 + i // 2 if i in (40, 41) else 10**13 + 1000 + i}",
         "razao_social": f"  LOJA   {i} ", "data_cadastro": text(start, i), "ativo": "S",
         "segmento": "Varejo", "cidade": "" if i == 1 else "Natal", "uf": "RN", "bairro": ""}
        for i in range(1, 121)
    ]
    sellers = [
        {"vendedor_id": i, "nome": f"V{i}", "regiao": "NE", "uf": "RN",
         "data_admissao": "2020-01-01", "data_desligamento": "2024-01-01" if i == 4 else "",
         "meta_mensal": 1000 * i} for i in range(1, 6)
    ]
    products = [
        {"sku": f"S{i}", "descricao": f"P {i}", "categoria": f"C{i % 3}", "marca": f"M{i % 4}",
         "nota_olfativa": "x", "preco_tabela": 10 + i, "custo_unitario": 4 + i, "unidade": "UN",
         "ativo": "N" if i == 2 else "S", "data_lancamento": "2024-05-01" if i == 3 else ""}
        for i in range(1, 13)
    ]
    orders, items, payments = [], [], []
    for n in range(1, 1201):
        day = start + dt.timedelta(days=random.randint(0, 302))
        customer = random.randint(1, 120) if n % 3 else random.randint(1, 20)
        cancelled = n % 50 == 0
        lines = []
        for k in range(1 + n % 3):
            sku = random.randint(1, 12)
            quantity = -1 if (n + k) % 40 == 0 else random.randint(1, 5)
            lines.append(quantity * (10 + sku))
            items.append({"item_id": n * 10 + k, "pedido_id": n, "sku": f"S{sku}",
                          "quantidade": quantity, "valor_bruto": lines[-1], "desconto_pct": 0,
                          "preco_praticado": f"{10 + sku}.00"})
        orders.append({"pedido_id": n, "cliente_id": customer, "vendedor_id": 1 + customer % 5,
                       "data_pedido": text(day, n), "canal": "loja",
                       "status": "Cancelado" if cancelled else "Faturado",
                       "valor_total": sum(lines)})
        payments.append({"pagamento_id": n, "pedido_id": n, "forma_pagamento": "pix",
                         "parcelas": 1, "valor": sum(lines), "valor_liquido": sum(lines),
                         "taxa_pct": 0, "data_vencimento": text(day, n),
                         "data_pagamento": text(day, n) if n % 4 else "",
                         "status_pagamento": "Pago" if n % 4 else "Aberto"})
    return {
        "clientes": customers, "vendedores": sellers, "produtos": products, "pedidos": orders,
        "itens_pedido": items, "pagamentos": payments,
        "estoque": [{"data_snapshot": d, "sku": f"S{i}", "saldo": i % 4}
                    for d in ("31/05/2024", "2024-06-01") for i in range(1, 13)],
        "carteira": [{"carteira_id": i, "cliente_id": i, "vendedor_id": 1 + i % 5,
                      "data_inicio": "2023-01-01", "data_fim": "2024-02-01" if i == 7 else ""}
                     for i in range(1, 121)],
        "oportunidades": [
            {"oportunidade_id": i, "cliente_id": i, "vendedor_id": 1, "origem": "site",
             "data_abertura": "2024-05-01", "data_fechamento": "2024-05-09",
             "etapa": "Fechado ganho", "probabilidade_pct": 50, "ciclo_dias": 8,
             "valor_estimado": 10, "motivo_perda": ""} for i in range(1, 60)],
        "visitas": [{"visita_id": i, "cliente_id": i, "vendedor_id": 1,
                     "data_visita": "01/06/2024", "resultado": "Fez pedido", "duracao_min": 30}
                    for i in range(1, 60)],
    }


@pytest.fixture(scope="module")
def delivery(tmp_path_factory):
    root = tmp_path_factory.mktemp("delivery")
    rows = rows_of_delivery()
    for system, names in EXTRACTS.items():
        (root / system).mkdir()
        for name in names:
            with open(root / system / f"{name}.csv", "w", newline="") as f:
                out = csv.DictWriter(f, COLUMNS[name])
                out.writeheader()
                out.writerows(rows[name])
    return root


def test_full_run(spark, delivery, tmp_path):
    ctx = pipeline.run(
        spark, str(delivery), "shop", str(tmp_path), AS_OF, TRAIN, fact_rows=(1000, 3000),
        queue_size=30, iterations=3, gates=False,
    )
    queue = spark.table("shop.call_queue")
    assert queue.count() == 30
    assert queue.where("name RLIKE '  '").count() == 0
    assert queue.where(F.col("seller") == "V4").count() == 0  # has left
    customers = ctx["customers"]
    assert customers.count() == 119  # two share a tax id
    fact = spark.table("shop.sales_fact")
    assert fact.where("customer_id = '41'").count() == 0
    assert fact.where("is_return AND revenue >= 0").count() == 0
    assert fact.where("city = 'Nao informada'").select("customer_id").distinct().count() == 1
    assert spark.sql("SHOW PARTITIONS shop.sales_fact").count() == 10
    assert spark.table("shop.model_metrics").first()["version"] == 1
    assert spark.table("shop.call_feedback").count() == 0
    described = {c.name: c.description for c in spark.catalog.listColumns("shop.sales_fact")}
    assert all(described.values())


def test_a_late_file_stops_the_run(spark, delivery, tmp_path):
    (delivery / "crm" / "visitas.csv").write_text(",".join(COLUMNS["visitas"]) + "\n")
    with pytest.raises(RuntimeError, match="crm/visitas.csv: no data rows"):
        pipeline.run(spark, str(delivery), "shop_late", str(tmp_path), AS_OF, TRAIN)
