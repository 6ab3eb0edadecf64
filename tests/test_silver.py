import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from salesloom.operators.contracts import Check, enforce, quarantine
from salesloom.operators.rank import survivor_map
from salesloom.plans import silver

CUSTOMERS = (
    "cliente_id string, cnpj string, razao_social string, data_cadastro string, ativo string, "
    "segmento string, cidade string, uf string, bairro string"
)


def customers(spark, *rows):
    return spark.createDataFrame(
        [(i, tax, name, date, active, "s", "c", "u", None) for i, tax, name, date, active in rows],
        CUSTOMERS,
    )


def test_oldest_registration_survives(spark):
    raw = customers(
        spark,
        ("2", "11.111.111/0001-11", "ana", "2020-01-02", "S"),
        ("1", "11111111000111", "ANA", "03/01/2020", "N"),
        ("3", "11111111000111", "Ana", "not a date", "S"),
        ("5", "22222222000122", "bob", "2020-01-01", "S"),
        ("4", "22222222000122", "bob", "2020-01-01", "S"),
    )
    kept = {r["customer_id"]: r for r in silver.clean_customers(raw).collect()}
    assert set(kept) == {"2", "4"}
    assert kept["2"]["registered_on"] == dt.date(2020, 1, 2) and kept["2"]["active"] is True


def test_rows_without_valid_tax_id_are_not_merged(spark):
    raw = customers(
        spark,
        ("1", "", "a", "2020-01-01", "S"), ("2", "--", "b", "2020-01-01", "S"),
        ("3", None, "c", "2020-01-01", "S"), ("4", "123456789012345", "d", "2020-01-01", "S"),
        ("5", "123456789012349", "e", "2020-01-01", "S"),
    )
    assert silver.clean_customers(raw).count() == 5


def test_repeated_customer_id_gives_one_row(spark):
    raw = customers(
        spark,
        ("1", "11111111000111", "a", "2020-01-02", "S"),
        ("1", "22222222000122", "a", "2020-01-01", "S"),
    )
    assert [r["tax_id"] for r in silver.clean_customers(raw).collect()] == ["22222222000122"]


def test_survivor_map(spark):
    raw = customers(
        spark,
        ("2", "11111111000111", "a", "2020-01-02", "S"),
        ("1", "11111111000111", "a", "2020-01-03", "S"), ("3", "", "b", "2020-01-01", "S"),
    )
    rows = silver.standardise_customers(raw).select(
        silver.identity_key().alias("k"), "customer_id", "registered_on")
    mapped = survivor_map(rows, ["k"], silver.survivor_order(), "customer_id").collect()
    assert {tuple(r) for r in mapped} == {("2", "2"), ("1", "2"), ("3", "3")}


def test_orders(spark):
    raw = spark.createDataFrame(
        [("1", "c", "v", "2024-01-31", "loja", " Cancelado ", "10.00"),
         ("2", "c", "v", "31/01/2024", "loja", "Faturado", "-3.50"),
         ("3", "c", "v", "31/02/2024", "loja", "", "x")],
        "pedido_id string, cliente_id string, vendedor_id string, data_pedido string, "
        "canal string, status string, valor_total string",
    )
    rows = {r["order_id"]: r for r in silver.clean_orders(raw).collect()}
    assert rows["1"]["cancelled"] and rows["1"]["net_value"] == 0
    assert rows["1"]["total_value"] == Decimal("10.00")
    assert rows["2"]["net_value"] == Decimal("-3.50") and rows["2"]["year"] == 2024
    assert rows["3"]["order_date"] is None and rows["3"]["net_value"] is None
    assert not rows["3"]["cancelled"]


def test_items_and_discontinued(spark):
    raw = spark.createDataFrame(
        [("1", "o", "A", "-2", "10", "0", "5.00"), ("2", "o", "B", "3", "10", "0", "1.10"),
         ("3", "o", "Z", "1", "10", "0", "oops")],
        "item_id string, pedido_id string, sku string, quantidade string, valor_bruto string, "
        "desconto_pct string, preco_praticado string",
    )
    products = spark.createDataFrame([("A", True), ("B", False)], "sku string, active boolean")
    rows = {r["item_id"]: r for r in silver.flag_discontinued(
        silver.clean_items(raw), products).collect()}
    assert rows["1"]["is_return"] and rows["1"]["quantity_abs"] == 2
    assert rows["1"]["revenue"] == Decimal("-10.00") and not rows["1"]["discontinued"]
    assert rows["2"]["discontinued"] and rows["3"]["discontinued"]
    assert rows["3"]["revenue"] is None


def test_stock_uses_the_parsed_date(spark):
    raw = spark.createDataFrame(
        [("31/01/2024", "A", "0"), ("2024-02-01", "A", "4")],
        "data_snapshot string, sku string, saldo string")
    stock = silver.clean_stock(raw)
    newest = stock.orderBy(F.desc("snapshot_on")).first()
    assert newest["balance"] == 4 and not newest["stock_out"]


def test_assignment_state(spark):
    sellers = spark.createDataFrame(
        [("1", None), ("2", dt.date(2024, 1, 1))], "seller_id string, left_on date")
    raw = spark.createDataFrame(
        [("a", "c", "1", "2024-01-01", None), ("b", "c", "2", "2024-01-01", None),
         ("c", "c", "1", "2024-01-01", "2024-02-01"), ("d", "c", "9", "2024-01-01", None),
         ("e", "c", "1", "2024-01-01", "unreadable")],
        "carteira_id string, cliente_id string, vendedor_id string, data_inicio string, "
        "data_fim string")
    rows = {r["assignment_id"]: (r["current"], r["orphaned"], r["seller_known"])
            for r in silver.clean_assignments(raw, sellers).collect()}
    assert rows == {
        "a": (True, False, True), "b": (False, True, True), "c": (False, False, True),
        "d": (True, False, False), "e": (False, False, True),
    }


def test_contracts(spark):
    df = spark.createDataFrame([(1, 5), (2, -1), (3, None)], "id int, q int")
    checks = [Check("positive", "q > 0")]
    good, bad = quarantine(df, checks)
    assert {r["id"] for r in good.collect()} == {1, 3}
    assert [(r["id"], r["_violations"]) for r in bad.collect()] == [(2, ["positive"])]
    assert enforce(df.where("id <> 2"), checks).count() == 2
    with pytest.raises(Exception, match="contract positive broken"):
        enforce(df, checks).collect()


def test_stamp(spark):
    df = spark.range(3).toDF("id")
    out = silver.stamp(df, df).collect()
    assert all(r["_source_rows"] == 3 and r["_processed_at"] for r in out)


def test_conversion_losses(spark):
    raw = spark.createDataFrame([("1",), ("x",), ("",), (None,)], "v string")
    out = silver.conversion_losses(raw, {"v": F.col("v").try_cast("int")}).collect()
    assert [tuple(r) for r in out] == [("v", 2, 1)]
