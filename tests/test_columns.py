import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from salesloom.functions import columns as C


def one(spark, value, expr, type_name="string"):
    return spark.createDataFrame([(value,)], f"v {type_name}").select(expr).first()[0]


def test_tax_id(spark):
    cases = {
        "12.345.678/0001-90": ("12345678000190", True),
        "2345678000190": ("02345678000190", True),
        "123456789012345": ("12345678901234", False),
        "": ("0" * 14, False),
        None: (None, False),
    }
    for text, expected in cases.items():
        got = spark.createDataFrame([(text,)], "v string").select(
            C.normalise_tax_id("v"), C.tax_id_valid("v")).first()
        assert tuple(got) == expected, text


def test_name(spark):
    assert one(spark, "  joão  da   SILVA ", C.normalise_name("v")) == "João Da Silva"


def test_parse_date(spark):
    day = dt.date(2024, 2, 1)
    for text, expected in {
        "2024-02-01": day, "01/02/2024": day, "31/02/2024": None, "soon": None, "": None,
        None: None,
    }.items():
        assert one(spark, text, C.parse_date("v")) == expected, text


def test_parse_date_more_formats(spark):
    assert one(spark, "2024.02.01", C.parse_date("v", ("dd/MM/yyyy", "yyyy.MM.dd"))) == dt.date(
        2024, 2, 1)


def test_flag(spark):
    for text, expected in {" S ": True, "N": False, "s": False, "": False, None: False}.items():
        assert one(spark, text, C.flag("v")) is expected


def test_net_value(spark):
    rows = spark.createDataFrame(
        [(Decimal("5.00"), True), (Decimal("-5.00"), False), (Decimal("7.50"), False)],
        "total decimal(18,2), cancelled boolean",
    ).select(C.net_value("total", "cancelled")).collect()
    assert [r[0] for r in rows] == [Decimal("0.00"), Decimal("-5.00"), Decimal("7.50")]


def test_map_values(spark):
    for text, expected in {"Fechado ganho": "Ganha", "Fechado perdido": "Perdida",
                           "Proposta": "Proposta", None: None}.items():
        assert one(spark, text, C.map_values("v", C.STAGE_NAMES)) == expected


def test_try_number(spark):
    assert one(spark, " 12.345 ", C.try_number("v", "decimal(12,2)")) == Decimal("12.35")
    assert one(spark, "abc", C.try_number("v", "int")) is None


def test_labels(spark):
    row = spark.createDataFrame([(2001, 3)], "y int, m int").select(
        C.year_month("y", "m"), C.month_start("y", "m")).first()
    assert tuple(row) == ("2001-03", "2001-03-01")


def test_safe_ratio(spark):
    df = spark.createDataFrame(
        [(Decimal("123.4550"), 1), (Decimal("1.0000"), 0), (Decimal("246.9100"), 2)],
        "n decimal(18,4), d bigint",
    )
    exact = [r[0] for r in df.select(C.safe_ratio("n", "d", 1, 2)).collect()]
    assert exact == [123.46, None, 123.46]
    plain = [r[0] for r in df.select(C.safe_ratio("n", "d")).collect()]
    assert plain == [123.455, None, 123.455]


def test_optional_filter(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "x int, y string")
    assert C.optional_filter(df, {"x": None, "y": None}).count() == 3
    assert C.optional_filter(df, {"y": ["a", "c"]}).count() == 2
    assert C.optional_filter(df, {"x": 2, "y": "b"}).count() == 1
    assert C.optional_filter(df, {"y": "it's"}).count() == 0


def test_money_rounds_half_up(spark):
    df = spark.createDataFrame([(Decimal("1.0050"),), (Decimal("-1.0050"),)], "v decimal(18,4)")
    assert [r[0] for r in df.select(C.money(F.col("v"))).collect()] == [1.01, -1.01]
