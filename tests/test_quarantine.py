"""Dead letters of a dirty extract; persistent views against their functions; deliveries that fail."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from salesloom.context import Ctx, Store
from salesloom.functions import columns as C
from salesloom.plans import metrics, views
from salesloom.sources import arrival, quarantine, testdata
from salesloom.sources.ingest import IngestError
from salesloom.sources.tables import write_table

SF = "/root/testdata/sf0.001"


def test_letters_and_rows_add_up(spark, tmp_path):
    lines = ["id,day,amount", "1,2024-01-02,5", "2,not a day,6", "3,2024-01-03,much", "4,2024-01-04", "5,,7",
             "6,2024-01-05,8,9", ",2024-01-06,1", "7,nor this,neither"]
    (tmp_path / "x.csv").write_text("\n".join(lines) + "\n")
    typed = {"day": C.parse_date("day"), "amount": C.try_number("amount", "int")}
    read = quarantine.read_lines(spark, Store(spark, "t"), str(tmp_path / "x.csv"), ["id", "day"])
    kept, letters = quarantine.split(read, typed, ["id", "day"])
    assert sorted(r["id"] for r in kept.collect()) == ["1", "3"]
    got = {(r["column"], r["raw"], r["reason"], r["whole"]) for r in letters.collect()}
    assert got == {
        ("day", "not a day", "untyped", True), ("amount", "much", "untyped", False),
        (None, "4,2024-01-04", "fields", True), ("day", None, "missing", True),
        (None, "6,2024-01-05,8,9", "fields", True), ("id", None, "missing", True),
        ("day", "nor this", "untyped", True), ("amount", "neither", "untyped", False)}
    assert all(r["source"].endswith("x.csv") for r in letters.collect())
    n = {r["reason"]: r["n"] for r in quarantine.balance(read, typed, ["id", "day"]).where("column = ''").collect()}
    assert n == {"rows in": 8, "rows kept": 2, "rows quarantined": 6, "fields": 2}
    with pytest.raises(IngestError):
        quarantine.read_lines(spark, Store(spark, "t"), str(tmp_path / "x.csv"), ["id", "other"])


def test_views_equal_their_functions(spark):
    db = f"views{random.randrange(10 ** 9)}"
    spark.sql(f"CREATE DATABASE {db}")
    try:
        ctx = testdata.context(spark, SF)
        for name, df in {"sales_fact": ctx["fact"], "customers": ctx["customers"], "products": ctx["products"],
                         "stock": ctx["stock"]}.items():
            write_table(df, f"{db}.{name}")
        saved = Ctx(spark, {name: spark.table(f"{db}.{table}") for name, table in (
            ("fact", "sales_fact"), ("customers", "customers"), ("products", "products"), ("stock", "stock"))}, ctx.as_of)
        write_table(spark.range(1), f"{db}.brand_ranking")  # what an earlier release kept
        for name in views.TEXTS:
            for _ in range(2):  # again over itself
                views.publish(spark, db, name, ctx.as_of, "What it's about")
            view, want = spark.table(f"{db}.{name}"), getattr(metrics, name)(saved)
            assert sorted(view.columns) == sorted(want.columns)
            assert {f.name: f.dataType for f in view.schema} == {f.name: f.dataType for f in want.schema}
            got = [tuple(r) for r in view.select(*sorted(view.columns)).collect()]
            assert got == [tuple(r) for r in want.select(*sorted(view.columns)).collect()] and got
            found = spark.catalog.getTable(f"{db}.{name}")
            assert found.tableType == "VIEW" and found.description == "What it's about"
    finally:
        spark.sql(f"DROP DATABASE {db} CASCADE")


def test_a_delivery_is_judged_without_raising(spark, tmp_path):
    (tmp_path / "erp").mkdir()
    (tmp_path / "erp/a.csv").write_text("x\n1\n")
    (tmp_path / "erp/b.csv").write_text("x\n")
    (tmp_path / "erp/c.csv").write_text("")
    control = arrival.probe(spark, str(tmp_path), dt.datetime(2024, 1, 1), {"erp": ("a", "b", "c", "d")})
    got = {r["file"]: (r["bytes"], r["rows"], r["verdict"]) for r in arrival.judge(control).collect()}
    assert got == {"a.csv": (4, 1, "ok"), "b.csv": (2, 0, "header only"), "c.csv": (0, 0, "empty"),
                   "d.csv": (-1, -1, "missing")}
    with pytest.raises(arrival.ArrivalError):
        arrival.check_arrival(control)
