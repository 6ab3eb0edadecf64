import datetime as dt
import pathlib

import pytest

from salesloom.context import Store
from salesloom.plans import catalog
from salesloom.sources import arrival, ingest, tables
from salesloom.sources.manifest import EXTRACTS

SMALL = {"erp": ["produtos"], "crm": ["clientes", "visitas"]}
WHEN = dt.datetime(2024, 1, 2, 3, 4, 5)


def put(root: pathlib.Path, name: str, text: str) -> None:
    path = root / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode())


@pytest.fixture
def delivery(tmp_path):
    put(tmp_path, "erp/produtos.csv",
        'sku,descricao,ativo\r\nA,"a ""big"" one",S\r\nB,,N\r\nC,"x,y",\r\n')
    put(tmp_path, "crm/clientes.csv", "cliente_id,cnpj\n1,2\n")
    put(tmp_path, "crm/visitas.csv", "visita_id,resultado\n1,x\n2,y\n")
    return tmp_path


def test_arrival(spark, delivery):
    control = arrival.probe(spark, str(delivery), WHEN, SMALL)
    rows = {r["file"]: (r["rows"], r["bytes"]) for r in control.collect()}
    assert {f: n for f, (n, _) in rows.items()} == {
        "produtos.csv": 3, "clientes.csv": 1, "visitas.csv": 2}
    assert rows["clientes.csv"][1] == (delivery / "crm/clientes.csv").stat().st_size
    assert {r["checked_at"] for r in control.collect()} == {"2024-01-02T03:04:05"}
    arrival.check_arrival(control)
    summary = arrival.arrival_summary(control).first()
    assert (summary["files"], summary["data_rows"]) == (3, 6)


def test_missing_empty_and_header_only(spark, delivery):
    put(delivery, "crm/clientes.csv", "")
    put(delivery, "crm/visitas.csv", "visita_id,resultado\n")
    wanted = {**SMALL, "erp": ["produtos", "pedidos"]}
    control = arrival.probe(spark, str(delivery), WHEN, wanted)
    rows = {r["file"]: (r["bytes"], r["rows"]) for r in control.collect()}
    assert rows["pedidos.csv"] == (-1, -1) and rows["clientes.csv"][1] <= 0
    assert rows["visitas.csv"][1] == 0
    with pytest.raises(arrival.ArrivalError) as error:
        arrival.check_arrival(control)
    for part in ("clientes.csv: missing or empty", "visitas.csv: no data rows",
                 "pedidos.csv: missing or empty"):
        assert part in str(error.value)


def test_an_extract_may_be_a_folder_of_parts(spark, delivery):
    for part in (1, 2):
        put(delivery, f"erp/pedidos.csv/part-{part}.csv", "pedido_id,status\n1,x\n2,y\n")
    control = arrival.probe(spark, str(delivery), WHEN, {"erp": ["produtos", "pedidos"]})
    rows = {r["file"]: r["rows"] for r in arrival.check_arrival(control).collect()}
    assert rows == {"produtos.csv": 3, "pedidos.csv": 4}
    assert ingest.ingest_csv(spark, str(delivery), "erp", "pedidos").count() == 4


def test_manifest_names_ten_files():
    assert {s: len(t) for s, t in EXTRACTS.items()} == {"erp": 5, "crm": 5}


def test_text_ingest(spark, delivery):
    df = ingest.ingest_csv(spark, str(delivery), "erp", "produtos", WHEN)
    assert all(t == "string" for n, t in df.dtypes if not n.startswith("_ingested"))
    rows = {r["sku"]: r for r in df.collect()}
    assert rows["A"]["descricao"] == 'a "big" one' and rows["A"]["ativo"] == "S"
    assert rows["B"]["descricao"] is None and rows["C"]["descricao"] == "x,y"
    assert rows["C"]["ativo"] is None
    assert rows["A"]["_source_path"] == "erp/produtos.csv" and rows["A"]["_ingested_at"] == WHEN


def test_malformed_lines_are_kept_apart(spark, delivery):
    put(delivery, "crm/visitas.csv", "visita_id,resultado\n1,x\n2,y,z\n3\n")
    bad = ingest.malformed(
        spark, str(delivery / "crm/visitas.csv"), ["visita_id", "resultado"])
    assert {r["_corrupt_record"] for r in bad.collect()} == {"2,y,z", "3"}


def test_reconciliation(spark, delivery):
    control = arrival.probe(spark, str(delivery), WHEN, SMALL)
    loaded = ingest.ingest_all(spark, str(delivery), SMALL, WHEN)
    ingest.assert_reconciled(ingest.reconcile_ingest(control, ingest.row_counts(loaded)))
    short = {**loaded, "visitas": loaded["visitas"].limit(1)}
    with pytest.raises(ingest.IngestError, match="visitas.csv file 2 table 1"):
        ingest.assert_reconciled(ingest.reconcile_ingest(control, ingest.row_counts(short)))
    extra = {**loaded, "pedidos": loaded["visitas"]}
    with pytest.raises(ingest.IngestError, match="pedidos.csv file None table 2"):
        ingest.assert_reconciled(ingest.reconcile_ingest(control, ingest.row_counts(extra)))


@pytest.fixture(scope="module")
def db(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS src_test")
    return "src_test"


def test_write_partitioned_and_replace(spark, db):
    df = spark.range(100).selectExpr("id", "2000 + id % 2 AS year", "id % 3 AS month")
    name = f"{db}.parts"
    tables.write_table(df, name, partition_by=("year", "month"))
    assert spark.table(name).count() == 100
    assert spark.sql(f"SHOW PARTITIONS {name}").count() == 6
    tables.replace_table(
        spark.table(name).where("id < 10"), name, Store(spark, "t"), partition_by=("year", "month"))
    assert spark.table(name).count() == 10
    tables.write_table(df.select("id"), name)
    assert spark.table(name).columns == ["id"]


def test_bucketed_join_has_no_exchange(spark, db):
    df = spark.range(1000).selectExpr("id AS k", "id AS v")
    for name in ("left_b", "right_b"):
        tables.write_bucketed(df, f"{db}.{name}", "k", 4, ["k"])
    joined = spark.table(f"{db}.left_b").join(
        spark.table(f"{db}.right_b").hint("merge"), "k")
    assert "Exchange" not in joined._jdf.queryExecution().sparkPlan().toString()
    assert joined.count() == 1000


def test_ensure_table_keeps_rows(spark, db):
    name = f"{db}.feedback"
    schema = "customer_id bigint, status string"
    tables.ensure_table(spark, name, schema, {"status": "what it's about"})
    spark.sql(f"INSERT INTO {name} VALUES (1, 'vendeu')")
    assert tables.ensure_table(spark, name, schema).count() == 1
    assert spark.catalog.listColumns(name)[1].description == "what it's about"


def test_required_tables(spark, db):
    spark.range(1).createOrReplaceTempView("there")
    tables.require_tables(spark, ["there"])
    with pytest.raises(tables.MissingTables, match="gone, also_gone"):
        tables.require_tables(spark, ["there", "gone", "also_gone"])


def test_comments_and_audit(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS audit_test")
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    tables.write_table(df, "audit_test.full", comments={"id": "key", "v": "it's a value"})
    tables.write_table(df, "audit_test.half", comments={"id": "key"})
    catalog.apply_comments(spark, "audit_test.full", "all there")
    catalog.create_view(
        spark, "audit_test.seen", "SELECT id FROM audit_test.full", "a view", {"id": "key"})
    cover = catalog.comment_coverage(catalog.metadata(spark, "audit_test"))
    got = {r["table_name"]: (r["table_status"], r["commented"], r["uncommented"])
           for r in cover.collect()}
    assert got == {"full": ("OK", 2, 0), "half": ("SEM COMMENT", 1, 1), "seen": ("OK", 1, 0)}
    with pytest.raises(catalog.AuditFailed, match="half"):
        catalog.audit(cover)
    catalog.apply_comments(spark, "audit_test.half", "now too")
    cover = catalog.comment_coverage(catalog.metadata(spark, "audit_test"))
    catalog.audit(cover, ["full", "seen"])
    with pytest.raises(catalog.AuditFailed, match="half: table OK, 1 columns"):
        catalog.audit(cover, ["half"])
    catalog.apply_comments(spark, "audit_test.half", None, {"v": "value"})
    catalog.audit(catalog.comment_coverage(catalog.metadata(spark, "audit_test")), ["half"])
