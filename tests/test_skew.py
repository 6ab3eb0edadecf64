"""The registered queries where single keys hold a third of the rows."""

import duckdb
import pytest

import __spark_entry__ as entry
from tests.compare import TABLES, database, difference

SOURCE = "/root/testdata/sf0.001"

# every third row of a table is moved to one key
MOVED = {
    "lineitem": """SELECT * REPLACE (
        CASE WHEN rowid % 3 = 0 THEN 77 ELSE l_orderkey END AS l_orderkey,
        CASE WHEN rowid % 3 = 1 THEN 12 ELSE l_partkey END AS l_partkey,
        CASE WHEN rowid % 3 = 2 THEN 3 ELSE l_suppkey END AS l_suppkey) FROM t""",
    "orders": """SELECT * REPLACE (
        CASE WHEN rowid % 3 = 0 THEN 6 ELSE o_custkey END AS o_custkey,
        CASE WHEN o_orderkey = 77 THEN 'F' ELSE o_orderstatus END AS o_orderstatus) FROM t""",
    "events": """SELECT * REPLACE (
        CASE WHEN rowid % 3 = 0 THEN 6 ELSE user_id END AS user_id) FROM t""",
}


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    root = tmp_path_factory.mktemp("skewed")
    con = duckdb.connect()
    for name in TABLES:
        con.execute(
            f"CREATE OR REPLACE TABLE t AS SELECT * FROM read_parquet('{SOURCE}/{name}.parquet')")
        body = MOVED.get(name, "SELECT * FROM t")
        con.execute(f"COPY ({body}) TO '{root}/{name}.parquet' (FORMAT parquet)")
    return str(root)


@pytest.fixture(scope="module")
def con(skewed):
    return database(skewed)


NAMES = (
    "sales_fact", "remapped_fact_totals", "dim_customer", "dim_product", "mart_seller_month",
    "mart_product_month", "abc_classes", "mart_receivables", "monthly_revenue", "brand_ranking",
    "category_margin", "customers_at_risk", "launch_effect", "features_asof", "training_label",
    "stratified_split", "rule_auc", "score_bands", "preferred_brand", "suggest_sku",
    "fn_suggest_products", "fn_availability", "feedback_merge", "queue_with_feedback",
    "dq_all", "dash_top_customers",
)


@pytest.mark.parametrize("name", NAMES)
def test_matches_sql(spark, con, skewed, name):
    df = entry.queries()[name](spark, skewed)
    assert difference(df, con, entry.oracle_sql()[name]) is None
