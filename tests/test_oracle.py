"""Every registered order query that has SQL gives DuckDB's rows on the smallest tables."""

import math

import duckdb
import pandas as pd
import pytest

from bloomline.plans import inventory_queries, order_queries, structure_queries, weekly_queries  # noqa: F401
from bloomline.plans.fixtures import TABLES
from bloomline.plans.registry import QUERIES, SQL

#: Whole chains that the smaller queries below cover in parts are left to the driver's run at a larger scale.
SMALL = [
    "clean_orders", "clean_inventory", "state_summary", "classify_market", "type_reference", "client_recency", "client_top_share",
    "mix_color", "sales_client_period", "client_week_sku", "repeated_structures", "typical_week", "composition_signature",
    "stem_conservation_audit", "purchase_priority", "color_shortage_top", "solid_weekly_demand", "week_panel", "market_year_growth",
]


def shown(df: pd.DataFrame) -> list[tuple]:
    def one(v):
        if v is None or v is pd.NaT or isinstance(v, float) and math.isnan(v):
            return "~"
        if isinstance(v, str):
            return v
        if hasattr(v, "strftime"):
            return pd.Timestamp(v).strftime("%F")
        return f"{float(v):.6g}"

    return sorted(tuple(one(v) for v in row) for row in df[sorted(df.columns)].itertuples(index=False))


@pytest.fixture(scope="session")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", SMALL)
def test_query_matches_sql(spark, duck, sf_dir, name):
    mine = QUERIES[name](spark, sf_dir).toPandas()
    other = duck.execute(SQL[name]).df()
    assert sorted(mine.columns) == sorted(other.columns)
    assert shown(mine) == shown(other)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_backtest_has_all_models(spark, sf_dir):
    from bloomline.operators import weekly

    rows = QUERIES["forecast_backtest"](spark, sf_dir)
    metrics = {r.model: r for r in weekly.forecast_metrics(rows, weekly.MODELS).collect()}
    assert set(metrics) == set(weekly.MODELS)
    assert all(m.mae >= 0 and m.wape is not None for m in metrics.values())
    assert rows.where("two_stage < 0").count() == 0


def test_entry_imports_without_a_session():
    import os
    import subprocess
    import sys

    code = "import __spark_entry__ as e; assert set(e.oracle_sql()) <= set(e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))), check=True)
