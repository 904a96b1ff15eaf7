"""Registered queries against their oracle on the smallest driver tables."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
from tools.verify import TABLES, rows_of

DATA = Path("/root/testdata/sf0.001")
SAMPLE = [
    "agg_06_scorecard_pivot", "agg_10_fd_mining", "agg_11_median_and_mad", "agg_25_roc_auc", "chk_06_city_fits_zip", "dr_01_psi",
    "dr_06_drifted_share", "exp_01_12_delivery_suite", "fn_02_make_gtin13", "inj_13_disturbed_events", "jn_07_denial_constraint",
    "jn_09_blocked_pairs", "jn_13_seasonal_windows", "ml_03_ecod", "prd_12_month_batch", "rep_08_apply_edits", "rul_11_sale_beyond_stock",
    "set_02_split_by_cause", "src_10_flatten_json", "str_04_windowed_metrics", "top_02_top_share", "val_04_ddl_load", "win_05_cusum",
]


@pytest.fixture(scope="module")
def oracle():
    duckdb = pytest.importorskip("duckdb")
    if not DATA.exists():
        pytest.skip("no driver tables")
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_oracle(spark, oracle, name):
    df = entry.queries()[name](spark, str(DATA))
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = oracle.execute(entry.oracle_sql()[name])
    assert got == rows_of([c[0] for c in cursor.description], cursor.fetchall())


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
