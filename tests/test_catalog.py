"""The catalogue against DuckDB, and what the plans must not contain."""

import glob
import os

import duckdb
import pytest

from conftest import DATA
from tableworks.plans import analytics_queries, catalog, core_queries, registry  # noqa: F401
from tools.check import canonical
from tools.plans import plan_of, smells

# no SQL twin: models, forecasts, sketches and Python text cutting
ROWS_ONLY = {
    "chunk_by_heading", "embed", "vector_near", "train_and_score", "score_boosted", "score_latest", "forecast_groups",
    "billing_forecast", "document_index",
}


def test_every_query_has_its_twin():
    queries, twins = registry.queries(), registry.oracle_sql()
    assert set(queries) - set(twins) == ROWS_ONLY
    assert set(twins) <= set(queries)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


FAST = ["map_codes", "join_asof", "join_range", "rolling_range", "merge_intervals", "assign_episode", "trailing_aggregates", "loss_ratio",
        "multi_level_totals", "apply_changes_scd2", "update_scd2", "merge_upsert", "expect", "quarantine", "custom_metrics", "entity_current",
        "training_set", "text_similarity", "prepare_series", "clinical_visits", "feedback_dataset", "sync_tables"]


@pytest.mark.parametrize("name", FAST)
def test_matches_sql(spark, duck, name):
    got = canonical(registry.queries()[name](spark, DATA).toPandas())
    want = canonical(duck.execute(registry.oracle_sql()[name]).df())
    assert list(got.columns) == list(want.columns) and got.equals(want)


# windows over one row per day or month, or one row per piece, may use one task
SMALL_WINDOWS = {"surrogate_key", "append_with_keys", "clinical_visits", "period_change", "rolling_days"}


@pytest.mark.parametrize("name", sorted({*FAST, *SMALL_WINDOWS} - {"sync_tables"}) + ["join_cross_scalar", "vector_top_k"])
def test_plans_have_no_cross_products(spark, name):
    found = smells(plan_of(registry.queries()[name](spark, DATA)))
    assert not found or (name in SMALL_WINDOWS and found == ["single-partition window"])


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(registry.queries()["query_files"](spark, DATA))
    assert "GreaterThan(o_totalprice,100000.0)" in plan
    assert "ReadSchema: struct<o_totalprice:double,o_orderstatus:string>" in plan or "ReadSchema: struct<o_orderstatus:string,o_totalprice:double>" in plan


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
