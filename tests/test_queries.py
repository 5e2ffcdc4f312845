"""Registered queries against their SQL on the smallest tables, one or more of every operator group."""

import glob
import os

import duckdb
import pytest

import __spark_entry__
from loamwork.plans import collecting, decisions, operations, registry

DATA = "/root/testdata/sf0.001"
NAMES = [
    "q_normalize_by_source", "q_consensus", "q_dataset", "q_class_metrics", "q_budget_state", "q_region_revenue", "q_page_probe", "q_record_keys", "q_canonical_record", "q_title_signals", "q_audit_sample", "q_group_split",
    "q_registry", "q_review_queue", "q_best_annotation", "q_rolling_24h", "q_ece", "q_roc_auc", "q_threshold_table", "q_summary_stats", "q_recommended_method", "q_chat_render", "q_difference", *decisions.ORACLES,
    *collecting.ORACLES, *operations.ORACLES, "q_provider_scores", "q_group_members", "q_block_candidate_pairs",
]


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")
@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for path in glob.glob(f"{DATA}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    found = registry.queries()[name](spark, DATA).toPandas()
    expected = con.sql(registry.oracle_sql()[name]).df()
    columns = sorted(expected.columns)
    assert columns == sorted(found.columns)
    a, b = (x[columns].astype(str).sort_values(columns).reset_index(drop=True) for x in (found, expected))
    assert a.equals(b)


def test_registry_is_consistent():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert len(registry.queries()) > 70
