"""The registered queries against their SQL; a few per group here, all of them in compare.py."""

import duckdb
import pytest

import __spark_entry__ as entry
from compare import TABLES, compare

SF = "/root/testdata/sf0.001"
SAMPLE = [
    "q05_grad_rate_country", "q12_top_performers", "q30_funnel", "g12_avg_skills", "g25_success_factors", "g26_peer_pairs",
    "g28_skill_cooccurrence", "g29_mobility", "j08_similar_learners", "t5_learner_journey", "t8_time_to_employment",
    "hist_learning", "hist_professional", "hist_transitions", "hist_sequence", "hist_distribution", "ent_learner",
    "edge_enrolled_in", "val_emp_consistency", "dq_report", "p12_concurrent", "src_csv", "inc_checkpoint",
    "inc_progress", "src_factory", "snk_clear", "snk_nodes", "q00_describe", "cat_schema", "q25_fallback", "q25_with_match", "q02b_by_city_broad",
    "g34_reachable", "g43_shortest_path", "g39_similar_context", "hist_sequence_all", "hist_learning_fallback", "st_professional", "fn_safe_casts",
    "fn_city_id_parity", "ent_city", "t1_top_countries",
]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, con, name):
    ok, note = compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], SF)
    assert ok, note


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
