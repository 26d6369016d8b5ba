from pathlib import Path

import pytest
from oracle import compare, connect

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
# Queries whose SQL is run in the suite; `python tests/oracle.py FOLDER` runs all of them.
CHECKED = ["clean_lines", "customer_features", "supervised_frame", "encoded_features", "pareto_curve", "rules_all_measures", "segment_rules",
           "stratified_split", "knn_scores", "reliability_curve", "decision_table", "quality_report", "silhouette_exact", "dbscan_flags"]

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="driver tables are not here")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", CHECKED)
def test_query_matches_sql(spark, con, name):
    result = compare(spark, con, FOLDER, name, entry.queries(), entry.oracle_sql())
    assert result.startswith("ok"), result


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert len(df.columns) == 24 and not df.isEmpty()
