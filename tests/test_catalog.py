"""Registered queries against their SQL on the smallest tables; ``TILLROLL_ALL=1`` checks every one."""

import os
import re
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from check import check, connect  # noqa: E402

from __spark_entry__ import SMALL, entry, oracle_sql, queries  # noqa: E402
from tillroll.catalog.all import QUERIES  # noqa: E402

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables are not here")

SOME = [
    "scan_transactions", "dedup", "clean_dataset", "cleaning_decisions", "monthly_revenue", "categorical_frequencies",
    "iqr_flags", "spearman", "gini", "sample_n", "customer_features", "future_target", "stratified_split",
    "cluster_profiles", "silhouette_euclidean", "classifier_metrics", "recommendation_facts",
]


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", list(oracle_sql()) if os.environ.get("TILLROLL_ALL") else SOME)
def test_query_matches_its_sql(spark, con, name):
    assert check(spark, con, SMALL, name, queries()[name], oracle_sql()[name]) == ""


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0


def test_sql_belongs_to_queries():
    assert set(oracle_sql()) <= set(queries())
    # training-text queries come from their own subpackage alone
    assert not [n for n in QUERIES if "pipeline" in n or re.match(r"op\d", n)]
