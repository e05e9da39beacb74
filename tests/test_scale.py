"""Plans and results where no table is broadcast, as on large inputs."""

import os
import sys
from collections import Counter

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from check import check, connect  # noqa: E402

from __spark_entry__ import SMALL, oracle_sql, queries  # noqa: E402
from tillroll.catalog.all import QUERIES  # noqa: E402
from tillroll.operators.prepare import drop_duplicate_lines  # noqa: E402
from tillroll.sources.retail_view import retail_lines  # noqa: E402

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables are not here")


@pytest.fixture
def no_broadcast(spark):
    known = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", known)


@pytest.fixture(scope="module")
def known_lines(spark):
    """The lines as they are with broadcast joins."""
    return Counter(retail_lines(spark, SMALL).collect())


def test_lines_move_twice(known_lines, no_broadcast):
    """Once for orders and once for parts; removing duplicates then needs no shuffle of its own."""
    lines = retail_lines(no_broadcast, SMALL)
    few = drop_duplicate_lines(lines)
    plan = few._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "ENSURE_REQUIREMENTS" in line]
    assert not [line for line in moved if "InvoiceNo" in line]
    assert sum("l_orderkey" in line or "(StockCode" in line for line in moved) == 2
    assert Counter(lines.collect()) == known_lines
    assert Counter(few.collect()) == Counter(dict.fromkeys(known_lines, 1))


@pytest.mark.parametrize("name", ["pair_study", "spearman", "p99_clip", "histogram"])
def test_lines_are_read_once_by_studies_of_measures(no_broadcast, name):
    """What the query is asked for reads written measures; the lines were read when they were written."""
    answer = QUERIES[name].run(no_broadcast, SMALL)
    assert "lineitem" not in answer._jdf.queryExecution().optimizedPlan().toString()
    assert check(no_broadcast, connect(SMALL), SMALL, name, queries()[name], oracle_sql()[name]) == ""
