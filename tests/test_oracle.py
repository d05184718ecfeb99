"""Every registered query equals its DuckDB SQL on the smallest test tables
(the driver repeats this at sf0.01)."""

import pytest

import __spark_entry__ as E
from plume.plans import catalog, oracle
from plume.plans.verify import compare, duck

from .conftest import SF_SMALL

SQL = oracle.oracle_sql()
# Fitted models without a SQL form: recall is tested in test_vector_index, forecasts in test_forecast (their design matrix
# is the query forecast_design).
NO_ORACLE = {"semantic_index", "forecast_trend"}
NAMES = sorted(set(catalog.queries()) - NO_ORACLE)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(NAMES) == set(SQL), set(NAMES) ^ set(SQL)


def test_lda_topics_shape(spark):
    df = catalog.queries()["lda_topics"](spark, SF_SMALL)
    rows = df.collect()
    assert df.columns == ["topic", "rank", "term", "weight"]
    assert len(rows) == 5 * 8 and all(r["term"] for r in rows)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = catalog.queries()[name](spark, SF_SMALL)
    ok, detail = compare(df, con, SQL[name])
    assert ok, detail


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["window_start", "window_end", "source", "post_count", "total_engagement",
                          "avg_engagement", "trend_score"]
    assert df.count() > 0
