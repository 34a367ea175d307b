"""Every registered query against its DuckDB oracle (the driver's gate), at sf0.001."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from churnlake.plans import catalog
from conftest import SF_SMALL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

SLOW = {"train_lr", "train_rf", "train_gbt", "cross_validate", "model_importance", "score_batch",
        "score_explain", "stream_score"}


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    return v


def _rows(cols, recs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    rows = [tuple(_norm(r[i]) for i in order) for r in recs]
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_query_matches_oracle(spark, duck, name):
    sdf = entry.queries()[name](spark, SF_SMALL)
    res = duck.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(sdf.columns) == sorted(dcols)
    a = _rows(sdf.columns, [tuple(r) for r in sdf.collect()])
    b = _rows(dcols, res.fetchall())
    assert a == b


def test_every_query_has_oracle_or_is_model_stream_or_listing():
    missing = set(catalog.QUERIES) - set(catalog.ORACLE)
    assert missing <= SLOW


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["Contract", "customers", "churn_rate", "mean_risk"]
    assert df.count() == 3
