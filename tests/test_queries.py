"""Every query with SQL gives DuckDB's rows; the others give rows."""

import decimal
import math
from pathlib import Path

import duckdb
import pytest

from covertrail.plans import catalog, models

DATA = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def rows(names, found):
    order = sorted(names)
    at = [names.index(n) for n in order]
    made = [tuple(plain(r[i]) for i in at) for r in found]
    return order, sorted(made, key=lambda r: tuple((x is None, isinstance(x, str), x if x is not None else 0) for x in r))


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_sql(spark, duck, name):
    df = catalog.QUERIES[name](spark, str(DATA))
    result = duck.execute(catalog.SQL[name])
    assert rows(df.columns, df.collect()) == rows([c[0] for c in result.description], result.fetchall())


@pytest.mark.parametrize("name", ["l1_l4_forest", "l2_l4_boosting", "l7_model_comparison", "l8_importance", "l9_permutation_importance", "l12_dominant_cluster"])
def test_models(spark, name):
    assert models.Q[name](spark, str(DATA)).count() > 0


def test_leaf_grid(spark):
    found = models.Q["l10_leaf_grid"](spark, str(DATA)).collect()
    means = {(r.rate, r.leaves): r.mean_score for r in found}
    assert set(means) == {(rate, leaves) for rate in (0.01, 0.1, 1.0, 5.0, 10.0) for leaves in (3, 10, 30, 50)} and len(found) == 20
    assert all(r["rank"] == 1 + sum(m > r.mean_score for m in means.values()) for r in found)
    tested = [r for r in found if r.test_score is not None]
    assert [(t.rate, t.leaves) for t in tested] == [min(k for k, m in means.items() if m == max(means.values()))]
    assert 0 <= tested[0].test_score <= 1
