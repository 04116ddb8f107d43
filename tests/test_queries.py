"""Every query that SQL can state, against DuckDB; the others run and give rows."""

import math

import duckdb
import numpy as np
import pandas as pd
import pytest
from small_tables import SF

from chronogrid.plans import registry

TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def canonical(df: pd.DataFrame) -> list[tuple]:
    def cell(v):
        if pd.isna(v):
            return ""
        if hasattr(v, "strftime"):
            return v.strftime("%Y-%m-%d")
        if isinstance(v, (int, float, np.number)) and not isinstance(v, bool):
            return float(v) + 0.0
        return str(v)

    return [tuple(cell(v) for v in row) for row in df[sorted(df.columns)].itertuples(index=False)]


def ordered(rows: list[tuple]) -> list[tuple]:
    """Texts first, then numbers by their leading digits, so that both sides' rows stand in one order."""
    return sorted(rows, key=lambda r: ([x for x in r if isinstance(x, str)], [float(f"{x:.6g}") for x in r if not isinstance(x, str)]))


def alike(x: tuple, y: tuple) -> bool:
    return all(math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-7) if isinstance(a, float) and isinstance(b, float) else a == b for a, b in zip(x, y))


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_matches_sql(spark, duck, name):
    ours, theirs = registry.QUERIES[name](spark, SF).toPandas(), duck.sql(registry.SQL[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert len(ours) == len(theirs)
    wrong = [(x, y) for x, y in zip(ordered(canonical(ours)), ordered(canonical(theirs))) if not alike(x, y)]
    assert not wrong, wrong[:3]


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.SQL)))
def test_gives_rows(spark, name):
    assert registry.QUERIES[name](spark, SF).limit(5).count() > 0


def test_entry_is_small_and_stable(spark):
    import __spark_entry__ as e

    assert e.entry(spark).columns[:3] == ["vi", "region", "year_label"]
    assert set(e.oracle_sql()) <= set(e.queries())


def test_range_predicate_reaches_the_scan(spark):
    from chronogrid.operators.filters import valid_range

    df = valid_range(spark.read.parquet(f"{SF}/lineitem.parquet"), 5.0, 10.0, "l_quantity")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_quantity,5.0)" in plan and "LessThanOrEqual(l_quantity,10.0)" in plan
