"""Every registered query against its SQL on the smallest tables."""

import pytest

from checks.compare import difference, rows_of
from checks.oracle import statement
from checks.registry import ORACLES, QUERIES, edge

from .conftest import SF_DIR

FIXTURES = [
    "roster", "override", "bdm", "agent", "sales", "partner", "policy", "quotes", "dp_master", "supply", "fav_pool",
    "files", "wide_names", "wide_roster",
]


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, con, name):
    assert difference(spark, con, QUERIES[name], ORACLES[name], SF_DIR) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", FIXTURES)
def test_input_tables_are_the_same_in_both_engines(spark, con, fx, name):
    df = edge(getattr(fx, name))
    kinds = {f.name: f.dataType.simpleString() for f in getattr(fx, name).schema}
    text = tuple(c for c, kind in kinds.items() if kind == "date")
    doubles = tuple(c for c, kind in kinds.items() if kind.startswith("decimal"))
    result = con.execute(statement(f"SELECT * FROM fx_{name}", dates=text, doubles=doubles))
    names = [d[0] for d in result.description]
    theirs = result.fetchall()
    at = {n: i for i, n in enumerate(names)}
    plain = [[str(r[at[c]])[:19] if kinds[c].startswith("timestamp") else r[at[c]] for c in df.columns] for r in theirs]
    assert rows_of(df.columns, df.collect()) == rows_of(df.columns, plain)
