"""Every registered query against its DuckDB statement on the same tables."""

import pytest

import __spark_entry__ as entry
from oracle.compare import connect, differences
from oracle.statements import statements
from terroir import catalog

QUERIES = catalog.queries()
STATEMENTS = statements()


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(STATEMENTS)
    assert QUERIES.keys() <= entry.queries().keys() and STATEMENTS.items() <= entry.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, sf, duck):
    assert differences(QUERIES[name](spark, sf), duck, STATEMENTS[name]) is None


def test_flagship(spark):
    df = entry.entry(spark)
    communes = connect("/root/testdata/sf0.001").execute(STATEMENTS["mart_logement_commune"]).fetchall()
    assert df.count() == len(communes) > 20
    assert len(df.columns) == 29


@pytest.mark.parametrize("name", [n for n in sorted(QUERIES) if "fauti" in n])
def test_faults_are_found(name, spark, sf):
    rows = QUERIES[name](spark, sf).collect()
    assert rows and (not hasattr(rows[0], "echecs") or any(r.echecs > 0 for r in rows))
