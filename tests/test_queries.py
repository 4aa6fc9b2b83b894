"""Every registered query: next to its SQL where there is one, else for shape and invariants."""

import pytest

import __spark_entry__
from checks.compare import compare, connect
from checks.oracle import ORACLE
from checks.queries import QUERIES, model_query

MODELS = [name for name in QUERIES if name.startswith("model_")]
SCREENED = [name for name in QUERIES if name.startswith("screened_")]


@pytest.fixture(scope="module")
def connection(small):
    return connect(small)


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in MODELS + SCREENED])
def test_query(spark, connection, small, name):
    _, difference = compare(spark, connection, small, name)
    assert difference == ""


@pytest.mark.parametrize("name", MODELS)
def test_model_query(spark, small, name):
    """On vectors of 1,024 columns; the bench runs them at full width."""
    rows = model_query(name.removeprefix("model_"), 1024)(spark, small).collect()
    assert sorted(r["split"] for r in rows) == ["test", "train"]
    assert all(r["rows"] > 0 and r["value"] >= 0 for r in rows)


def test_every_sql_has_its_query():
    assert set(ORACLE) <= set(QUERIES)
    assert __spark_entry__.queries().keys() >= QUERIES.keys()
    assert __spark_entry__.oracle_sql().items() >= ORACLE.items()


def test_entry(spark):
    rows = __spark_entry__.entry(spark).collect()
    assert rows and rows[0].asDict().keys() == {"movie", "avg_rating"}
