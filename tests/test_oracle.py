"""Every registered traffic query against its SQL, over whole small tables."""

import pytest

from roadtally.queries import QUERIES, SQL

from .oracle import DATA, spark_rows, sql_rows

SF = f"{DATA}/sf0.001"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    columns, found = spark_rows(QUERIES[name](spark, SF))
    if name not in SQL:
        assert found
        return
    names, expected = sql_rows(SQL[name], SF)
    assert columns == names
    assert found == expected


def test_places_shared_by_even_and_odd_departements(spark):
    """On this table several counters stand at one place; on the small one each place has one."""
    name, sf = "match_mapping_by_route_marker", f"{DATA}/sf0.1"
    assert spark_rows(QUERIES[name](spark, sf)) == sql_rows(SQL[name], sf)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
