"""Every query that has SQL gives the SQL's rows, names and types."""

import pytest
from oracle import database, differences

from workload import ALL


@pytest.fixture(scope="module")
def connection(sf_dir):
    return database(sf_dir)


@pytest.mark.parametrize("name", [n for n, q in ALL.items() if q.sql])
def test_same_as_sql(spark, sf_dir, connection, name):
    query = ALL[name]
    assert differences(query.run(spark, sf_dir), connection, query.sql) == []


def test_entry_points(spark):
    import __spark_entry__ as entry

    rows = entry.entry(spark).collect()
    assert len(rows) == 20 and rows[0]["n"] >= rows[-1]["n"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert all(callable(run) for run in entry.queries().values())


def test_sql_states_sparks_stop_words(spark):
    from verbatide.operators.features import stop_list
    from workload import sql as S

    assert S.SPARK_STOP_WORDS + S.V.STOP_MARKS == stop_list()
