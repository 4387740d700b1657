"""Every registered query against its SQL twin, at the smallest scale."""

import sys

import __spark_entry__ as entry
import pytest

sys.path.insert(0, "tools")

from tools.compare import connect, sorted_rows  # noqa: E402


@pytest.fixture(scope="session")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_query_has_a_twin():
    assert set(entry.BUILDERS) <= set(entry.queries()) and set(entry.BUILDERS) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(entry.BUILDERS))
def test_query_matches_its_twin(spark, duck, sf_dir, name):
    df = entry.queries()[name](spark, sf_dir)
    got = sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    cursor = duck.execute(entry.oracle_sql()[name])
    want = sorted_rows([d[0] for d in cursor.description], cursor.fetchall())
    assert got == want


def test_entry_has_a_stable_schema(spark, sf_dir):
    first, second = entry.entry(spark), entry.entry(spark)
    assert first.schema == second.schema and first.count() > 0
