"""Every query of the catalog against its SQL; those without SQL give rows."""

import pytest

from casita.plans import catalog
from tests.oracle import compare, connect


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_matches_sql(spark, sf_dir, con, name):
    compare(spark, con, sf_dir, catalog.queries()[name], catalog.oracle_sql()[name])


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql()) - {"p1_listings", "p2_statistics"}))
def test_gives_rows(spark, sf_dir, name):
    assert catalog.queries()[name](spark, sf_dir).count() > 0


def test_entry():
    import __spark_entry__

    assert set(catalog.queries()) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
