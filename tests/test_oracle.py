"""Every parcel query that SQL can express against its SQL; the others run and give rows."""

import pytest
from oracle import SF, compare

import __spark_entry__ as entry

QUERIES, SQL = entry._parcels()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    if name in SQL:
        compare(spark, QUERIES[name], SQL[name])
    else:
        assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1
