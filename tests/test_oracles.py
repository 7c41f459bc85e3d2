"""Every registered query on whole tables against its SQL oracle."""
import pytest

import __spark_entry__ as entry
from tests.compare import differences, oracle_frame

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, name):
    got = QUERIES[name](spark, SF).toPandas()
    assert differences(got, oracle_frame(ORACLES[name], SF)) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_oracle_gives_rows(spark, name):
    assert len(QUERIES[name](spark, SF).toPandas()) > 0


def test_entry_gives_rows(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "total_records" in df.columns


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
