import pytest

import __spark_entry__ as registered
import compare
from segflow.plans.oracles import ORACLES
from segflow.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return compare.connect(SF)


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLES)
    assert set(registered.oracle_sql()) <= set(registered.queries())


def test_entry(spark):
    rows = registered.entry(spark)
    assert rows.columns == ["transaction_file_source_id", "request_pos", "request_segment", "pos", "key", "value"]
    assert rows.count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, db, name):
    assert compare.compare(spark, db, name, SF) is None
