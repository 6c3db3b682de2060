"""Every registered query against its SQL counterpart on the smallest tables."""

import os

import pytest

import __spark_entry__ as contract
from bindings.registry import ENTRIES
from tools.compare import difference, duck

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not mounted")


@pytest.fixture(scope="module", autouse=True)
def compiled(spark):
    """The plans run as in production: with generated code."""
    names = {"spark.sql.codegen.wholeStage": "true", "spark.sql.codegen.factoryMode": "FALLBACK"}
    before = {n: spark.conf.get(n) for n in names}
    for n, value in names.items():
        spark.conf.set(n, value)
    yield
    for n, value in before.items():
        spark.conf.set(n, value)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(ENTRIES))
def test_query(spark, con, name):
    frame = contract.queries()[name](spark, SF)
    assert difference(frame, con, contract.oracle_sql()[name]) is None


def test_entry(spark):
    assert contract.entry(spark).count() > 0
