"""Every query of the catalogue against its SQL on the smallest tables."""

import importlib

import pytest
from conftest import SF_DIR, same

from mereflow.plans import CATALOGUE

CASES = [(m, k) for m in CATALOGUE for k in importlib.import_module(f"mereflow.plans.{m}").QUERIES]


@pytest.mark.parametrize("module,name", CASES)
def test_query(spark, duck, module, name):
    m = importlib.import_module(f"mereflow.plans.{module}")
    df = m.QUERIES[name](spark, SF_DIR)
    if name in m.ORACLE:
        same(df, duck, m.ORACLE[name])
    else:
        assert df.collect()


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
