"""Physical-plan guards (sf0.001).  Queries with an SQL twin are guarded where
they are compared (``test_oracle.py``); this file guards the others and the
flagship scan, and runs the queries without a twin once.
"""
import pytest

from plumbline.plans.catalog import load_all
from tests.conftest import SF0001
from tests.plan_guard import check_plan

REG = load_all()


@pytest.mark.parametrize("name", sorted(n for n, (_f, sql) in REG.items() if sql is None))
def test_plan_and_rows_without_twin(spark, name):
    df = REG[name][0](spark, SF0001)
    check_plan(name, df)
    assert df.count() > 0


def test_entity_scan_is_pruned_and_read_once(spark):
    plan = check_plan("entity_table", REG["entity_table"][0](spark, SF0001))
    assert "l_quantity" not in plan and "l_shipdate" not in plan and "c_acctbal" not in plan
    assert plan.count("FileScan parquet") == 5
