"""Every registered query against its SQL twin on the smallest tables."""

import pytest
from compare import compare, oracle_connection

from pilotlamp.plans import load_all
from pilotlamp.plans.registry import QUERIES

load_all()
FOLDER = "/root/testdata/sf0.001"
# these have nothing to report on the smallest tables
MAY_BE_EMPTY = {"j20_ambiguous_names", "o03_train_only_devices", "f30_indicator_terms", "w12_quota_selection"}


@pytest.fixture(scope="module")
def oracle():
    return oracle_connection(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, oracle, name):
    problem = compare(spark, oracle, FOLDER, QUERIES[name])
    assert problem == "" or (name in MAY_BE_EMPTY and problem in ("both empty", "no rows")), problem


def test_contract():
    import __spark_entry__ as entry
    assert set(entry.oracle_sql()) <= set(entry.queries()) and len(entry.queries()) > 120
