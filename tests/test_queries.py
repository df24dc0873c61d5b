import os

import pytest

import __spark_entry__ as contract
from oracle import compare, connect

SF = "/root/testdata/sf0.001"

# fits at full rounds take minutes; tests/test_trees.py checks the same code and SQL with few rounds
SLOW = {"second_order_trees", "leaf_wise_trees", "final_model", "tuned_search", "soft_vote", "best_family", "ensemble",
        "balance_compare", "feature_votes", "model_compare"}


def test_entry(spark):
    assert contract.entry(spark).count() == 4


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, name):
    if name in SLOW and not os.environ.get("WEAKSPOT_SLOW"):
        pytest.skip("set WEAKSPOT_SLOW=1 to run it")
    problem, rows, _ = compare(spark, connect(SF), SF, contract.queries()[name], contract.oracle_sql().get(name))
    assert problem is None
    assert rows > 0 or name in contract.oracle_sql()
