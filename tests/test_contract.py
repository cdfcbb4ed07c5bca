"""Every registered query against its SQL, and the shape of the main plan."""

import pytest

import __spark_entry__ as contract
from tests.oracle import compare, connect

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(SMALL)


@pytest.mark.parametrize("name", list(contract.oracle_sql()))
def test_query_equals_its_sql(spark, db, name):
    ok, note = compare(spark, db, SMALL, name)
    assert ok, note
    assert "TYPES" not in note, note


def test_every_library_query_has_its_sql():
    from tierwell.catalogue import ENTRIES

    assert set(ENTRIES) <= set(contract.oracle_sql())


def test_the_rest_stands_without_the_operators_for_training_data():
    """Nothing else imports them, and the contract does without them."""
    import subprocess
    import sys

    code = """
import importlib.abc, sys
class Gone(importlib.abc.MetaPathFinder):
    def find_spec(self, name, path=None, target=None):
        if name.startswith("tierwell.llm") or name == "corpus_pipeline":
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
assert "q1_volume_by_type" in e.queries() and not any(n.startswith("op") or n == "pipeline" for n in e.queries())
"""
    assert subprocess.run([sys.executable, "-c", code], timeout=120).returncode == 0


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_facts_shuffle_twice_and_join_once(spark):
    """Once by transaction to deduplicate, once by account to join; small sides aside."""
    from tierwell.catalogue.roles import Roles

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = Roles(spark, SMALL).fact._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("SortMergeJoin [account_id") == 1
    assert text.count("hashpartitioning(transaction_id") == 1
    assert "Python" not in text
