"""Every registered query against its DuckDB oracle (the driver's gate), on
the smallest scale so the suite stays quick; ``tests/oracle_compare.py``
runs the same check at sf0.01."""

import os

import pytest

import __spark_entry__ as E
from oracle_compare import compare, duck

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def brute_force() -> dict[str, str]:
    """Queries that SQL can't express and the tests that check them instead, as
    the test folders of optional parts name them."""
    import glob
    import runpy

    out = {}
    for path in glob.glob(os.path.join(os.path.dirname(__file__), "*", "brute_force.py")):
        out.update(runpy.run_path(path)["BRUTE_FORCE"])
    return out


def test_every_query_has_an_oracle_or_a_named_test():
    tests = brute_force()
    assert set(E.queries()) - set(E.oracle_sql()) <= set(tests)
    for name in tests.values():
        path, test = name.split("::")
        with open(os.path.join(os.path.dirname(__file__), path)) as f:
            assert f"def {test}(" in f.read(), name


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, SF, name, E.queries()[name], E.oracle_sql().get(name), con)
    assert r["status"] == ("OK" if name in E.oracle_sql() else "rows-only"), r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["store_name", "city", "total_revenue", "total_orders"]
    assert df.count() > 0
