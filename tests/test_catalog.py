"""Every registered query against its SQL, or for a plausible result where there is none."""

import pytest

from tessera.catalog import QUERIES
from tools.compare import compare, connect

FOLDER = "/root/testdata/sf0.001"
# grow or fit many models; they run in tools/compare.py and bench.py
SLOW = {"pr_04_ablation", "vs_06_two_stage_search", "rk_12_lambdamart"}


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in SLOW])
def test_query(spark, con, name):
    result = compare(spark, con, QUERIES[name], FOLDER)
    assert result.startswith(("ok", "rows")), result
    assert int(result.split()[1]) > 0


def test_entry_points():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.oracle_sql()) > 150
