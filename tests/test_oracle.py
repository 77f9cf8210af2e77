"""Every registered query against DuckDB, over the whole smallest tables."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as contract
from oracle import connect, difference

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
ORACLES = contract.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, duck, name):
    assert difference(contract.queries()[name](spark, FOLDER), duck, ORACLES[name]) is None


def test_entry(spark):
    assert contract.entry(spark).columns == ["productId", "count"]
    assert set(ORACLES) <= set(contract.queries())


def test_core_queries_without_the_optional_folders(tmp_path):
    root = Path(contract.__file__).parent
    copy = tmp_path / "copy"
    left_out = shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__")
    shutil.copytree(root, copy, ignore=left_out)
    script = "import __spark_entry__ as c; print(len(c.queries()), set(c.queries()) == set(c.oracle_sql()))"
    done = subprocess.run(
        [sys.executable, "-c", script], cwd=copy, capture_output=True, text=True, timeout=120,
        env={**os.environ, "PYTHONPATH": str(copy)},
    )
    core = [name for name, query in contract.queries().items() if query.__module__ == "__spark_entry__"]
    assert done.stdout.split() == [str(len(core)), "True"], done.stderr[-2000:]


def test_results_do_not_depend_on_the_session_zone(spark, duck):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    try:
        for name in ("scan_ratings", "popular_month", "popular_month_sql", "popular_month_zone"):
            found = difference(contract.queries()[name](spark, FOLDER), duck, ORACLES[name])
            assert found is None, name
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
