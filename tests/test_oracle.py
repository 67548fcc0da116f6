"""Every registered query equals its DuckDB oracle at sf0.01."""

import importlib.util
import os

import pytest

from oracle import compare, duck

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")

spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
entry_mod = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry_mod)
QUERIES = entry_mod.queries()
ORACLES = entry_mod.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    assert compare(df, con, ORACLES[name]) == []


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
