"""Every catalogue query against its DuckDB oracle on the smallest scale factor."""

import math
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from labelforge.plans.catalogue import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    return v


def _canon(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in data), key=repr)


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0
    assert df.columns == ["userId", "segment", "acct"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = queries()[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    sql = oracle_sql()[name]
    res = duck.execute(sql)
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert _canon(df.columns, got) == _canon(cols, res.fetchall())


def test_entry_works_without_the_optional_part(tmp_path):
    """The entry imports, with the catalogue's queries, where the optional files are gone."""
    import shutil
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copy(os.path.join(root, "__spark_entry__.py"), tmp_path)
    shutil.copytree(os.path.join(root, "labelforge"), tmp_path / "labelforge",
                    ignore=shutil.ignore_patterns("llm", "__pycache__"))
    out = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"],
                         cwd=tmp_path, capture_output=True, text=True, check=True).stdout.split()
    assert out == [str(len(QUERIES))] * 2
