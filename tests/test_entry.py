from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as contract

DATA = "/root/testdata/sf0.001"


def test_names():
    queries, sql = contract.queries(), contract.oracle_sql()
    assert set(sql) <= set(queries) and len(queries) >= 40


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["age_group", "gender", "dialect", "n", "cer"] and df.count() > 0


def test_llm_is_optional(tmp_path):
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.abspath(contract.__file__))
    shutil.copytree(os.path.join(root, "tidewright"), tmp_path / "tidewright", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(root, "__spark_entry__.py"), tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not [n for n in q if n.startswith('op') or n == 'pipeline']; e.oracle_sql()"
    env = {**os.environ, "PYTHONPATH": str(tmp_path)}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env=env)
    # and the rest's own tests pass without both folders
    shutil.copytree(os.path.join(root, "tests"), tmp_path / "tests", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    subprocess.run([sys.executable, "-m", "pytest", "tests", "-q", "-x", "-k", "not against_sql and not optional and not whole"], cwd=tmp_path, check=True, env=env)


@pytest.mark.parametrize("name", sorted(n for n in contract.oracle_sql() if not n.startswith("op") and n != "pipeline"))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{f}'")
    df = contract.queries()[name](spark, DATA)
    got = con.execute(contract.oracle_sql()[name])
    columns = [c[0] for c in got.description]
    assert sorted(columns) == sorted(df.columns)
    want = sorted((tuple(r) for r in got.fetchall()), key=repr)
    assert sorted((tuple(r) for r in df.select(*columns).collect()), key=repr) == want
