"""Registered queries equal their SQL on the smallest tables."""

import os
import shutil
import subprocess
import sys

import pytest

from checks.compare import compare, connect
from checks.oracles import ORACLES
from checks.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLES) == {"gbt_forecast", "gbt_backtest"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, sf, con, name):
    got = QUERIES[name](spark, sf).toPandas()
    assert compare(got, con.execute(ORACLES[name]).df()) == ""


def test_entry(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.count() > 0 and "rsi_14" in df.columns
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("gone", [("barline/llm", "tests/llm"), ("barline/llm", "tests/llm", "corpus_pipeline.py")])
def test_entry_without_the_optional_operators(tmp_path, gone):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    copy = tmp_path / "repo"
    shutil.copytree(root, copy, ignore=lambda folder, names: [
        n for n in names if n.startswith(".") or n == "__pycache__"
        or os.path.relpath(os.path.join(folder, n), root) in gone])
    code = ("import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert set(o) <= set(q); "
            "print(len(q), [n for n in q if n.startswith('op') and n[2].isdigit() or n == 'pipeline'])")
    done = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, timeout=120,
                          env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
    assert done.stdout.split(maxsplit=1)[1].strip() == "[]" and int(done.stdout.split()[0]) == len(QUERIES), done.stderr
