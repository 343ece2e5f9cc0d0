"""Every registered query of the bibliographic operators against its SQL."""

import pytest
from oracle import check, connect

from foliant import catalog

QUERIES, SQL = catalog.queries(), catalog.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, sf_dir, con, name):
    check(spark, sf_dir, con, QUERIES[name], SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    assert df.columns and df.count() >= 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_without_the_corpus_subpackage(tmp_path):
    """The entry imports, and the other queries are there, when foliant/llm and the pipeline are gone."""
    import os
    import shutil
    import subprocess
    import sys

    from conftest import ROOT

    shutil.copytree(f"{ROOT}/foliant", tmp_path / "foliant", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'hist_by_status' in q and not any(k.startswith('op1_') for k in q); e.oracle_sql()"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    assert subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env).returncode == 0
