"""Driver contract: entry() runs; every registered query equals its DuckDB oracle (sf0.001)."""
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from compare_oracle import TABLES, digest  # noqa: E402

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from tidemark.workloads.oracle import oracle  # noqa: E402
from tidemark.workloads.queries import QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry(spark):
    df = entry(spark)
    assert df.count() > 0
    assert "recid" in df.columns


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(queries())
    assert set(QUERIES) == set(oracle())
    assert set(oracle_sql()) <= set(queries())


def test_entry_without_the_optional_packages(tmp_dir):
    """A copy without the text operators still imports, with all other queries; errors inside them are raised."""
    import shutil
    import subprocess
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    skip = shutil.ignore_patterns("llm", "corpus_pipeline.py", ".git", "__pycache__", "spark-warehouse", "tests")
    shutil.copytree(root, f"{tmp_dir}/repo", ignore=skip)
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), any(n.startswith('op') or n == 'pipeline' for n in q), len(e.oracle_sql()))"
    run = lambda: subprocess.run([sys.executable, "-c", code], cwd=f"{tmp_dir}/repo", capture_output=True, text=True)
    assert run().stdout.split() == [str(len(QUERIES)), "False", str(len(QUERIES))]
    os.makedirs(f"{tmp_dir}/repo/tidemark/llm")
    for name in ("__init__", "queries"):
        with open(f"{tmp_dir}/repo/tidemark/llm/{name}.py", "w") as f:
            f.write("import no_such_module\n" if name == "queries" else "")
    assert "no_such_module" in run().stderr


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(oracle_sql()[name])
    cols = [c[0] for c in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert len(rows) == len(drows)
    assert digest(df.columns, rows)[0] == digest(cols, drows)[0]
