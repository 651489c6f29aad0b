import shutil
import subprocess
import sys
from pathlib import Path

import __spark_entry__ as entry


def test_contract(spark, monkeypatch):
    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(queries) and len(queries) > 100
    assert all(callable(q) for q in queries.values())


def test_engine_alone(tmp_path):
    """Without the corpus folders and the pipeline, the entry imports and has the engine's queries."""
    here = Path(__file__).resolve().parent.parent
    shutil.copytree(here / "tidegrid", tmp_path / "tidegrid", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(here / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'win12_gap_fill' in e.oracle_sql() and not any(k.startswith('op') or k == 'pipeline' for k in q); print(len(q))"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True)
    assert int(out.stdout.split()[-1]) > 100
