"""The entry module, with and without the optional parts."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry

ROOT = Path(__file__).parent.parent


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert {"block_kinds", "asof_parent", "markdown_blocks"} <= set(entry.queries())


@pytest.mark.parametrize("pipeline", [False, True])
def test_import_without_optional_parts(tmp_path, pipeline):
    if pipeline and (ROOT / "corpus_pipeline.py").exists():
        shutil.copy(ROOT / "corpus_pipeline.py", tmp_path)
    shutil.copytree(ROOT / "sheaf", tmp_path / "sheaf", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; names = [*e.queries(), *e.oracle_sql()]; assert not any(n.startswith('op') and n[2].isdigit() or n == 'pipeline' for n in names), names; print(len(names))"
    got = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)})
    assert got.returncode == 0, got.stderr
    assert int(got.stdout) > 90


def test_entry_runs(spark):
    out = entry.queries()["block_kinds"](spark, "/root/testdata/sf0.001")
    assert out.columns == ["doc_id", "kind", "n_lines", "n_chars"] and out.count() > 0
