from __future__ import annotations

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def test_entry(spark):
    import __spark_entry__

    df = __spark_entry__.entry(spark)
    assert df.count() > 0 and "policy_count" in df.columns
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_library_stands_without_the_corpus_operators(tmp_path):
    """With the subpackage and the pipeline gone, the entry still imports and has all other queries."""
    import shutil

    shutil.copytree(ROOT / "gridloom", tmp_path / "gridloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; from gridloom import catalogue as c; assert set(e.queries()) == set(c.queries()) and e.oracle_sql(); print('fine')"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)}, capture_output=True, text=True)
    assert "fine" in out.stdout, out.stderr


def test_nothing_imports_the_corpus_operators():
    for f in (ROOT / "gridloom").rglob("*.py"):
        if "llm" not in f.relative_to(ROOT).parts:
            assert "gridloom.llm" not in f.read_text() and "import llm" not in f.read_text(), f
