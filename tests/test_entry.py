"""The driver's entry works with and without the training-data folder."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_entry_without_training_data(tmp_path):
    (tmp_path / "__spark_entry__.py").symlink_to(ROOT / "__spark_entry__.py")
    package = tmp_path / "paperloom"
    package.mkdir()
    for p in (ROOT / "paperloom").iterdir():
        if p.name not in ("llm", "__pycache__"):
            (package / p.name).symlink_to(p)
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not [k for k in q if k.startswith('op') or k == 'pipeline'], q; e.oracle_sql()"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env={"PYTHONPATH": str(tmp_path), "PATH": "/usr/bin:/bin"})
    assert done.returncode == 0, done.stderr[-800:]


def test_nothing_else_imports_training_data():
    for p in (ROOT / "paperloom").rglob("*.py"):
        if "llm" not in p.parts:
            assert "paperloom.llm" not in p.read_text()
            assert "from ..llm" not in p.read_text()
