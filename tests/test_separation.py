"""The library stands without the subpackage for corpora."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def test_nothing_outside_imports_the_subpackage():
    for path in (ROOT / "plenum").rglob("*.py"):
        if "llm" not in path.relative_to(ROOT / "plenum").parts:
            assert "plenum.llm" not in path.read_text(), path


def test_entry_imports_without_it(tmp_path):
    import shutil

    shutil.copytree(ROOT / "plenum", tmp_path / "plenum", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'rule_cascade_orders' in q and not any(n.startswith('op') for n in q if n[2:3].isdigit()); e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=120)
