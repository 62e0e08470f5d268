"""The engine stands without the llm subpackage."""

import pathlib
import subprocess
import sys

ROOT = pathlib.Path(__file__).resolve().parent.parent


def test_nothing_else_imports_the_subpackage():
    for path in (ROOT / "rallyframe").rglob("*.py"):
        if "llm" not in path.relative_to(ROOT).parts:
            assert "llm" not in path.read_text(encoding="utf-8"), path


def test_entry_works_without_it():
    code = "import sys; sys.modules['rallyframe.llm'] = None; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; q = e.queries(); assert 'podium' in q and 'pipeline' not in q and not any(k.startswith('op1') for k in q) and set(e.oracle_sql()) == set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)
