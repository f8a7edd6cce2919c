"""The entry module with and without the optional subpackage."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).parents[1]


def test_every_sql_has_a_query():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries()) and "etl_full" in entry.queries()


def test_imports_without_the_subpackage(tmp_path):
    for p in ROOT.rglob("*.py"):
        rel = p.relative_to(ROOT)
        if "llm" in rel.parts or rel.name == "corpus_pipeline.py" or rel.parts[0] == "tests":
            continue
        to = tmp_path / rel
        to.parent.mkdir(parents=True, exist_ok=True)
        to.write_text(p.read_text(encoding="utf-8"), encoding="utf-8")
    code = "import __spark_entry__ as e; q = e.queries(); assert 'etl_full' in q and not any(n.startswith('op1') for n in q) and 'pipeline' not in q; e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)})


def test_nothing_else_imports_the_subpackage():
    for p in (ROOT / "rillflow").rglob("*.py"):
        if "llm" not in p.parts:
            assert "rillflow.llm" not in p.read_text(encoding="utf-8") or p.name == "__spark_entry__.py"
