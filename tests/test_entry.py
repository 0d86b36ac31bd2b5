"""The entry works without the optional subpackage and its pipeline."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
SHOW = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), any(n.startswith('op') and n[2].isdigit() or n == 'pipeline' for n in e.queries()))"


def shown(folder):
    # only what is in the folder may be imported, whatever the caller's path
    clean = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-B", "-c", SHOW], cwd=folder, capture_output=True, text=True, env=clean)
    assert run.returncode == 0, run.stderr
    return run.stdout.split()


@pytest.mark.parametrize("missing", [("ratecal/llm", "corpus_pipeline.py"), ("ratecal/llm",), ("corpus_pipeline.py",)])
def test_without_optional_parts(tmp_path, missing):
    shutil.copytree(ROOT, tmp_path / "repo", ignore=lambda folder, names: [
        n for n in names if n in (".git", "__pycache__") or str((Path(folder) / n).relative_to(ROOT)) in missing
    ])
    core, sqls, optional = shown(tmp_path / "repo")
    assert core == sqls and optional == "False"


def test_other_import_errors_are_not_hidden(tmp_path):
    shutil.copytree(ROOT, tmp_path / "repo", ignore=shutil.ignore_patterns(".git", "__pycache__", "llm", "corpus_pipeline.py"))
    (tmp_path / "repo" / "corpus_pipeline.py").write_text("import no_such_module_at_all\n")
    with pytest.raises(AssertionError, match="no_such_module_at_all"):
        shown(tmp_path / "repo")
