"""The registry without the corpus folders."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
CORPUS = ("matchloom/llm", "tests/llm")


@pytest.mark.parametrize("gone", [CORPUS, (*CORPUS, "corpus_pipeline.py")])
def test_imports_without_the_corpus_folders(tmp_path, gone):
    skipped = {str(ROOT / g) for g in gone}

    def left_out(folder: str, names: list[str]) -> list[str]:
        return [n for n in names if n in (".git", "__pycache__") or str(Path(folder, n)) in skipped]

    shutil.copytree(ROOT, tmp_path / "repo", ignore=left_out)
    code = "import __spark_entry__ as e; q = e.queries(); assert set(e.oracle_sql()) <= set(q); print(*q)"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "repo", capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
    names = done.stdout.split()
    assert "gold_timeline" in names
    assert not [n for n in names if n == "pipeline" or n.startswith("op")]
