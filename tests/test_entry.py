"""The entry works without the corpus operators, whatever is missing of them."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

REPO = Path(__file__).resolve().parents[1]
SAY = "import __spark_entry__ as e; q = e.queries(); print(len(q), any(n.startswith('op') and n[2].isdigit() for n in q), 'pipeline' in q)"


@pytest.mark.parametrize("case", ["no folder", "leftover folder", "no library"])
def test_entry_without_corpus(tmp_path, case):
    for name in ("orderlens", "verification"):
        shutil.copytree(REPO / name, tmp_path / name, ignore=shutil.ignore_patterns("__pycache__", "llm"))
    shutil.copy(REPO / "__spark_entry__.py", tmp_path)
    if case == "leftover folder":
        (tmp_path / "orderlens" / "llm" / "__pycache__").mkdir(parents=True)
    if case == "no library":
        (tmp_path / "orderlens" / "llm").mkdir()
        (tmp_path / "orderlens" / "llm" / "__init__.py").write_text("")
        (tmp_path / "orderlens" / "llm" / "queries.py").write_text("import a_library_that_is_missing\n")
    said = subprocess.run([sys.executable, "-c", SAY], cwd=tmp_path, capture_output=True, text=True, check=True)
    count, operators, pipeline = said.stdout.split()
    assert int(count) > 100 and (operators, pipeline) == ("False", "False")
