"""The entry module without the optional part."""

import os
import shutil
import subprocess
import sys

import pytest

from tests.conftest import ROOT

SHOW = "import __spark_entry__ as E; print(*sorted(E.queries())); print(*sorted(E.oracle_sql()))"


@pytest.mark.parametrize("also", [(), ("corpus_pipeline.py",)])
def test_core_queries_stand_without_the_optional_part(tmp_path, also):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=lambda d, names: [
        n for n in names if n in (".git", "__pycache__", "llm") or (n in also and d == ROOT)])
    out = subprocess.run([sys.executable, "-c", SHOW], cwd=copy, env=os.environ | {"PYTHONPATH": str(copy)},
                         capture_output=True, text=True, timeout=120, check=True).stdout.split("\n")
    names, twins = out[0].split(), out[1].split()
    assert len(names) >= 67 and names == twins  # every core query has its twin
    assert not any(n.startswith("op") or n == "pipeline" for n in names)
