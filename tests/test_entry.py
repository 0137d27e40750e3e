"""The entry point with and without the training-data subpackage."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SAY = "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); print(len(q), any(k.startswith('op') for k in q), set(s) <= set(q))"


@pytest.mark.parametrize("left", ["nothing", "a folder", "broken imports"])
def test_without_the_subpackage(tmp_path, left):
    for name in ("__spark_entry__.py", "termloom"):
        source = os.path.join(ROOT, name)
        if os.path.isdir(source):
            shutil.copytree(source, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        else:
            shutil.copy(source, tmp_path / name)
    if left != "nothing":
        (tmp_path / "termloom/llm/__pycache__").mkdir(parents=True)
        (tmp_path / "corpus_pipeline.py").write_text("from termloom.llm import queries\n")
    if left == "broken imports":
        (tmp_path / "termloom/llm/queries.py").write_text("import a_library_that_is_not_there\n")
    out = subprocess.run([sys.executable, "-c", SAY], cwd=tmp_path, capture_output=True, text=True, check=True).stdout.split()
    assert int(out[0]) >= 70 and out[1:] == ["False", "True"]
