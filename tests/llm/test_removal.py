"""Without these folders the rest of the library still imports and registers its queries."""

import os
import shutil
import subprocess
import sys

from llm_cases import ROOT


def test_entry_without_the_operators(tmp_path):
    shutil.copytree(os.path.join(ROOT, "cinelens"), tmp_path / "cinelens",
                    ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), tmp_path)
    said = subprocess.run([sys.executable, "-B", "-c", "import __spark_entry__ as e; print(*e.queries())"],
                          cwd=tmp_path, capture_output=True, text=True, check=True,
                          env={**os.environ, "PYTHONPATH": ""}).stdout.split()
    assert "top_rated_per_decade" in said and not any(x.startswith("op") or x == "pipeline" for x in said)


def test_nothing_else_imports_them():
    for folder, _, names in os.walk(os.path.join(ROOT, "cinelens")):
        if os.path.basename(folder) != "llm":
            for n in names:
                if n.endswith(".py"):
                    assert "llm" not in open(os.path.join(folder, n)).read(), n


def test_a_missing_library_costs_only_these_queries(tmp_path):
    (tmp_path / "ahocorasick.py").write_text("raise ImportError('not here')")
    got = subprocess.run([sys.executable, "-B", "-c", "import __spark_entry__ as e; print(*e.queries())"],
                         cwd=ROOT, capture_output=True, text=True, check=True, env={**os.environ, "PYTHONPATH": str(tmp_path)})
    said = got.stdout.split()
    assert "top_rated_per_decade" in said and not any(x.startswith("op") or x == "pipeline" for x in said)
    assert "not here" in got.stderr
