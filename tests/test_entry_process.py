"""The entry file works when loaded by path from elsewhere, in a bare session."""

import os
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = r"""
import importlib.util, json, sys
spec = importlib.util.spec_from_file_location("entry_mod", sys.argv[1])
m = importlib.util.module_from_spec(spec); spec.loader.exec_module(m)
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .getOrCreate())
df = m.entry(spark)
rows = df.collect()
print(json.dumps({"cols": df.columns, "rows": len(rows),
                  "queries": len(m.queries()), "oracle": len(m.oracle_sql()),
                  "core": len([q for q in m.queries() if q in m.QUERIES and q in m.oracle_sql()])}))
spark.stop()
"""


def test_entry_loads_by_path_in_a_bare_session():
    out = subprocess.run([sys.executable, "-c", SCRIPT, os.path.join(ROOT, "__spark_entry__.py")],
                         cwd=tempfile.mkdtemp(prefix="cinelens-entry-"), capture_output=True,
                         text=True, timeout=600, check=True)
    import json
    res = json.loads([x for x in out.stdout.splitlines() if x.startswith("{")][-1])
    assert res["cols"] == ["title", "highest_rating", "decade"]
    assert res["rows"] > 0
    assert res["core"] == 48 and res["queries"] >= res["oracle"] >= 48
