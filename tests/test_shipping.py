"""Python tasks must import the package on workers even when the driver runs
elsewhere with a plain session (the package is shipped with addPyFile)."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
import __spark_entry__ as E
# fresh process: the first Python operators to run are the TSQR fit and the MLP
assert len(E.queries()["poly_fit_d1"](spark, "/root/testdata/sf0.001").collect()) == 5
assert len(E.queries()["mlp_curve"](spark, "/root/testdata/sf0.001").collect()) > 0
rows = E.queries()["te_single_pvalue"](spark, "/root/testdata/sf0.001").collect()
assert len(rows) == 2 and all(r["p_value"] is not None for r in rows)
print("SHIPPED_OK")
spark.stop()
"""


def test_python_tasks_run_from_another_directory(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=str(tmp_path), env=env, capture_output=True,
                         text=True, timeout=900)
    assert "SHIPPED_OK" in out.stdout, out.stderr[-3000:]
