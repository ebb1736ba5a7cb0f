import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = r'''
import sys
sys.path.insert(0, REPO)
from pyspark.sql import SparkSession
from pickwise.plans import cv
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
rows = [(d, p, float(d), float(p), float(d * p % 7 + p)) for d in range(6) for p in range(4)]
df = spark.createDataFrame(rows, "Demand_ID long, Plant_ID long, DF1 double, PF1 double, Cost double")
out = cv.lasso_logo(df, ["DF1", "PF1"], [0.1], None).collect()
print("FOLDS", len(out))
spark.stop()
'''


def test_python_workers_need_no_installed_package():
    """The driver imports the package from a path only it knows (as the
    contract driver does); the Arrow solver must still run in the workers."""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    folder = tempfile.mkdtemp(prefix="pw-cwd-")
    res = subprocess.run([sys.executable, "-c", f"REPO = {REPO!r}\n" + SCRIPT], cwd=folder, env=env,
                         capture_output=True, text=True, timeout=600)
    assert "FOLDS 6" in res.stdout, res.stderr[-2000:]
