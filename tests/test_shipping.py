import os
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
from marginalia.operators import neighbours, perceptron
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
rows = [(0, [3.0, 3.0], 1.0), (1, [4.0, 3.0], 1.0), (2, [1.0, 1.0], -1.0)]
df = spark.createDataFrame(rows, "id bigint, features array<double>, label double")
fit = perceptron.perceptron_fit(df, "mixing", shards=1)
assert [r.alpha for r in perceptron.perceptron_alpha(df, fit).orderBy("id").collect()] == [2, 0, 5]
assert neighbours.nearest(df, df, 2, pivots=2).count() == 6
print("shipped")
"""


def test_executors_need_no_copy_of_the_package(tmp_path):
    """Workers are started where the package cannot be found."""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    command = [sys.executable, "-c", SCRIPT.format(root=str(ROOT))]
    done = subprocess.run(command, cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.stdout.strip().endswith("shipped"), done.stderr[-2000:]
