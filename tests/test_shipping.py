import os
import subprocess
import sys

CODE = """
import sys
sys.path.insert(0, {root!r})
import __spark_entry__ as E
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config(
    "spark.sql.shuffle.partitions", "2").getOrCreate()
print("ROWS", E.queries()["viewer_text"](spark, "/root/testdata/sf0.001").count())
"""


def test_queries_with_python_tasks_run_from_another_folder(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", CODE.format(root=root)], cwd=tmp_path, env=env,
                         capture_output=True, text=True, timeout=300)
    assert "ROWS 50" in out.stdout, out.stderr[-2000:]
