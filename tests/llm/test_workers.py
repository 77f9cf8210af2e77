import os
import subprocess
import sys
from pathlib import Path

SCRIPT = """
import sys, warnings
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "2").getOrCreate())
import __spark_entry__ as contract
for name, query in contract.queries().items():
    if name.startswith("op"):
        print(name, query(spark, "/root/testdata/sf0.001").count())
"""


def test_workers_do_not_need_the_package(tmp_path):
    """Every operator from a folder where workers cannot import the library."""
    root = Path(__file__).resolve().parents[2]
    script = tmp_path / "elsewhere.py"
    script.write_text(SCRIPT.format(root=str(root)))
    path = [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p and Path(p).resolve() != root]
    env = {**os.environ, "PYTHONPATH": os.pathsep.join(path)}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    counts = dict(line.split() for line in done.stdout.splitlines() if line.startswith("op"))
    assert len(counts) == 13 and all(int(n) > 0 for n in counts.values()), done.stderr[-2000:]
