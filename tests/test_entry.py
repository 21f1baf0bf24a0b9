"""The entry points as another program would call them: another folder, a session of its own."""

import os
import subprocess
import sys
from pathlib import Path

REPO = str(Path(__file__).parent.parent)

PROGRAM = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "2").getOrCreate()
import __spark_entry__ as entry
print(entry.entry(spark).count() > 0, entry.queries()["vec_topk"](spark, "/root/testdata/sf0.001").count() > 0)
"""


def test_from_another_folder(folder):
    clean = {name: value for name, value in os.environ.items() if name != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", PROGRAM, REPO], cwd=folder, env=clean, capture_output=True, text=True,
                          timeout=240)
    assert done.stdout.split() == ["True", "True"], done.stderr[-2000:]
